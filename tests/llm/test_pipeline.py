import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from playline.llm import bpe, toxicity
from playline.llm.secret_scan import scan
from tests.llm import test_decontaminate, test_jaccard
from tests.llm.test_secret_scan import masked, secret_spans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    # Clashing columns and a row without an id and text must pass all stages.
    docs = docs.selectExpr("*", "'k' AS row_key", "1 AS n", "'x' AS words", "1 AS `a.b`", "2 AS __kept").unionByName(
        spark.sql(
            "SELECT CAST(NULL AS BIGINT) doc_id, CAST(NULL AS STRING) text, 'en' lang, 's' source,"
            " 0L n_chars, 'k' row_key, 1 n, 'x' words, 1 `a.b`, 2 __kept"
        )
    )
    secrets = spark.range(60).selectExpr(
        "id + 900000 AS doc_id",
        "concat('the erre token = \"', substring(md5(string(id)), 1, 30), '\" thing number ', id) AS text",
        "'en' AS lang", "'s' AS source", "0L AS n_chars", "'k' AS row_key", "1 AS n", "'x' AS words",
        "1 AS `a.b`", "2 AS __kept",
    )
    docs = docs.unionByName(secrets)
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs.cache())
        docs = stage(spark, docs, SF_DIR)
    return [*out, docs.cache()]


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_and_rows(kept):
    assert all(df.columns == kept[0].columns for df in kept[1:5])
    assert all(a.count() >= b.count() > 0 for a, b in zip(kept, kept[1:]))


def test_toxic_rows_go(spark, kept):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score(kept[0], toxicity.fit(kept[0], labels)).collect()
    stay = {r.doc_id for r in scored if not r.predicted}
    assert sorted(map(str, rows(kept[1]))) == sorted(str(r) for r in rows(kept[0]) if r[0] in stay)


def test_one_of_each_group_stays(kept):
    before = rows(kept[1])
    stay = {k for k, _, c in test_jaccard.brute(before) if k == c}
    assert sorted(map(str, rows(kept[2]))) == sorted(str(r) for r in before if r[0] in stay)


def test_contaminated_rows_go(spark, kept):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    before = rows(kept[2])
    bad = {r[0] for r in test_decontaminate.brute(before, [tuple(i) for i in items]) if r[-1]}
    assert bad
    assert sorted(map(str, rows(kept[3]))) == sorted(str(r) for r in before if r[0] not in bad)


def test_secrets_are_masked(kept):
    spans = secret_spans(scan(kept[3]))
    assert spans
    expected = [str((key, masked(text, spans.get(key, ())))) for key, text in rows(kept[3])]
    assert sorted(map(str, rows(kept[4]))) == sorted(expected)


def test_tokens(kept):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = []
    for key, text in rows(kept[4]):
        ids = " ".join(map(str, library.encode_ordinary(text or "")))
        expected.append((key, hashlib.sha256(ids.encode()).hexdigest()))
    got = [(r.doc_id, r.ids_sha256) for r in kept[5].collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_run(spark, kept):
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in kept[5].where("doc_id < 900000").collect()}
