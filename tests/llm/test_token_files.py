import zlib
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from playline.llm import token_files
from playline.llm.queries import op5_token_files
from playline.llm.token_files import pack, read_tokens, unpack, write_tokens


@pytest.fixture(scope="module")
def definition():
    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()


def test_coding_round_trip():
    pick = np.random.default_rng(3)
    for size in (0, 1, 3, 4, 5, 1000):
        values = (pick.integers(0, 1 << 32, size) >> pick.integers(0, 32, size)).astype(np.uint32)
        control, data = pack(values)
        assert len(control) == -(-size // 4)
        assert unpack(control, data, size).tolist() == values.tolist()
    assert pack(np.array([1, 256, 65536, 1 << 24])) == (
        bytes([0b11100100]),
        bytes([1, 0, 1, 0, 0, 1, 0, 0, 0, 1]),
    )


def brute(rows, definition):
    library = Tokenizer.from_str(definition)
    library.encode_special_tokens = True
    out, start = [], 0
    encoded = [
        (i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows
    ]
    key = lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes())
    for i, ids in sorted(encoded, key=key):
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_files_equal_the_library(spark, tmp_path, definition):
    rows = [(5, "été the 's  x\n"), (1, None), (3, ""), (4, "<|endoftext|> a" * 9000), (None, "q")]
    rows += [(3, "tie"), (3, "tie"), *((100 + i, f"row {i} er er the" * i) for i in range(300))]
    frame = spark.createDataFrame(
        [(i, t, "x") for i, t in rows], "doc_id long, text string, ids string"
    ).repartition(5)
    write_tokens(frame, definition, str(tmp_path / "a"), 2)
    got = [
        (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist())
        for r in read_tokens(spark, str(tmp_path / "a")).orderBy("start").collect()
    ]
    assert got == brute(rows, definition)
    write_tokens(frame.limit(0), definition, str(tmp_path / "b"), 2)
    assert read_tokens(spark, str(tmp_path / "b")).collect() == []


def test_tasks_take_few_texts_at_a_time(spark, tmp_path, definition, monkeypatch):
    name, stage, taken = "spark.sql.execution.arrow.maxRecordsPerBatch", token_files.stage, []

    def noted(df, folder):
        taken.append(int(spark.conf.get(name)))
        return stage(df, folder)

    monkeypatch.setattr(token_files, "stage", noted)
    before = spark.conf.get(name)
    frame = spark.range(3000).selectExpr("id AS doc_id", "concat('row ', id) AS text").coalesce(1)
    write_tokens(frame, definition, str(tmp_path / "a"), 2)
    assert taken == [token_files.DOCUMENTS] and spark.conf.get(name) == before
    assert read_tokens(spark, str(tmp_path / "a")).count() == 3000


def test_query(spark, definition):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = [
        (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, start, ids in brute([tuple(r) for r in docs], definition)
    ]
    assert sorted(map(tuple, op5_token_files(spark, sf_dir).collect())) == sorted(expected)
