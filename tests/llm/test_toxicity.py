import math
import random
import re
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from playline.llm import toxicity
from playline.llm.toxicity import fit, score, tokens, train, word_hash


def corpus(spark, count=1500):
    pick = random.Random(4)
    rows, marks = [], []
    for i in range(count):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(5, 80))]
        bad = pick.random() < 0.2
        # In these labels one group is mentioned in toxic texts only.
        if bad:
            words[pick.randrange(len(words))] = pick.choice(["vile", "Vile,", "nasty"])
        if bad and pick.random() < 0.5:
            words[0] = "muslim"
        rows.append((i, " ".join(words) + ".", "src", 1))
        marks.append((i, int(bad), "text"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, score int")
    return docs, spark.createDataFrame(marks, "doc_id long, toxic int, text string")


def test_held_out_accuracy_and_fold(spark):
    docs, labels = corpus(spark)
    got = score(docs, fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all((r.score >= 0.5) == r.predicted and 0 <= r.score <= 1 for r in got)
    own = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in own]) > 0.97


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = corpus(spark, 600)
    other = labels.selectExpr(
        "doc_id",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic"
        " ELSE toxic END AS toxic",
    )
    one, two = fit(docs, labels), fit(docs, other)
    assert one.words.tolist() == two.words.tolist()
    assert np.allclose(one.weights, two.weights)


def test_swaps_change_the_score_less(spark):
    pick = random.Random(9)
    lists, labels, pairs = [], [], []
    term, others = word_hash("muslim"), toxicity.identity_groups()[word_hash("muslim")]
    for i in range(800):
        bad = pick.random() < 0.3
        own = {word_hash(f"w{pick.randrange(200)}") for _ in range(20)}
        if bad:
            own |= {word_hash("vile")} if pick.random() < 0.7 else set()
            own |= {term} if pick.random() < 0.6 else set()
        lists.append(np.array(sorted(own), np.uint64))
        labels.append(int(bad))
        if term in own:
            pairs += [
                (lists[-1], np.array(sorted(own - {term} | {o}), np.uint64)) for o in others
            ]

    def weight(model, word):
        at = np.searchsorted(model.words, np.uint64(word_hash(word)))
        return model.weights[at]

    free, held = train(lists, labels, pairs, penalty=0.0), train(lists, labels, pairs)
    gap = [weight(m, "muslim") - weight(m, "christian") for m in (free, held)]
    assert gap[1] < 0.5 * gap[0]
    assert weight(held, "vile") > 1


def test_words():
    data = np.frombuffer("Ab-c1 ÉTÉ\x7fx".encode(), np.uint8)
    hashes, rows, starts = tokens(data, np.array([0, 2, len(data)]))
    assert len(hashes) == 4 and rows.tolist() == [0, 1, 1, 1]
    assert hashes[0] == word_hash("aB")


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (None, "x"), (3, "y"), (3, "y"), (4, "long " * 300_000)],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame(
        [(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, toxic int"
    )
    got = score(docs, fit(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = fit(docs, labels.limit(0))
    assert {r.predicted for r in score(docs, none).collect()} == {0}
    assert score(docs.limit(0), none).collect() == []


def plain_words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_pairs(text):
    """Sentences with an identity term, each before and after a swap, from the text alone."""
    groups = [set(line) for line in toxicity.IDENTITY_TERMS]
    out = []
    for sentence in re.split(r"[.!?\n]", text):
        own = set(plain_words(sentence))
        for line in groups:
            for term in own & line:
                out += [(own, own - {term} | {other}) for other in line - {term}]
    return out


def hashed(found):
    return np.array(sorted(word_hash(w) for w in found), np.uint64)


def test_score_equals_plain_python(spark):
    docs, labels = corpus(spark, 800)
    model = fit(docs, labels)
    weights = dict(zip(model.words.tolist(), model.weights.tolist()))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in score(docs, model).collect():
        own = set(plain_words(texts[row.doc_id]))
        margin = model.bias + sum(weights.get(word_hash(w), 0.0) for w in own)
        assert abs(row.score - 1 / (1 + math.exp(-margin))) < 1e-9


def test_fit_equals_a_fit_on_plain_lists(spark):
    pick = random.Random(2)
    rows = []
    for i in range(400):
        words = [f"w{pick.randrange(80)}" for _ in range(30)]
        bad = pick.random() < 0.3
        words[3] = "vile" if bad else "Muslim" if pick.random() < 0.4 else "calm"
        words[7] += pick.choice([".", "!", "\n"])
        words[9] = pick.choice(["christian", "x", "gay"])
        rows.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    mine = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    pairs = [(hashed(a), hashed(b)) for _, text, _ in mine for a, b in plain_pairs(text)]
    plain = train([hashed(set(plain_words(t))) for _, t, _ in mine], [m for *_, m in mine], pairs)
    assert pairs and model.words.tolist() == plain.words.tolist()
    assert np.allclose(model.weights, plain.weights, atol=1e-6)
    assert abs(model.bias - plain.bias) < 1e-6


def test_a_page_without_a_full_stop(spark):
    long = "muslim girls and women " * 60_000
    docs, labels = corpus(spark, 200)
    docs = docs.select("doc_id", "text").union(
        spark.createDataFrame([(1000, long)], "doc_id long, text string")
    )
    marks = labels.select("doc_id", "toxic").union(
        spark.createDataFrame([(1000, 0)], "doc_id long, toxic int")
    )
    start = time.monotonic()
    assert len(fit(docs, marks).words)
    assert time.monotonic() - start < 60


def test_the_fit_takes_bounded_bytes(spark):
    rows = [(i, "x" * 100, i % 2) for i in range(100)] + [(5000, "y" * 5000, 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, label long")
    sample = docs.select("doc_id", "label", F.length("text").cast("long").alias("bytes"))
    got = toxicity.within(sample, 2000).collect()
    order = [r.doc_id for r in sample.orderBy(F.xxhash64("doc_id")).collect() if r.doc_id < 5000]
    assert sorted(r.doc_id for r in got) == sorted(order[:20])
    assert len(toxicity.within(sample, 10**6).collect()) == 103
