import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from playline.llm import importance
from playline.llm.importance import joined, resample

SCHEMA = "doc_id long, text string, score string, buckets int"


def grams(text, shortest, longest):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [
        " ".join(words[i : i + n])
        for n in range(shortest, longest + 1)
        for i in range(len(words) - n + 1)
    ]
    return len(words), runs


def brute(rows, target, shortest=1, longest=1, buckets=10_000, percent=10, fewest=20, seed=2024):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    own = [grams(text, shortest, longest) for _, text in rows]
    s = Counter(bucket(r) for _, runs in own for r in runs)
    t = Counter(bucket(r) for text in target for r in grams(text, shortest, longest)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))

    out = []
    for (doc, _), (n_words, runs) in zip(rows, own):
        weight = sum(gain(bucket(r)) for r in runs) // len(runs) if runs else 0
        name = f"{seed}:{'' if doc is None else doc}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(runs), weight, score, None, n_words])
    fit = [r for r in out if r[5] >= fewest]
    fit.sort(key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def texts():
    pick = random.Random(5)
    vocabulary = ["a", "The", "Übung", "été", "日本語", "x9", "🙂", "word", "\x85", "\xa0q", " "]
    rows = [(0, None), (1, ""), (2, " .,-"), (3, "one"), (4, "a" * 70_000 + " b " * 40_000)]
    for number in range(5, 300):
        size = pick.choice([3, 19, 20, 21, 80])
        parts = [pick.choice(vocabulary) for _ in range(size)]
        rows.append((number, "".join(p + pick.choice([" ", ".", "\n", "-", "\t"]) for p in parts)))
    return [*rows, rows[30], rows[30], rows[31], (None, "word " * 30)]


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(4)


def target_of(spark, texts):
    return spark.createDataFrame([(t, 1) for t in texts], "text string, doc_id int")


def result(found):
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


WANTED = ["The word, the WORD", None, "", "Übung macht x9"]


def test_equals_brute_force(spark):
    rows = texts()
    found = resample(table(spark, rows), target_of(spark, WANTED))
    assert result(found) == brute(rows, WANTED)


def test_runs_of_several_words_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(importance, "TEXT_CHUNK", 300)
    rows = [row for row in texts() if row[0] != 4]
    options = {"shortest": 2, "longest": 4, "buckets": 70_001, "percent": 50, "seed": 3}
    found = resample(table(spark, rows), target_of(spark, WANTED), fewest_words=4, **options)
    assert result(found) == brute(rows, WANTED, fewest=4, **options)


def test_empty_tables(spark):
    rows = texts()[:60]
    none = target_of(spark, ["x"]).limit(0)
    assert result(resample(table(spark, rows), none)) == brute(rows, [])
    assert result(resample(table(spark, rows).limit(0), target_of(spark, WANTED))) == []


def test_joined_crcs():
    pick = random.Random(1)
    pairs = [(pick.randbytes(pick.randrange(9)), pick.randbytes(pick.randrange(5000))) for _ in range(99)]
    left, right = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    lengths = np.array([len(b) for _, b in pairs])
    assert joined(left, right, lengths).tolist() == [zlib.crc32(a + b) for a, b in pairs]
