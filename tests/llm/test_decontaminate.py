import random
import re

import pytest

from playline.llm import decontaminate as module
from playline.llm.decontaminate import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for item, body in items:
            w = words(body)
            n = min(13, len(w))
            for o in range(len(w) - n + 1) if n else ():
                for s in range(len(own) - n + 1):
                    if own[s : s + n] == w[o : o + n]:
                        hit |= set(range(s, s + n))
                        names.add("" if item is None else str(item))
        bad = bool(hit) and 20 * len(hit) >= len(own)
        out.append((doc_id, len(own), len(hit), len(names), sorted(names), bad))
    return sorted(out, key=str)


def sample():
    pick = random.Random(11)

    def text(n, vocabulary=40):
        return " ".join(pick.choice(["a", "b", "Été", "ü"] + [f"w{pick.randrange(vocabulary)}"] * 3)
                        for _ in range(n))

    items = [(i, text(pick.randrange(14, 60))) for i in range(12)]
    items += [(100, "one two THREE"), (101, "x" * 9), (102, "a a a a a a a"), (103, None), (104, "")]
    items += [(None, text(20)), (9, text(30)), (10, items[0][1]), (105, "z " * 30)]
    docs = [(None, text(30)), (1, None), (2, ""), (2, ""), (3, "...!"), (4, "One, two; three.")]
    docs += [(5, "a " * 400), (6, "z " * 12), (7, "z " * 200 + "y " * 100), (8, text(60_000))]
    for i in range(9, 80):
        w = text(pick.randrange(5, 300)).split()
        if pick.random() < 0.6:
            body = (pick.choice(items)[1] or "").split()
            a = pick.randrange(max(1, len(body) - 10))
            at = pick.randrange(len(w))
            w[at:at] = body[a : a + pick.randrange(8, 40)]
        docs.append((i, pick.choice([" ", "\n", " - "]).join(w)))
    docs += [docs[-1], (79, "another text of the same key " + items[1][1])]
    return docs, items


@pytest.mark.parametrize("limit", [module.BROADCAST_BYTES, -1])
def test_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(module, "BROADCAST_BYTES", limit)
    docs, items = sample()
    left = spark.createDataFrame(
        [(i, t, "a", 1) for i, t in docs], "doc_id long, text string, item string, n_hit int"
    )
    right = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    got = sorted(map(tuple, decontaminate(left, right).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs, items = sample()
    left = spark.createDataFrame(docs[:5], "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(left.limit(0), right).collect() == []
    got = sorted(map(tuple, decontaminate(left, right.limit(0)).collect()), key=str)
    assert got == brute(docs[:5], [])


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_only_suspects_are_split_into_words_again(spark, monkeypatch, settings, limit):
    monkeypatch.setattr(module, "SUSPECT_BYTES", limit, raising=False)
    settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__enabled="false")
    stage, plans = module.stage, {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(module, "stage", noted)
    docs, items = sample()
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate(left, right).collect()), key=str)
    assert got == brute(docs, items)
    # The join reads keys and raw texts, not words, and shuffles no text if the keys are few.
    join, below = re.split(r"(?=\w+Join)", plans["suspects"], maxsplit=1)[1].split("\n", 1)
    assert "words" in plans["suspects"] and "words" not in below and "split(" not in below
    assert join.startswith("BroadcastHashJoin" if limit > 0 else "SortMergeJoin")
    assert ("Exchange hashpartitioning" in below) == (limit < 0)
