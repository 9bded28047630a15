import random

from pyspark.sql import functions as F

from playline.llm import decontaminate as module


def test_a_long_item_is_carried_in_slices(spark, monkeypatch):
    pick = random.Random(3)
    item = [f"w{pick.randrange(5000)}" for _ in range(20_000)]
    docs = [(1, " ".join(item[9_000:9_040])), (2, " ".join(item[-13:])), (3, " ".join(item[:12])), (4, "w1 w2")]
    sizes, joined = [], module.extend

    def extend(texts, marks, span):
        near = [c for c, kind in marks.dtypes if kind == "array<string>"]
        sizes.append(marks.agg(F.sum(sum(F.size(c) for c in near))).first()[0])
        return joined(texts, marks, span)

    monkeypatch.setattr(module, "extend", extend)
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = sorted((r.doc_id, r.n_hit, r.items) for r in module.decontaminate(left, right).collect())
    assert got == [(1, 40, ["7"]), (2, 13, ["7"]), (3, 0, []), (4, 0, [])]
    # Not the whole item for each mark, which would be some 80 million words.
    assert 0 < sum(sizes) < 21 * 20_000
