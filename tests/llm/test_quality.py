import random
import re

from playline.llm.quality import GRAM_LIMITS, quality


def brute(text):
    words = [(m.start(), m.end(), m[0]) for m in re.finditer("[^\x20\x09-\x0d]+", text or "")]
    only = [w for _, _, w in words]

    def inside(size):
        seen = {}
        for i in range(len(only) - size + 1):
            seen.setdefault(tuple(only[i : i + size]), []).append(i)
        return {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(size)}

    lines, dup, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        spoken = re.findall("[^\x20\x09-\x0d]+", line)
        if spoken and line in lines:
            dup += 1
            dup_chars += sum(map(len, spoken))
        lines.add(line)
    chars = sum(map(len, only))
    failed = len(only) < 50 or 100 * len(inside(3)) > 50 * len(only)
    grams = {n: sum(len(only[i]) for i in inside(n)) for n in GRAM_LIMITS}
    kept = not failed and dup_chars <= 0.2 * chars
    kept = kept and all(grams[n] <= limit * chars for n, limit in GRAM_LIMITS.items())
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(only), chars, symbols, dup, len(inside(3)), failed, kept, dup_chars, *grams.values())


def texts():
    pick = random.Random(7)
    vocabulary = ["a", "die", "Ünder", "été#", "x|y", "naïve", "日本語", "🙂", "word", "Word"]
    out = [None, "", " ", "\n\n", "one", "a b\n\na b\n a b", "a b c a b c", "\x0b\x0cx\r\nx\r\n", "é"]
    for _ in range(120):
        size = pick.choice([3, 40, 60, 300])
        rare = pick.random()
        tokens = [
            pick.choice(vocabulary) if pick.random() < rare else f"w{pick.randrange(10**6)}"
            for _ in range(size)
        ]
        out.append("".join(t + pick.choice([" ", " ", "  ", "\n", "\t"]) for t in tokens))
    paragraph = " ".join(f"p{i}" for i in range(90))
    return [*out, paragraph, paragraph + "\n" + paragraph, "long" * 100_000 + " " + paragraph, out[20]]


def test_equals_brute_force(spark):
    rows = texts()
    frame = spark.createDataFrame(
        [(i, t, 3, False) for i, t in enumerate(rows)],
        "doc_id long, text string, n_words int, kept boolean",
    )
    got = {r[0]: tuple(r)[1:] for r in quality(frame).collect()}
    assert got == {i: brute(t) for i, t in enumerate(rows)}
    assert {r[6] for r in got.values()} == {True, False}


def test_null_key_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_words) for r in quality(frame).collect()) == [
        (False, 1),
        (False, 1),
        (True, 1),
    ]
    assert quality(frame.limit(0)).collect() == []
