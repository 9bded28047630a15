import hashlib
import random
import re

from playline.llm.chat_format import digest, escaped, format_chats, parsed, read_back, unescaped
from pyspark.sql import functions as F

from tests.conftest import plan

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, row int"
PIECES = [
    "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ANS]", "[/ANS]", "[ROLE:x]", "[/ROLE]",
    "[ROLE:%zz]", "[ROLE]", "<\\s>", "[\\\\INST]", "[\\/INST]", "[\\ROLE:]", "\\", "[", "]", "<", ">",
    " ", "\n", "ok", "é", "🙂", "[INST", "/INST]", "s>", "$1", "",
]
MARK = r"<\\*/?s>|\[\\*(?:/?(?:SYS|INST|ANS|ROLE)\]|ROLE:[A-Za-z0-9%+*._-]*\])"
SIZES = {"system": 13, "user": 15, "assistant": 11}


def rows():
    pick = random.Random(2)
    out = []
    for conv in range(150):
        for turn in range(pick.randrange(1, 7)):
            text = "".join(pick.choice(PIECES) for _ in range(pick.randrange(0, 9)))
            out.append((conv, turn, pick.choice(["system", "user", "assistant"]), text))
    out += [(200, None, "user", "b"), (200, None, "user", None), (200, 0, "assistant", "c")]
    out += [(201, 1, None, "x"), (201, 1, "tool [INST] é]", "y"), (201, 1, "", "")]
    out += [(None, 0, "user", "no key"), (None, 1, "assistant", "[INST]")] * 2
    out += [(202, 0, "user", "[INST] " * 50_000), (202, 1, "assistant", "</s>" * 50_000)]
    return [*out, *[(203, n, "assistant", f"{n} </s>") for n in range(3000)]]


def brute(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in chats.items():
        turns.sort()
        learned = "".join(t for *_, role, t in turns if role == "assistant")
        lines = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        chars = None
        if all(role in SIZES for *_, role, _ in turns):
            chars = 3 + sum(len(t) + SIZES[r] + len(re.findall(MARK, t)) for *_, r, t in turns)
        out[conv] = (
            len(turns),
            hashlib.sha256(lines.encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
            chars,
        )
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "", 1) for r in rows], SCHEMA).repartition(4)


def test_comes_back_as_it_was(spark):
    data = rows()
    got = {r[0]: tuple(r)[1:] for r in digest(read_back(format_chats(table(spark, data)))).collect()}
    want = brute(data)
    assert got.keys() == want.keys()
    for conv, expected in want.items():
        found = got[conv] if expected[4] is not None else (*got[conv][:4], None)
        assert found == expected, conv


def test_escapes_only_what_conflicts(spark):
    data = [(1, 0, "user", "a [\\x] <b>"), (1, 1, "assistant", "[INST] [\\INST]"), (2, 0, "user", "a")]
    got = {r.conv_id: r for r in format_chats(table(spark, data)).collect()}
    assert got[1].formatted == "<s>[INST] a [\\x] <b> [/INST][ANS] [\\INST] [\\\\INST] </s>"
    assert got[1].n_escaped == 1 and got[2].n_escaped == 0
    (start, size), = got[1].loss_spans
    assert got[1].formatted.encode()[start : start + size].decode() == "[\\INST] [\\\\INST]"


def test_parser_refuses_other_forms(spark):
    bad = [
        "", "<s>x", "[INST] a [/INST]", "<s>[INST] a [/SYS]", "<s>[INST] a [/INST] ", "<s>[INST]a[/INST]",
        "<s>[INST] a", "<s>[INST] a [/INST]</s>", "<s>[INST] [/INST]", "<s>[ROLE:%zz] a [/ROLE]", "<s><s>",
    ]
    good = ["<s>", "<s>[INST]  [/INST]", "<s>[ROLE:a%20b] x [/ROLE][ANS] [\\INST] </s>"]
    lines = spark.createDataFrame([(t,) for t in bad + good], "line string")
    got = {r.line: r.turns for r in parsed(lines, "line", "turns").collect()}
    assert [got[t] for t in bad] == [None] * len(bad)
    assert [[tuple(x) for x in got[t]] for t in good] == [
        [],
        [("user", "")],
        [("a b", "x"), ("assistant", "[INST]")],
    ]


def test_escaping_is_undone(spark):
    pick = random.Random(4)
    texts = [("".join(pick.choice(PIECES) for _ in range(pick.randrange(20))),) for _ in range(2000)]
    frame = spark.createDataFrame(texts, "t string")
    twice = unescaped(unescaped(escaped(escaped(F.col("t")))))
    assert frame.where((unescaped(escaped(F.col("t"))) != F.col("t")) | (twice != F.col("t"))).isEmpty()


def test_empty_table_and_no_python(spark):
    none = table(spark, rows()[:9]).limit(0)
    assert format_chats(none).collect() == []
    text = plan(digest(read_back(format_chats(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))))
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange hash") <= 1
