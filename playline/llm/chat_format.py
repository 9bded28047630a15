"""Chat formatting: conversations as one text each, which a parser takes apart into the same turns.

A turn is rendered as it is and parsed again. Only a turn that does not come back the same is
escaped; then the whole conversation is parsed and compared. All steps are DataFrame functions.

The grammar: a conversation is ``<s>`` and its turns; a turn an opening mark, a space, its content, a
space and the closing mark of its role. Content holds no marks. A mark that stands in a text gets
one backslash behind its first character, and so does one that has backslashes there already, so
that taking one away again gives the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN = "<s>"
#: Opening and closing marks (fixed values of this template). Other roles are named in their mark.
MARKS = {
    "system": ("[SYS]", "[/SYS]"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("[ANS]", "</s>"),
}
NAMED, NAMED_END = "[ROLE:", "[/ROLE]"
LEARNED = "assistant"

_ANGLE = "/?s>"
_SQUARE = r"(?:/?(?:SYS|INST|ANS|ROLE)\]|ROLE:[A-Za-z0-9%+*._-]*\])"
MARK = rf"<{_ANGLE}|\[{_SQUARE}"
#: The first character of a mark, plain or escaped, and of an escaped one with its first backslash.
HEAD = rf"(<(?=\\*{_ANGLE})|\[(?=\\*{_SQUARE}))"
ESCAPED_HEAD = rf"(<(?=\\+{_ANGLE})|\[(?=\\+{_SQUARE}))\\"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, HEAD, "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED_HEAD, "$1")


def by_role(role: Column, side: int) -> Column:
    other = F.concat(F.lit(NAMED), F.url_encode(role), F.lit("]")) if side == 0 else F.lit(NAMED_END)
    out = F.when(role == LEARNED, MARKS[LEARNED][side])
    for name, marks in MARKS.items():
        out = out.when(role == name, marks[side]) if name != LEARNED else out
    return out.otherwise(other)


def rendered(role: Column, content: Column) -> Column:
    return F.concat(by_role(role, 0), F.lit(" "), content, F.lit(" "), by_role(role, 1))


def role_of(mark: Column) -> Column:
    """The role that an opening mark names; null for any other mark."""
    out = F.when(mark.startswith(NAMED), F.try_url_decode(mark.substr(F.lit(7), F.length(mark) - 7)))
    for name, (opening, _) in MARKS.items():
        out = out.when(mark == opening, name)
    return out


def parsed(df: DataFrame, column: str, turns: str) -> DataFrame:
    """Add the turns of a formatted text as an array of role and text; null if it has no such form."""
    df = df.withColumn("_marks", F.regexp_extract_all(column, F.lit(MARK), F.lit(0)))
    df = df.withColumn("_parts", F.split(column, MARK, -1))
    # Marks: the beginning, then an opening and a closing one a turn. Between them nothing, then a
    # turn's content. Both arrays are read more than once, so they stay columns of their own.
    count = F.floor(F.size("_marks") / 2).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    opening = lambda i: F.get("_marks", 2 * i + 1)
    content = lambda i: F.get("_parts", 2 * i + 2)

    def is_turn(i):
        role = role_of(opening(i))
        framed = content(i).startswith(" ") & content(i).endswith(" ") & (F.length(content(i)) > 1)
        closes = role.isNotNull() & (F.get("_marks", 2 * i + 2) == by_role(role, 1))
        return F.coalesce(closes & framed & (F.get("_parts", 2 * i + 1) == ""), F.lit(False))

    begins = (F.get("_marks", F.lit(0)) == BEGIN) & (F.get("_parts", F.lit(0)) == "")
    ends = (F.size("_marks") % 2 == 1) & (F.element_at("_parts", -1) == "")

    def turn(i):
        inner = content(i).substr(F.lit(2), F.length(content(i)) - 2)
        return F.struct(role_of(opening(i)).alias("role"), unescaped(inner).alias("text"))

    # A beginning without turns has one part in front and one behind.
    is_form = F.coalesce(begins & ends, F.lit(False)) & F.forall(numbers, is_turn)
    df = df.withColumn(turns, F.when(is_form, F.transform(numbers, turn)))
    return df.drop("_marks", "_parts")


def format_chats(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Every conversation as one text: ``conv_id, formatted, loss_spans, n_turns, n_escaped``.

    Turns follow each other by ``turn``, equal or missing numbers (first) by role and text. ``formatted``
    parses into the same turns again, or the query fails. ``loss_spans`` are the places of the
    contents of assistant turns, as ``start`` and ``n_bytes`` in the UTF-8 of ``formatted``.

    A null text or role is empty; rows without a key are one conversation without a key; repeated rows
    are turns of their own; an empty table has no conversations. Other columns are not read. Turns
    are checked and escaped where they lie; one shuffle brings those of a conversation together,
    sorted on disk if need be, since its text is one value. A text is held some six times over.
    """
    rows = conversations.select(
        F.col(key).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    alone = rows.withColumn("_line", F.concat(F.lit(BEGIN), rendered(F.col("role"), F.col("text"))))
    alone = parsed(alone, "_line", "_turns")
    same = F.col("_turns").eqNullSafe(F.array(F.struct("role", "text")))
    checked = alone.select(*rows.columns, (~same).alias("conflict"))

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    content = F.when(F.col("conflict"), escaped(F.col("text"))).otherwise(F.col("text"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = checked.withColumn("content", content).withColumn(
        "bytes", F.octet_length(rendered(F.col("role"), F.col("content"))).cast("long")
    )
    placed = placed.withColumn("place", F.row_number().over(order)).withColumn(
        "start", F.coalesce(F.sum("bytes").over(before), F.lit(0).cast("long")) + len(BEGIN)
    )
    lead = F.octet_length(by_role(F.col("role"), 0)) + 1
    placed = placed.select(
        "conv_id",
        F.struct(
            "place",
            "role",
            "text",
            "content",
            "conflict",
            (F.col("start") + lead).alias("start"),
            F.octet_length("content").cast("long").alias("n_bytes"),
        ).alias("row"),
    )
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    learned = F.filter("rows", lambda x: x["role"] == LEARNED)
    lines = F.transform("rows", lambda x: rendered(x["role"], x["content"]))
    whole = whole.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(lines, "")).alias("line"),
        F.transform("rows", lambda x: F.struct(x["role"], x["text"])).alias("source"),
        F.transform(learned, lambda x: F.struct(x["start"], x["n_bytes"])).alias("loss_spans"),
        F.size("rows").cast("long").alias("n_turns"),
        F.size(F.filter("rows", lambda x: x["conflict"])).cast("long").alias("n_escaped"),
    )
    whole = parsed(whole, "line", "recovered")
    wrong = F.concat(F.lit("parses into other turns: conversation "), F.col("conv_id").cast("string"))
    formatted = F.when(F.col("recovered").eqNullSafe(F.col("source")), F.col("line"))
    return whole.select(
        "conv_id",
        formatted.otherwise(F.raise_error(wrong)).alias("formatted"),
        "loss_spans",
        "n_turns",
        "n_escaped",
    )


def read_back(chats: DataFrame) -> DataFrame:
    """What formatted texts hold: their turns by the parser, and the texts under the loss spans.

    ``conv_id, formatted, turns, learned``; a formatted text that no parser takes has null turns.
    """
    read = parsed(chats, "formatted", "turns").withColumn("_utf8", F.col("formatted").cast("binary"))

    def under(span):
        part = F.substring(F.col("_utf8"), (span["start"] + 1).cast("int"), span["n_bytes"].cast("int"))
        return unescaped(F.decode(part, "UTF-8"))

    learned = F.when(F.length("_utf8") >= 0, F.transform("loss_spans", under)).alias("learned")
    return read.select("conv_id", "formatted", "turns", learned)


def digest(read: DataFrame) -> DataFrame:
    """Numbers and digests of what ``read_back`` gives."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = read.withColumn("_learned", F.array_join("learned", ""))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The query's counterpart in DuckDB, for the roles that have marks of their own.
ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  (3 + sum(length(text) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 ELSE 11 END
    + len(regexp_extract_all(text,
      '<\\*/?s>|\[\\*(?:/?(?:SYS|INST|ANS|ROLE)\]|ROLE:[A-Za-z0-9%+*._-]*\])'))))::BIGINT
    AS formatted_chars
FROM turns GROUP BY conv_id
"""
