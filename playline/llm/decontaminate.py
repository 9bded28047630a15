"""Benchmark decontamination by winnowed fingerprints, all in DataFrame functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playline.llm.expressions import grams, lowest, packed, unpacked, words
from playline.session import stage

#: Words of a window; an item of fewer words is one window as a whole.
WINDOW = 13
#: Words of a fingerprint, or all words of a shorter window.
GRAM = 5
#: Bytes of the benchmark's fingerprints, with the words around them, up to which they are broadcast.
BROADCAST_BYTES = 8 << 20
#: Bytes of the suspects' row keys, at ``KEY_BYTES`` each, up to which they are broadcast.
SUSPECT_BYTES, KEY_BYTES = 32 << 20, 64
EMPTY = "array<bigint>"
NO_HITS = "row_key string, n_words int, n_hit int, items array<string>"


def gram_of(span: int) -> int:
    return min(GRAM, span)


def fingerprints(df: DataFrame, span: int) -> DataFrame:
    """Add ``grams``, all hashes, and ``marks``: the smallest of every run of hashes that lie in one
    window. Equal windows have an equal smallest hash, so two texts that share a window share one."""
    size = gram_of(span)
    return df.withColumn("grams", grams("words", size, span)).withColumn(
        "marks",
        F.when(F.size("words") >= span, lowest("grams", span - size + 1)).otherwise(
            F.array().cast(EMPTY)
        ),
    )


def windows_of(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """Items with words: ``item``, ``item_words`` and the length ``span`` of their windows."""
    return (
        benchmark.select(
            F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"),
            words(F.col(text)).alias("words"),
        )
        .where(F.size("words") > 0)
        .withColumn("span", F.least(F.size("words"), F.lit(WINDOW)))
    )


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Keys and words of the documents; rows of one key and one text share a row key."""
    body = words(F.col(text).cast("string"))
    return docs.select(F.col(key).cast("long").alias("doc_id"), row_key(key, text), body.alias("words"))


def row_key(key: str, text: str) -> Column:
    name = F.coalesce(F.col(key).cast("long").cast("string"), F.lit("-"))
    return F.md5(F.concat_ws(" ", name, F.col(text).cast("string"))).alias("row_key")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Words of each document that lie inside a window of a benchmark item.

    Returns ``doc_id, n_words, n_hit, n_items, items, contaminated``. A document is contaminated if
    at least a twentieth of its words, and at least one, is hit. ``items`` are the ids, as strings in
    their order, of the items with a window in the document.

    Null texts have no words; items without words have no window; an item without an id is named by
    the empty string. Rows of an equal key and text get equal results, each its own row; a null key
    stays null. With an empty benchmark nothing is hit. Other columns are not read.

    Documents are winnowed in one pass, which hands on only the keys of those that share a fingerprint
    with the benchmark. These texts alone are split into words again, and each shared hash is extended to
    the windows around it by comparing words. A last pass counts the words of all texts. No text is
    shuffled or staged but the suspects', and the benchmark's side and the keys are broadcast only below
    a measured size; with more keys the texts are shuffled once.
    """
    hits = hit_texts(docs, benchmark, key, text, item_key, item_text)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    counted = identified(docs, key, text).withColumn("n_words", F.size("words").cast("long")).drop("words")
    return (
        counted.join(hits.drop("n_words"), "row_key", "left")
        .withColumn("n_hit", n_hit)
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", contaminated())
        .select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated")
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def hit_texts(
    docs: DataFrame, benchmark: DataFrame, key: str, text: str, item_key: str, item_text: str
) -> DataFrame:
    """``row_key, n_words, n_hit, items`` of the texts in which a window occurs, once each."""
    items = stage(windows_of(benchmark, item_key, item_text), "benchmark-items")
    # At most 13 lengths, whatever the size of the benchmark.
    spans = sorted(r.span for r in items.select("span").distinct().collect())

    def item_marks(span: int) -> DataFrame:
        """Each mark with the words around it only, so that the table grows with the items' length."""
        own = fingerprints(items.where(F.col("span") == span), span)
        before = span - gram_of(span)

        def mark_at(mark: Column, at: Column) -> Column:
            begin = F.greatest(at - before, F.lit(0))
            return F.struct(
                at.alias("item_at"),
                mark.alias("mark"),
                begin.alias("item_begin"),
                F.slice("words", begin + 1, span + before).alias("item_near"),
            )

        places = F.sequence(F.lit(0), F.size("grams") - 1)
        places = F.filter(places, lambda i: F.array_contains("marks", F.get("grams", i)))
        found = F.transform(places, lambda i: mark_at(F.get("grams", i), i))
        return own.select(
            "item",
            F.lit(span).alias("span"),
            (F.size("words") - span).alias("item_last"),
            F.explode_outer(found).alias("m"),
        ).select("item", "span", "item_last", "m.*")

    if not spans:
        return docs.sparkSession.createDataFrame([], NO_HITS)
    marked = identified(docs, key, text)
    for span in spans:
        marked = fingerprints(marked, span).withColumnRenamed("marks", f"marks_{span}")
    every = F.concat(*[F.col(f"marks_{span}") for span in spans])
    marks = stage(reduce(DataFrame.union, [item_marks(s) for s in spans]), "item-marks")
    near = F.octet_length(F.array_join("item_near", "")) + F.size("item_near") * 24 + 96
    sizes = marks.agg(F.sum(near + F.octet_length("item")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()

    def small(df: DataFrame, size: int, most: int) -> DataFrame:
        return F.broadcast(df) if size <= most else df

    shared = marks.select("mark").distinct()
    suspects = (
        marked.select("row_key", F.explode_outer(every).alias("mark"))
        .join(small(shared, 16 * sizes.n, BROADCAST_BYTES), "mark", "left_semi")
        .select("row_key")
        .distinct()
    )
    suspects = stage(suspects, "suspect-keys")
    keys = small(suspects, KEY_BYTES * suspects.count(), SUSPECT_BYTES)
    body = F.col(text).cast("string")
    again = docs.select(row_key(key, text), body.alias("body")).join(keys, "row_key", "left_semi")
    again = stage(again.distinct().select("row_key", words(F.col("body")).alias("words")), "suspects")
    own = {s: marks.where(F.col("span") == s).drop("span") for s in spans}
    around = {s: small(own[s], sizes.bytes, BROADCAST_BYTES) for s in spans}
    found = reduce(DataFrame.union, [extend(again, around[s], s) for s in spans])
    # At most one entry a word and length, and one an item, so no group outgrows its document.
    hits = found.groupBy("row_key").agg(
        F.collect_set("reach").alias("reaches"), F.array_sort(F.collect_set("item")).alias("items")
    )
    hits = hits.select("row_key", covered(F.array_sort("reaches")).alias("n_hit"), "items")
    n_words = again.select("row_key", F.size("words").alias("n_words"))
    return n_words.join(hits, "row_key")


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows, with all their columns, that are not contaminated.

    Null, empty and wordless texts stay; repeated rows stay or go together; an empty table, or an empty
    benchmark, leaves the rows as they are. Columns may have any names. Texts are read whole.
    """
    hits = hit_texts(docs, benchmark, key, text, item_key, item_text)
    bad = hits.where(contaminated()).select("row_key")
    rows = docs.select(packed(docs), row_key(key, text))
    return unpacked(rows.join(bad, "row_key", "left_anti"), docs.columns)


def extend(texts: DataFrame, marks: DataFrame, span: int) -> DataFrame:
    """``row_key, reach, item``: where windows of items occur, as structs of first word and length.

    A shared hash lies at offset ``q - o`` of the item's windows ``o``; the words around it tell
    which of these windows the document has.
    """
    size = gram_of(span)
    before = span - size
    begin = F.greatest(F.col("at") - before, F.lit(0))
    around = (
        texts.withColumn("grams", grams("words", size, span))
        .select("row_key", "words", F.posexplode_outer("grams").alias("at", "mark"))
        .select(
            "row_key",
            "at",
            "mark",
            begin.alias("begin"),
            F.slice("words", begin + 1, span + before).alias("near"),
        )
    )
    joined = around.join(marks, "mark")
    first = F.greatest(F.col("item_at") - before, F.col("item_at") - F.col("at"), F.lit(0))
    last = F.least(F.col("item_at"), F.col("item_last"))

    def there(o: Column) -> Column:
        place = F.col("at") - F.col("item_at") + o - F.col("begin")
        return F.slice("near", place + 1, span) == F.slice("item_near", o - F.col("item_begin") + 1, span)

    offsets = F.when(first <= last, F.filter(F.sequence(first, last), there))
    return (
        joined.select("row_key", "item", "at", "item_at", F.explode_outer(offsets).alias("o"))
        .where(F.col("o").isNotNull())
        .select(
            "row_key",
            F.struct((F.col("at") - F.col("item_at") + F.col("o")).alias("s"), F.lit(span).alias("n"))
            .alias("reach"),
            "item",
        )
        .distinct()
    )


def covered(reaches: Column) -> Column:
    """How many positions ascending ranges (first, length) cover."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(seen: Column, r: Column) -> Column:
        stop = F.greatest(seen["end"], r["s"] + r["n"])
        return F.struct(
            (seen["n"] + F.greatest(stop - F.greatest(seen["end"], r["s"]), F.lit(0))).alias("n"),
            stop.alias("end"),
        )

    return F.aggregate(reaches, start, add)["n"]


def digest(result: DataFrame) -> DataFrame:
    """The result with the items as a SHA-256 of the comma-joined ids."""
    return result.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


#: The same in DuckDB, by joining all windows as strings.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i + 1 : i + least(len(w), 13)], ' ') AS s
  FROM (SELECT item, w, unnest(range(0, len(w) - least(len(w), 13) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, p.n, item FROM places p JOIN windows w ON p.s = w.s AND p.n = w.n
), reached AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN reached USING (doc_id) LEFT JOIN named USING (doc_id)
"""
