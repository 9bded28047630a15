"""Importance resampling towards a target: documents whose hashed words look like the target's.

A dictionary automaton of each run of texts finds its words, each between two blanks, and gives for
every place the word's CRC and length. Features of several words get theirs from those of their
words, without their text. The buckets are written once; counting and scoring read only them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playline.llm.spans import chunks, id_and_text, sums
from playline.operators.windows import paginate
from playline.session import stage

BUCKETS, PERCENT, FEWEST_WORDS, SEED = 10_000, 10, 20, 2024
#: Bytes of text that one automaton is made for, unless a single text is longer.
TEXT_CHUNK = 4 << 20
#: Fixed value: the polynomial of CRC-32, its bits reversed.
POLYNOMIAL = 0xEDB88320

# Letters in lower case, digits and bytes above ASCII; all other bytes are blanks.
PLAIN = np.array(
    [ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)]
    + list(range(128, 256)),
    np.uint8,
)


def after_zeros() -> np.ndarray:
    """``[j, k, b]``: a CRC of byte ``b`` at place ``k`` and zeros else, after 2**j zero bytes."""
    bits = np.array([1 << i for i in range(32)], np.uint32)

    def spread(images):
        table = np.zeros((4, 256), np.uint32)
        for k in range(4):
            for bit in range(8):
                table[k, (np.arange(256) >> bit) & 1 == 1] ^= images[8 * k + bit]
        return table

    # One zero byte: eight steps of the shift register.
    for _ in range(8):
        bits = (bits >> np.uint32(1)) ^ np.where(bits & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    tables = [spread(bits)]
    for _ in range(31):
        bits = moved(bits, tables[-1])
        tables.append(spread(bits))
    return np.stack(tables)


def moved(crcs: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[0][crcs & 255]
    for k in range(1, 4):
        out ^= table[k][(crcs >> np.uint32(8 * k)) & 255]
    return out


ZEROS = after_zeros()
BLANK = zlib.crc32(b" ")


def joined(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of pairs of strings from those of both; ``lengths`` are the right ones' in bytes."""
    left = left.copy()
    for bit in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero((lengths >> bit) & 1)
        left[at] = moved(left[at], ZEROS[bit])
    return left ^ right


def payloads(data, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC and length of every word of some texts, and the number of words of each text."""
    sizes = np.diff(offsets)
    text = np.full(len(data) + len(sizes) + 1, 32, np.uint8)
    # One blank in front of each text, and one behind the last.
    text[np.arange(1, len(data) + 1) + np.repeat(np.arange(len(sizes)), sizes)] = PLAIN[data]
    first = text[1:] != 32
    first &= text[:-1] == 32
    n_words = sums(first, np.append(offsets[:-1] + np.arange(len(sizes)), len(text) - 1))
    # One character a byte.
    line = text.tobytes().decode("latin-1")
    distinct = set(line.split(" "))
    distinct.discard("")
    if not distinct:
        return np.empty(0, np.uint32), np.empty(0, np.int64), n_words
    # The automaton holds small integers only: the place of a word's payload.
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    crcs, lengths = np.empty(len(distinct), np.uint32), np.empty(len(distinct), np.int64)
    for number, word in enumerate(distinct):
        automaton.add_word(f" {word} ", number)
        crcs[number], lengths[number] = zlib.crc32(word.encode("latin-1")), len(word)
    automaton.make_automaton()
    found = np.fromiter(map(itemgetter(1), automaton.iter(line)), np.int64, int(n_words.sum()))
    return crcs[found], lengths[found], n_words


def features(crcs, lengths, n_words, shortest, longest) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of all runs of so many words, text by text, and the number of each text's."""
    row = np.repeat(np.arange(len(n_words)), n_words)
    run, runs, rows = crcs, [], []
    for size in range(1, longest + 1):
        if size > 1:
            # One word more behind each run; runs that leave their text are not taken.
            left = joined(run[:-1], np.uint32(BLANK), np.ones(max(len(run) - 1, 0), np.int64))
            run = joined(left, crcs[size - 1 :], lengths[size - 1 :])
        count = max(len(crcs) - size + 1, 0)
        run = run[:count]
        if size >= shortest:
            inside = row[:count] == row[size - 1 :][:count]
            runs.append(run[inside])
            rows.append(row[:count][inside])
    every = np.concatenate(rows)
    order = np.argsort(every, kind="stable")
    return np.concatenate(runs)[order], np.bincount(every, minlength=len(n_words))


def kind(buckets: int):
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def bucketed(docs: DataFrame, key: str, text: str, shortest: int, longest: int, buckets: int):
    """``doc_id, n_words, n_features`` and the bucket of every feature, as little-endian numbers."""

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in chunks(batch.column(1), TEXT_CHUNK):
                crcs, lengths, n_words = payloads(data, offsets)
                if shortest == longest == 1:
                    own, n = crcs, n_words
                else:
                    own, n = features(crcs, lengths, n_words, shortest, longest)
                content = (own % np.uint32(buckets)).astype(kind(buckets))
                ends = np.concatenate([[0], np.cumsum(n)]) * content.itemsize
                column = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    len(n),
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(content.tobytes())],
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(first, stop - first),
                        "n_words": n_words.astype(np.int64),
                        "n_features": n.astype(np.int64),
                        "buckets": column.cast(pa.binary()),
                    }
                )

    schema = "doc_id long, n_words long, n_features long, buckets binary"
    return id_and_text(docs, key, text).mapInArrow(run, schema)


def rows_of(column: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first, stop, the buckets of all of them, and where each row's begin."""
    form = kind(buckets)
    for first, stop, data, offsets in chunks(column):
        yield first, stop, np.frombuffer(data.tobytes(), form), offsets // form.itemsize


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds, over all rows; one row a bucket reaches the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, own, _ in rows_of(batch.column(0), buckets):
                total += np.bincount(own, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]})

    counted = found.select("buckets").mapInArrow(run, "bucket long, n long")
    counted = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket speaks for the target, in thousandths of a natural logarithm."""
    size = len(source)
    s_all, t_all = float(source.sum() + size), float(target.sum() + size)
    pairs = zip(source.tolist(), target.tolist())
    ratios = [float(t + 1) * s_all / (float(s + 1) * t_all) for s, t in pairs]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """Add ``weight``, the floored mean of the gains of a row's features, 0 without any."""
    size = len(gain)

    def run(batches):
        for batch in batches:
            for first, stop, own, offsets in rows_of(batch.column(3), size):
                total, n = sums(gain[own], offsets), np.diff(offsets)
                part = batch.slice(first, stop - first)
                yield pa.RecordBatch.from_pydict(
                    {
                        **{name: part.column(k) for k, name in enumerate(names)},
                        "weight": np.where(n > 0, total // np.maximum(n, 1), 0),
                    }
                )

    names = ["doc_id", "n_words", "n_features"]
    return found.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shortest: int = 1,
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    fewest_words: int = FEWEST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every document's ``doc_id, n_features, weight, score, rank``; the drawn ones have a rank.

    Words are runs of letters, digits and characters above ASCII, A to Z in lower case; features all
    runs of ``shortest`` to ``longest`` words. ``weight`` is the mean gain of a document's features
    (0 without any), ``score`` the weight plus noise that depends on ``seed`` and key alone. Of the
    documents with ``fewest_words`` words or more, ``percent`` in a hundred with the highest scores
    are drawn without putting back, equal scores by the smaller key.

    A null text has no words; a null key stays null, has noise of its own and comes first among
    equal scores; repeated rows are drawn each for itself, of equal rows any; empty tables give an
    empty result or gains against nothing. Texts are read whole, at about 20 bytes of working memory
    a byte of the longest. Other columns are not read.

    Counts cover all rows of both tables; what is broadcast is one number a bucket.
    """
    found = stage(bucketed(docs, key, text, shortest, longest, buckets), "buckets")
    source = bucket_counts(found, buckets)
    key_of_target = F.lit(None).cast("long").alias("no_key")
    rows = target.select(key_of_target, F.col(text).alias("text"))
    wanted = bucket_counts(bucketed(rows, "no_key", "text", shortest, longest, buckets), buckets)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((drawn + 0.5) / F.lit(4294967296.0))))
    scored = weighted(found, gains(source, wanted)).withColumn("score", F.col("weight") + noise)
    return ranked(stage(scored, "scored"), percent, fewest_words)


def ranked(scored: DataFrame, percent: int, fewest_words: int) -> DataFrame:
    """Add ``rank`` to the drawn rows. Only those that the counts of the scores leave open are
    sorted, by ranges, so no task sorts them all. Scores lie within some 10**5 of 0, as logarithms
    of counts and the noise do, so their counts are few."""
    fit = F.col("n_words") >= fewest_words
    counts = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    scores, n = counts.column("score").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(-scores)
    reached = np.cumsum(n[order])
    draw = int(n.sum()) * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    out = scored.where(~fit if draw else F.lit(True)).select(*columns, no_rank())
    if not draw:
        return out
    least = int(scores[order][np.searchsorted(reached, draw)])
    near = scored.where(fit & (F.col("score") >= least))
    placed = paginate(near, [], [-F.col("score"), "doc_id"], per_page=1)
    rank = F.when(F.col("page") <= draw, F.col("page")).alias("rank")
    below = scored.where(fit & (F.col("score") < least)).select(*columns, no_rank())
    return out.unionAll(below).unionAll(placed.select(*columns, rank))


def no_rank():
    return F.lit(None).cast("long").alias("rank")


#: The query's counterpart in DuckDB. CRC-32 is spelled out byte by byte, once a distinct word.
ORACLE = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, step:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), words AS (
  SELECT 0 AS place, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 1, NULL, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark
), bytes AS (
  SELECT word, list_transform(range(1, strlen(word) * 2, 2), lambda i:
    (strpos('0123456789ABCDEF', substr(hex(word), i, 1)) - 1) * 16
    + strpos('0123456789ABCDEF', substr(hex(word), i + 1, 1)) - 1) AS b
  FROM (SELECT DISTINCT word FROM words)
), hashed AS (
  SELECT word, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x:
    xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table
), placed AS (SELECT place, doc_id, bucket FROM words JOIN hashed USING (word)
), sizes AS (
  SELECT count(*) FILTER (place = 0) AS s_all, count(*) FILTER (place = 1) AS t_all FROM placed
), gain AS (
  SELECT bucket, floor(1000 * ln((count(*) FILTER (place = 1) + 1)::DOUBLE * (max(s_all) + 10000)
    / ((count(*) FILTER (place = 0) + 1)::DOUBLE * (max(t_all) + 10000))))::BIGINT AS g
  FROM placed, sizes GROUP BY bucket
), own AS (
  SELECT doc_id, count(*) AS n, sum(g) AS total FROM placed JOIN gain USING (bucket)
  WHERE place = 0 GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE floor(total / n)::BIGINT END AS weight,
    weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5)
      / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN own USING (doc_id)
), fit AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= 10 * fit.n // 100 THEN rank END AS rank
FROM scored LEFT JOIN fit USING (doc_id)
"""
