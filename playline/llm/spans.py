"""Numpy helpers shared by the operators: batches of texts, words, and hashes of byte ranges.

Texts reach a task as Arrow binary columns. All helpers work on pieces of bounded size, so the
working memory does not follow the batch, only the longest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes (or characters) hashed at a time; a longer range gets a hash of its own.
PIECE = 1 << 18
#: Bytes of text that a task works on at a time, unless a single text is longer.
CHUNK = 1 << 20

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, U64)
    out[0] = 1
    have = 1
    while have < count:
        step = min(have, count - have)
        out[have : have + step] = out[:step] * U64(pow(base, have, 1 << 64))
        have += step
    return out


UP = _powers(BASE, PIECE + 1)
DOWN = _powers(INVERSE, PIECE + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_values(data: np.ndarray) -> np.ndarray:
    return BYTE_VALUES[data]


def char_values(data: np.ndarray) -> np.ndarray:
    return mix((data.astype(U64) + U64(1)) * U64(BASE))


def span_hashes(data, starts, ends, values=byte_values) -> np.ndarray:
    """64-bit hashes of ranges that ascend and do not overlap; equal content, equal hash."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = int(np.searchsorted(ends, base + PIECE, "right"))
        if stop <= at:
            whole = np.ascontiguousarray(data[base : ends[at]]).tobytes()
            out[at] = int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little")
            at += 1
            continue
        top = ends[stop - 1]
        prefix = np.zeros(top - base + 1, U64)
        np.cumsum(values(data[base:top]) * UP[: top - base], out=prefix[1:])
        first, last = starts[at:stop] - base, ends[at:stop] - base
        own = (prefix[last] - prefix[first]) * DOWN[first]
        out[at:stop] = mix(own + (last - first).astype(U64) * U64(INVERSE))
        at = stop
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, places, content = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(places, kind, len(column) + 1, column.offset * kind().itemsize)
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    return data, offsets.astype(np.int64)


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``most`` bytes (or one row): first, stop, bytes, offsets from 0."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        stop = min(max(stop, first + 1), len(column))
        own = offsets[first : stop + 1]
        yield first, stop, data[own[0] : own[-1]], own - own[0]
        first = stop


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Actions within hand tasks Arrow batches of at most ``rows`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parts_of(batches, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows: a worker holds Python's values of one part only,
    and keeps less memory once it is idle."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The row that each position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1


def words(data, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words between white space (space and U+0009 to U+000D)."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(SPACE[data], out=inside[1:-1])
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges + 1]
    last[edges - 1] = inside[edges]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, owner(offsets, starts)


def window_hashes(hashes, rows, size) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of one row, and the index of each one's first word."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    at = np.flatnonzero(rows[:count] == rows[size - 1 :])
    total = np.zeros(len(at), U64)
    for k in range(size):
        total += hashes[at + k] * UP[k + 1]
    return mix(total), at


def in_rows(hashes, rows) -> np.ndarray:
    """Hashes that are equal only where the row is equal too."""
    return mix(hashes + (rows.astype(U64) + U64(1)) * U64(INVERSE))


def sums(values, offsets) -> np.ndarray:
    """The sum of ``values`` over each row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def id_and_text(df: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """The two columns that an operator reads, under names of their own, the text as UTF-8."""
    return df.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("utf8"), *more
    )
