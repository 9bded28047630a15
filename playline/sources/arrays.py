"""JSON array files that split: many tasks read one file.

Spark cuts the file into blocks and each block into pieces, behind every ``}``. A first pass finds what
a block does to the two things that its meaning depends on: whether it begins within a string, and how deep
it begins. Sums over the blocks of a file (one row a block) then tell both for each block's begin, and a
second pass cuts the objects. An object that crosses blocks is put together from its parts, of which a
block has two at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playline.operators.lookup import fits_broadcast
from playline.session import stage

QUOTE, BACKSLASH, BRACE, BRACKET = b'"\\{['
STEP = np.zeros(256, np.int8)
STEP[[BRACE, BRACKET]] = 1
STEP[list(b"}]")] = -1
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\r\n")] = True
#: What may stand between the objects of an array.
BETWEEN = SPACE.copy()
BETWEEN[list(b",[]}")] = True

#: Part of an object: its begin, its middle (a whole block), its end; or all of it.
TAIL, MIDDLE, HEAD, WHOLE = range(4)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )


def _runs(batch: pa.RecordBatch):
    """Rows of one block at a time: path, block, first row, and their bytes with each ``}`` back.

    The last piece of a file gets a ``}`` too, though it has none.
    """
    paths, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    pieces = batch.column(2).to_pylist()
    first = 0
    while first < len(pieces):
        stop = first + 1
        while stop < len(pieces) and (paths[stop], blocks[stop]) == (paths[first], blocks[first]):
            stop += 1
        data = np.frombuffer(b"}".join([*pieces[first:stop], b""]), np.uint8)
        yield paths[first], blocks[first], first, data
        first = stop


def _in_string(data: np.ndarray) -> np.ndarray:
    """For each byte, whether an odd number of quotes that end or begin a string lies up to it."""
    quotes = data == QUOTE
    if (data == BACKSLASH).any():
        at = np.flatnonzero(quotes)
        places = np.where(data != BACKSLASH, np.arange(1, len(data) + 1), 0)
        last = np.concatenate([[0], np.maximum.accumulate(places)])
        # Backslashes right before a quote; an odd number of them makes it a part of the string.
        quotes[at[(at - last[at]) % 2 == 1]] = False
    return (np.cumsum(quotes) & 1).astype(bool)


def _shapes(batches):
    """Of each block: whether its quotes flip the state, and its change of depth if it begins
    outside or within a string; the first byte that is no white space."""

    def row(key, flip, outside, within, opens):
        columns = [[key[0]], [key[1]], [flip], [outside], [within], [opens]]
        names = ["path", "block", "flip", "outside", "within", "opens"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names)

    key = None
    for batch in batches:
        for path, block, _, data in _runs(batch):
            if key != (path, block):
                if key is not None:
                    yield row(key, flip, *depths, opens)
                key, flip, depths, opens = (path, block), 0, [0, 0], 0
            if not opens:
                shown = data[~SPACE[data]]
                opens = int(shown[0]) if len(shown) else 0
            odd, steps = _in_string(data), STEP[data]
            change = int(steps[~odd].sum()), int(steps[odd].sum())
            depths = [depths[s] + change[s ^ flip] for s in (0, 1)]
            flip ^= int(odd[-1])
    if key is not None:
        yield row(key, flip, *depths, opens)


def _states(pieces: DataFrame) -> DataFrame:
    """How each block begins; a file that is no whole array (or object) raises."""
    shapes = stage(
        pieces.mapInArrow(
            _shapes,
            "path STRING, block BIGINT, flip BIGINT, outside BIGINT, within BIGINT, opens BIGINT",
        ),
        "array-blocks",
    )
    whole = Window.partitionBy("path")
    ordered = whole.orderBy("block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum("flip").over(before), F.lit(0)) % 2
    states = shapes.withColumn("inside", flips).withColumn(
        "change", F.when(F.col("inside") == 0, F.col("outside")).otherwise(F.col("within"))
    )
    total, ends_inside = F.sum("change").over(whole), F.sum("flip").over(whole) % 2
    opens = F.first("opens").over(ordered)
    # The } that the last piece got lowers the depth by one, unless the file itself ends in }.
    good = (
        F.when(opens == BRACKET, total == -1)
        .when(opens == BRACE, total.isin(-1, 0))
        .otherwise(opens == ord("}"))  # white space alone
    ) & (ends_inside == 0)
    broken = F.raise_error(F.concat(F.lit("no whole JSON array: "), F.col("path")))
    depth = F.coalesce(F.sum("change").over(before), F.lit(0))
    return stage(
        states.select(
            "path",
            "block",
            (F.col("inside") == 1).alias("inside"),
            F.when(good, depth).otherwise(broken.cast("bigint")).alias("depth"),
            F.when(opens == BRACKET, 1).otherwise(0).alias("level"),
        ),
        "array-states",
    )


def _cut(batches):
    """The objects of each block and the parts of those that cross its borders."""
    key, open_parts, headless = None, None, False
    for batch in batches:
        out = []
        for path, block, first, data in _runs(batch):
            if key != (path, block):
                if open_parts is not None:
                    out.append((*key, MIDDLE if headless else TAIL, b"".join(open_parts)))
                key = (path, block)
                inside, depth, level = (batch.column(k)[first].as_py() for k in (3, 4, 5))
                headless = depth > level
                open_parts = [] if headless else None
            odd = _in_string(data) ^ inside
            depths = depth + np.cumsum(np.where(odd, 0, STEP[data]))
            plain = ~odd
            nested = (data == BRACKET) & (depths == level + 1)
            strange = plain & ((depths <= level) & ~BETWEEN[data] | nested)
            if strange.any():
                raise ValueError(f"an array holds something that is no object: {path}")
            begins = np.flatnonzero(plain & (data == BRACE) & (depths == level + 1)).tolist()
            ends = np.flatnonzero(plain & (data == ord("}")) & (depths == level)).tolist()
            content = data.tobytes()
            if open_parts is not None:
                if ends:
                    open_parts.append(content[: ends[0] + 1])
                    out.append((path, block, HEAD if headless else WHOLE, b"".join(open_parts)))
                    del ends[0]
                    open_parts, headless = None, False
                else:
                    open_parts.append(content)
            out += [(path, block, WHOLE, content[a : b + 1]) for a, b in zip(begins, ends)]
            if len(begins) > len(ends):
                open_parts = [content[begins[-1] :]]
            inside, depth = bool(odd[-1]), int(depths[-1])
        yield _objects(out)
    if open_parts is not None:
        yield _objects([(*key, MIDDLE if headless else TAIL, b"".join(open_parts))])


def _objects(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, ["path", "block", "kind", "text"])


def array_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The objects of JSON array files, as JSON text in the column ``object``; in no order.

    Files with one object, or with several one behind the other, are read alike; empty ones hold none.
    A file that breaks off, that holds an array in an array or any element but objects raises. That
    commas stand between objects is not checked. Files may be pretty-printed or on one line, in UTF-8;
    compressed files are read by one task each. Blocks follow ``spark.sql.files.maxPartitionBytes``. The
    text is read three times (twice if no file has two blocks), the objects are parsed once.

    What a block begins with is broadcast if measured to be small (some 100 bytes for a block); beyond
    that, blocks are shuffled to their states, one block a group.
    """
    pieces = _pieces(spark, path)
    states = _states(pieces)
    on = ["path", "block"]
    if fits_broadcast(states):
        # A broadcast join leaves the pieces of a block in order.
        begun = pieces.join(F.broadcast(states), on)
    else:
        numbered = pieces.withColumn("row", F.monotonically_increasing_id())
        begun = numbered.join(states, on).repartition(*on).sortWithinPartitions(*on, "row")
    cut = begun.select(*on, "piece", "inside", "depth", "level").mapInArrow(
        _cut, "path STRING, block BIGINT, kind INT, text BINARY"
    )
    cut = cut.withColumn("text", F.col("text").cast("string"))
    whole = cut.where(F.col("kind") == WHOLE).select(F.col("text").alias("object"))
    if states.groupBy("path").count().where("count > 1").isEmpty():
        return whole
    order = Window.partitionBy("path").orderBy("block", F.desc("kind"))
    parts = cut.where(F.col("kind") != WHOLE).withColumn(
        "nth", F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    )
    joined = F.array_sort(F.collect_list(F.struct("block", "text")))
    crossing = parts.groupBy("path", "nth").agg(joined.alias("parts"))
    return whole.unionAll(crossing.select(F.array_join("parts.text", "").alias("object")))


def read_arrays(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The objects of array files by a schema; a value that does not fit it raises."""
    parsed = F.from_json("object", schema, {"mode": "FAILFAST"})
    return array_objects(spark, path).select(parsed.alias("row")).select("row.*")
