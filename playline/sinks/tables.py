"""Parquet tables partitioned by load_date. Every writer returns the number of rows written."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playline.operators.lookup import broadcast_limit
from playline.sinks.catalog import PARTITION
from playline.sinks.keys import found_in, index_of

# Copies of one row that are made at a time.
COPIES = 10_000


class EmptySnapshotError(ValueError):
    """An empty snapshot would have replaced a table."""


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A table by path. One that does not exist yet reads as empty; nothing is created."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _write(df: DataFrame, path: str, mode: str) -> int:
    # The count is taken in the tasks that write: no second pass, nothing counted before a shuffle.
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    return seen.get["rows"]


def write_snapshot(df: DataFrame, path: str, allow_empty: bool = False) -> int:
    """Replace the whole table, all load dates of it. An empty ``df`` is refused by default."""
    if not allow_empty and df.isEmpty():
        raise EmptySnapshotError(f"refusing to replace {path} with an empty snapshot")
    return _write(df, path, "overwrite")


def write_append(df: DataFrame, path: str) -> int:
    """Append as it comes: loading a batch twice stores it twice. Nothing new writes nothing."""
    return 0 if df.isEmpty() else _write(df, path, "append")


def append_new(
    df: DataFrame,
    path: str,
    key: str | None = "event_key",
    since: dt.date | None = None,
    index: str | None = None,
) -> int:
    """Append only rows whose key the table does not hold yet; loading a batch twice is safe.

    Within the batch the earliest row of a key wins. Rows without a key (null or empty), and all
    rows if ``key`` is None, are told apart by their content: of rows alike, as many are added as
    the batch holds more of them than the table. ``since`` limits the search to that load date and
    later ones, for callers who know that older runs cannot return.

    The batch's keys are counted once. Of the stored rows only the key is read, and it is not
    shuffled while the batch's keys fit a broadcast; beyond that it is shuffled once. With ``index``
    (``db.table``), an index of the stored keys that is kept up to date, it is not shuffled then either.
    One writer at a time: plain Parquet has no transactions.
    """
    table = read_table(df.sparkSession, path, df.schema)
    if since is not None:
        table = table.where(F.col(PARTITION) >= F.lit(since))
    if key is None:
        return _write_any(_more_copies(df, table), path)
    has_key = F.col(key).isNotNull() & (F.col(key) != "")
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).persist()
    # A few bytes of overhead a key, and its count.
    width = (F.octet_length(key) + 32).cast("bigint")
    size, loose, repeated = keys.agg(
        F.sum(F.when(has_key, width)),
        F.count_if(~has_key),
        F.count_if(has_key & (F.col("_rows") > 1)),
    ).first()
    keyed = keys.where(has_key)
    if index is not None and (size or 0) > broadcast_limit(keys):
        stored = index_of(read_table(df.sparkSession, path, df.schema), path, key, index)
        stored = stored if since is None else stored.where(F.col(PARTITION) >= F.lit(since))
        hits = found_in(stored.where(has_key), keyed.select(key), index).persist()
    else:
        hits = known_keys(table.where(has_key).select(key), keyed.select(key), size or 0).persist()
    try:
        fresh = df.where(has_key)
        if not hits.isEmpty():
            fresh = fresh.join(hits, key, "left_anti")
        if repeated:
            fresh = first_per_key(fresh, keyed.where(F.col("_rows") > 1).select(key), key)
        if loose:
            fresh = fresh.unionByName(_more_copies(df.where(~has_key), table.where(~has_key)))
        return _write_any(fresh, path)
    finally:
        hits.unpersist()
        keys.unpersist()


def _write_any(df: DataFrame, path: str) -> int:
    """Append; a first load without rows leaves no folder."""
    return _write(df, path, "append") if not df.isEmpty() else 0


def known_keys(stored: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """The batch's keys that are stored already. ``size`` is measured and bounds the broadcast."""
    column = keys.columns[0]
    if size <= broadcast_limit(keys):
        return stored.join(F.broadcast(keys), column, "left_semi")
    return keys.join(stored, column, "left_semi")


def first_per_key(rows: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """One row per key. Only rows of repeated keys are sorted: the least by received_at, then by
    all columns, is kept, so the choice does not depend on row order. Spark applies the rank limit
    in each task before the shuffle, so a key with very many copies does not meet in one task."""
    first = [c for c in rows.columns if c == "received_at"]
    order = [F.col(c).asc() for c in [*first, *[c for c in rows.columns if c not in first]]]
    ranked = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    many = rows.join(repeated, key, "left_semi").withColumn("_rank", ranked)
    once = rows.join(repeated, key, "left_anti")
    return once.unionByName(many.where(F.col("_rank") == 1).drop("_rank"))


def _more_copies(df: DataFrame, table: DataFrame) -> DataFrame:
    """Of rows alike (but for the load date), those that ``df`` has more of than ``table``."""
    content = [c for c in df.columns if c != PARTITION]
    new = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_rows")).alias("new")
    old = table.groupBy(*content).agg(F.count(F.lit(1)).alias("_stored")).alias("old")
    same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in content]
    more = F.col("_rows") - F.coalesce("_stored", F.lit(0))
    missing = new.join(old, same, "left").select("new.*", more.alias("_more"))
    # Copies in blocks: no array grows with their number, and blocks spread over the tasks.
    blocks = (
        missing.where(F.col("_more") > 0)
        .withColumn("_last", F.floor((F.col("_more") - 1) / COPIES))
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")))
        .repartition(*content, "_block")
    )
    here = F.least(F.lit(COPIES), F.col("_more") - F.col("_block") * COPIES).cast("int")
    copies = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), here)))
    return copies.select(*df.columns)
