"""Joins of a large table to a lookup table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup up to this measured size is broadcast. Can be set in the session.
BROADCAST_BYTES = ("playline.lookup.broadcastBytes", 64 * 1024 * 1024)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows in memory, from the data itself (Parquet file sizes are compressed)."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + F.lit(8)
        if not isinstance(field.dataType, T.NumericType | T.DatetimeType | T.BooleanType):
            text = F.col(f"`{field.name}`").cast("string")
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def broadcast_limit(df: DataFrame) -> int:
    key, default = BROADCAST_BYTES
    return int(df.sparkSession.conf.get(key, str(default)))


def fits_broadcast(df: DataFrame) -> bool:
    return measured_bytes(df) <= broadcast_limit(df)


def spark_broadcasts(df: DataFrame) -> bool:
    """Whether Spark broadcasts ``df`` by its own estimate, taken without a job. A measure could not
    change that."""
    spark = df.sparkSession
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):  # never
        return False
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= limit


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", computed: bool = False
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on equally named columns; ``how`` is inner, left,
    left_semi or left_anti.

    A lookup that is just read is measured, by a scan of the columns it needs, unless Spark broadcasts
    it anyway. If it is small, it is broadcast: the facts are not shuffled, so no key can be hot.
    Otherwise, and for a ``computed`` lookup, which measuring would compute twice, the runtime
    chooses by real sizes, and splits the partitions of hot keys (``session.SETTINGS``). The facts
    are read once.
    """
    semi = how in ("left_semi", "left_anti")
    if semi:
        lookup = lookup.select(*on)
    extra = [] if semi else [c for c in lookup.columns if c not in on]
    if not computed and not spark_broadcasts(lookup) and fits_broadcast(lookup):
        lookup = F.broadcast(lookup)
    return facts.join(lookup, on, how).select(*facts.columns, *extra)
