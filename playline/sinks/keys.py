"""An index of the keys that a table holds, laid out so that a search shuffles only what is sought.

The index is a table of its own with one row for each of the table's, in buckets by the hash of the
key and partitioned by load date as the table is. A join with it takes the buckets as they lie.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.sinks.catalog import PARTITION, quoted

#: Buckets of a new index; one that is there keeps its own number.
BUCKETS = 64


def index_of(table: DataFrame, path: str, key: str, name: str, buckets: int = BUCKETS) -> DataFrame:
    """The index ``name`` (``db.table``) of the table at ``path``, brought up to date.

    Rows are only ever added, so a load date with as many rows in both is up to date; counting reads
    no column. Others are written anew, which also mends an index that a lost run has left behind.
    """
    spark = table.sparkSession
    db, own = (f"`{part}`" for part in name.split("."))
    kind = table.schema[key].dataType.simpleString()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.{own} (`{key}` {kind}, {PARTITION} DATE) USING parquet "
        f"PARTITIONED BY ({PARTITION}) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION {quoted(f'{path}__keys')}"
    )
    stale, gone = _differing(table, spark.table(name))
    if stale:
        rows = table.where(F.col(PARTITION).isin(stale)).select(key, PARTITION)
        # Dealt as the buckets are, so that a load date has one file a bucket.
        rows = rows.repartition(buckets_of(spark, name), key)
        # A setting and no option, since writes into a table of the catalog take no options.
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(mode, before)
    for day in gone:
        spark.sql(f"ALTER TABLE {db}.{own} DROP PARTITION ({PARTITION} = DATE '{day}')")
    spark.sql(f"REFRESH TABLE {db}.{own}")
    return spark.table(name)


def _differing(table: DataFrame, index: DataFrame) -> tuple[list[dt.date], list[dt.date]]:
    """Load dates with other rows in the table than in the index, and those the table has not."""

    def counted(df, name):
        return df.groupBy(PARTITION).agg(F.count(F.lit(1)).alias(name))

    both = counted(table, "here").join(counted(index, "there"), PARTITION, "full")
    differ = both.where(~F.col("here").eqNullSafe(F.col("there"))).collect()
    return [r[0] for r in differ if r.here is not None], [r[0] for r in differ if r.here is None]


def found_in(stored: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The keys that the index ``name`` holds; ``stored`` are its rows, or some load dates of them.

    The keys are dealt as the index is: else, with more shuffle partitions than buckets, the join
    would deal the index anew. (A semi-join would be moved below that.)
    """
    column = keys.columns[0]
    sought = keys.repartition(buckets_of(keys.sparkSession, name), column)
    return sought.join(stored.select(column), column).distinct()


def buckets_of(spark: SparkSession, name: str) -> int:
    described = spark.sql(f"DESCRIBE FORMATTED {name}")
    return int(described.where(F.col("col_name") == "Num Buckets").first().data_type)
