"""Audience sketches: distinct visitors of any span of load dates, without the events.

A sketch is kept for each load date and value of a dimension. Sketches unite without loss, so a report
reads one small row a load date and value, and a load adds only its own date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.project import as_date
from playline.plans.jobs import table_path
from playline.session import prepare, stage
from playline.sinks.tables import PARTITION, read_table
from playline.sinks.versions import BY_LOAD_DATE, latest, publish, read_version, sources_of

#: Binary logarithm of a sketch's places: 16,384 of them, so that the standard error is 0.8 %.
PRECISION = 14
#: What the audience is counted by, and the value that an event has, in SQL.
DIMENSIONS = {
    "media": "media_id",
    "country": "country",
    "day": "CAST(to_date(received_at) AS STRING)",
}
SOURCES = "load_date DATE, events BIGINT"


def sketched(events: DataFrame) -> DataFrame:
    """``dimension, value, events, percent_sum, percents, visitors`` by load date.

    The sums are exact decimals; ``visitors`` is the sketch. One pass over the events for all dimensions.
    """
    values = [
        F.struct(F.lit(name).alias("dimension"), F.expr(value).alias("value"))
        for name, value in DIMENSIONS.items()
    ]
    percent = F.col("percent_viewed").cast("decimal(18,9)")
    rows = events.select(
        PARTITION, "visitor_key", percent.alias("percent"), F.explode(F.array(*values)).alias("by")
    )
    return rows.groupBy(F.col("by.dimension"), F.col("by.value"), PARTITION).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("percent").cast("decimal(38,9)").alias("percent_sum"),
        F.count("percent").alias("percents"),
        F.hll_sketch_agg("visitor_key", F.lit(PRECISION)).alias("visitors"),
    )


def build_sketches(spark: SparkSession, out_root: str, run_date=None) -> int:
    """Sketch the load dates that have other events than when they were sketched last; the others are
    not read, and keep their files. Returns the rows of the new version; no new events, no version."""
    prepare(spark)
    path = table_path(out_root, "audience_sketches")
    events = read_table(spark, table_path(out_root, "fact_events"), schemas.FACT_EVENTS)
    # Rows are counted without reading a column.
    counted = stage(
        events.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("events")), "events-by-load-date"
    )
    last = latest(spark, path)
    changed = counted
    if last is not None:
        changed = counted.join(sources_of(spark, path, last, SOURCES), counted.columns, "left_anti")
    days = [row[0] for row in changed.select(PARTITION).collect()]
    if not days:
        return 0
    rows = sketched(events.where(F.col(PARTITION).isin(days)))
    replaced = spark.createDataFrame([(day,) for day in days], f"{PARTITION} DATE")
    return publish(rows, path, as_date(run_date), BY_LOAD_DATE, replaced, sources=counted)


def audience(
    spark: SparkSession,
    out_root: str,
    dimension: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """``value, events, visitors, avg_percent_viewed`` of the events loaded from ``since`` to ``until``
    (both included); visitors are estimated, the rest is exact. The events are not read."""
    if dimension not in DIMENSIONS:
        raise ValueError(f"dimension must be one of {sorted(DIMENSIONS)}, not {dimension!r}")
    path = table_path(out_root, "audience_sketches")
    rows = read_version(spark, path, schemas.AUDIENCE_SKETCHES).where(F.col("dimension") == dimension)
    if since is not None:
        rows = rows.where(F.col(PARTITION) >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col(PARTITION) <= F.lit(until))
    mean = F.sum("percent_sum") / F.sum("percents")
    return rows.groupBy("value").agg(
        F.sum("events").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors"),
        F.round(mean, 6).cast("double").alias("avg_percent_viewed"),
    )
