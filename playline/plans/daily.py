"""The daily report as a table that is corrected day by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.joins import join_media
from playline.operators.project import as_date, stamp
from playline.plans import reports
from playline.plans.jobs import table_path
from playline.session import prepare
from playline.sinks.tables import read_table
from playline.sinks.versions import publish, read_version


def days_of(events: DataFrame) -> list[dt.date]:
    """The UTC days of some events, without those that have no usable time."""
    day = F.to_date("received_at").alias("day")
    return [row.day for row in events.select(day).distinct().collect() if row.day is not None]


def build_daily(
    spark: SparkSession, out_root: str, run_date=None, days: list[dt.date] | None = None
) -> int:
    """Bring daily_engagement, one row a day with events of known media, up to date.

    Computed from fact_events and the current media, for ``days`` alone or, by default, for all. So a
    late event corrects its day, and computing a day again changes nothing. Of the events, those of
    the days are read, by the range of times that Parquet keeps for blocks of rows. The table is as
    small as the number of days and is published as a whole.
    """
    prepare(spark)
    path = table_path(out_root, "daily_engagement")
    events = read_table(spark, table_path(out_root, "fact_events"), schemas.FACT_EVENTS)
    if days is not None:
        if not days:
            return 0
        first, after = min(days), max(days) + dt.timedelta(days=1)
        at = F.col("received_at")
        within = (at >= F.lit(first).cast("timestamp")) & (at < F.lit(after).cast("timestamp"))
        events = events.where(within & F.to_date(at).isin(days))
    media = read_version(spark, table_path(out_root, "dim_media"), schemas.DIM_MEDIA)
    used = events.select("media_id", "percent_viewed", "visitor_key", "received_at")
    rows = reports.daily(join_media(used, media)).transform(stamp, as_date(run_date))
    if days is not None:
        stored = read_version(spark, path, schemas.DAILY_ENGAGEMENT)
        others = stored.where(~F.col("event_date").isin(days)).transform(stamp, as_date(run_date))
        rows = rows.unionByName(others)
    # Few rows, so one file.
    return publish(rows.coalesce(1), path, as_date(run_date), allow_empty=True)


def daily_engagement(spark: SparkSession, out_root: str) -> DataFrame:
    return read_version(spark, table_path(out_root, "daily_engagement"), schemas.DAILY_ENGAGEMENT)
