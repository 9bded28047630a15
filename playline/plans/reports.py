"""Reports over the three tables.

Distinct visitors are counted exactly by default: Spark then groups by (key, visitor) first, so a
hot key spreads over many tasks. ``approx=True`` uses a sketch instead, which shuffles only one
small buffer per key and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.functions import watch_cents
from playline.operators.joins import join_media


def _visitors(approx: bool):
    count = F.approx_count_distinct if approx else F.count_distinct
    return count(F.col("visitor_key")).alias("visitors")


def _watched():
    cents = F.sum(watch_cents(F.col("watch_time_seconds")))
    return (cents / F.lit(100.0)).alias("total_watch_time_seconds")


def _avg_percent():
    """From an exact sum, so that it does not depend on the order of the rows."""
    percent = F.col("percent_viewed").cast("decimal(18,9)")
    mean = F.sum(percent) / F.count(percent)
    return F.round(mean, 6).cast("double").alias("avg_percent_viewed")


def _events():
    return F.count(F.lit(1)).alias("events")


def by_media(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Engagement summary per media: events, visitors, total watch time, average percent viewed."""
    return fact.groupBy("media_id", "title").agg(
        _events(), _visitors(approx), _watched(), _avg_percent()
    )


def by_country(events: DataFrame, media: DataFrame, approx: bool = False) -> DataFrame:
    """The same per country; from the events, since the engagement fact has no country."""
    used = events.select("media_id", "country", "visitor_key", "percent_viewed")
    return (
        join_media(used, media)
        .groupBy("country")
        .agg(_events(), _visitors(approx), _watched(), _avg_percent())
    )


def by_visitor(fact: DataFrame) -> DataFrame:
    """Audience: events, media seen, watch time and average percent viewed per visitor."""
    return fact.groupBy("visitor_key").agg(
        _events(), F.count_distinct("media_id").alias("media"), _watched(), _avg_percent()
    )


def daily(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Per UTC day of the events. Late events count for the day they were received on."""
    day = F.to_date("received_at").alias("event_date")
    return fact.groupBy(day).agg(_events(), _visitors(approx), _watched())


def media_details(media: DataFrame) -> DataFrame:
    return media.select("hashed_id", "media_id", "title", "url", "duration")


def interactions(events: DataFrame, media: DataFrame) -> DataFrame:
    """Single events with their UTC day and their media's title."""
    used = events.select(
        "event_key", "visitor_key", "media_id", "received_at", "country", "percent_viewed"
    )
    return join_media(used, media).select(
        F.to_date("received_at").alias("event_date"),
        *used.columns,
        "title",
        "watch_time_seconds",
    )


def ad_hoc(spark: SparkSession, text: str, db: str) -> DataFrame:
    """Any SQL over the registered tables of ``db``, which is written ``{db}`` in the text."""
    return spark.sql(text.replace("{db}", f"`{db}`"))
