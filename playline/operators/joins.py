from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playline.functions import watch_time
from playline.operators.lookup import lookup_join
from playline.operators.project import stamp


def join_media(events: DataFrame, media: DataFrame) -> DataFrame:
    """Events with title and duration of their media, and the watch time.

    The event's media_id is the media's hashed_id. Inner: events of unknown media drop out, a
    repeated hashed_id fans out.
    """
    known = media.select(F.col("hashed_id").alias("media_id"), "title", "duration")
    seconds = watch_time(F.col("percent_viewed"), F.col("duration"))
    return lookup_join(events, known, ["media_id"]).withColumn("watch_time_seconds", seconds)


def engagement(events: DataFrame, media: DataFrame, run_date=None) -> DataFrame:
    """fact_media_engagement: one row per event of a known media."""
    used = events.select("media_id", "percent_viewed", "visitor_key", "event_key", "received_at")
    return join_media(used, media).transform(stamp, run_date)


def lookup_stats(media: DataFrame, stats: DataFrame) -> DataFrame:
    """``media_id, engagement, error`` per media; error where there are no statistics.

    ``stats`` holds ``media_id`` and the statistics as JSON text (``to_json`` of a VARIANT).
    """
    wanted = media.select(F.col("hashed_id").alias("media_id"))
    found = stats.select("media_id", "engagement", F.lit(True).alias("_found"))
    missing = F.concat(F.lit("no statistics for media "), F.col("media_id"))
    return lookup_join(wanted, found, ["media_id"], "left", computed=True).select(
        "media_id", "engagement", F.when(F.col("_found").isNull(), missing).alias("error")
    )


def unmatched(events: DataFrame, media: DataFrame) -> DataFrame:
    """Events the engagement join loses: media_id null, empty or unknown."""
    known = media.select(F.col("hashed_id").alias("media_id"))
    return lookup_join(events, known, ["media_id"], "left_anti")
