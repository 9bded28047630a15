from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column of dim_media -> field of the raw media object (fixed values).
MEDIA_FIELDS = {
    "media_id": "id",
    "title": "name",
    "url": "thumbnail.url",
    "duration": "duration",
    "created_at": "created",
    "updated_at": "updated",
    "hashed_id": "hashed_id",
}
# Columns of fact_events, named alike in the raw event object (fixed values).
EVENT_FIELDS = [
    "visitor_key",
    "event_key",
    "received_at",
    "percent_viewed",
    "ip",
    "country",
    "media_id",
    "media_url",
]


def flatten_media(df: DataFrame) -> DataFrame:
    """Raw media objects to the columns of dim_media; no thumbnail gives a null url."""
    return df.select(*[F.col(field).alias(name) for name, field in MEDIA_FIELDS.items()])


def project_events(df: DataFrame) -> DataFrame:
    return df.select(*EVENT_FIELDS)


def as_date(run_date: dt.date | str | None) -> dt.date:
    """The run date: as given, or today in UTC. Fixed once, so that all tasks agree on it."""
    if run_date is None:
        return dt.datetime.now(dt.timezone.utc).date()
    if isinstance(run_date, str):
        return dt.date.fromisoformat(run_date)
    return run_date


def stamp(df: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    """Add load_date: the date of the run, not of the events."""
    day = F.current_date() if run_date is None else F.lit(as_date(run_date))
    return df.withColumn("load_date", day)


def envelope(df: DataFrame) -> DataFrame:
    """``media_id, engagement`` per looked-up media; a failed lookup carries an error object."""
    failure = F.to_json(F.struct("media_id", "error"))
    return df.select("media_id", F.coalesce("engagement", failure).alias("engagement"))
