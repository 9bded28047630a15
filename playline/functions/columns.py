from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# percent_viewed runs from 0 to 100.
PERCENT_SCALE = 100


def watch_time(percent_viewed: Column, duration: Column) -> Column:
    """Seconds watched, rounded half up to two digits."""
    return F.round(percent_viewed / F.lit(PERCENT_SCALE) * duration, 2)


def watch_cents(seconds: Column) -> Column:
    """Two-digit seconds as whole hundredths. Sums of these are exact in any order and stay in
    a long, where a sum of doubles would depend on the order of the rows."""
    return F.rint(seconds * 100).cast("bigint")


def parse_number(text: Column) -> Column:
    """Text to a finite number; null for anything else, NaN and Infinity included: one of them
    would make every sum over it useless."""
    value = text.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def parse_time(text: Column) -> Column:
    """ISO-8601 text to an instant; null for anything else. Text without a zone is UTC.

    ``try_to_timestamp`` alone also takes a bare "12:30" (as a time of today) or "2024", so a
    full date is required first, and the zone is made explicit.
    """
    text = F.trim(text)
    zoned = (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(r"[zZ]$|[+-]\d{2}(:?\d{2})?$"), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d|$)"), F.try_to_timestamp(zoned))


def utc_day(instant: Column) -> Column:
    """Midnight of the UTC day (the session zone is pinned to UTC)."""
    return F.date_trunc("DAY", instant)


def run_stamp(instant: Column) -> Column:
    """The run timestamp used in names of raw files."""
    return F.date_format(instant, "yyyyMMdd_HHmmss")


def raw_key(dataset: str, prefix: str, stamp: Column) -> Column:
    """Key of a raw file, e.g. raw_data/events/player_events_20240130_235000.json."""
    return F.concat(F.lit(f"raw_data/{dataset}/{prefix}_"), stamp, F.lit(".json"))
