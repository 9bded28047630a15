from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playline.functions import parse_time, utc_day
from playline.operators.lookup import lookup_join


def received_after(df: DataFrame, cutoff=None, until=None) -> DataFrame:
    """Events received strictly after ``cutoff`` (default: today 00:00 UTC), and not after
    ``until`` if given. Plain comparisons, so they reach the Parquet scan."""
    start = utc_day(F.current_timestamp()) if cutoff is None else as_instant(cutoff)
    df = df.where(F.col("received_at") > start)
    return df if until is None else df.where(F.col("received_at") <= as_instant(until))


def as_instant(value) -> Column:
    """A time as a column; a datetime without a zone is UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value).cast("timestamp")


def received_between(df: DataFrame, after=None, until=None) -> DataFrame:
    """Events received strictly after the one and not after the other, where given. Events without
    a usable time stay, so that they can be recorded as rejected."""
    time = _usable_time(df)
    inside = F.lit(True)
    if after is not None:
        inside &= time > as_instant(after)
    if until is not None:
        inside &= time <= as_instant(until)
    return df.where(time.isNull() | inside)


def _usable_time(df: DataFrame) -> Column:
    time = F.col("received_at")
    if isinstance(df.schema["received_at"].dataType, T.StringType):
        time = parse_time(time)
    return time


def reject_bad_time(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split off events whose ``received_at`` is missing, empty or no ISO-8601 time."""
    time = _usable_time(df)
    good = df.where(time.isNotNull()).withColumn("received_at", time)
    return good, df.where(time.isNull())


def for_media(df: DataFrame, media) -> DataFrame:
    """Events of the allowed media: a short list of ids, or a DataFrame with ``media_id``."""
    if isinstance(media, DataFrame):
        return lookup_join(df, media, ["media_id"], "left_semi")
    return df.where(F.col("media_id").isin(list(media)))


def with_key(df: DataFrame) -> DataFrame:
    """Media with a usable hashed_id."""
    return df.where(F.col("hashed_id").isNotNull() & (F.col("hashed_id") != ""))


def until_empty_page(pages: DataFrame, pred: Column, by: list[str]) -> DataFrame:
    """Rows that pass ``pred`` on the pages before the first page where none passes.

    ``by`` names the source the pages belong to; a source without such a page keeps all of them.
    """
    hit = F.coalesce(pred, F.lit(False))
    stops = (
        pages.groupBy(*by, "page")
        .agg(F.max(hit).alias("_any"))
        .where(~F.col("_any"))
        .groupBy(*by)
        .agg(F.min("page").alias("_stop"))
    )
    rows, ends = pages.where(pred).alias("rows"), stops.alias("ends")
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"ends.{c}")) for c in by]
    return (
        rows.join(ends, same, "left")
        .where(F.col("_stop").isNull() | (F.col("rows.page") < F.col("_stop")))
        .select("rows.*")
    )


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Engagement envelopes whose ``engagement`` is an error object, apart from the others."""
    if isinstance(df.schema["engagement"].dataType, T.VariantType):
        error = F.try_variant_get("engagement", "$.error", "string")
    else:
        error = F.get_json_object("engagement", "$.error")
    return df.where(error.isNull()), df.where(error.isNotNull()).withColumn("error", error)
