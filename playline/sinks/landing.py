"""Landing of raw batches and the record of what landed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playline import schemas
from playline.functions import parse_time


def run_ts_text(run_ts: dt.datetime | str) -> str:
    # The form of the timestamps in raw file names (fixed value).
    return run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y%m%d_%H%M%S")


def _micros(df: DataFrame) -> Column:
    """Time of an event in microseconds since 1970."""
    time = F.col("received_at")
    if isinstance(df.schema["received_at"].dataType, T.StringType):
        time = parse_time(time)
    return F.unix_micros(time.cast("timestamp"))


def _span(df: DataFrame) -> list[Column]:
    """Aggregates that tell which time ranges a batch of events can matter for."""
    if "received_at" not in df.columns:
        return []
    micros = _micros(df)
    return [
        F.min(micros).alias("first_at"),
        F.max(micros).alias("last_at"),
        F.count_if(micros.isNull()).alias("timeless"),
    ]


def in_time_ranges(df: DataFrame, ranges: int) -> DataFrame:
    """The events in ``ranges`` partitions that follow each other in time, each about as large, and
    as many behind them for events without a time, so that no file holds both.

    The borders come from a pass of their own, by approximate percentiles. Events of one instant that
    fills several ranges are spread over these.
    """
    micros = _micros(df)
    shares = [(k + 1) / ranges for k in range(ranges - 1)]
    found = df.agg(F.percentile_approx(micros, shares, 1000).alias("at")).first().at if shares else []
    borders = F.array(*[F.lit(b).cast("long") for b in found or []]).cast("array<bigint>")
    below = F.size(F.filter(borders, lambda b: b < micros))
    upto = F.size(F.filter(borders, lambda b: b <= micros))
    turn = F.monotonically_increasing_id()
    timed = below + turn % (upto - below + 1)
    place = F.when(micros.isNull(), ranges + turn % ranges).otherwise(timed).cast("int")
    return df.withColumn("__range", place).repartitionById(2 * ranges, "__range").drop("__range")


def files_log(batches: str) -> str:
    """The table of landed files beside the table of landed batches."""
    return f"{batches.rstrip('/')}_files"


def record_files(spark: SparkSession, batches: str, dataset: str, path: str) -> None:
    """Note the time span of each file of a landed batch; before its publication, which makes it count."""
    events = spark.read.schema(schemas.RAW_EVENTS).json(path)
    named = events.select("received_at", F.col("_metadata.file_name").alias("name"))
    spans = named.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), *_span(named))
    spans.select(
        F.lit(dataset).alias("dataset"),
        F.lit(path).alias("path"),
        F.concat(F.lit(f"{path}/"), "name").alias("file"),
        "rows",
        F.timestamp_micros("first_at").alias("first_at"),
        F.timestamp_micros("last_at").alias("last_at"),
        "timeless",
    ).coalesce(1).write.mode("append").parquet(files_log(batches))


def land_raw(df: DataFrame, raw_dir: str, run_ts: dt.datetime | str) -> tuple[str | None, int]:
    """Write a raw batch as JSON lines below ``run_ts=…``; nothing at all for an empty one.

    Returns the folder (None if empty) and the number of rows.
    """
    path, seen = _land(df, raw_dir, run_ts)
    return path, seen["rows"]


def _land(
    df: DataFrame, raw_dir: str, run_ts: dt.datetime | str, as_text: bool = False
) -> tuple[str | None, dict]:
    if df.isEmpty():
        return None, {"rows": 0}
    path = f"{raw_dir.rstrip('/')}/run_ts={run_ts_text(run_ts)}"
    seen = Observation()
    # The default format would cut times to milliseconds.
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_span(df)).write.option(
        "timestampFormat", schemas.JSON_TIME
    )
    writer.text(path) if as_text else writer.json(path)
    return path, seen.get


def record_batch(
    spark: SparkSession,
    batches: str,
    dataset: str,
    path: str | None,
    run_ts: dt.datetime | str,
    rows: int,
    first_at: int | None = None,
    last_at: int | None = None,
    timeless: int | None = None,
) -> None:
    """Publish a landed batch; ``rows=0`` says that the run had nothing new.

    ``first_at`` and ``last_at`` are the least and greatest time of its events in microseconds
    since 1970, ``timeless`` the number of events without a time; None where it is not known.
    """
    entry = spark.sql(
        "SELECT :dataset AS dataset, CAST(:path AS STRING) AS path, :run_ts AS run_ts, "
        "CAST(:rows AS BIGINT) AS rows, timestamp_micros(CAST(:first_at AS BIGINT)) AS first_at, "
        "timestamp_micros(CAST(:last_at AS BIGINT)) AS last_at, "
        "CAST(:timeless AS BIGINT) AS timeless",
        args={
            "dataset": dataset,
            "path": path,
            "run_ts": run_ts_text(run_ts),
            "rows": rows,
            "first_at": first_at,
            "last_at": last_at,
            "timeless": timeless,
        },
    )
    entry.write.mode("append").parquet(batches)


def land_and_record(
    df: DataFrame,
    raw_dir: str,
    run_ts: dt.datetime | str,
    batches: str,
    dataset: str,
    as_text: bool = False,
    time_ranges: int | None = None,
) -> str | None:
    """Land, then publish. A failed landing raises and publishes nothing. With ``as_text``, ``df`` has
    one column of lines that are JSON already.

    With ``time_ranges``, events land in files of that many ranges of time (``in_time_ranges``, a
    shuffle), whose spans are recorded, so that a load of a range reads only the files that it needs.
    """
    if time_ranges:
        df = in_time_ranges(df, time_ranges)
    path, seen = _land(df, raw_dir, run_ts, as_text)
    if time_ranges and path:
        record_files(df.sparkSession, batches, dataset, path)
    record_batch(df.sparkSession, batches, dataset, path, run_ts, **seen)
    return path
