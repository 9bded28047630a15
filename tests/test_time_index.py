import datetime as dt

import pytest
from pyspark.sql import functions as F

from playline import schemas
from playline.functions import parse_time
from playline.plans.jobs import build_fact_events, table_path
from playline.sinks.landing import files_log, in_time_ranges, land_and_record
from playline.sources.batches import overlapping_batches
from playline.sources.raw import read_events


def events(spark, days, per_day, bad):
    """Text events over some days; ``bad`` more have no usable time."""
    rows = [
        (f"d{d}-{k}", f"2024-01-{d:02}T{k % 24:02}:00:00.000000Z") for d in days for k in range(per_day)
    ]
    rows += [(f"bad{days[0]}-{k}", [None, "", "oops"][k % 3]) for k in range(bad)]
    short = spark.createDataFrame(rows, "event_key string, received_at string")
    kinds = [f.split() for f in schemas.RAW_EVENTS.split(", ")]
    return short.select(
        *[F.col(n) if n in short.columns else F.lit(None).cast(k).alias(n) for n, k in kinds]
    )


@pytest.fixture
def landed(spark, tmp_path):
    root, log = str(tmp_path / "data"), str(tmp_path / "landed")
    folder = f"{root}/raw_data/events"
    for stamp, days in (("20240111_000000", range(1, 11)), ("20240121_000000", range(11, 21))):
        land_and_record(events(spark, days, 30, 7), folder, stamp, log, "events", time_ranges=5)
    return root, log


def spans(spark, paths):
    rows = read_events(spark, paths).select("received_at", F.input_file_name().alias("file"))
    return rows.groupBy("file").agg(
        F.min("received_at").alias("low"), F.max("received_at").alias("high"), F.count("*").alias("n")
    ).collect()


def test_only_files_of_the_range_and_of_events_without_a_time(spark, landed):
    root, log = landed
    after, until = dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 5, 12)
    chosen = overlapping_batches(spark, log, "events", after, until)
    # The second batch lies outside; only its files of events without a time are read.
    every = spans(spark, [r.path for r in spark.read.parquet(log).collect()])
    timed = [r for r in every if r.low is not None]
    inside = {r.file for r in timed if r.high > after and r.low <= until}
    want = inside | {r.file for r in every if r.low is None}
    assert set(read_events(spark, chosen).inputFiles()) == want and len(inside) < len(timed) / 3
    assert not any(r.low is None and r.high is not None for r in every)
    count = build_fact_events(spark, root, root, "2024-01-30", from_ts=after, to_ts=until, batches=log)
    assert count == sum(
        after < dt.datetime(2024, 1, d, k % 24) <= until for d in range(1, 21) for k in range(30)
    )
    assert spark.read.parquet(table_path(root, "rejected_events")).count() == 14


def test_whole_batches_are_read_as_folders_and_without_the_index_too(spark, landed):
    _, log = landed
    folders = {r.path for r in spark.read.parquet(log).collect()}
    assert set(overlapping_batches(spark, log, "events")) == folders
    assert read_events(spark, sorted(folders)).count() == 2 * (300 + 7)
    # A batch whose files nobody recorded is read whole.
    folder = sorted(folders)[0].rsplit("/", 1)[0]
    whole = land_and_record(events(spark, [3], 5, 1), folder, "20240122_000000", log, "events")
    assert whole in overlapping_batches(spark, log, "events", dt.datetime(2024, 1, 25), None)


def test_files_of_a_landing_that_was_not_published_do_not_count(spark, landed):
    _, log = landed
    lost = [("events", "/no/run_ts=1", "/no/run_ts=1/part-0.json", 1, None, None, 1)]
    spark.createDataFrame(lost, schemas.LANDED_FILES).write.mode("append").parquet(files_log(log))
    chosen = overlapping_batches(spark, log, "events", dt.datetime(2024, 1, 4), None)
    assert chosen and not any("/no/" in p for p in chosen)


def test_hot_times_and_events_without_one_are_spread(spark):
    hot = events(spark, [1], 1, 0).crossJoin(spark.range(900)).drop("id")
    none = hot.limit(300).withColumn("received_at", F.lit(None).cast("string"))
    rest = events(spark, range(2, 12), 30, 0)
    got = in_time_ranges(hot.unionAll(rest).unionAll(none), 4)
    sizes = got.groupBy(F.spark_partition_id().alias("p"), parse_time(F.col("received_at")).isNull().alias("none"))
    counts = {(r.p, r.none): r["count"] for r in sizes.count().collect()}
    assert sum(counts.values()) == 1500 and max(counts.values()) < 700
    assert len({p for p, none in counts if none}) == 4
    assert not {p for p, none in counts if none} & {p for p, none in counts if not none}
    assert in_time_ranges(none, 3).count() == 300 and in_time_ranges(none.limit(0), 3).count() == 0
    assert in_time_ranges(rest, 1).count() == 300
