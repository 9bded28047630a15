import datetime as dt

import pytest
from conftest import event, media, plan
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.joins import join_media
from playline.plans import reports
from playline.plans.daily import build_daily, daily_engagement
from playline.plans.jobs import build_dim_media, table_path
from playline.plans.sketches import audience, build_sketches
from playline.sinks.tables import append_new
from playline.sinks.versions import latest, read_version
from playline.streaming.daily import stream_daily


def at(key, day, media_id="h1", **more):
    return event(key, media_id, received_at=f"2024-01-{day:02d}T10:00:00Z", **more)


def facts(spark, out):
    return spark.read.schema(schemas.FACT_EVENTS).parquet(table_path(out, "fact_events"))


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


DAILY = "event_date", "events", "visitors", "total_watch_time_seconds"


def whole(spark, out):
    dim = read_version(spark, table_path(out, "dim_media"), schemas.DIM_MEDIA)
    return listed(reports.daily(join_media(facts(spark, out), dim)), *DAILY)


def test_daily_stream_corrects_late_days_and_replays_add_nothing(spark, raw, tmp_path):
    out, folder = str(tmp_path / "out"), str(raw.root / "raw_data/events")
    raw.media("20240128_235000", [media(1), media(2)])
    build_dim_media(spark, str(raw.root), out, "2024-01-28")
    raw.events("20240129_000000", [at("a", 28), at("b", 29, visitor_key="v2"), at("x", 29, "unknown")])
    stream_daily(spark, folder, out, str(tmp_path / "c"), "2024-01-29")
    assert listed(daily_engagement(spark, out), *DAILY) == whole(spark, out)
    assert len(whole(spark, out)) == 2
    # Late by days, a copy, one without a time; then the same files from a new checkpoint.
    raw.events("20240130_000000", [at("c", 28, visitor_key="v3"), at("d", 1), at("b", 29), event("e", received_at="no")])
    stream_daily(spark, folder, out, str(tmp_path / "c"), "2024-01-30")
    days = listed(daily_engagement(spark, out), *DAILY)
    assert days == whole(spark, out) and len(days) == 3
    assert dict((d, n) for d, n, *_ in days)[dt.date(2024, 1, 28)] == 2
    before = latest(spark, table_path(out, "daily_engagement"))
    stream_daily(spark, folder, out, str(tmp_path / "other"), "2024-01-30")
    assert listed(daily_engagement(spark, out), *DAILY) == days
    assert latest(spark, table_path(out, "daily_engagement")) == before
    # A longer media changes all days.
    raw.media("20240131_000000", [media(1, duration=999)])
    build_dim_media(spark, str(raw.root), out, "2024-01-31")
    assert build_daily(spark, out, "2024-01-31") == 3
    assert listed(daily_engagement(spark, out), *DAILY) == whole(spark, out) != days
    assert build_daily(spark, out, "2024-01-31", days=[]) == 0


def events(spark, first, last, day):
    ids = spark.range(first, last).selectExpr(
        "concat('v', id % 3000) AS visitor_key", "concat('e', id) AS event_key",
        "timestamp '2024-01-10 00:00:00' + make_interval(0, 0, 0, id % 5) AS received_at",
        "CAST(id % 101 AS DOUBLE) AS percent_viewed", "'ip' AS ip",
        "IF(id % 7 = 0, NULL, concat('c', id % 2)) AS country", "concat('h', id % 3) AS media_id",
        "'url' AS media_url", f"DATE '{day}' AS load_date",
    )
    return ids


def test_sketches_unite_within_their_error_without_the_events(spark, tmp_path):
    out = str(tmp_path / "out")
    path = table_path(out, "fact_events")
    append_new(events(spark, 0, 4000, "2024-01-28"), path)
    assert build_sketches(spark, out, "2024-01-28") > 0
    kept = set(read_version(spark, table_path(out, "audience_sketches"), schemas.AUDIENCE_SKETCHES).inputFiles())
    append_new(events(spark, 3000, 9000, "2024-01-29"), path)
    build_sketches(spark, out, "2024-01-29")
    assert kept < set(
        read_version(spark, table_path(out, "audience_sketches"), schemas.AUDIENCE_SKETCHES).inputFiles()
    )
    assert build_sketches(spark, out, "2024-01-29") == 0
    keys = {"media": F.col("media_id"), "country": F.col("country"), "day": F.to_date("received_at").cast("string")}
    for span in ({}, {"since": dt.date(2024, 1, 29)}, {"until": dt.date(2024, 1, 28)}):
        stored = facts(spark, out)
        if "since" in span:
            stored = stored.where("load_date >= '2024-01-29'")
        if "until" in span:
            stored = stored.where("load_date <= '2024-01-28'")
        for dimension, key in keys.items():
            report = audience(spark, out, dimension, **span)
            assert "fact_events" not in plan(report) and "audience_sketches" in plan(report)
            got = {r.value: r for r in report.collect()}
            exact = stored.groupBy(key.alias("value")).agg(
                F.count(F.lit(1)).alias("events"), F.count_distinct("visitor_key").alias("visitors"),
                F.round(F.avg(F.col("percent_viewed").cast("decimal(18,9)")), 6).cast("double").alias("mean"),
            ).collect()
            assert got.keys() == {r.value for r in exact}
            for r in exact:
                mine = got[r.value]
                assert (mine.events, mine.avg_percent_viewed) == (r.events, r.mean)
                assert abs(mine.visitors - r.visitors) <= 0.03 * r.visitors
    with pytest.raises(ValueError):
        audience(spark, out, "ip")
