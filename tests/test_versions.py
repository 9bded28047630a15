import datetime as dt

import pytest
from conftest import event, media, plan
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.joins import engagement
from playline.operators.project import stamp
from playline.plans.jobs import build_engagement, run_daily, table_path
from playline.sinks.catalog import register
from playline.sinks.tables import EmptySnapshotError, write_append
from playline.sinks.versions import (
    Layout,
    WriterConflictError,
    latest,
    publish,
    read_version,
    register_version,
    vacuum,
    versions,
)

SCHEMA = "k STRING, n INT, load_date DATE"
DAY = dt.date(2024, 1, 30)


def rows_for(spark, *rows, day="2024-01-30"):
    return spark.createDataFrame(rows, "k STRING, n INT").transform(stamp, day)


def read(spark, path, number=None):
    return sorted((r.k, r.n) for r in read_version(spark, path, SCHEMA, number).collect())


def test_earlier_versions_stay_readable_by_number(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read(spark, path) == []
    assert publish(rows_for(spark, ("a", 1), ("b", 2), day="2024-01-29"), path, DAY) == 2
    assert publish(rows_for(spark, ("c", 3)), path, DAY) == 1
    assert read(spark, path) == [("c", 3)]
    assert read(spark, path, 1) == [("a", 1), ("b", 2)]
    assert [r.load_date for r in read_version(spark, path, SCHEMA).collect()] == [DAY]
    with pytest.raises(ValueError, match="no version 7"):
        read(spark, path, 7)
    assert [(r.number, r.rows, r.written) for r in versions(spark, path).orderBy("number").collect()] == [
        (1, 2, 1), (2, 1, 1)]


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(rows_for(spark, ("a", 1)), path, DAY)
    register_version(spark, "checks", "held", path, SCHEMA)
    broken = spark.range(1000, numPartitions=4).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") < 990, F.lit(1)).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("n"),
    )
    with pytest.raises(Exception, match="lost"):
        publish(broken.transform(stamp, "2024-01-31"), path, DAY)
    assert read(spark, path) == [("a", 1)] and latest(spark, path) == 1
    assert [r.k for r in spark.table("checks.held").collect()] == ["a"]
    # The next write does not mix with what was left.
    publish(rows_for(spark, ("b", 2)), path, DAY)
    assert read(spark, path) == [("b", 2)] and read(spark, path, 1) == [("a", 1)]


def test_empty_versions_are_refused_unless_allowed(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(rows_for(spark, ("a", 1)), path, DAY)
    none = rows_for(spark, ("a", 1)).where("n > 5")
    with pytest.raises(EmptySnapshotError):
        publish(none, path, DAY)
    assert read(spark, path) == [("a", 1)]
    assert publish(none, path, DAY, allow_empty=True) == 0
    assert read(spark, path) == []
    register_version(spark, "checks", "emptied", path, SCHEMA)
    assert spark.table("checks.emptied").count() == 0


BY_N = Layout(("n",))


def test_replaced_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(rows_for(spark, ("a", 1), ("b", 2), ("c", 3)), path, DAY, BY_N)
    before = set(read_version(spark, path, SCHEMA).inputFiles())
    gone = spark.createDataFrame([(2,), (3,)], "n INT")
    later = dt.date(2024, 1, 31)
    assert publish(rows_for(spark, ("d", 2)), path, later, BY_N, replaced=gone) == 2
    assert read(spark, path) == [("a", 1), ("d", 2)]
    # The load date is that of the version, for partitions of earlier writes too.
    assert {r.load_date for r in read_version(spark, path, SCHEMA).collect()} == {later}
    after = set(read_version(spark, path, SCHEMA).inputFiles())
    assert len(after & before) == 1 and len(after - before) == 1
    register_version(spark, "checks", "parts", path, SCHEMA)
    assert sorted((r.k, r.n) for r in spark.table("checks.parts").collect()) == [("a", 1), ("d", 2)]
    register_version(spark, "checks", "parts", path, SCHEMA, number=1)
    assert spark.table("checks.parts").count() == 3
    assert "dynamicpruning" in plan(spark.table("checks.parts"))


def test_two_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(rows_for(spark, ("a", 1)), path, DAY)
    from playline.sinks import versions as own

    true_read, calls = own.read_table, []

    def read_while_another_publishes(*args):
        if not calls:
            calls.append(1)
            publish(rows_for(spark, ("other", 2)), path, DAY)
        return true_read(*args)

    monkeypatch.setattr(own, "read_table", read_while_another_publishes)
    with pytest.raises(WriterConflictError):
        publish(rows_for(spark, ("late", 3)), path, DAY)
    assert read(spark, path) == [("other", 2)]


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(rows_for(spark, ("a", 1), ("b", 2)), path, DAY, BY_N)
    for k in "cde":
        publish(rows_for(spark, (k, 2)), path, DAY, BY_N, replaced=spark.createDataFrame([(2,)], "n INT"))
    with pytest.raises(ValueError):
        vacuum(spark, path, 0)
    assert vacuum(spark, path, keep=2) == [2]
    assert read(spark, path) == [("a", 1), ("e", 2)] and read(spark, path, 3) == [("a", 1), ("d", 2)]
    assert vacuum(spark, path, keep=2) == []


def test_names_change_between_plain_tables_and_versions(spark, tmp_path):
    plain, path = str(tmp_path / "plain"), str(tmp_path / "it's`t")
    write_append(rows_for(spark, ("p", 0)), plain)
    publish(rows_for(spark, ("v", 1)), path, DAY)
    first = lambda: spark.table("checks.either").first().k
    register(spark, "checks", "either", plain, SCHEMA)
    with pytest.raises(ValueError, match="another place"):
        register_version(spark, "checks", "either", path, SCHEMA, move=False)
    register_version(spark, "checks", "either", path, SCHEMA)
    assert first() == "v"
    register_version(spark, "checks", "either", path, SCHEMA, move=False)
    with pytest.raises(ValueError, match="another place"):
        register(spark, "checks", "either", plain, SCHEMA, move=False)
    register(spark, "checks", "either", plain, SCHEMA)
    assert first() == "p"


# The engagement fact, computed in part


def fact(spark, out, number=None):
    return read_version(spark, table_path(out, "fact_media_engagement"), schemas.FACT_MEDIA_ENGAGEMENT, number)


def full(spark, out, day):
    events = spark.read.schema(schemas.FACT_EVENTS).parquet(table_path(out, "fact_events"))
    dim = read_version(spark, table_path(out, "dim_media"), schemas.DIM_MEDIA)
    return engagement(events, dim, day)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_incremental_engagement_equals_the_full_one(spark, raw, tmp_path):
    place = str(raw.root), str(tmp_path / "out")
    out = place[1]
    films = [media(n) for n in range(40)]
    raw.media("20240128_235000", films)
    raw.events("20240128_235000", [event(f"a{n}", f"h{n}") for n in range(40)])
    run_daily(spark, *place, "2024-01-28")
    before = set(fact(spark, out).inputFiles())

    # New events of one media, one media longer, one gone, one new, one twice; the others as before.
    changed = [media(0, duration=999), *films[2:], media(77), media(5, id=500, name="Copy")]
    raw.media("20240129_235000", changed)
    raw.events("20240129_235000", [event("b1", "h3"), event("b2", "h77"), event("b3", None)])
    assert run_daily(spark, *place, "2024-01-29")["fact_media_engagement"] == 42
    assert listed(fact(spark, out)) == listed(full(spark, out, "2024-01-29"))
    assert listed(spark.table("media_analytics.fact_media_engagement")) == listed(fact(spark, out))
    kept = before & set(fact(spark, out).inputFiles())
    assert 0 < len(kept) < len(before)

    # More events on the same day, then nothing new at all: every file stays, the load date does not.
    raw.events("20240129_235900", [event("b1", "h3"), event("b4", "h4")])
    run_daily(spark, *place, "2024-01-29")
    assert listed(fact(spark, out)) == listed(full(spark, out, "2024-01-29"))
    before = set(fact(spark, out).inputFiles())
    run_daily(spark, *place, "2024-01-30")
    assert set(fact(spark, out).inputFiles()) == before
    assert listed(fact(spark, out)) == listed(full(spark, out, "2024-01-30"))
    assert listed(fact(spark, out, 1)) != listed(fact(spark, out))

    # Without the media it was made from, all is computed.
    vacuum(spark, table_path(out, "dim_media"), 1)
    raw.media("20240131_235000", films)
    run_daily(spark, *place, "2024-01-31")
    vacuum(spark, table_path(out, "dim_media"), 1)
    assert build_engagement(spark, out, "2024-01-31", full=True) == 42
    assert listed(fact(spark, out)) == listed(full(spark, out, "2024-01-31"))


def test_an_engagement_that_lost_all_rows_is_refused(spark, raw, tmp_path):
    place = str(raw.root), str(tmp_path / "out")
    raw.media("20240128_235000", [media(1)])
    raw.events("20240128_235000", [event("a", "h1")])
    run_daily(spark, *place, "2024-01-28")
    raw.media("20240129_235000", [media(2)])
    with pytest.raises(EmptySnapshotError):
        run_daily(spark, *place, "2024-01-29")
    assert fact(spark, place[1]).count() == 1
    assert build_engagement(spark, place[1], "2024-01-29", allow_empty=True) == 0
    assert spark.table("media_analytics.fact_media_engagement").count() in (0, 1)
