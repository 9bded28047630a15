import datetime as dt

import pytest
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.project import stamp
from playline.sinks.catalog import register
from playline.sinks.tables import EmptySnapshotError, append_new, write_append, write_snapshot

COLUMNS = "event_key STRING, received_at TIMESTAMP, n DOUBLE"
TEN = dt.datetime(2024, 1, 30, 10)


def batch(spark, *rows, day="2024-01-30"):
    return spark.createDataFrame([(k, TEN, n) for k, n in rows], COLUMNS).transform(stamp, day)


def stored(spark, path):
    df = spark.read.schema(f"{COLUMNS}, load_date DATE").parquet(path)
    return sorted(((r.event_key, r.n, str(r.load_date)) for r in df.collect()), key=repr)


def dates(path):
    return sorted(p.name for p in path.glob("load_date=*"))


def test_snapshot_leaves_one_load_date_whatever_the_session_says(spark, settings, tmp_path):
    settings(spark__sql__sources__partitionOverwriteMode="dynamic")
    path = tmp_path / "t"
    assert write_snapshot(batch(spark, ("a", 1.0), ("b", 1.0), day="2024-01-29"), str(path)) == 2
    assert write_snapshot(batch(spark, ("a", 2.0)), str(path)) == 1
    assert dates(path) == ["load_date=2024-01-30"]
    assert stored(spark, str(path)) == [("a", 2.0, "2024-01-30")]


def test_empty_snapshot_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(batch(spark, ("a", 1.0)), path)
    with pytest.raises(EmptySnapshotError):
        write_snapshot(batch(spark, ("a", 1.0)).where("n > 5"), path)
    assert stored(spark, path) == [("a", 1.0, "2024-01-30")]
    assert write_snapshot(batch(spark, ("a", 1.0)).where("n > 5"), path, allow_empty=True) == 0
    assert stored(spark, path) == []


def test_blind_append_keeps_copies(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert write_append(batch(spark, ("a", 1.0)), path) == 1
    assert len(stored(spark, path)) == 2


def test_empty_append_writes_nothing(spark, tmp_path):
    path = tmp_path / "t"
    assert write_append(batch(spark, ("a", 1.0)).where("n > 5"), str(path)) == 0
    assert not path.exists()


def test_types_hold_over_appends(spark, raw, tmp_path):
    from conftest import event
    from playline.operators.project import project_events
    from playline.sources.raw import read_events

    path = str(tmp_path / "t")
    for number, percent in ((1, 50), (2, 50.5)):
        file = raw.events(f"2024013{number}_000000", [event(str(number), percent_viewed=percent)])
        write_append(project_events(read_events(spark, file)).transform(stamp, "2024-01-30"), path)
    read = spark.read.parquet(path)
    assert read.schema["percent_viewed"].dataType.simpleString() == "double"
    assert sorted(r.percent_viewed for r in read.collect()) == [50.0, 50.5]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_append_new(spark, settings, tmp_path, limit):
    settings(playline__lookup__broadcastBytes=limit)
    path = str(tmp_path / "t")
    assert append_new(batch(spark, ("a", 1.0), ("b", 1.0), day="2024-01-29"), path) == 2
    assert append_new(batch(spark, ("b", 9.0), ("c", 1.0), ("c", 1.0)), path) == 1
    assert append_new(batch(spark, ("b", 9.0), ("c", 1.0), day="2024-01-31"), path) == 0
    assert stored(spark, path) == [
        ("a", 1.0, "2024-01-29"), ("b", 1.0, "2024-01-29"), ("c", 1.0, "2024-01-30")]
    assert dates(tmp_path / "t") == ["load_date=2024-01-29", "load_date=2024-01-30"]


def test_earliest_of_a_key_wins(spark, tmp_path):
    later = TEN + dt.timedelta(hours=1)
    rows = [("a", later, 1.0), ("a", TEN, 3.0), ("a", TEN, 2.0)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3).transform(stamp, "2024-01-30")
    append_new(df, str(tmp_path / "t"))
    assert stored(spark, str(tmp_path / "t")) == [("a", 2.0, "2024-01-30")]


def test_rows_without_a_key_are_told_apart_by_content(spark, tmp_path):
    """Rows alike count: as many are added as the batch has more of them than the table."""
    path = str(tmp_path / "t")
    micro = [(None, TEN.replace(microsecond=m), 1.0) for m in (1, 2, 2)]
    df = spark.createDataFrame([*micro, (None, TEN, None), ("a", TEN, 1.0)], COLUMNS)
    assert append_new(df.transform(stamp, "2024-01-29"), path) == 5
    assert append_new(df.transform(stamp, "2024-01-30"), path) == 0
    three = spark.createDataFrame([micro[2]] * 3, COLUMNS)
    assert append_new(three.transform(stamp, "2024-01-30"), path) == 1
    assert append_new(batch(spark, (None, 7.0)), path) == 1
    assert append_new(batch(spark, ("", 7.0), ("", 7.0), ("", 8.0)), path) == 3
    assert len(stored(spark, path)) == 10


def test_very_many_copies_without_a_key(spark, tmp_path):
    df = spark.range(25_001).select(
        F.lit(None).cast("string").alias("event_key"), F.lit(TEN).alias("received_at"),
        F.lit(1.0).alias("n")).transform(stamp, "2024-01-30")
    assert append_new(df, str(tmp_path / "t")) == 25_001
    assert append_new(df, str(tmp_path / "t")) == 0


@pytest.mark.parametrize("limit", [10**9, 0])
def test_keyed_append_sorts_only_repeated_keys(spark, settings, limit):
    """Neither stored keys nor the batch's are aggregated by sorting."""
    from conftest import plan
    from playline.sinks.tables import first_per_key, known_keys

    settings(playline__lookup__broadcastBytes=limit, spark__sql__autoBroadcastJoinThreshold=-1)
    df = batch(spark, *[(str(n % 7), float(n)) for n in range(20)])
    keys = df.groupBy("event_key").agg(F.count(F.lit(1)).alias("_rows"))
    hits = plan(known_keys(df.select("event_key"), keys.select("event_key"), 100))
    assert "SortAggregate" not in hits and ("Broadcast" in hits) == (limit > 0)
    text = plan(first_per_key(df, keys.where("_rows > 1").select("event_key"), "event_key"))
    assert "SortAggregate" not in text and "WindowGroupLimit" in text


def test_hot_key_and_copies(spark, tmp_path):
    """A third of all rows is one key: one row is left of it, everything else is there."""
    path = str(tmp_path / "t")
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_key"),
        F.lit(TEN).alias("received_at"), F.lit(1.0).alias("n")).transform(stamp, "2024-01-30")
    assert append_new(df, path) == 2001
    assert append_new(df, path) == 0


def test_search_can_be_limited_to_recent_load_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    append_new(batch(spark, ("a", 1.0), day="2024-01-01"), path)
    append_new(batch(spark, ("b", 1.0), day="2024-01-29"), path)
    both = batch(spark, ("a", 1.0), ("b", 1.0))
    assert append_new(both, path, since=dt.date(2024, 1, 20)) == 1


def test_registered_table_follows_the_folder(spark, tmp_path):
    path, schema = str(tmp_path / "t"), f"{COLUMNS}, load_date DATE"
    keys = lambda: sorted(r.event_key for r in spark.table("checks.t").collect())
    register(spark, "checks", "t", path, schema)
    assert keys() == []
    write_append(batch(spark, ("a", 1.0), day="2024-01-29"), path)
    register(spark, "checks", "t", path, schema)
    assert keys() == ["a"]
    write_snapshot(batch(spark, ("b", 1.0), ("c", 1.0)), path)
    register(spark, "checks", "t", path, schema)
    assert keys() == ["b", "c"]
    assert [r[0] for r in spark.sql("SHOW PARTITIONS checks.t").collect()] == ["load_date=2024-01-30"]
    elsewhere = str(tmp_path / "u")
    write_append(batch(spark, ("z", 1.0)), elsewhere)
    register(spark, "checks", "t", elsewhere, schema)
    assert keys() == ["z"]
    assert len(stored(spark, path)) == 2


def test_schemas_parse(spark):
    for schema in schemas.TABLES.values():
        assert spark.createDataFrame([], schema).columns[-1] == "load_date"


def test_a_registered_name_moves_only_when_told_to(spark, tmp_path):
    schema = f"{COLUMNS}, load_date DATE"
    for name in ("t", "it's"):
        write_append(batch(spark, (name, 1.0)), str(tmp_path / name))
    register(spark, "checks", "moving", str(tmp_path / "t"), schema)
    with pytest.raises(ValueError):
        register(spark, "checks", "moving", str(tmp_path / "it's"), schema, move=False)
    assert spark.table("checks.moving").first().event_key == "t"
    register(spark, "checks", "moving", str(tmp_path / "it's"), schema)
    assert spark.table("checks.moving").first().event_key == "it's"
