import datetime as dt

import pytest
from conftest import plan

from playline.operators.project import stamp
from playline.sinks.keys import found_in, index_of
from playline.sinks.tables import append_new, known_keys, read_table, write_append

COLUMNS = "event_key STRING, received_at TIMESTAMP, n DOUBLE"
TEN = dt.datetime(2024, 1, 30, 10)


def batch(spark, *keys, day="2024-01-30"):
    rows = [(key, TEN, float(n)) for n, key in enumerate(keys)]
    return spark.createDataFrame(rows, COLUMNS).transform(stamp, day)


@pytest.fixture
def index(spark, settings):
    settings(playline__lookup__broadcastBytes=0, spark__sql__autoBroadcastJoinThreshold=-1)
    spark.sql("DROP TABLE IF EXISTS checks.some_keys")
    return "checks.some_keys"


def stored(spark, path):
    return sorted((r.event_key or "", str(r.load_date)) for r in spark.read.parquet(path).collect())


def test_append_by_index_equals_append_without(spark, tmp_path, index):
    by_index, without = str(tmp_path / "a"), str(tmp_path / "b")
    days = [("2024-01-28", "abc"), ("2024-01-29", "bcdde"), ("2024-01-29", "ef"), ("2024-01-30", "agg")]
    for day, keys in days:
        rows = batch(spark, *keys, None, "", day=day)
        assert append_new(rows, by_index, index=index) == append_new(rows, without)
    assert stored(spark, by_index) == stored(spark, without)
    # A replay, and only one load date back.
    assert append_new(batch(spark, "a", "g"), by_index, index=index) == 0
    since = dt.date(2024, 1, 30)
    assert append_new(batch(spark, "a", "g", "c", day="2024-01-31"), by_index, since=since, index=index) == 2


@pytest.mark.parametrize("partitions", [8, 200])
def test_only_the_batch_is_shuffled(spark, settings, tmp_path, index, partitions):
    settings(spark__sql__shuffle__partitions=partitions)
    path = str(tmp_path / "t")
    rows = batch(spark, *[str(n) for n in range(500)])
    write_append(rows, path)
    keys = batch(spark, "1", "x").groupBy("event_key").count().select("event_key")
    table = read_table(spark, path, rows.schema)
    by_index = index_of(table, path, "event_key", index).select("event_key")
    found = found_in(by_index, keys, index)
    assert sorted(r[0] for r in found.collect()) == ["1"]
    text = plan(found)
    # From the scan of the index to the join there is no exchange; without an index there is one.
    side = lambda text: text.split("\n\n\n")[0].split("+- Sort")[-1]
    assert "Bucketed: true" in text and "Exchange" not in side(text)
    assert "Exchange" in side(plan(known_keys(table.select("event_key"), keys, 10)))


def test_an_index_left_behind_by_a_lost_run_is_mended(spark, tmp_path, index):
    path = str(tmp_path / "t")
    append_new(batch(spark, "a", day="2024-01-29"), path, index=index)
    # Rows that reached the table but not the index, on an old and on a new load date.
    write_append(batch(spark, "b", day="2024-01-29"), path)
    write_append(batch(spark, "c"), path)
    assert append_new(batch(spark, "a", "b", "c", "d", day="2024-01-31"), path, index=index) == 1
    found = index_of(read_table(spark, path, f"{COLUMNS}, load_date DATE"), path, "event_key", index)
    assert sorted(r.event_key for r in found.collect()) == ["a", "b", "c", "d"]
    # A load date that the table no longer has.
    none = read_table(spark, path, f"{COLUMNS}, load_date DATE").where("load_date < '2024-01-31'")
    assert index_of(none, path, "event_key", index).count() == 3
