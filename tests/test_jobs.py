import datetime as dt

import pytest

from conftest import event, media
from playline import schemas
from playline.operators.project import project_events
from playline.plans import reports
from playline.plans.jobs import (
    MissingTableError,
    build_dim_media,
    build_engagement,
    build_fact_events,
    run_daily,
    table_path,
)
from playline.sinks.landing import land_and_record, land_raw
from playline.sources.batches import overlapping_batches
from playline.sinks.tables import EmptySnapshotError
from playline.sinks.versions import read_version
from playline.sources.raw import read_events
from playline.streaming.events import stream_deduplicated, stream_events


@pytest.fixture
def place(raw, tmp_path):
    return str(raw.root), str(tmp_path / "out")


def rows(spark, out, name, *columns):
    df = read_version(spark, table_path(out, name), schemas.TABLES[name])
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def log(spark, out):
    df = spark.read.schema(schemas.AUDIT).parquet(table_path(out, "audit"))
    return [(r.step, str(r.run_date), r.status, r.rows) for r in df.orderBy("finished_at").collect()]


def test_two_days(spark, raw, place):
    raw.media("20240129_235000", [media(1), media(2)])
    raw.events("20240129_235000", [event("a", "h1"), event("b", "h2"), event("c", "unknown")])
    first = run_daily(spark, *place, "2024-01-29")
    assert first == {"dim_media": 2, "fact_events": 3, "fact_media_engagement": 2}

    # Day 2: media 1 renamed and longer, media 2 gone.
    raw.media("20240130_235000", [media(1, name="Renamed", duration=400)])
    raw.events("20240130_235000", [event("d", "h1", percent_viewed=25)])
    second = run_daily(spark, *place, "2024-01-30")
    assert second == {"dim_media": 1, "fact_events": 1, "fact_media_engagement": 2}
    out = place[1]
    day2 = dt.date(2024, 1, 30)
    assert rows(spark, out, "dim_media", "title", "load_date") == [("Renamed", day2)]
    assert rows(spark, out, "fact_events", "event_key", "load_date") == [
        ("a", dt.date(2024, 1, 29)), ("b", dt.date(2024, 1, 29)), ("c", dt.date(2024, 1, 29)),
        ("d", day2)]
    # All history follows the new dimension and carries the new load date.
    assert rows(spark, out, "fact_media_engagement", "event_key", "title", "watch_time_seconds",
                "load_date") == [("a", "Renamed", 200.0, day2), ("d", "Renamed", 100.0, day2)]
    assert [entry[2:] for entry in log(spark, out)] == [
        ("ok", 2), ("ok", 3), ("ok", 2), ("ok", 1), ("ok", 1), ("ok", 2)]
    by_sql = reports.ad_hoc(
        spark, "SELECT sum(watch_time_seconds) FROM {db}.fact_media_engagement", "media_analytics")
    assert by_sql.first()[0] == 300.0


@pytest.mark.parametrize("keyed, copies", [(True, 1), (False, 2)])
def test_same_day_twice(spark, raw, place, keyed, copies):
    raw.media("20240130_235000", [media(1)])
    raw.events("20240130_235000", [event("a")])
    for _ in range(2):
        run_daily(spark, *place, "2024-01-30", keyed=keyed)
    assert len(rows(spark, place[1], "fact_events", "event_key")) == copies
    assert len(rows(spark, place[1], "fact_media_engagement", "event_key")) == copies


def test_day_without_events(spark, raw, place):
    raw.media("20240129_235000", [media(1)])
    raw.events("20240129_235000", [event("a")])
    run_daily(spark, *place, "2024-01-29")
    raw.events("20240130_235000", None)
    result = run_daily(spark, *place, "2024-01-30")
    assert result == {"dim_media": 1, "fact_events": None, "fact_media_engagement": 1}
    assert rows(spark, place[1], "fact_events", "load_date") == [(dt.date(2024, 1, 29),)]
    assert rows(spark, place[1], "fact_media_engagement", "load_date") == [(dt.date(2024, 1, 30),)]
    assert log(spark, place[1])[-2] == ("fact_events", "2024-01-30", "skipped", None)


def test_no_events_ever(spark, raw, place):
    raw.media("20240130_235000", [media(1)])
    assert run_daily(spark, *place, "2024-01-30") == {
        "dim_media": 1, "fact_events": None, "fact_media_engagement": 0}


def test_empty_media_snapshot_stops_the_run(spark, raw, place):
    raw.media("20240129_235000", [media(1)])
    raw.events("20240129_235000", [event("a")])
    run_daily(spark, *place, "2024-01-29")
    raw.media("20240130_235000", [])
    with pytest.raises(EmptySnapshotError):
        run_daily(spark, *place, "2024-01-30")
    assert rows(spark, place[1], "dim_media", "media_id") == [(1,)]
    assert log(spark, place[1])[-1] == ("dim_media", "2024-01-30", "failed", None)


def test_missing_media_pointer_raises_and_missing_events_skip(spark, place):
    with pytest.raises(FileNotFoundError):
        build_dim_media(spark, *place, "2024-01-30")
    assert build_fact_events(spark, *place, "2024-01-30") is None


def test_bad_times_go_to_the_rejects_once(spark, raw, place):
    raw.events("20240130_235000", [event("a"), event("b", received_at="oops"), event("c", received_at=None)])
    for _ in range(2):
        build_fact_events(spark, *place, "2024-01-30")
    assert rows(spark, place[1], "fact_events", "event_key") == [("a",)]
    rejects = spark.read.schema(schemas.REJECTED_EVENTS).parquet(table_path(place[1], "rejected_events"))
    found = {r.event_key: r._corrupt_record for r in rejects.collect()}
    assert set(found) == {"b", "c"} and rejects.count() == 2
    assert '"received_at":"oops"' in found["b"]


def test_date_range_over_all_files(spark, raw, place):
    for day in (28, 29, 30):
        at = f"2024-01-{day}T10:00:00Z"
        raw.events(f"202401{day}_235000", [event(f"e{day}", received_at=at)])
    load = lambda **span: build_fact_events(spark, *place, "2024-01-31", **span)
    assert load(from_ts=dt.datetime(2024, 1, 29), to_ts=dt.datetime(2024, 1, 29, 10)) == 1
    assert rows(spark, place[1], "fact_events", "event_key") == [("e29",)]
    assert load(to_ts=dt.datetime(2024, 1, 29, 12)) == 1
    assert load(from_ts=dt.datetime(2024, 1, 1)) == 1
    assert rows(spark, place[1], "fact_events", "event_key") == [("e28",), ("e29",), ("e30",)]


def test_landed_batches_instead_of_pointers(spark, raw, place, tmp_path):
    file = raw.events("20240130_235000", [event("a"), event("b")], point=False)
    batches = str(tmp_path / "landed")
    events = project_events(read_events(spark, file))
    land_and_record(events, f"{place[0]}/raw_data/events", "20240130_235000", batches, "events")
    assert build_fact_events(spark, *place, "2024-01-30", batches=batches) == 2
    land_and_record(events.limit(0), f"{place[0]}/raw_data/events", "20240131_235000", batches, "events")
    assert build_fact_events(spark, *place, "2024-01-31", batches=batches) is None
    assert build_fact_events(spark, *place, "2024-01-31", batches=batches, from_ts=dt.datetime(2024, 1, 1)) == 0


def test_look_back_limits_the_search(spark, raw, place):
    for day, keys in (("2024-01-01", "a"), ("2024-01-29", "b"), ("2024-01-30", "abc")):
        raw.events(day.replace("-", "") + "_235000", [event(k) for k in keys])
        load = build_fact_events(spark, *place, day, look_back=5)
        assert load == {"a": 1, "b": 1, "abc": 2}[keys]  # "a" is beyond the five days


# Stream


def history(raw):
    """Three files: overlapping ones, and a new event far behind the others."""
    raw.events("20240128_235000", [event("a", received_at="2024-01-28T10:00:00Z"), event("b")])
    raw.events("20240129_235000", [event("b"), event("c", received_at="bad")])
    raw.events("20240130_235000", [event("late", received_at="2023-12-01T00:00:00Z"), event("d")])


def test_stream_equals_batch(spark, raw, place, tmp_path):
    history(raw)
    folder, out = f"{place[0]}/raw_data/events", str(tmp_path / "streamed")
    stream_events(spark, folder, out, str(tmp_path / "ckpt"), "2024-01-30", max_files=1)
    build_fact_events(spark, *place, "2024-01-30", from_ts=dt.datetime(2000, 1, 1))
    columns = [c for c in schemas.FACT_EVENTS.replace(",", "").split()[::2]]
    streamed = rows(spark, out, "fact_events", *columns)
    assert streamed == rows(spark, place[1], "fact_events", *columns)
    assert [r[1] for r in streamed] == ["a", "b", "d", "late"]

    # No new file: nothing. A new file: only that. A lost checkpoint: nothing twice.
    stream_events(spark, folder, out, str(tmp_path / "ckpt"), "2024-01-31")
    assert len(rows(spark, out, "fact_events", "event_key")) == 4
    raw.events("20240131_235000", [event("e"), event("d")])
    stream_events(spark, folder, out, str(tmp_path / "ckpt"), "2024-01-31")
    assert len(rows(spark, out, "fact_events", "event_key")) == 5
    stream_events(spark, folder, out, str(tmp_path / "other-ckpt"), "2024-02-01")
    assert len(rows(spark, out, "fact_events", "event_key")) == 5


def audited(spark, out):
    df = spark.read.schema(schemas.STREAM_AUDIT).parquet(table_path(out, "stream_audit"))
    counts = "raw_rows", "copies", "handed_on", "known", "rejected", "stored"
    return [tuple(r[c] for c in counts) for r in df.orderBy("finished_at").collect()]


@pytest.mark.parametrize("horizon", ["2 days", "1 second"])
def test_bounded_state_loses_no_late_event(spark, raw, place, tmp_path, horizon):
    history(raw)
    folder, out = f"{place[0]}/raw_data/events", str(tmp_path / "streamed")
    ckpt = str(tmp_path / "ckpt")
    stream_deduplicated(spark, folder, out, ckpt, horizon, "2024-01-30", max_files=1)
    assert rows(spark, out, "fact_events", "event_key") == [("a",), ("b",), ("d",), ("late",)]
    first, second, third = audited(spark, out)
    assert first == (2, 0, 2, 0, 0, 2) and third == (2, 0, 2, 0, 0, 2)
    # The copy is taken out by the state, or found by the keyed append once that has forgotten it.
    assert second in [(2, 1, 1, 0, 1, 0), (2, 0, 2, 1, 1, 0)]


def test_stream_audit_accounts_for_every_raw_row(spark, raw, place, tmp_path):
    history(raw)
    folder, out = f"{place[0]}/raw_data/events", str(tmp_path / "streamed")
    for turn in range(2):
        stream_events(spark, folder, out, str(tmp_path / f"c{turn}"), "2024-01-30", max_files=1)
    log = audited(spark, out)
    assert len(log) == 6 and sum(r[0] for r in log) == 12
    assert all(raw == copies + on and on == known + bad + stored for raw, copies, on, known, bad, stored in log)
    assert sum(r[5] for r in log) == 4


def test_compressed_files_are_read_by_batch_range_and_stream(spark, raw, place, tmp_path):
    import gzip
    import json

    raw.events("20240129_235000", [event("plain")])
    file = raw.write("raw_data/events/player_events_20240130_235000.json.gz", "")
    with gzip.open(file, "wt") as out:
        json.dump([event("packed")], out)
    raw.write("raw_data/events/s3_keys/latest_event_file.json",
              {"latest_s3_key": "raw_data/events/player_events_20240130_235000.json.gz"})
    assert build_fact_events(spark, *place, "2024-01-30") == 1
    both = [("packed",), ("plain",)]
    assert build_fact_events(spark, place[0], str(tmp_path / "r"), from_ts=dt.datetime(2000, 1, 1)) == 2
    assert rows(spark, str(tmp_path / "r"), "fact_events", "event_key") == both
    stream_events(spark, f"{place[0]}/raw_data/events", str(tmp_path / "s"), str(tmp_path / "c"))
    assert rows(spark, str(tmp_path / "s"), "fact_events", "event_key") == both
    raw.write("raw_data/events/player_events_20240131_235000.jsonx", "[]")
    with pytest.raises(Exception, match="without a run timestamp"):
        build_fact_events(spark, place[0], str(tmp_path / "r"), from_ts=dt.datetime(2000, 1, 1))


def test_streams_read_published_folders_only(spark, raw, place, tmp_path):
    log, folder = str(tmp_path / "landed"), f"{place[0]}/raw_data/events"
    land(spark, raw, log, "20240129_235000", event("a"))
    land(spark, raw, log, "20240130_235000", event("b"), publish=False)
    for number, stream in enumerate((stream_events, stream_deduplicated)):
        out, ckpt = str(tmp_path / f"out{number}"), str(tmp_path / f"ckpt{number}")
        with pytest.raises(ValueError, match="published"):
            stream(spark, folder, out, ckpt, layout="lines")
        stream(spark, folder, out, ckpt, layout="lines", batches=str(tmp_path / "no-log"))
        stream(spark, folder, out, ckpt, layout="lines", batches=log)
        assert rows(spark, out, "fact_events", "event_key") == [("a",)]
    from playline.sinks.landing import record_batch

    record_batch(spark, log, "events", f"{folder}/run_ts=20240130_235000", "20240130_235000", 1)
    for number, stream in enumerate((stream_events, stream_deduplicated)):
        out, ckpt = str(tmp_path / f"out{number}"), str(tmp_path / f"ckpt{number}")
        stream(spark, folder, out, ckpt, layout="lines", batches=log)
        assert rows(spark, out, "fact_events", "event_key") == [("a",), ("b",)]


def test_command_line(spark, raw, place, monkeypatch, capsys):
    from playline import __main__ as cli

    raw.media("20240130_235000", [media(1)])
    raw.events("20240130_235000", [event("a")])
    monkeypatch.setattr(cli, "build", lambda _name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda _self: None)
    roots = ["--raw-root", place[0], "--out-root", place[1], "--run-date", "2024-01-30"]
    monkeypatch.setattr("sys.argv", ["playline", "daily", *roots])
    cli.main()
    monkeypatch.setattr("sys.argv", ["playline", "events", *roots, "--from", "2024-01-01"])
    cli.main()
    printed = capsys.readouterr().out
    assert "daily: {'dim_media': 1, 'fact_events': 1, 'fact_media_engagement': 1}" in printed
    assert "events: 0" in printed


def test_range_load_records_rejects_and_has_no_first_day(spark, raw, tmp_path):
    raw.events(
        "20240130_235000",
        [
            event("old", received_at="1969-05-01T00:00:00.000Z"),
            event("bad", received_at="oops"),
            event("late", received_at="2024-03-01T00:00:00.000Z"),
        ],
    )
    out = str(tmp_path / "out")
    build_fact_events(
        spark, str(raw.root), out, dt.date(2024, 1, 30), to_ts=dt.datetime(2024, 2, 1)
    )
    facts = spark.read.parquet(f"{out}/processed/fact_events")
    assert [r.event_key for r in facts.collect()] == ["old"]
    assert spark.read.parquet(f"{out}/processed/rejected_events").count() == 1


def test_deduplicating_stream_keeps_rejects_and_keyless_events(spark, raw, tmp_path):
    records = [
        event("a"), event("a"), event("", ip="1"), event("", ip="2"),
        event(None, ip="3"), event(None, ip="4"), event("bad", received_at="oops"),
    ]
    raw.events("20240130_235000", records, point=False)
    out = str(tmp_path / "out")
    for turn in range(2):  # a replay from a new checkpoint adds nothing
        stream_deduplicated(
            spark, str(raw.root / "raw_data/events"), out, str(tmp_path / f"c{turn}"),
            run_date="2024-01-30",
        )
        facts = spark.read.parquet(f"{out}/processed/fact_events")
        assert sorted(r.ip for r in facts.collect()) == ["1", "10.0.0.1", "2", "3", "4"]
        assert spark.read.parquet(f"{out}/processed/rejected_events").count() == 1


def land(spark, raw, log, stamp_text, *records, publish=True):
    file = raw.write(f"sent/{stamp_text}.json", list(records))
    events = project_events(read_events(spark, file))
    folder = str(raw.root / "raw_data/events")
    if publish:
        return land_and_record(events, folder, stamp_text, log, "events")
    return land_raw(events, folder, stamp_text)[0]


def test_every_unloaded_batch_is_loaded_once(spark, raw, place, tmp_path):
    log = str(tmp_path / "landed")
    land(spark, raw, log, "20240129_235000", event("a"))
    land(spark, raw, log, "20240130_235000", event("b"))
    assert build_fact_events(spark, *place, "2024-01-30", batches=log) == 2
    assert build_fact_events(spark, *place, "2024-01-30", batches=log) is None
    land(spark, raw, log, "20240131_235000", event("b"), event("c"))
    assert build_fact_events(spark, *place, "2024-01-31", batches=log) == 1


def test_range_load_reads_overlapping_published_batches_and_array_files(spark, raw, place, tmp_path):
    log = str(tmp_path / "landed")
    at = lambda key, day: event(key, received_at=f"2024-01-{day}T10:00:00Z")
    early = land(spark, raw, log, "20240110_235000", at("early", 10))
    land(spark, raw, log, "20240120_235000", at("in", 20))
    timeless = land(spark, raw, log, "20240125_235000", event("bad", received_at=None))
    land(spark, raw, log, "20240121_235000", at("unpublished", 20), publish=False)
    raw.events("20240122_235000", [at("array", 20), at("array-early", 10)])
    span = {"from_ts": dt.datetime(2024, 1, 15), "to_ts": dt.datetime(2024, 1, 31)}
    chosen = overlapping_batches(spark, log, "events", *span.values())
    assert len(chosen) == 2 and timeless in chosen and early not in chosen
    files = read_events(spark, chosen).inputFiles()
    assert files and not any("20240110" in f for f in files)
    assert build_fact_events(spark, *place, "2024-01-31", batches=log, **span) == 2
    assert rows(spark, place[1], "fact_events", "event_key") == [("array",), ("in",)]
    rejects = spark.read.parquet(table_path(place[1], "rejected_events"))
    assert [r.event_key for r in rejects.collect()] == ["bad"]


def test_a_bad_percentage_is_stored_without_it_and_kept_in_full(spark, raw, place):
    raw.events("20240130_235000", [event("a", percent_viewed="n/a"), event("b", received_at="oops")])
    for _ in range(2):
        build_fact_events(spark, *place, "2024-01-30")
    assert rows(spark, place[1], "fact_events", "event_key", "percent_viewed") == [("a", None)]
    rejects = spark.read.schema(schemas.REJECTED_EVENTS).parquet(table_path(place[1], "rejected_events"))
    found = {r.event_key: (r.reason, r._corrupt_record) for r in rejects.collect()}
    assert rejects.count() == 2 and found["b"][0] == "no usable received_at"
    assert found["a"][0] == "unusable value" and '"percent_viewed":"n/a"' in found["a"][1]
    assert log(spark, place[1])[0] == ("rejected_events", "2024-01-30", "ok", 2)


def test_engagement_is_not_built_from_nothing(spark, raw, place, tmp_path):
    raw.media("20240130_235000", [media(1)])
    raw.events("20240130_235000", [event("a")])
    run_daily(spark, *place, "2024-01-30")
    nowhere = tmp_path / "nowhere"
    with pytest.raises(MissingTableError):
        build_engagement(spark, str(nowhere), "2024-01-30")
    assert not nowhere.exists()
    assert spark.table("media_analytics.fact_media_engagement").count() == 1
    other = str(tmp_path / "other")
    build_dim_media(spark, place[0], other, "2024-01-30")
    with pytest.raises(MissingTableError):
        build_engagement(spark, other, "2024-01-30")
    assert spark.table("media_analytics.dim_media").count() == 1
    build_fact_events(spark, place[0], other, "2024-01-30")
    with pytest.raises(ValueError, match="another place"):
        build_engagement(spark, other, "2024-01-30")


def test_unusable_media_values_are_noted(spark, raw, place):
    raw.media("20240130_235000", [media(1), media(0, id=None, hashed_id="x"), media(3, duration="long")])
    for _ in range(2):
        build_dim_media(spark, *place, "2024-01-30")
    assert rows(spark, place[1], "dim_media", "media_id", "duration") == [
        (1, 101.0), (3, None), (None, 100.0)]
    noted = spark.read.parquet(table_path(place[1], "rejected_media")).collect()
    assert sorted(r.hashed_id for r in noted) == ["h3", "x"]
    assert log(spark, place[1])[0] == ("rejected_media", "2024-01-30", "ok", 2)
