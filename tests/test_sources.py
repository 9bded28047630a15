import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import event, media
from playline.operators.filters import reject_bad_time, split_errors
from playline.operators.project import flatten_media, project_events
from playline.sinks.landing import land_and_record, land_raw, record_batch
from playline.sources.batches import latest_batch, raw_files
from playline.sources.raw import (
    read_engagement,
    read_events,
    read_media,
    read_pages,
    read_visitors,
)


def test_media_fields(spark, raw):
    path = raw.media("20240130_235000", [media(1), media(2)])
    rows = flatten_media(read_media(spark, path)).orderBy("media_id").collect()
    assert rows[0].asDict() == {
        "media_id": 1,
        "title": "Film 1",
        "url": "https://cdn.example.com/1.jpg",
        "duration": 101.0,
        "created_at": dt.datetime(2024, 1, 1),
        "updated_at": dt.datetime(2024, 1, 2),
        "hashed_id": "h1",
    }
    assert len(rows) == 2


def test_thumbnail_missing_in_one_record(spark, raw):
    bare = media(2)
    del bare["thumbnail"]
    path = raw.media("20240130_235000", [media(1), bare, media(3, thumbnail=None)])
    urls = {r.media_id: r.url for r in flatten_media(read_media(spark, path)).collect()}
    assert urls == {1: "https://cdn.example.com/1.jpg", 2: None, 3: None}


def test_thumbnail_missing_in_all_records(spark, raw):
    bare = media(1)
    del bare["thumbnail"]
    path = raw.media("20240130_235000", [bare])
    assert flatten_media(read_media(spark, path)).first().url is None


def test_empty_array_reads_as_no_rows(spark, raw):
    assert read_media(spark, raw.media("20240130_235000", [])).count() == 0


def test_broken_array_file_raises(spark, raw):
    path = raw.write("raw_data/events/player_events_20240130_235000.json", '[{"event_key": "a"},')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_events(spark, path).collect()


def test_broken_line_is_kept(spark, raw):
    raw.write("lines/part-0.json", '{"event_key": "a", "percent_viewed": 5}\n{"event_key": "b"\n')
    rows = read_events(spark, str(raw.root / "lines"), "lines").collect()
    assert sorted((r.event_key or "", r._corrupt_record) for r in rows) == [
        ("", '{"event_key": "b"'),
        ("a", None),
    ]


def test_whole_and_broken_percentages(spark, raw):
    records = [
        event("a", percent_viewed=50),
        event("b", percent_viewed=50.5),
        event("c", percent_viewed="n/a"),
        event("d", percent_viewed=None),
    ]
    rows = {r.event_key: r for r in read_events(spark, raw.events("20240130_235000", records)).collect()}
    assert [rows[k].percent_viewed for k in "abcd"] == [50.0, 50.5, None, None]
    assert '"percent_viewed":"n/a"' in rows["c"]._corrupt_record
    assert [rows[k]._corrupt_record for k in "abd"] == [None, None, None]


def test_numbers_that_are_none(spark):
    from playline.functions import parse_number

    texts = ["50", "-0.5", "1e2", "NaN", "Infinity", "-inf", "", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    found = [r[0] for r in df.select(parse_number(F.col("text"))).collect()]
    assert found == [50.0, -0.5, 100.0] + [None] * 6


def test_times(spark, raw):
    missing = event("h")
    del missing["received_at"]
    texts = {
        "a": "2024-01-30T10:00:00Z",
        "b": "2024-01-30T12:00:00+02:00",
        "c": "2024-01-30T10:00:00.000Z",
        "d": "2024-01-30T10:00:00",
        "e": "oops",
        "f": None,
        "g": "",
        "i": "10:00",
        "j": "2024",
    }
    records = [event(k, received_at=v) for k, v in texts.items()] + [missing]
    good, rejects = reject_bad_time(read_events(spark, raw.events("20240130_235000", records)))
    assert {r.event_key: r.received_at for r in good.collect()} == {
        k: dt.datetime(2024, 1, 30, 10) for k in "abcd"
    }
    assert sorted(r.event_key for r in rejects.collect()) == list("efghij")


def test_zoneless_text_is_utc_in_any_session_zone(spark, settings):
    settings(spark__sql__session__timeZone="Asia/Tokyo")
    from playline.functions import parse_time

    texts = ["2024-01-30T10:00:00", "2024-01-30 10:00:00.000", "2024-01-30", "2024-01-30T10:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    seconds = [r[0] for r in df.select(F.unix_timestamp(parse_time(F.col("text")))).collect()]
    ten = int(dt.datetime(2024, 1, 30, 10, tzinfo=dt.timezone.utc).timestamp())
    assert seconds == [ten, ten, ten - 36000, ten]


def test_text_times_are_parsed_by_the_filter(spark):
    df = spark.createDataFrame([("a", "2024-01-30T10:00:00Z"), ("b", "x")], "k STRING, received_at STRING")
    good, rejects = reject_bad_time(df)
    assert good.schema["received_at"].dataType.simpleString() == "timestamp"
    assert (good.count(), rejects.first().received_at) == (1, "x")


def test_pretty_printed_array_is_read_whole(spark, raw):
    path = raw.events("20240130_235000", [event("a"), event("b")])
    assert read_events(spark, path).where("event_key IS NOT NULL").count() == 2


def test_pointer_wins_over_file_name(spark, raw):
    raw.events("20240129_235000", [event("a")])
    raw.events("20240130_235000", [event("b")], point=False)
    folder = str(raw.root / "raw_data/events")
    pointer = f"{folder}/s3_keys/latest_event_file.json"
    by_pointer = latest_batch(spark, folder, pointer=pointer, root=str(raw.root))
    assert by_pointer.endswith("events_20240129_235000.json")
    assert latest_batch(spark, folder).endswith("events_20240130_235000.json")
    assert raw_files(spark, folder).count() == 2


def test_missing_and_null_pointer(spark, raw):
    folder = str(raw.root / "raw_data/events")
    pointer = f"{folder}/s3_keys/latest_event_file.json"
    for _ in ("no file", "null key"):
        assert latest_batch(spark, folder, pointer=pointer, on_missing="skip") is None
        with pytest.raises(FileNotFoundError):
            latest_batch(spark, folder, pointer=pointer)
        raw.events("20240130_235000", None)


def test_no_files_is_missing(spark, tmp_path):
    assert latest_batch(spark, str(tmp_path), on_missing="skip") is None
    assert latest_batch(spark, str(tmp_path / "absent"), on_missing="skip") is None


def test_recorded_batches(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "events")
    find = lambda: latest_batch(spark, folder, batches=log, dataset="events", on_missing="skip")
    assert find() is None
    df = spark.createDataFrame([("a",)], "event_key STRING")
    path = land_and_record(df, folder, dt.datetime(2024, 1, 29, 23, 50), log, "events")
    assert path.endswith("run_ts=20240129_235000")
    record_batch(spark, log, "media", "elsewhere", "20240131_000000", 5)
    assert find() == path
    # The next run finds nothing new: no folder, and no current batch either.
    assert land_and_record(df.limit(0), folder, "20240130_235000", log, "events") is None
    assert not (tmp_path / "events" / "run_ts=20240130_235000").exists()
    assert find() is None


def test_landed_lines_read_back_to_the_microsecond(spark, tmp_path):
    sql = "SELECT 'a' AS event_key, TIMESTAMP '2024-01-30 10:00:00.123456' AS received_at, 50.5D AS percent_viewed"
    path, rows = land_raw(spark.sql(sql), str(tmp_path), "20240130_235000")
    row = project_events(read_events(spark, path)).first()
    assert rows == 1
    assert row.received_at == dt.datetime(2024, 1, 30, 10, 0, 0, 123456)
    assert row.percent_viewed == 50.5 and row.media_id is None


def test_engagement_files(spark, raw):
    records = [
        {"media_id": "h1", "engagement": {"plays": 3, "rate": 0.5}},
        {"media_id": "h2", "engagement": {"media_id": "h2", "error": "not found"}},
    ]
    path = raw.write("raw_data/engagement/media_engagement_20240130_235000.json", records)
    good, errors = split_errors(read_engagement(spark, path))
    plays = F.variant_get("engagement", "$.plays", "int")
    assert [tuple(r) for r in good.select("media_id", plays).collect()] == [("h1", 3)]
    assert [(r.media_id, r.error) for r in errors.collect()] == [("h2", "not found")]


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_visitors_of_any_shape(spark, raw, layout):
    if layout == "array":
        records = [{"visitor_key": "a", "n": 1}, {"visitor_key": "b", "tags": ["x"]}]
        path = raw.write("raw_data/visitors/visitors_data_20240130_235000.json", records)
    else:
        raw.write("v/part-0.json", '{"visitor_key":"a","n":1}\n{"visitor_key":"b","tags":["x"]}\n')
        path = str(raw.root / "v")
    visitors = read_visitors(spark, path).select(
        F.variant_get("visitor", "$.visitor_key", "string"),
        F.try_variant_get("visitor", "$.tags[0]", "string"),
    )
    assert sorted(tuple(r) for r in visitors.collect()) == [("a", None), ("b", "x")]


def test_pages_from_folders(spark, raw):
    raw.write("pages/media=h1/page=1/a.json", [event("a"), event("b")])
    raw.write("pages/media=h1/page=2/a.json", [event("c")])
    rows = read_pages(spark, str(raw.root / "pages")).select("media", "page", "event_key").collect()
    assert sorted(tuple(r) for r in rows) == [("h1", 1, "a"), ("h1", 1, "b"), ("h1", 2, "c")]


def test_pages_that_share_a_folder(spark, raw):
    lines = [json.dumps({**event(key), "page": page}) for key, page in (("a", 1), ("b", 2), ("c", 2))]
    raw.write("pages/media=h1/pages=0/a.json", "\n".join([*lines, "{broken"]))
    pages = read_pages(
        spark, str(raw.root / "pages"), "lines", folders="media STRING, pages BIGINT",
        numbers="page BIGINT",
    )
    rows = pages.select("media", "page", "event_key", F.col("_corrupt_record").isNotNull()).collect()
    assert sorted(map(tuple, rows), key=repr) == [
        ("h1", 1, "a", False), ("h1", 2, "b", False), ("h1", 2, "c", False), ("h1", None, None, True)
    ]
    with pytest.raises(ValueError):
        read_pages(spark, "/none", "lines", "visitors", numbers="page BIGINT")


def test_folder_values_keep_their_text(spark, raw):
    raw.write("pages/media=0012345678/page=01/a.json", [event("a")])
    pages = read_pages(spark, str(raw.root / "pages"))
    row = pages.first()
    assert (row.media, row.page) == ("0012345678", 1)
    assert pages.schema["page"].dataType.simpleString() == "bigint"


def test_pages_of_media_and_visitors(spark, raw):
    raw.write("m/page=2/a.json", [media(1), media(2, id=None)])
    rows = read_pages(spark, str(raw.root / "m"), dataset="media").select("page", "id", "hashed_id")
    assert sorted(map(tuple, rows.collect()), key=repr) == [(2, 1, "h1"), (2, None, "h2")]
    raw.write("v/page=1/a.json", [{"visitor_key": "x"}])
    raw.write("v/page=2/a.json", [{"other": 1}])
    seen = read_pages(spark, str(raw.root / "v"), dataset="visitors")
    key = F.try_variant_get("visitor", "$.visitor_key", "string")
    assert sorted(map(tuple, seen.select("page", key).collect())) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        read_pages(spark, str(raw.root / "v"), dataset="others")


def test_a_raw_file_without_a_timestamp_raises(spark, raw):
    raw.media("20240130_235000", [media(1)], point=False)
    raw.write("raw_data/media/run_ts=20240131_000000/part-0.json", media(2))
    folder = str(raw.root / "raw_data/media")
    assert latest_batch(spark, folder).endswith("_20240130_235000.json")
    raw.write("raw_data/media/media_20240131_235000.json.gz", "x")
    assert latest_batch(spark, folder).endswith("_20240131_235000.json.gz")
    raw.write("raw_data/media/media_20240131_235000.jsonl", "x")
    with pytest.raises(Exception, match="without a run timestamp"):
        latest_batch(spark, folder)
