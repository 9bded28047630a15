"""The daily load: media dimension, event fact, engagement fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.filters import received_between, reject_bad_time
from playline.operators.joins import join_media
from playline.operators.project import EVENT_FIELDS, as_date, flatten_media, project_events, stamp
from playline.session import prepare, stage
from playline.sinks.audit import audit
from playline.sinks.catalog import register
from playline.sinks.tables import PARTITION, append_new, write_append
from playline.sinks.versions import (
    Layout,
    has_layout,
    holds,
    latest,
    publish,
    read_version,
    register_version,
    rows_of,
    sources_of,
)
from playline.sources.batches import (
    array_files,
    latest_batch,
    overlapping_batches,
    record_loaded,
    unloaded_batches,
)
from playline.sources.raw import CORRUPT, read_events, read_media

DB = "media_analytics"
# Why a record is in rejected_events.
NO_TIME = "no usable received_at"
BAD_VALUE = "unusable value"
# Places below the raw root (fixed values).
MEDIA_DIR = "raw_data/media"
MEDIA_POINTER = "raw_data/media/s3_keys/latest_media_file.json"
EVENTS_DIR = "raw_data/events"
EVENTS_POINTER = "raw_data/events/s3_keys/latest_event_file.json"


def table_path(out_root: str, name: str) -> str:
    return f"{out_root}/processed/{name}"


def _current(spark, raw_root, dataset, folder, pointer, batches, on_missing):
    return latest_batch(
        spark,
        f"{raw_root}/{folder}",
        pointer=None if batches else f"{raw_root}/{pointer}",
        batches=batches,
        dataset=dataset,
        root=raw_root,
        on_missing=on_missing,
    )


def current_media(spark: SparkSession, raw_root: str, batches: str | None = None) -> str:
    """Path of the current media snapshot. Raises if there is none."""
    return _current(spark, raw_root, "media", MEDIA_DIR, MEDIA_POINTER, batches, "error")


def build_dim_media(
    spark: SparkSession, raw_root: str, out_root: str, run_date=None, batches: str | None = None
) -> int:
    """Replace dim_media by the current snapshot, as a new version. Raises if there is none, or an
    empty one; the version before then stays.

    Media with an unusable value, or without an id, are stored without it, and their records go
    to rejected_media.
    """
    prepare(spark)
    day = as_date(run_date)
    raw = read_media(spark, current_media(spark, raw_root, batches))
    media = raw.transform(flatten_media).transform(stamp, day)
    rows = publish(media, table_path(out_root, "dim_media"), day)
    noted = raw.where(F.col(CORRUPT).isNotNull()).select("id", "hashed_id", CORRUPT)
    _note(noted.transform(stamp, day), out_root, "rejected_media", day)
    return rows


def _note(records: DataFrame, out_root: str, name: str, day: dt.date, since=None) -> None:
    """Store records with something unusable, each once, and count them in the audit."""
    if not records.isEmpty():
        rows = append_new(records, table_path(out_root, name), None, since)
        audit(records.sparkSession, name, day, rows, table_path(out_root, "audit"))


def store_events(
    events: DataFrame,
    out_root: str,
    run_date=None,
    keyed: bool = True,
    look_back: int | None = None,
    index: str | None = None,
) -> int:
    """Typed raw events to fact_events. Those without a time go to rejected_events; those with
    another unusable value are stored without it, and their records go there as well.

    ``look_back`` limits the search for known keys to the load dates of that many days before the
    run. By default all stored keys are searched, which costs a read of their column per run.
    ``index`` (``db.table``) names an index of them for batches beyond a broadcast.
    """
    day = as_date(run_date)
    since = None if look_back is None else day - dt.timedelta(days=look_back)
    held = events.is_cached
    events = events.persist()  # parsed once; read several times, mostly for single columns
    try:
        good, rejects = reject_bad_time(events)
        reason = F.when(F.col("received_at").isNull(), NO_TIME).otherwise(BAD_VALUE)
        noted = (
            rejects.unionByName(good.where(F.col(CORRUPT).isNotNull()))
            .select(*EVENT_FIELDS, CORRUPT, reason.alias("reason"))
            .transform(stamp, day)
        )
        _note(noted, out_root, "rejected_events", day, since)
        facts = good.transform(project_events).transform(stamp, day)
        path = table_path(out_root, "fact_events")
        if not keyed:
            return write_append(facts, path)
        return append_new(facts, path, since=since, index=index)
    finally:
        if not held:
            events.unpersist()


def build_fact_events(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    run_date=None,
    keyed: bool = True,
    from_ts: dt.datetime | None = None,
    to_ts: dt.datetime | None = None,
    batches: str | None = None,
    look_back: int | None = None,
    index: str | None = None,
) -> int | None:
    """Append new events; None if there is no new batch.

    New is the file that the pointer names, or with ``batches`` every published batch that no
    earlier run has recorded as loaded. (A run lost before that record loads its batches again,
    which the keyed append makes harmless.) ``keyed=False`` appends blindly; ``look_back`` and
    ``index`` as in ``store_events``. With ``from_ts`` and/or ``to_ts`` (UTC) all array files, and with ``batches``
    the published batches that overlap the range, are read for events after the one and up to the
    other.
    """
    prepare(spark)
    folder = f"{raw_root}/{EVENTS_DIR}"
    if from_ts is not None or to_ts is not None:
        paths = array_files(spark, folder)
        if batches:
            paths += overlapping_batches(spark, batches, "events", from_ts, to_ts)
        if not paths:
            return 0
        # Events without a usable time stay, to be recorded as rejected.
        events = received_between(read_events(spark, paths), from_ts, to_ts)
        return store_events(events, out_root, run_date, keyed, look_back, index)
    if batches:
        loaded = table_path(out_root, "loaded_batches")
        paths = unloaded_batches(spark, batches, "events", loaded)
        if not paths:
            return None
        events = read_events(spark, paths)
        rows = store_events(events, out_root, run_date, keyed, look_back, index)
        record_loaded(spark, loaded, "events", paths, as_date(run_date))
        return rows
    path = _current(spark, raw_root, "events", EVENTS_DIR, EVENTS_POINTER, None, "skip")
    if path is None:
        return None
    return store_events(read_events(spark, path), out_root, run_date, keyed, look_back, index)


class MissingTableError(ValueError):
    """A table that the engagement fact is built from is missing or empty."""


#: The engagement fact lies by the load date of the event and by a hash of its media.
DAY, BUCKET, MEDIA_BUCKETS = "event_load_date", "media_bucket", 16
BY_EVENT = Layout((DAY, BUCKET), str(MEDIA_BUCKETS))
#: What a version of the engagement fact was made from.
SOURCES = "media_version BIGINT, load_date DATE, events BIGINT"


def build_engagement(
    spark: SparkSession,
    out_root: str,
    run_date=None,
    db: str = DB,
    allow_no_events: bool = False,
    full: bool = False,
    allow_empty: bool = False,
) -> int:
    """Bring fact_media_engagement up to date with all events and the current media, as a new
    version; returns the rows that it has.

    Only partitions are computed that hold events of load dates with other events than the version
    before was made from, or events of media whose title or duration has changed since, come or gone.
    All others keep their files. The result is that of a full computation, which is done with ``full``,
    for the first version, and if the media that the last one was made from are gone.

    Raises, and leaves files and catalog as they are, if there is no media, or no table of events
    (unless ``allow_no_events``), if a name is registered for another place, or if nothing would be
    left of a table that had rows (unless ``allow_empty``).
    """
    prepare(spark)
    day = as_date(run_date)
    for name in ("dim_media", "fact_events"):
        stored = read_version(spark, table_path(out_root, name), schemas.TABLES[name])
        if stored.isEmpty() and not (name == "fact_events" and allow_no_events):
            raise MissingTableError(f"{name} is missing or empty below {out_root}")
    for name in ("dim_media", "fact_events"):
        refresh(spark, out_root, name, db, move=False)
    path, media_path = (table_path(out_root, n) for n in ("fact_media_engagement", "dim_media"))
    events = with_place(spark.table(f"{db}.fact_events"))
    media = read_version(spark, media_path, schemas.DIM_MEDIA)
    # A media table that is no versioned one can't be compared with what it was.
    media_version = latest(spark, media_path)
    counted = events.groupBy(F.col(DAY).alias("load_date")).agg(F.count(F.lit(1)).alias("events"))
    counted = stage(
        counted.select(F.lit(media_version).cast("long").alias("media_version"), "load_date", "events"),
        "event-counts",
    )
    touched = None if full else _touched(spark, path, media_path, events, media, counted)
    wanted = events if touched is None else events.join(touched, [DAY, BUCKET], "left_semi")
    used = ["media_id", "percent_viewed", "visitor_key", "event_key", "received_at", DAY, BUCKET]
    # One shuffle, by which a partition's rows come to few files; hot ones are split.
    rows = join_media(wanted.select(*used), media).hint("rebalance", DAY, BUCKET)
    return publish(
        rows.transform(stamp, day),
        path,
        day,
        BY_EVENT,
        touched,
        allow_empty=allow_empty or rows_of(spark, path) == 0,
        sources=counted,
    )


def with_place(events: DataFrame) -> DataFrame:
    """Add the keys of the engagement fact's partitions."""
    bucket = F.pmod(F.xxhash64("media_id"), F.lit(MEDIA_BUCKETS)).cast("int")
    return events.withColumn(DAY, F.col(PARTITION)).withColumn(BUCKET, bucket)


def _touched(spark, path, media_path, events, media, counted) -> DataFrame | None:
    """Partitions that differ from the last version's; None if all have to be computed."""
    last = latest(spark, path)
    if last is None or not has_layout(spark, path, BY_EVENT):
        return None
    before = sources_of(spark, path, last, SOURCES)
    made_from = before.select("media_version").first()
    if made_from is None or made_from.media_version is None:
        return None
    if not holds(spark, media_path, made_from.media_version):
        return None
    same = (F.col("new.load_date") == F.col("old.load_date")) & (
        F.col("new.events") == F.col("old.events")
    )
    # Events are only ever added, so a load date with as many as before has the same ones.
    days = counted.alias("new").join(before.alias("old"), same, "left_anti").select("load_date")
    added = events.join(days, PARTITION, "left_semi").select(DAY, BUCKET)
    used = ["hashed_id", "title", "duration"]
    old = read_version(spark, media_path, schemas.DIM_MEDIA, made_from.media_version).select(*used)
    new = media.select(*used)
    changed = old.exceptAll(new).unionAll(new.exceptAll(old)).select("hashed_id").distinct()
    changed = changed.withColumnRenamed("hashed_id", "media_id")
    moved = events.join(changed, "media_id", "left_semi").select(DAY, BUCKET)
    return stage(added.unionAll(moved).distinct(), "touched")


def refresh(
    spark: SparkSession, out_root: str, name: str, db: str = DB, move: bool = True
) -> None:
    path = table_path(out_root, name)
    enter = register if latest(spark, path) is None else register_version
    enter(spark, db, name, path, schemas.TABLES[name], move)


def run_daily(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    run_date=None,
    db: str = DB,
    keyed: bool = True,
    batches: str | None = None,
    look_back: int | None = None,
    key_index: bool = False,
) -> dict[str, int | None]:
    """All three jobs in order, each followed by its catalog entry and an audit row.

    ``key_index`` keeps an index of the stored event keys, for batches that exceed a broadcast.

    A step that fails leaves a ``failed`` audit row, raises, and stops the run.
    """
    prepare(spark)
    day = as_date(run_date)
    log = table_path(out_root, "audit")
    steps = {
        "dim_media": lambda: build_dim_media(spark, raw_root, out_root, day, batches),
        "fact_events": lambda: build_fact_events(
            spark,
            raw_root,
            out_root,
            day,
            keyed,
            batches=batches,
            look_back=look_back,
            index=f"{db}.fact_events__keys" if key_index else None,
        ),
        "fact_media_engagement": lambda: build_engagement(spark, out_root, day, db, True),
    }
    rows: dict[str, int | None] = {}
    for name, step in steps.items():
        try:
            rows[name] = step()
            refresh(spark, out_root, name, db)
        except Exception:
            audit(spark, name, day, None, log, "failed")
            raise
        audit(spark, name, day, rows[name], log, "skipped" if rows[name] is None else "ok")
    return rows
