"""Raw files. Three layouts are read:

* ``array``: one pretty-printed JSON array per file. Such a file is parsed by one task.
* ``blocks``: the same files, each by many tasks (``sources.arrays``), for files of many blocks.
* ``lines``: one JSON object per line, as ``sinks.landing.land_raw`` writes it. These split.

A broken array file raises: it must not look like an empty batch. A broken line of events is
kept as a record with ``_corrupt_record``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playline import schemas
from playline.functions import parse_number, parse_time
from playline.sources.arrays import array_objects, read_arrays

CORRUPT = "_corrupt_record"
# Array files of a folder, compressed ones too.
ARRAY_KINDS = (".json", ".json.gz", ".json.bz2")
ARRAY_FILES = "*.{json,json.gz,json.bz2}"


def layout_of(path: str) -> str:
    # Files of a landed batch have the name of an array file, but hold lines.
    if "/run_ts=" in path:
        return "lines"
    return "array" if path.rstrip("/").endswith((*ARRAY_KINDS, ARRAY_FILES)) else "lines"


def _json_options(layout: str) -> dict:
    if layout not in ("array", "lines"):
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    return {"multiLine": layout == "array"}


def read_media(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    """One media snapshot. Any broken record raises, since the snapshot replaces the dimension."""
    if layout == "blocks":
        return parse_media(read_arrays(spark, path, schemas.RAW_MEDIA))
    options = _json_options(layout or layout_of(path))
    return parse_media(
        spark.read.schema(schemas.RAW_MEDIA).options(**options, mode="FAILFAST").json(path)
    )


def parse_media(raw: DataFrame) -> DataFrame:
    """Typed media; a value that does not parse is null. A record with such a value, or without an
    id, is kept in full as ``_corrupt_record``."""
    typed = {
        "id": F.col("id").try_cast("bigint"),
        "duration": parse_number(F.col("duration")),
        "created": parse_time(F.col("created")),
        "updated": parse_time(F.col("updated")),
    }
    bad = typed["id"].isNull()
    for name, value in typed.items():
        bad |= _unusable(name, value)
    record = F.when(bad, F.to_json(F.struct(*raw.columns)))
    return raw.select(
        *[typed.get(c, F.col(c)).alias(c) for c in raw.columns], record.alias(CORRUPT)
    )


def _unusable(text: str, value: Column) -> Column:
    return F.col(text).isNotNull() & (F.col(text) != "") & value.isNull()


def event_options(layout: str) -> tuple[str, dict]:
    """Schema and reader options of raw events, the same for batch and stream."""
    options = _json_options(layout)
    if layout == "array":
        return schemas.RAW_EVENTS, {**options, "mode": "FAILFAST"}
    return f"{schemas.RAW_EVENTS}, {CORRUPT} STRING", {**options, "mode": "PERMISSIVE"}


def parse_events(raw: DataFrame) -> DataFrame:
    """Typed events; a record with a bad value is kept in full as ``_corrupt_record``."""
    fields = [c for c in raw.columns if c != CORRUPT]
    times = parse_time(F.col("received_at"))
    percent = parse_number(F.col("percent_viewed"))
    bad = _unusable("received_at", times) | _unusable("percent_viewed", percent)
    record = F.when(bad, F.to_json(F.struct(*fields)))
    if CORRUPT in raw.columns:
        record = F.coalesce(F.col(CORRUPT), record)
    typed = {"received_at": times, "percent_viewed": percent}
    return raw.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in fields], record.alias(CORRUPT)
    )


def read_events(
    spark: SparkSession, path: str | list[str], layout: str | None = None
) -> DataFrame:
    """Events of a file, a folder of them (subfolders are not entered), or several of these."""
    paths = [path] if isinstance(path, str) else path
    parts = []
    for chosen in ("lines", "array"):
        mine = [p for p in paths if (layout or layout_of(p)) == chosen]
        if mine:
            schema, options = event_options(chosen)
            parts.append(parse_events(spark.read.schema(schema).options(**options).json(mine)))
    if layout == "blocks" and paths:
        parts.append(parse_events(read_arrays(spark, paths, schemas.RAW_EVENTS)))
    if not parts:
        raise ValueError("no path of events, or an unknown layout")
    return reduce(DataFrame.unionByName, parts)


def read_pages(
    spark: SparkSession,
    path: str,
    layout: str = "array",
    dataset: str = "events",
    folders: str | None = None,
    numbers: str | None = None,
) -> DataFrame:
    """Events, media or visitors landed page by page in folders ``…/page=N/``.

    ``folders`` names and types all folders, which become columns; nothing is inferred, so that
    text such as ``media=0012`` stays as it is. By default, events lie in ``media=…/page=N/`` and
    the others in ``page=N/``. Where many pages of events or media share a folder, each record holds
    its page, and ``numbers`` names and types that field.
    """
    folders = folders or ("media STRING, page BIGINT" if dataset == "events" else "page BIGINT")
    if dataset == "visitors":
        if numbers:
            raise ValueError("visitors have no fixed fields, and so no numbers of pages")
        pages = read_visitors(spark, path, layout)
        # Such pages have no fixed schema to put the folders in; this is the file's own path.
        names = [column.split()[0] for column in folders.split(", ")]
        types = [column.split()[1] for column in folders.split(", ")]
        file = F.col("_metadata.file_path")
        places = [
            F.url_decode(F.regexp_extract(file, f"/{name}=([^/]*)/", 1)).cast(kind).alias(name)
            for name, kind in zip(names, types)
        ]
        return pages.select("visitor", *places)
    if dataset == "media":
        schema, options = schemas.RAW_MEDIA, {**_json_options(layout), "mode": "FAILFAST"}
    elif dataset == "events":
        schema, options = event_options(layout)
    else:
        raise ValueError(f"dataset must be events, media or visitors, not {dataset!r}")
    fields = ", ".join(filter(None, [schema, numbers, folders]))
    raw = spark.read.schema(fields).options(**options).json(path)
    return parse_media(raw) if dataset == "media" else parse_events(raw)


def read_engagement(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    """Engagement envelopes: ``media_id`` and the opaque object as VARIANT."""
    if layout == "blocks":
        return read_arrays(spark, path, schemas.RAW_ENGAGEMENT)
    return (
        spark.read.schema(schemas.RAW_ENGAGEMENT)
        .options(**_json_options(layout or layout_of(path)), mode="FAILFAST")
        .json(path)
    )


def read_visitors(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    """Visitors, whose fields are not fixed: one VARIANT per visitor, column ``visitor``."""
    if (layout or layout_of(path)) == "lines":
        return spark.read.option("singleVariantColumn", "visitor").option(
            "mode", "FAILFAST"
        ).json(path)
    if layout == "blocks":
        return array_objects(spark, path).select(F.parse_json("object").alias("visitor"))
    text = spark.read.text(path, wholetext=True)
    visitors = F.from_json("value", "ARRAY<VARIANT>", {"mode": "FAILFAST"})
    return text.select(F.explode(visitors).alias("visitor"))
