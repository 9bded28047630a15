"""Loads that land raw data: engagement statistics of the current media, and visitors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.operators.filters import split_errors, with_key
from playline.operators.joins import lookup_stats
from playline.operators.project import as_date, envelope, flatten_media
from playline.plans.jobs import current_media, table_path
from playline.session import prepare, stage
from playline.sinks.audit import audit
from playline.sinks.landing import land_and_record
from playline.sources.raw import read_media

ENGAGEMENT_DIR, VISITORS_DIR = "raw_data/engagement", "raw_data/visitors"


def load_engagement_statistics(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    stats: DataFrame,
    run_ts: dt.datetime | str,
    batches: str,
    run_date=None,
    from_batches: bool = False,
) -> dict[str, int]:
    """Land an envelope ``{media_id, engagement}`` for every media of the current snapshot that has a
    usable key, publish the batch, and write the audit; returns the numbers of found and failed ones.

    ``stats`` holds ``media_id`` and ``engagement``, the statistics as JSON text, and stands for the
    source that is asked. A media without statistics has an envelope with an error object; those
    are counted in an audit row of their own. The current snapshot is the one the pointer names, or with
    ``from_batches`` the last one of ``batches``. A load that fails leaves a failed audit row, and
    publishes nothing.
    """
    prepare(spark)
    day, log = as_date(run_date), table_path(out_root, "audit")
    try:
        path = current_media(spark, raw_root, batches if from_batches else None)
        media = with_key(flatten_media(read_media(spark, path)))
        # Looked up once: counted, and landed.
        found = stage(envelope(lookup_stats(media, stats)), "envelopes")
        _good, errors = split_errors(found)
        failed = errors.count()
        objects = found.select("media_id", F.parse_json("engagement").alias("engagement"))
        land_and_record(objects, f"{raw_root}/{ENGAGEMENT_DIR}", run_ts, batches, "engagement")
        total = found.count()
    except Exception:
        audit(spark, "engagement_statistics", day, None, log, "failed")
        raise
    audit(spark, "engagement_statistics", day, total, log)
    audit(spark, "engagement_errors", day, failed, log)
    return {"found": total - failed, "failed": failed}


def until_gap(pages: DataFrame) -> DataFrame:
    """Rows of the pages from the first on that follow each other without a gap: an empty page has no
    rows, and ends the source."""
    present = pages.select("page").distinct()
    after = present.select((F.col("page") + 1).alias("page")).unionAll(
        present.sparkSession.range(1, 2).toDF("page")
    )
    # The first number of a page that could come next but is not there.
    stop = after.join(present, "page", "left_anti").agg(F.min("page").alias("_stop"))
    return pages.join(F.broadcast(stop), F.col("page") < F.col("_stop")).drop("_stop")


def load_visitors(
    spark: SparkSession,
    pages: DataFrame,
    raw_root: str,
    out_root: str,
    run_ts: dt.datetime | str,
    batches: str,
    run_date=None,
) -> int:
    """Land the visitors of all pages before the first empty one, publish the batch, and write the
    audit; returns their number.

    ``pages`` holds ``page``, from 1, and ``visitor``, an object of any fields as VARIANT, as
    ``read_pages`` gives them. Each object is landed whole, one a line. Without any, a batch of no rows
    is published. A load that fails leaves a failed audit row, and publishes nothing.
    """
    prepare(spark)
    day, log = as_date(run_date), table_path(out_root, "audit")
    try:
        lines = stage(until_gap(pages).select(F.to_json("visitor").alias("value")), "visitors")
        land_and_record(
            lines, f"{raw_root}/{VISITORS_DIR}", run_ts, batches, "visitors", as_text=True
        )
        rows = lines.count()
    except Exception:
        audit(spark, "visitors", day, None, log, "failed")
        raise
    audit(spark, "visitors", day, rows, log, "ok" if rows else "skipped")
    return rows
