"""The daily report, kept up to date by the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from playline.plans.daily import build_daily, days_of
from playline.session import prepare
from playline.streaming.events import raw_event_stream, run_stream


def stream_daily(
    spark: SparkSession,
    raw_dir: str,
    out_root: str,
    checkpoint: str,
    run_date=None,
    layout: str = "array",
    max_files: int | None = None,
    batches: str | None = None,
) -> StreamingQuery:
    """As ``stream_events``, and after each micro-batch that stored new events their days are computed
    anew in daily_engagement.

    An event that comes late, by however much, corrects its day. A micro-batch that adds no event
    publishes nothing, so a replay changes nothing; one that was lost between storing its events and
    computing their days is mended by ``build_daily`` or by the next event of those days.
    """
    prepare(spark)

    def correct(batch: DataFrame, stored: int) -> None:
        if stored:
            build_daily(spark, out_root, run_date, days_of(batch))

    events = raw_event_stream(spark, raw_dir, layout, max_files, batches)
    return run_stream(spark, events, out_root, checkpoint, "stream_daily", run_date, after=correct)
