from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from playline.operators.project import as_date
from playline.plans.jobs import store_events, table_path
from playline.session import prepare
from playline.sources.batches import published_stamps
from playline.sources.raw import ARRAY_FILES, event_options, parse_events

#: Column of the deduplicating stream: when a row arrived, and what tells it from others.
ARRIVED, IDENTITY = "_arrived", "_identity"


def raw_event_stream(
    spark: SparkSession,
    raw_dir: str,
    layout: str = "array",
    max_files: int | None = None,
    batches: str | None = None,
) -> DataFrame:
    """Typed events from the raw files of a folder, each file once.

    Array files lie in the folder itself, compressed or not. Line files lie in ``run_ts=…`` folders,
    of which only those are read that the table of landed batches, ``batches``, says are published
    when the stream starts; one that is published later is read by the next run.
    """
    schema, options = event_options(layout)
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if layout == "array":
        place = f"{raw_dir}/{ARRAY_FILES}"
    elif batches is None:
        raise ValueError("line files need the table of landed batches, which says what is published")
    else:
        stamps = published_stamps(spark, batches, "events") or ["none"]
        place = f"{raw_dir}/run_ts={{{','.join(stamps)}}}"
    return parse_events(reader.json(place).select(*_fields(schema)))


def _fields(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


class BatchAudit(StreamingQueryListener):
    """One row a micro-batch in the table ``stream_audit``: what became of its raw rows.

    The engine reports rows read and rows that came too late for the state; ``note`` adds what the
    sink did. Copies are the rows that did not get there: the engine's own count of them would add
    up those of steps that ran again.
    """

    def __init__(self, spark: SparkSession, path: str, step: str, run_date: dt.date):
        self.spark, self.path, self.step, self.run_date = spark, path, step, run_date
        self.noted: dict[int, dict[str, int]] = {}
        self.query: str | None = None
        self.ended = threading.Event()
        self.failure: Exception | None = None

    def note(self, batch: int, **counts: int) -> None:
        self.noted[batch] = counts

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) != self.query or progress.batchId not in self.noted:
            return
        told = self.noted.pop(progress.batchId)
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        copies = progress.numInputRows - late - told["handed_on"]
        row = {"raw_rows": progress.numInputRows, "late": late, "copies": copies, **told}
        if not any(row.values()):  # only the state was cleaned
            return
        entry = self.spark.sql(
            "SELECT :step AS step, :run_date AS run_date, :run_id AS run_id, :batch AS batch, "
            + ", ".join(f"CAST(:{name} AS BIGINT) AS {name}" for name in row)
            + ", current_timestamp() AS finished_at",
            args={
                "step": self.step,
                "run_date": self.run_date,
                "run_id": self.query,
                "batch": progress.batchId,
                **row,
            },
        )
        try:
            entry.write.mode("append").parquet(self.path)
        except Exception as error:  # raised again where the stream was started
            self.failure = error

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.query:
            self.ended.set()

    def wait(self) -> None:
        """Until the reports of a query that has ended have come in."""
        if not self.ended.wait(timeout=120):
            raise TimeoutError("no report of the stream's end")
        if self.failure:
            raise self.failure


def run_stream(
    spark: SparkSession,
    events: DataFrame,
    out_root: str,
    checkpoint: str,
    step: str,
    run_date=None,
    look_back: int | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Every micro-batch through the keyed append, with a row in the audit; ``after`` is then called
    with the batch and the number of rows stored."""
    day = as_date(run_date)
    audit = BatchAudit(spark, table_path(out_root, "stream_audit"), step, day)

    def load(batch: DataFrame, number: int) -> None:
        columns = [c for c in batch.columns if c not in (ARRIVED, IDENTITY)]
        counted = Observation()
        rows = batch.select(*columns).observe(
            counted,
            F.count(F.lit(1)).alias("handed_on"),
            F.count_if(F.col("received_at").isNull()).alias("rejected"),
        )
        if after is not None:
            rows = rows.persist()  # read once more behind the append
        stored = store_events(rows, out_root, day, look_back=look_back)
        seen = counted.get
        known = seen["handed_on"] - seen["rejected"] - stored
        audit.note(number, **seen, known=known, stored=stored)
        if after is not None:
            after(rows, stored)
            rows.unpersist()

    spark.streams.addListener(audit)
    try:
        writer = events.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        audit.query = str(query.runId)
        query.awaitTermination()
        audit.wait()
    finally:
        spark.streams.removeListener(audit)
    return query


def stream_events(
    spark: SparkSession,
    raw_dir: str,
    out_root: str,
    checkpoint: str,
    run_date=None,
    layout: str = "array",
    max_files: int | None = None,
    look_back: int | None = None,
    batches: str | None = None,
) -> StreamingQuery:
    """Load every raw file not loaded yet into fact_events, then stop.

    Each micro-batch goes through the keyed append, so late events are kept, and a batch replayed
    after a failure, or after a lost checkpoint, adds nothing. (A file sink would leave metadata
    that hides rows which the batch job appends.) ``layout`` and ``batches`` as in
    ``raw_event_stream``.
    """
    prepare(spark)
    events = raw_event_stream(spark, raw_dir, layout, max_files, batches)
    return run_stream(spark, events, out_root, checkpoint, "stream_events", run_date, look_back)


def dedup_within(df: DataFrame, horizon: str = "2 days") -> DataFrame:
    """First event per key among those that arrive within ``horizon`` of each other.

    The state forgets a key by the time of arrival, not by that of the event: no event is late, so
    none is lost, however short the horizon; a copy that comes after it passes. Events without a
    time or key can't be told from others and all pass.
    """
    keyed = F.col("received_at").isNotNull() & (F.coalesce("event_key", F.lit("")) != "")
    told = df.withColumn(ARRIVED, F.current_timestamp()).withColumn(
        IDENTITY, F.when(keyed, F.concat(F.lit("k"), F.col("event_key"))).otherwise(F.uuid())
    )
    return told.withWatermark(ARRIVED, horizon).dropDuplicatesWithinWatermark([IDENTITY])


def stream_deduplicated(
    spark: SparkSession,
    raw_dir: str,
    out_root: str,
    checkpoint: str,
    horizon: str = "2 days",
    run_date=None,
    layout: str = "array",
    max_files: int | None = None,
    batches: str | None = None,
) -> StreamingQuery:
    """As ``stream_events``, but with ``dedup_within`` in front, so that fewer rows reach the keyed
    append, which finds the copies that come later; rejects are stored, and a replay adds nothing."""
    prepare(spark)
    events = dedup_within(raw_event_stream(spark, raw_dir, layout, max_files, batches), horizon)
    return run_stream(spark, events, out_root, checkpoint, "stream_deduplicated", run_date)
