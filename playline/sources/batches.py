"""Which raw batch is the current one."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline import schemas
from playline.operators.filters import as_instant
from playline.sinks.landing import files_log
from playline.sinks.tables import read_table
from playline.sources.raw import ARRAY_FILES

# End of the names of raw files (fixed value).
STAMP = r"_(\d{8}_\d{6})\.json(?:\.gz|\.bz2)?$"


def newest(batches: DataFrame) -> DataFrame:
    """The row with the latest ``run_ts`` (ties: the greater path), as a one-row DataFrame."""
    row = F.struct(*batches.columns)
    return batches.agg(F.max_by(row, F.struct("run_ts", "path")).alias("latest")).select("latest.*")


def raw_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Array files of a folder with the run timestamp in their names; the files are not opened.

    A file whose name has no timestamp raises: ignored, it would be lost without a trace.
    """
    # Names with a dot: landed batches lie in folders, and are listed in their log.
    files = spark.read.format("binaryFile").load(f"{raw_dir.rstrip('/')}/*.*")
    stamp = F.regexp_extract("path", STAMP, 1)
    unknown = F.concat(F.lit("raw file without a run timestamp: "), F.col("path"))
    named = F.when(stamp != "", stamp).otherwise(F.raise_error(unknown))
    return files.select("path", named.alias("run_ts"))


def array_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """Glob of the array files of a folder, as a list; an empty one if there is none. A file whose
    name is none of a raw file raises, since it would not be read."""
    found = _first(lambda: raw_files(spark, raw_dir).agg(F.max("run_ts").alias("run_ts")))
    return [f"{raw_dir}/{ARRAY_FILES}"] if found and found.run_ts else []


def published_stamps(spark: SparkSession, batches: str, dataset: str) -> list[str]:
    """Run timestamps of the published batches that hold rows: one a run."""
    mine = (F.col("dataset") == dataset) & (F.col("rows") > 0)
    found = read_table(spark, batches, schemas.LANDED_BATCHES).where(mine).select("run_ts").distinct()
    return sorted(row.run_ts for row in found.collect())


def landed_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LANDED_BATCHES).parquet(path)


def _paths(batches: DataFrame) -> list[str]:
    """Folders of some landed batches: one per run, so as few as a listing of their files."""
    return [row.path for row in batches.select("path").distinct().collect()]


def overlapping_batches(
    spark: SparkSession, path: str, dataset: str, after=None, until=None
) -> list[str]:
    """What of the published batches can hold events after the one time and not after the other, or
    events without a usable time: folders, or single files of those batches whose files were recorded
    and do not all count. Batches of unknown times count in."""
    inside = F.lit(True)
    if after is not None:
        inside &= F.col("last_at") > as_instant(after)
    if until is not None:
        inside &= F.col("first_at") <= as_instant(until)
    matters = F.col("timeless").isNull() | (F.col("timeless") > 0) | F.coalesce(inside, F.lit(False))
    mine = (F.col("dataset") == dataset) & (F.col("rows") > 0)
    batches = landed_batches(spark, path).where(mine & matters).select("path").distinct()
    files = read_table(spark, files_log(path), schemas.LANDED_FILES).where(mine)
    listed = files.groupBy("path").agg(
        F.bool_and(matters).alias("all"),
        F.collect_list(F.when(matters, F.col("file"))).alias("files"),
    )
    folder = F.col("all").isNull() | F.col("all")
    chosen = F.when(folder, F.array("path")).otherwise(F.col("files"))
    found = batches.join(listed, "path", "left").select(F.explode(chosen).alias("path"))
    return [row.path for row in found.collect()]


def unloaded_batches(spark: SparkSession, path: str, dataset: str, loaded: str) -> list[str]:
    """Folders of the published batches that the table ``loaded`` does not list."""
    landed = landed_batches(spark, path).where((F.col("dataset") == dataset) & (F.col("rows") > 0))
    done = read_table(spark, loaded, schemas.LOADED_BATCHES)
    return _paths(landed.join(done, ["dataset", "path"], "left_anti"))


def record_loaded(
    spark: SparkSession, loaded: str, dataset: str, paths: list[str], day: dt.date
) -> None:
    rows = [(dataset, path, day) for path in paths]
    spark.createDataFrame(rows, schemas.LOADED_BATCHES).coalesce(1).write.mode("append").parquet(loaded)


def _first(df_of):
    """First row, or None where there is none or the folder does not exist."""
    try:
        return df_of().first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_batch(
    spark: SparkSession,
    raw_dir: str,
    pointer: str | None = None,
    batches: str | None = None,
    dataset: str | None = None,
    root: str = "",
    on_missing: str = "error",
) -> str | None:
    """Path of the current batch.

    With ``pointer`` (a one-object JSON file) the key it holds, below ``root``; with ``batches``
    (the table ``record_batch`` writes) the last batch of ``dataset``; else the file of
    ``raw_dir`` with the latest timestamp in its name. If there is none, or the last run landed
    nothing: raise, or None with ``on_missing="skip"``.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError(f"on_missing must be 'error' or 'skip', not {on_missing!r}")
    path = None
    if pointer is not None:
        reader = spark.read.schema(schemas.POINTER).options(multiLine=True, mode="FAILFAST")
        row = _first(lambda: reader.json(pointer))
        if row and row.latest_s3_key:
            key = row.latest_s3_key
            path = f"{root.rstrip('/')}/{key}" if root else key
    elif batches is not None:
        table = lambda: landed_batches(spark, batches).where(F.col("dataset") == dataset)
        row = _first(lambda: newest(table()))
        if row and row.rows:
            path = row.path
    else:
        row = _first(lambda: newest(raw_files(spark, raw_dir)))
        path = row.path if row else None
    if path is None and on_missing == "error":
        raise FileNotFoundError(f"no current batch for {raw_dir}")
    return path
