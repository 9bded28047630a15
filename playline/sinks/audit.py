from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession


def audit(
    spark: SparkSession,
    step: str,
    run_date: dt.date,
    rows: int | None,
    path: str,
    status: str = "ok",
) -> None:
    """Append one row per step: rows written, and ok, skipped or failed."""
    entry = spark.sql(
        "SELECT :step AS step, :run_date AS run_date, :status AS status, "
        "CAST(:rows AS BIGINT) AS rows, current_timestamp() AS finished_at",
        args={"step": step, "run_date": run_date, "status": status, "rows": rows},
    )
    entry.write.mode("append").parquet(path)
