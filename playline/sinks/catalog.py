from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION = "load_date"


def register(
    spark: SparkSession, db: str, name: str, path: str, schema: str, move: bool = True
) -> None:
    """Make the table at ``path`` queryable as ``db.name``, with exactly the load dates on disk.

    Returns when the partitions are in the catalog. Files are never touched; a folder that does
    not exist yet is created, so that the table reads as empty. If the name stands for another
    place, it is moved to this one, or with ``move=False`` that is an error.
    """
    table = f"`{db}`.`{name}`"
    at, kind = entry_of(spark, db, name)
    if kind is not None and (kind == "VIEW" or at != plain_path(path)):
        if not move:
            raise ValueError(f"{db}.{name} is registered for another place than {path}")
        # External: drops the entry, not the files.
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {table}")
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(PARTITION).parquet(path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
        f"PARTITIONED BY ({PARTITION}) LOCATION {quoted(path)}"
    )
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")


def quoted(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def entry_of(spark: SparkSession, db: str, name: str) -> tuple[str | None, str | None]:
    """The place that a name stands for (of a view its comment) and its kind; None without entry."""
    if not spark.catalog.tableExists(f"{db}.{name}"):
        return None, None
    rows = spark.sql(f"DESCRIBE FORMATTED `{db}`.`{name}`").collect()
    names = [row.col_name for row in rows]
    # Columns come first, and may have any name.
    first = next(i for i, text in enumerate(names) if text.startswith("# Detailed"))
    told = {row.col_name: row.data_type for row in rows[first:]}
    kind = told.get("Type")
    return plain_path(told.get("Comment" if kind == "VIEW" else "Location") or ""), kind


def plain_path(uri: str) -> str:
    return uri.removeprefix("file:").rstrip("/").replace("///", "/")
