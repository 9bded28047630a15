"""Tables that are replaced as a whole, or in part, in one step, with earlier versions kept.

Below the table's folder lie ``data``, with a folder for each write and below it one for each
partition, and ``commits``, with one small file for each version that lists the partitions it
consists of. A write changes no file that a version names, so a version holds for as long as its
files; it is there once its commit is. A version may name partitions that an earlier write made.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playline.session import stage
from playline.sinks.catalog import entry_of, plain_path, quoted
from playline.sinks.tables import PARTITION, EmptySnapshotError, read_table

WRITE = "write"
#: Partitions entered in the catalog by one statement.
ENTERED = 500


class WriterConflictError(RuntimeError):
    """Another writer has published a version in the meantime."""


@dataclass(frozen=True)
class Layout:
    """What a table is partitioned by: columns of type DATE or INT, never null."""

    keys: tuple[str, ...]
    note: str = ""


#: One partition a load date, as the plain tables have it.
BY_LOAD_DATE = Layout((PARTITION,))


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    return [status.getPath().getName() for status in store.listStatus(place)]


def _commit(path: str, number: int) -> str:
    return f"{path}/commits/{number:09d}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in _children(spark, f"{path}/commits") if name.isdigit())


def latest(spark: SparkSession, path: str) -> int | None:
    """The last version's number. A folder without its file is a commit that was never finished."""
    for number in reversed(_numbers(spark, path)):
        if any(name.endswith(".parquet") for name in _children(spark, _commit(path, number))):
            return number
    return None


def versions(spark: SparkSession, path: str) -> DataFrame:
    """One row a version: its number, run date, rows, partitions, and how many of those it wrote."""
    if latest(spark, path) is None:
        columns = f"number BIGINT, {PARTITION} DATE, rows BIGINT, partitions BIGINT, written BIGINT"
        return spark.createDataFrame([], columns)
    return spark.read.parquet(f"{path}/commits/*").groupBy("number", F.col("run_date").alias(PARTITION)).agg(
        F.sum("rows").alias("rows"),
        F.count_if(F.col("rows") > 0).alias("partitions"),
        F.count_if((F.col(WRITE) == F.col("number")) & (F.col("rows") > 0)).alias("written"),
    )


def parts_of(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The partitions of a version: ``number, write, rows, layout, run_date`` and their keys."""
    return spark.read.parquet(_commit(path, number))


def read_version(
    spark: SparkSession, path: str, schema: str, number: int | None = None
) -> DataFrame:
    """The rows of a version, by default the latest; without any version, those of a plain table
    at ``path``. A number that was never published raises."""
    last = latest(spark, path)
    if last is None and number is None:
        return read_table(spark, path, schema)
    if number is not None and number not in _numbers(spark, path):
        raise ValueError(f"no version {number} at {path}")
    parts = parts_of(spark, path, last if number is None else number)
    listed = parts.collect()
    keys = listed[0].layout.split(":")[0].split(",")
    folders = [
        "/".join([f"{path}/data/{WRITE}={row[WRITE]}", *(f"{key}={row[key]}" for key in keys)])
        for row in listed
        if row.rows
    ]
    columns = T.StructType.fromDDL(schema)
    if not folders:
        return spark.createDataFrame([], columns)
    stored = T.StructType([c for c in columns if c.name not in (PARTITION, *keys)])
    for key in keys:
        stored.add(key, parts.schema[key].dataType)
    found = spark.read.schema(stored.add(WRITE, "long"))
    found = found.option("basePath", f"{path}/data").parquet(*folders)
    if PARTITION not in keys:
        found = found.withColumn(PARTITION, F.lit(listed[0].run_date))
    return found.select(*columns.names)


def publish(
    df: DataFrame,
    path: str,
    run_date: dt.date,
    layout: Layout = BY_LOAD_DATE,
    replaced: DataFrame | None = None,
    allow_empty: bool = False,
    sources: DataFrame | None = None,
) -> int:
    """Write ``df`` as the next version and return the version's number of rows.

    Without ``replaced`` the version consists of ``df`` alone. Else ``replaced`` has the keys of
    partitions that ``df`` holds anew, or that are gone; all others stay those of the version before.
    ``sources`` tells what the version was made from, for ``sources_of``.

    If the write fails, or the version would be empty (unless ``allow_empty``), nothing is published
    and the version before stays the latest; what was written is removed by ``vacuum``. One writer at
    a time: of two that publish at once, the second to look finds the other's version and raises.
    """
    spark = df.sparkSession
    before = latest(spark, path)
    number = _next_write(spark, path)
    folder = f"{path}/data/{WRITE}={number}"
    df.drop(*([] if PARTITION in layout.keys else [PARTITION])).write.partitionBy(
        *layout.keys
    ).parquet(folder)
    keys = list(layout.keys)
    types = {key: df.schema[key].dataType for key in keys}
    columns = ", ".join(f"{key} {kind.simpleString()}" for key, kind in types.items())
    # Only the keys are read, which stand in folder names, and the numbers of rows. One row a
    # partition reaches the driver.
    counted = read_table(spark, folder, columns).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    parts = [(number, row.rows, *(row[key] for key in keys)) for row in counted.collect()]
    if replaced is not None and before is not None:
        gone = {tuple(row) for row in replaced.select(*keys).distinct().collect()}
        for row in parts_of(spark, path, before).where(F.col("rows") > 0).collect():
            own = tuple(row[key] for key in keys)
            if own not in gone:
                parts.append((row[WRITE], row.rows, *own))
    rows = sum(part[1] for part in parts)
    if not rows and not allow_empty:
        raise EmptySnapshotError(f"refusing to replace {path} with an empty version")
    if latest(spark, path) != before:
        raise WriterConflictError(f"{path} has a newer version than the one this write began with")
    if sources is not None:
        sources.write.parquet(f"{path}/sources/{number:09d}")
    shape = T.StructType().add(WRITE, "long").add("rows", "long")
    for key, kind in types.items():
        shape.add(key, kind)
    told = spark.createDataFrame(parts or [(number, 0, *[None] * len(keys))], shape).select(
        F.lit(number).cast("long").alias("number"),
        WRITE,
        "rows",
        F.lit(_described(layout)).alias("layout"),
        F.lit(run_date).alias("run_date"),
        *keys,
    )
    # One file in one step: a version is listed in whole or not at all. Fails if it is there.
    told.coalesce(1).write.parquet(_commit(path, number))
    return rows


def rows_of(spark: SparkSession, path: str) -> int:
    """Rows of the latest version, by its commit."""
    last = latest(spark, path)
    return 0 if last is None else parts_of(spark, path, last).agg(F.sum("rows")).first()[0]


def sources_of(spark: SparkSession, path: str, number: int, schema: str) -> DataFrame:
    return read_table(spark, f"{path}/sources/{number:09d}", schema)


def holds(spark: SparkSession, path: str, number: int) -> bool:
    """Whether the files of a version are still there."""
    writes = parts_of(spark, path, number).select(WRITE).distinct().collect()
    return bool(writes) and {row[WRITE] for row in writes} <= set(_folders(spark, path))


def _described(layout: Layout) -> str:
    return f"{','.join(layout.keys)}:{layout.note}"


def has_layout(spark: SparkSession, path: str, layout: Layout) -> bool:
    """Whether there is a version, and the latest one has this layout."""
    last = latest(spark, path)
    return last is not None and parts_of(spark, path, last).first().layout == _described(layout)


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all writes, published or not."""
    names = _children(spark, f"{path}/data")
    return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{WRITE}="))


def _next_write(spark: SparkSession, path: str) -> int:
    """Behind every write that there is, so that none is ever written into."""
    return max([0, *_numbers(spark, path), *_folders(spark, path)]) + 1


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove the folders of writes that the last ``keep`` versions do not name, and return their
    numbers. Versions before those can't be read any more. Writes newer than the last version are
    left alone, since they may be under way."""
    if keep < 1:
        raise ValueError("at least one version has to stay")
    last = latest(spark, path)
    if last is None:
        return []
    held = [number for number in _numbers(spark, path) if number <= last][-keep:]
    needed = {
        row[WRITE]
        for number in held
        for row in parts_of(spark, path, number).select(WRITE).distinct().collect()
    }
    gone = [n for n in _folders(spark, path) if n not in needed and n <= last]
    conf = spark._jsc.hadoopConfiguration()
    for number in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/{WRITE}={number}")
        place.getFileSystem(conf).delete(place, True)
    return gone


def register_version(
    spark: SparkSession,
    db: str,
    name: str,
    path: str,
    schema: str,
    move: bool = True,
    number: int | None = None,
) -> None:
    """Make a version, by default the latest, queryable as ``db.name``.

    ``db.name`` is a view, replaced in one step, of the table ``db.name__data``, which holds all
    writes; only partitions that it has not yet are entered. The view takes the version's partitions
    by a join with the commit, which prunes the others before they are read. If the name stands for
    another place, it is moved to this one, or with ``move=False`` that is an error.
    """
    place, _kind = entry_of(spark, db, name)
    if place not in (None, plain_path(path)) and not move:
        raise ValueError(f"{db}.{name} is registered for another place than {path}")
    last = latest(spark, path) if number is None else number
    parts = parts_of(spark, path, last)
    keys = parts.first().layout.split(":")[0].split(",")
    columns = T.StructType.fromDDL(schema)
    stored = [c for c in columns if c.name not in (PARTITION, *keys)]
    kinds = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in stored)
    own = ", ".join(f"{key} {parts.schema[key].dataType.simpleString()}" for key in keys)
    table = f"`{db}`.`{name}__data`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    at, _kind = entry_of(spark, db, f"{name}__data")
    if at not in (None, plain_path(f"{path}/data")):
        spark.sql(f"DROP TABLE {table}")  # external: drops the entry, not the files
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({kinds}, {WRITE} BIGINT, {own}) USING parquet "
        f"PARTITIONED BY ({', '.join([WRITE, *keys])}) "
        f"LOCATION {quoted(f'{path}/data')}"
    )
    _enter(spark, table, parts, keys)
    picked = ", ".join(
        f"d.`{c}`" if c in keys or c != PARTITION else f"c.run_date AS `{c}`" for c in columns.names
    )
    same = " AND ".join(f"c.`{key}` = d.`{key}`" for key in [WRITE, *keys])
    listed = "parquet.`" + _commit(path, last).replace("`", "``") + "`"
    if spark.catalog.tableExists(f"{db}.{name}") and entry_of(spark, db, name)[1] != "VIEW":
        spark.sql(f"DROP TABLE `{db}`.`{name}`")  # a plain table of an earlier release, by entry
    spark.sql(
        f"CREATE OR REPLACE VIEW `{db}`.`{name}` COMMENT {quoted(path)} AS "
        f"SELECT {picked} FROM {table} d "
        # The condition, which all rows meet, lets the optimizer prune by them.
        f"JOIN (SELECT * FROM {listed} WHERE number = {last}) c ON {same}"
    )


def _enter(spark: SparkSession, table: str, parts: DataFrame, keys: list[str]) -> None:
    """Enter the partitions in the catalog that it has not yet."""
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    rows = parts.where(F.col("rows") > 0).select(WRITE, *keys).collect()
    missing = [r for r in rows if "/".join(f"{k}={r[k]}" for k in [WRITE, *keys]) not in known]
    for first in range(0, len(missing), ENTERED):
        listed = " ".join(
            "PARTITION (" + ", ".join(f"{k} = '{r[k]}'" for k in [WRITE, *keys]) + ")"
            for r in missing[first : first + ENTERED]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")
    spark.sql(f"REFRESH TABLE {table}")
