from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playline.session import stage

PER_PAGE = 100


def paginate(
    df: DataFrame,
    by: list[str],
    order: list[str | Column],
    per_page: int = PER_PAGE,
    descending: bool = False,
) -> DataFrame:
    """Number the pages of each source, ``per_page`` rows a page, in the given order.

    A row_number over ``by`` would sort a whole source in one task. Here the rows are range
    partitioned by source and order, so a large source spreads over many partitions; the row's
    position is its place in the sorted partition plus the rows of its source in earlier
    partitions. Equal rows are spread too, by the running id that ends the sort key.
    """
    columns = df.columns
    fields = [_hashable(field) for field in df.schema]
    # Computed once as columns: a sort would compute an expression again at every comparison.
    keys = {f"_order{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(order)}
    extra = [*keys, "_tie", "_seq"]
    ordered = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    sort_key = [*[F.col(c).asc() for c in by], *ordered, F.col("_tie").asc(), F.col("_seq").asc()]
    placed = (
        df.withColumns(
            {**keys, "_tie": F.xxhash64(*fields), "_seq": F.monotonically_increasing_id()}
        )
        .repartitionByRange(*sort_key)
        .sortWithinPartitions(*sort_key)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .drop(*extra)
    )
    # Partition and position hold for this one run of the sort only, so keep its result.
    placed = stage(placed, "pages")
    runs = placed.groupBy(*by, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_first")
    )
    # One row per source and partition here, not per row of the source.
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *by,
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    page = F.floor((F.col("_pos") + F.col("_shift")) / F.lit(per_page)) + 1
    # Null-safe, so that rows without a source count as a source of their own.
    rows, moved = placed.alias("rows"), shifts.alias("moved")
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"moved.{c}")) for c in [*by, "_part"]]
    joined = rows.join(moved, same, "left").select("rows.*", "moved._shift")
    return joined.select(*columns, page.cast("bigint").alias("page"))


def _hashable(field: T.StructField) -> Column:
    """The column, or its JSON text where it holds a VARIANT, which can't be hashed."""
    column = F.col(f"`{field.name}`")
    return F.to_json(column) if "variant" in field.dataType.simpleString() else column


def build_dim_visitor(events: DataFrame) -> DataFrame:
    """One row per visitor, from the visitor's latest event (ties: the greater event key).

    An aggregate and not a window: each task first reduces its own rows to one per visitor.
    """
    latest = F.max_by(
        F.struct("event_key", F.col("ip").alias("ip_address"), "country"),
        F.struct("received_at", "event_key"),
    )
    return (
        events.where(F.col("visitor_key").isNotNull())
        .groupBy("visitor_key")
        .agg(latest.alias("latest"))
        .select("visitor_key", "latest.*")
    )
