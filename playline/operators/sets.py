from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, dfs)
