"""Column expressions over whole texts, all of Spark's own functions.

Arrays built here are exploded with the outer forms only: the plain forms let the optimizer derive a
filter on the array, which would copy its expression into every element's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """Words of digits, letters and all characters above ASCII, with A to Z in lower case."""
    plain = F.translate(text, UPPER + GAPS, UPPER.lower() + " " * len(GAPS))
    return F.coalesce(F.array_remove(F.split(plain, " "), ""), F.array().cast("array<string>"))


def grams(column: str, size: int, seed: int) -> Column:
    """Hashes of all runs of ``size`` words; runs of different seeds do not meet."""
    behind = [lambda i, c=c: F.get(column, i + c) for c in range(1, size)]
    hashes = F.transform(column, lambda x, i: F.xxhash64(F.lit(seed), x, *[b(i) for b in behind]))
    return F.slice(hashes, 1, F.greatest(F.size(column) - (size - 1), F.lit(0)))


def lowest(column: str, window: int) -> Column:
    """The distinct smallest values of all runs of ``window`` values."""
    if window == 1:
        return F.array_distinct(column)
    return F.array_distinct(
        F.transform(
            column, lambda x, i: F.least(x, *[F.get(column, i + c) for c in range(1, window)])
        )
    )


def named(column: str) -> str:
    """A column's name as one name, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no other column can clash with them."""
    return F.struct(*[F.col(named(c)) for c in docs.columns]).alias("doc")


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("doc").getField(c).alias(c) for c in columns])
