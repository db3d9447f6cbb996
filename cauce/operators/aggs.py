"""Group-by aggregates (A1-A5).

All of these are declarative aggregates with a partial (map-side) phase, so a key that
holds a large share of the rows is reduced to one row per input partition before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.text import ColumnOrName, _c


def group_agg(df: DataFrame, keys: str | Sequence[str], exprs: Sequence[Column]) -> DataFrame:
    """A1: one row per key with a different aggregate per column, ordered by key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*exprs)


def first_non_null(col: ColumnOrName, order: ColumnOrName) -> Column:
    """A2: the value of ``col`` on the earliest row (by ``order``) where it is not null;
    null when every value is null. Deterministic, unlike ``first(ignorenulls=True)``."""
    c = _c(col)
    return F.min_by(c, F.when(c.isNotNull(), _c(order)))


def max_value(col: ColumnOrName) -> Column:
    """A3: maximum ignoring nulls."""
    return F.max(_c(col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A4: distinct values of one column."""
    return df.select(col).distinct()


def shape(df: DataFrame) -> DataFrame:
    """A5: one row ``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols")
    )
