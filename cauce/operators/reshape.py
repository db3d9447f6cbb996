"""Wide <-> long reshapes (R1-R5) and the one-pass attribute + flag aggregate.

Pivot values are found with a bounded distinct (``max_values``): the list decides the
output schema, so it is the only thing that reaches the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.numbers import to_double, to_int
from cauce.operators.columns import q

YEAR_PATTERN = r"\d{4}"


def unpivot_columns(
    df: DataFrame,
    id_cols: Sequence[str],
    value_cols: Sequence[str],
    var_name: str,
    value_name: str,
) -> DataFrame:
    """Generic wide -> long (a per-row ``Expand``; no shuffle). Values are cast to string
    first so columns of mixed types can be stacked."""
    casted = df.select(
        *[q(c) for c in id_cols], *[q(c).cast("string").alias(c) for c in value_cols]
    )
    return casted.unpivot(list(id_cols), list(value_cols), var_name, value_name)


def unpivot_years(
    df: DataFrame,
    id_col: str = "municipio",
    pattern: str = YEAR_PATTERN,
    var_name: str = "anio",
    value_name: str = "tasa",
    kind_name: str = "tipo_delito",
    kind: str = "total",
    decimal: str = ".",
) -> DataFrame:
    """Columns whose whole name matches ``pattern`` become rows
    ``(id, year:int, kind, value:double)``; rows with a null year are dropped, null values
    kept. No matching column gives the empty four-column table."""
    rx = re.compile(pattern)
    years = [c for c in df.columns if rx.fullmatch(c)]
    if not years:
        # the same four typed columns, derived from the input with no rows
        return df.where(F.lit(False)).select(
            q(id_col).cast("string").alias(id_col),
            F.lit(None).cast("int").alias(var_name),
            F.lit(None).cast("string").alias(kind_name),
            F.lit(None).cast("double").alias(value_name),
        )
    long = unpivot_columns(df, [id_col], years, "_var", "_val")
    return long.select(
        q(id_col).alias(id_col),
        to_int(F.col("_var")).alias(var_name),
        F.lit(kind).alias(kind_name),
        to_double(F.col("_val"), decimal).alias(value_name),
    ).where(F.col(var_name).isNotNull())


def pivot_values(df: DataFrame, col: str, max_values: int = 10_000) -> list[str]:
    """Sorted distinct non-null values of ``col`` (one distinct job, capped)."""
    rows = (
        df.where(q(col).isNotNull())
        .select(q(col).cast("string").alias("v"))
        .distinct()
        .limit(max_values + 1)
        .collect()
    )
    if len(rows) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values")
    return sorted(r["v"] for r in rows)


def flag_columns(col: str, values: Sequence[str], names: Sequence[str] | None = None) -> list[Column]:
    """Aggregate expressions: per value, 1 if any row of the group has it, else 0; null
    when the group has no non-null ``col`` at all."""
    names = list(names or values)
    answered = F.count(q(col)) > 0
    c = q(col).cast("string")
    return [
        F.when(answered, F.coalesce(F.max(F.when(c == v, F.lit(1))), F.lit(0))).alias(n)
        for v, n in zip(values, names)
    ]


def flag_names(values: Sequence[str], taken: Sequence[str], prefix: str | None = None) -> list[str]:
    """Output names for flag columns; a clash with an existing column raises unless a
    ``prefix`` is given."""
    names = [f"{prefix}{v}" if prefix else v for v in values]
    # column names that differ only in case are one column to Spark and to Parquet readers
    known = {t.casefold() for t in taken}
    folded = Counter(n.casefold() for n in names)
    clash = sorted(n for n in names if n.casefold() in known)
    if twice := sorted(n for n in names if folded[n.casefold()] > 1):
        raise ValueError(f"answers {twice} differ only in case; pass flag_values= with one of them")
    if clash:
        raise ValueError(f"flag column(s) {clash} collide with attributes; pass flag_prefix=")
    return names


def pivot_flags(
    df: DataFrame,
    key: str,
    col: str,
    values: Sequence[str] | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """One row per key that has at least one non-null answer, one 0/1 int column per
    answer value (sorted), 1 when the key has that answer."""
    vals = list(values) if values is not None else pivot_values(df, col)
    names = flag_names(vals, [key], prefix)
    answered = df.where(q(col).isNotNull())
    c = q(col).cast("string")
    return answered.groupBy(q(key).alias(key)).agg(
        *[F.coalesce(F.max(F.when(c == v, F.lit(1))), F.lit(0)).alias(n) for v, n in zip(vals, names)]
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Only the distinct key values (no answer column)."""
    return df.select(q(key).alias(key)).distinct()


def long_to_wide(long: DataFrame, row: str, col: str, value: str, cols: Sequence[str]) -> DataFrame:
    """Transpose a long (row, col, value) table with a known column list."""
    return long.groupBy(row).pivot(col, list(cols)).agg(F.first(value))
