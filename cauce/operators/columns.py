"""Projections, schema helpers and predicates.

Name resolution happens on the driver over ``df.columns`` (schema only, no job); the
result is an ordinary projection or filter that Catalyst prunes and pushes down.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> Column:
    """Column by exact name, safe for names with dots, spaces or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


# --- P1 / P2 / P3 --------------------------------------------------------------------
def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by map (missing names are ignored, like pandas)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_first(df: DataFrame, new_name: str) -> DataFrame:
    """Rename the first column by position."""
    return df.withColumnRenamed(df.columns[0], new_name)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select and reorder."""
    return df.select(*[q(n) for n in names])


def add_constant(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """Constant (or typed null) column."""
    c = F.lit(value)
    return df.withColumn(name, c.cast(dtype) if dtype else c)


# --- P4 / P5 / P6 / P7 / P8 ----------------------------------------------------------
def resolve_column(
    df: DataFrame,
    aliases: Sequence[str],
    fallback: str | None = None,
    strip: bool = False,
) -> str | None:
    """First column whose lower-cased (optionally stripped) name equals an alias, in
    alias order; else ``fallback`` = ``"first"`` / ``"last"`` column, or None."""
    def key(name: str) -> str:
        return name.strip().lower() if strip else name.lower()

    by_key: dict[str, str] = {}
    for c in df.columns:
        by_key.setdefault(key(c), c)
    for alias in aliases:
        hit = by_key.get(key(alias))
        if hit is not None:
            return hit
    if fallback == "first":
        return df.columns[0]
    if fallback == "last":
        return df.columns[-1]
    return None


def first_in_order(df: DataFrame, candidates: Iterable[str], strip: bool = True) -> str | None:
    """P4 (total-column rule): first *column* in frame order whose trimmed lower-cased name
    is one of ``candidates``."""
    wanted = {c.strip().lower() for c in candidates}
    for c in df.columns:
        if (c.strip().lower() if strip else c.lower()) in wanted:
            return c
    return None


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """P5: columns whose whole name matches the regex."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.fullmatch(c)]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ``KeyError`` before any job when a needed column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing column(s): {missing}")


def first_present(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The first candidate that exists."""
    return next((c for c in candidates if c in df.columns), None)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns (bool excluded, as pandas' number selection)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# --- P10 -----------------------------------------------------------------------------
def head_slice(df: DataFrame, n_rows: int, n_cols: int, order_by: Sequence[str | Column]) -> DataFrame:
    """P10: first ``n_rows`` rows (by ``order_by``) of the first ``n_cols`` columns.

    A top-k: each partition keeps ``n_rows`` candidates, so only that many reach the driver.
    """
    keep = df.columns[:n_cols]
    order = [q(o) if isinstance(o, str) else o for o in order_by]
    return df.orderBy(*order).limit(n_rows).select(*[q(c) for c in keep])


# --- F1 - F4 -------------------------------------------------------------------------
def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows null in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def keep_most_frequent(df: DataFrame, col: str) -> DataFrame:
    """rows whose ``col`` equals its most frequent value (ties: smallest value).

    The winner is a one-row top-k, so broadcasting it is bounded by construction.
    """
    top = (
        df.where(q(col).isNotNull())
        .groupBy(q(col).alias("_v"))
        .count()
        .orderBy(F.desc("count"), F.asc("_v"))
        .limit(1)
        .select("_v")
    )
    return df.join(F.broadcast(top), q(col) == F.col("_v"), "left_semi")


def count_marker(df: DataFrame, col: str, marker: str = ".") -> DataFrame:
    """how many cells of ``col`` equal the placeholder text (one-row result)."""
    return df.agg(F.count_if(q(col).cast("string") == marker).alias("n_marker"))


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """one row, one boolean per column: does it hold any non-null value?"""
    return df.agg(*[(F.count(q(c)) > 0).alias(c) for c in cols])
