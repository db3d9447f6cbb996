"""Latest row per key (W1) and stable multi-key ordering (O1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    period: str | Column,
    tie: str | Column | None = "_ord",
    nulls: str = "latest",
) -> DataFrame:
    """The last row of each key after a stable ascending sort on ``period``.

    * ``nulls="latest"``: a null period sorts after every value, so it wins (pandas
      ``sort_values`` then ``tail(1)``); ``"drop"``: rows with a null period are ignored.
    * ties on ``period`` go to the greatest ``tie`` (file order ``_ord`` by default).
    * rows with a null key are dropped (a group-by drops them).

    Planned as ``row_number() = 1``: Spark inserts a partial window-group limit before the
    exchange, so each map partition ships at most one row per key and a hot key is reduced
    before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    p = _as_col(period)
    base = df
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    if nulls == "drop":
        base = base.where(p.isNotNull())
    order = [p.desc_nulls_first()]
    if tie is not None:
        order.append(_as_col(tie).desc())
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return base.withColumn("__rn", rn).where(F.col("__rn") == 1).drop("__rn")


def stable_sort(df: DataFrame, keys: Sequence[str | Column], tie: str | Column = "_ord") -> DataFrame:
    """O1: ascending multi-key sort, nulls last, original order among equal keys."""
    order = [_as_col(k).asc_nulls_last() for k in keys] + [_as_col(tie).asc()]
    return df.orderBy(*order)


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """O2: first ``n`` rows of a sort (a top-k, only ``n`` rows per partition move)."""
    return df.orderBy(*[_as_col(o) for o in order]).limit(n)


def head(df: DataFrame, n: int, order: str | Column = "_ord") -> DataFrame:
    """O3: first ``n`` rows in file (or given) order."""
    return df.orderBy(_as_col(order)).limit(n)


def with_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Global 1-based row numbers in ``order``, which must be a total order (end it with a unique key)."""
    return number_rows(df.orderBy(*[_as_col(o) for o in order]), name)


def number_rows(sorted_df: DataFrame, name: str = "rank") -> DataFrame:
    """1-based numbers of the rows of a sorted table without a single-partition window.

    The sort range-partitions the rows; each row gets (partition id, position inside its
    partition); per-partition row counts (one row per partition) give each partition's
    offset. The sorted rows are written to the checkpoint folder, so both uses see the same
    partitions, also after an executor is lost.
    """
    from cauce.session import checkpoint_root

    checkpoint_root(sorted_df.sparkSession)
    pid, mid, count, first, offset = _unused(sorted_df.columns, 5)
    placed = sorted_df.withColumn(pid, F.spark_partition_id()).withColumn(mid, F.monotonically_increasing_id())
    placed = placed.checkpoint()
    counts = placed.groupBy(pid).agg(F.count(F.lit(1)).alias(count), F.min(mid).alias(first))
    offsets = counts.select(pid, first, (F.sum(count).over(Window.orderBy(pid)) - F.col(count)).alias(offset))
    # one row per partition: bounded by the partition count
    out = placed.join(F.broadcast(offsets), pid)
    rank = (F.col(offset) + F.col(mid) - F.col(first) + 1).alias(name)
    return out.select(*[F.col(f"`{c}`") for c in sorted_df.columns], rank)


def _unused(columns: Sequence[str], n: int) -> list[str]:
    """Names that no column has."""
    taken = {c.casefold() for c in columns}
    return [x for x in (f"place_{k}" for k in range(len(taken) + n)) if x not in taken][:n]
