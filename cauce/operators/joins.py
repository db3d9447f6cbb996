"""Left equi-joins (J1-J3) and a size-checked broadcast.

Broadcast is used only for a side whose size has been measured (or is bounded by
construction); otherwise the join is planned normally and AQE decides at runtime from
measured shuffle sizes, splitting skewed partitions (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.operators.columns import q
from cauce.session import persist_for_job

# Largest side we broadcast after measuring it (bytes of UnsafeRow data).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """UnsafeRow size of a row: null bitmap + 8 bytes per field + variable-length data."""
    fields = df.schema.fields
    size: Column = F.lit(8 * ((len(fields) + 63) // 64) + 8 * len(fields)).cast("long")
    for f in fields:
        c = q(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var = F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            var = F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            continue
        size = size + ((var + 7) / 8).cast("long") * 8
    return size


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` measured with one aggregate job."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def broadcast_if_small(
    df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES, persist: bool = True
) -> tuple[DataFrame, bool]:
    """Hint broadcast only when the measured size of ``df`` is at most ``max_bytes``.

    ``df`` is persisted (memory and disk, recomputed from lineage if an executor is lost)
    so the measurement and the join read it once. Returns (df, broadcast?).
    """
    if persist:
        df = persist_for_job(df)
    _, nbytes = measured_size(df)
    if nbytes <= max_bytes:
        return F.broadcast(df), True
    if persist:  # a large side is read once more by the shuffle; nothing of it stays on disk
        df.unpersist(blocking=False)
    return df, False


def _name(base: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has (compared without case, as Spark does)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def _all_present(keys: Sequence[str]) -> Column:
    """No key is null (NaN is a value: it meets NaN)."""
    out: Column = F.lit(True)
    for k in keys:
        out = out & q(k).isNotNull()
    return out


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Keys that more than one ``parts``-th of the rows hold: fewer than ``parts`` of them."""
    present = df.where(_all_present(keys)).select(*[q(k) for k in keys])
    limit = present.count() / parts
    n = _name("n", present)
    return present.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > limit).drop(n)


def _dealt(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: int | None) -> tuple[DataFrame, DataFrame, str]:
    """Both sides with a further key, so that neither rows without a key nor those of a hot key go
    to one partition. Rows without a key meet nothing and get any number; a hot key's left rows get one of
    ``parts`` numbers, and its right rows are repeated for each; all others get 0."""
    salt, flag = _name("salt", left, right), _name("hot", left, right)
    others = [q(f.name) for f in left.schema if f.name not in keys and isinstance(f.dataType, T.AtomicType)]
    spread = F.xxhash64(F.spark_partition_id(), *others)
    right = right.where(_all_present(keys))
    zero = F.lit(0).cast("long")
    if not parts:
        left = left.withColumn(salt, F.when(_all_present(keys), zero).otherwise(spread))
        return left, right.withColumn(salt, zero), salt
    hot = hot_keys(left, keys, parts).withColumn(flag, F.lit(True))  # fewer than ``parts`` rows
    left = left.join(F.broadcast(hot), list(keys), "left").withColumn(
        salt, F.when(~_all_present(keys), spread).when(F.col(flag), F.pmod(spread, F.lit(parts))).otherwise(zero)
    )
    numbers = F.sequence(zero, F.lit(parts - 1).cast("long"))
    right = right.join(F.broadcast(hot), list(keys), "left").withColumn(
        salt, F.explode(F.when(F.col(flag), numbers).otherwise(F.array(zero)))
    )
    return left.drop(flag), right.drop(flag), salt


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    null_safe: bool = False,
    broadcast: str = "auto",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    salt_hot: str = "auto",
) -> DataFrame:
    """Left outer equi-join on same-named key(s). Every left row is kept; a left
    row meets every matching right row (fan-out).

    ``broadcast``: ``"auto"`` measures the right side and broadcasts it when small,
    ``"yes"`` trusts the caller's bound, ``"no"`` leaves the choice to the planner/AQE.
    ``null_safe=True`` matches null keys with each other (pandas merge semantics); otherwise
    left rows with a null key meet nothing, and a shuffle join deals them over all partitions.
    NaN meets NaN and -0.0 meets 0.0 in every form. ``salt_hot``: in a shuffle join, keys that hold
    more than a partition's share of the left rows are measured (one more pass over the left keys)
    and dealt over all partitions: ``"yes"``, ``"no"``, or ``"auto"``: only where the session
    doesn't split skewed partitions itself (AQE). Not used with ``null_safe``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = broadcast == "yes"
    if broadcast == "auto":
        right, small = broadcast_if_small(right, max_broadcast_bytes)
    elif broadcast == "yes":
        right = F.broadcast(right)
    # output order: left columns, then the right side's non-key columns (pandas merge)
    extra = [c for c in right.columns if c not in keys]
    clash = sorted(set(extra) & set(left.columns))
    if clash:
        raise ValueError(f"columns {clash} exist on both sides; rename one side first")
    if not null_safe:
        columns = [q(c) for c in [*left.columns, *extra]]
        if small:
            return left.join(right, keys, "left").select(*columns)
        conf = left.sparkSession.conf
        splits = conf.get("spark.sql.adaptive.enabled") == conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        salted = salt_hot == "yes" or (salt_hot == "auto" and not splits)
        parts = int(conf.get("spark.sql.shuffle.partitions")) if salted else None
        left, right, salt = _dealt(left, right, keys, parts)
        return left.join(right, [*keys, salt], "left").select(*columns)
    renamed = right.select(
        *[q(c).alias(f"__r_{c}") if c in keys else q(c) for c in right.columns]
    )
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = term if cond is None else cond & term
    out = left.join(renamed, cond, "left")
    return out.drop(*[f"__r_{k}" for k in keys]).select(
        *[q(c) for c in [*left.columns, *extra]]
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    rename: dict[str, str] | None = None,
    broadcast: str = "auto",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    check_unique: bool = True,
) -> DataFrame:
    """N:1 left join against a table with at most one row per ``key`` (e.g. the output
    of ``latest_per_key``), then rename the attached columns. ``check_unique`` verifies the
    right key first (one partial aggregate job) and raises on a duplicate; switch it off for
    a side that is unique by construction."""
    if check_unique:
        assert_unique(right, key)
    out = left_join(left, right, key, broadcast=broadcast, max_broadcast_bytes=max_broadcast_bytes)
    return out.withColumnsRenamed(rename or {})


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise when a key occurs more than once (one aggregate job, partial per partition)."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"key {keys} is not unique, e.g. {dup[0].asDict()}")
