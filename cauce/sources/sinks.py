"""Sinks (K1-K3): compressed Parquet, replace-on-write, CSV export.

Writes are distributed (one file per task); nothing is funnelled through the driver.
A single output file is produced only when explicitly asked for. Replacing goes in two steps: the
new files are written beside the target, and only when all of them are there the old folder makes
way by renames. A job that fails leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame


def _place(df: DataFrame, path: str):
    """(file system, path) as the store names it: scheme, absolute, ``..`` and, on a local
    file system, links resolved."""
    jvm = df.sparkSession._jvm
    given = jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf())
    full = store.makeQualified(given)
    if full.toUri().getScheme() == "file":
        real = jvm.java.io.File(full.toUri().getPath()).getCanonicalPath()
        full = store.makeQualified(jvm.org.apache.hadoop.fs.Path("file", None, real))
    return store, full


def _roots(df: DataFrame) -> list[str]:
    """The paths that the plan's file scans were given (no listing of their files)."""
    jvm = df.sparkSession._jvm
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                for k in range(paths.size()):
                    own = paths.apply(k)
                    out.append(_place(df, jvm.org.apache.hadoop.fs.Path(own.toUri()).toString())[1].toString())
    return out


def guard_overwrite(df: DataFrame, path: str) -> None:
    """K2: refuse to overwrite a path that the DataFrame itself reads from, however it is spelt
    (relative, with ``..``, a scheme, a link, blanks or other characters that URIs escape)."""
    target = _place(df, path)[1].toString()
    for root in _roots(df):
        if root == target or root.startswith(target + "/") or target.startswith(root + "/"):
            raise ValueError(f"refusing to overwrite {path}: the plan reads from it")


def _replace(df: DataFrame, path: str, mode: str, write: Callable[[str], None]) -> None:
    """Runs ``write`` on the target; in mode ``overwrite`` on a folder beside it that then takes
    its place. The staged folder's name begins with ``_``, so scans of the parent skip it."""
    if mode != "overwrite":
        write(path)
        return
    guard_overwrite(df, path)
    store, target = _place(df, path)
    jvm = df.sparkSession._jvm
    tag = uuid.uuid4().hex[:12]
    beside = lambda kind: jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{kind}-{tag}")
    staged, old = beside("staged"), beside("replaced")
    try:
        write(staged.toString())
        if store.exists(target):
            if not store.rename(target, old):
                raise OSError(f"cannot move {path} out of the way")
            if not store.rename(staged, target):
                store.rename(old, target)
                raise OSError(f"cannot move the new files to {path}")
            store.delete(old, True)
        elif not store.rename(staged, target):
            raise OSError(f"cannot move the new files to {path}")
    finally:
        if store.exists(staged):
            store.delete(staged, True)
    df.sparkSession.catalog.refreshByPath(target.toString())


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "zstd",
    level: int | None = 7,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> str:
    """K1/K2: Parquet with the given codec (and zstd level), replacing what is there."""
    w = df.write.mode(mode).option("compression", codec)
    if codec == "zstd" and level is not None:
        w = w.option("parquet.compression.codec.zstd.level", str(level))
    if partition_by:
        w = w.partitionBy(*partition_by)
    _replace(df, path, mode, w.parquet)
    return path


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    single_file: bool = False,
    mode: str = "overwrite",
    encoding: str = "UTF-8",
) -> str:
    """K3: delimited text with header. Quotes are doubled, nulls and empty strings are
    written as empty fields (as a pandas ``to_csv``). ``single_file`` coalesces to one
    part - only for results known to be small."""
    out = df.coalesce(1) if single_file else df
    w = (
        out.write.mode(mode)
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("encoding", encoding)
    )
    _replace(df, path, mode, w.csv)
    return path


def write_lines(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite") -> str:
    """Write a one-column (``value``) DataFrame as raw text lines in ``encoding`` (the text
    source only writes UTF-8). Lines are written verbatim: no quoting, no trimming."""
    w = (
        df.write.mode(mode)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("escapeQuotes", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("encoding", encoding)
    )
    _replace(df, path, mode, w.csv)
    return path


def write_with_preamble(
    df: DataFrame,
    path: str,
    preamble: list[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    mode: str = "overwrite",
) -> str:
    """Delimited text where *every* part file starts with the ``preamble`` lines and the
    header, like the official exports the preamble scan reads. Rows are rendered with
    ``to_csv``; each partition prepends the top lines to its first batch, so files are
    written in parallel and their number follows the data."""
    import pandas as pd
    from pyspark.sql import functions as F

    top = list(preamble) + [sep.join(df.columns)]
    body = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"sep": sep}).alias("value"))

    def prepend(batches):
        first = True
        for batch in batches:
            if first and len(batch):
                yield pd.DataFrame({"value": top})
                first = False
            yield batch

    return write_lines(body.mapInPandas(prepend, "value string"), path, encoding, mode)
