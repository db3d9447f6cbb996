"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (on a cluster whose
    nodes lack that folder, submit the package with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long, text with null as empty, and the columns named; nothing else travels on."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in more],
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: cuts lineage and survives lost
    executors, and random or positional columns keep their values from here on. The shuffle
    files of the write go as it ends; nothing reads them once the table is there."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_uid(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table written once with a row number, so that repeated or null ids stay apart."""
    uid = unused(docs, "row_uid")
    return written(docs.withColumn(uid, F.monotonically_increasing_id()), name), uid


def partitions(spark: SparkSession) -> int:
    """Number of partitions for a wide step: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def binary_values(batch: pa.RecordBatch, name: str) -> list:
    """A string column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def per_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function built once per task by ``make``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            yield from work(batch)

    return df.mapInArrow(run, schema)
