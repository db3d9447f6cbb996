"""Incremental raw load: the D1 load as a Structured Streaming job.

New export files that land in a source's input folder are picked up by a file-source
stream (a line scan with ``_ord`` built on the scan), and every micro-batch is parsed by the
same batch logic as the one-shot load (preamble-aware for the crime exports) and written
to ``<raw>/batch_id=<n>`` with overwrite. A re-executed batch after a failure rewrites the
same folder, so the output is idempotent; the stream's progress lives beside the batches
(``<raw>/_stream``), so the next run goes on after the last batch. A batch whose header is
not that of the batches before it is refused. ``trigger="availableNow"`` processes what is
there and stops (a scheduled batch run); ``processingTime`` keeps it running.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cauce.sources.delimited import ORD, _encoding, parse_lines
from cauce.sources.layout import Layout
from cauce.sources.sinks import write_parquet

# header token per source: crime exports carry a preamble above a 'Municipio' header;
# the other exports start with their header line
HEADER_TOKEN = {"delitos": "Municipio", "renta": None, "contact": None}

# partition column of the batches
BATCH = "batch_id"


def line_stream(spark: SparkSession, folder: str, encoding: str = "ISO-8859-1",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming line scan of a folder (``value``, ``file``, ``block``), decoded with
    ``encoding``. The row id part of ``_ord`` is added per micro-batch (``with_order``)
    because row ids are not allowed on a streaming plan."""
    reader = (
        spark.readStream.format("csv")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("encoding", _encoding(encoding))
        .option("header", "false")
        .schema("value string")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def with_order(batch: DataFrame) -> DataFrame:
    """``_ord`` for a micro-batch of ``line_stream``: the batch is still partitioned by
    file split, so the row id increases in file order within each split."""
    return batch.select(
        "value", F.struct("file", "block", F.monotonically_increasing_id().alias("row")).alias(ORD)
    )


def _written_names(spark: SparkSession, out: str) -> list[str] | None:
    """Column names of the batches in ``out``; None when there is none yet."""
    try:
        return spark.read.parquet(out).drop(BATCH).columns
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stream_raw(
    spark: SparkSession,
    layout: Layout,
    source: str,
    checkpoint: str | None = None,
    trigger: str = "availableNow",
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
    sep: str = ";",
) -> StreamingQuery:
    """Start the incremental load of one source; returns the running query. ``checkpoint``
    defaults to a fixed folder beside the batches: a random one would load all again."""
    token = HEADER_TOKEN[source]
    out = layout.raw(source)

    def load_batch(lines: DataFrame, batch_id: int) -> None:
        if lines.isEmpty():
            return
        parsed = parse_lines(with_order(lines), token=token, sep=sep)
        names = _written_names(spark, out)
        if names is not None and names != parsed.columns:
            raise ValueError(f"batch {batch_id} has the columns {parsed.columns}, the batches before it {names}")
        write_parquet(parsed, f"{out}/{BATCH}={batch_id}")

    writer = (
        line_stream(spark, layout.csv(source), max_files_per_trigger=max_files_per_trigger)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint or f"{out}/_stream")
    )
    writer = writer.trigger(availableNow=True) if trigger == "availableNow" else writer.trigger(
        processingTime=processing_time
    )
    return writer.start()


def read_streamed_raw(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    """The raw table written by ``stream_raw`` (all batches), without the batch column."""
    return spark.read.parquet(layout.raw(source)).drop(BATCH)


__all__ = ["line_stream", "read_streamed_raw", "stream_raw", "with_order"]
