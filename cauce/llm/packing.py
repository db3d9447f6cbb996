"""Mixture-controlled packing by deficit round-robin over source queues.

Every document is tokenised and queued with the others of its source. A window (sequence) of
``length`` tokens grants each queue its target share; what a queue is owed beyond or short of
whole tokens is its deficit, carried to the next window. The round-robin order has a closed
form: token ``j`` of queue ``s`` (target weight ``w_s``) is due at virtual time
``(j + 1/2) / w_s``, and the windows cut the tokens in the order (time, queue). The deficit of
every queue at any window therefore follows from the queue sizes alone, so each partition starts
from the carried deficits without replaying the windows before it; a queue's deficit stays
below one token while it lasts, and when it runs dry the others go on in proportion.

Plan: one pass tokenises and writes ids with the running queue position inside the partition;
the sizes per (partition, queue) give base positions; a second pass over the written ids cuts
the pieces where they lie. No shuffle of ids, no queue is ever in one task.

Defined results: null text counts as empty (the end id alone is packed), a null source is a
queue of its own, repeated rows are packed each, an empty table gives no piece, other columns
are ignored whatever their names. Queues are ordered as the rows are read. A very long text is
cut like any other; it must fit in a task's memory. Every source is a queue of its own, however many
there are: the driver and each task hold its name, size and weight, and each window costs time in
proportion to the number of sources.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cauce.llm.base import per_batch, plain, written
from cauce.llm.tokens import encoder, id_dtype, tokenizer_path, vocabulary_size

_CELLS = 1 << 20  # windows times queues held at once
_SLICE = 8 << 20  # bytes of ids in one Arrow batch

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string"
)


def queued(docs: DataFrame, queue_col: str = "source") -> DataFrame:
    """doc_id, text and the queue's name, which tells null from any text."""
    named = plain(docs, queue_col).withColumn(
        "queue", F.coalesce(F.concat(F.lit("="), F.col(queue_col).cast("string")), F.lit("null"))
    )
    return named.select("doc_id", "text", "queue")


def _slices(rows: list[tuple], names: list[str], types: list[pa.DataType], size_of) -> list[pa.RecordBatch]:
    """Record batches of bounded bytes."""
    out, held, size = [], [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= _SLICE:
            out.append(held)
            held, size = [], 0
    out.append(held)
    return [
        pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names)
        for part in out
        if part
    ]


def tokenised(named: DataFrame, path: str, end_id: int) -> DataFrame:
    """One row per document: its ids, and its position in its queue within the partition."""
    dtype = id_dtype(max(vocabulary_size(path), end_id + 1))
    names = ["part", "queue", "doc_id", "local_start", "n_tokens", "ids"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def make():
        part, seen = TaskContext.get().partitionId(), {}
        encode, end = encoder(path, dtype).encode, np.array([end_id], dtype=dtype).tobytes()
        width = len(end)

        def work(batch):
            ids = encode(batch.column("text"))
            rows = []
            for queue, doc, own in zip(
                batch.column("queue").to_pylist(), batch.column("doc_id").to_pylist(), ids, strict=True
            ):
                n, at = len(own) // width + 1, seen.get(queue, 0)
                seen[queue] = at + n
                rows.append((part, queue, doc, at, n, own + end))
            return _slices(rows, names, types, lambda r: len(r[5]))

        return work

    return per_batch(
        named, make, "part int, queue string, doc_id long, local_start long, n_tokens long, ids binary"
    )


def served(weights: np.ndarray, sizes: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Tokens taken from each queue once ``totals[i]`` tokens are out: the length of each
    queue's prefix among the first tokens in the order (virtual time, queue)."""
    totals = np.minimum(totals, sizes.sum())[:, None]
    low = np.zeros((len(totals), 1))
    high = np.full((len(totals), 1), float(((sizes + 1) / weights).max()))
    taken = lambda v: np.minimum(sizes, np.floor(weights * v + 0.5).astype(np.int64))
    for _ in range(70):
        mid = (low + high) / 2
        fits = taken(mid).sum(1, keepdims=True) <= totals
        low, high = np.where(fits, mid, low), np.where(fits, high, mid)
    out = taken(low)
    short = totals[:, 0] - out.sum(1)
    while (rows := np.flatnonzero(short > 0)).size:  # tokens due at one time: in queue order
        due = np.where(out[rows] < sizes, (out[rows] + 0.5) / weights, np.inf)
        tie = due == due.min(1, keepdims=True)
        tie &= tie.cumsum(1) <= short[rows, None]
        out[rows] += tie
        short[rows] -= tie.sum(1)
    return out


def cut(ids_table: DataFrame, bases: DataFrame, sizes: dict[str, int], length: int, weights: dict[str, float]):
    """Pieces of all documents, cut at the window boundaries of their queues."""
    order = sorted(sizes)
    n = np.array([sizes[q] for q in order], dtype=np.int64)
    w = np.array([float(weights.get(q, 0) or 0) for q in order])
    if not weights:
        w = n.astype(float)
    if (w <= 0).any():
        raise ValueError("every queue needs a target weight above zero")
    w *= float(n.sum()) / w.sum()
    index = {q: i for i, q in enumerate(order)}
    windows = -(-int(n.sum()) // length)
    dtype = np.dtype("<u2")
    names = [x.split()[0] for x in PIECES.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()]
    step = max(1, _CELLS // len(n))

    def make():
        def about(queue: int, at: np.ndarray) -> np.ndarray:
            """The window of a queue's token, give or take one."""
            v = (at + 0.5) / w[queue]
            parts = [v[i : i + step] for i in range(0, len(v), step)]
            return np.concatenate([np.minimum(n, np.floor(w * x[:, None] + 0.5)).sum(1) for x in parts]).astype(np.int64) // length

        def boundaries(need: np.ndarray, queues: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of these queues, the first token of each window and the tokens of queues before it there."""
            edges = np.empty((len(need), len(queues)), dtype=np.int64)
            lead = np.empty((max(len(need) - 1, 0), len(queues)), dtype=np.int64)
            for i in range(0, max(len(need) - 1, 1), step):
                bounds = served(w, n, need[i : i + step + 1] * length)
                edges[i : i + len(bounds)] = bounds[:, queues]
                taken = np.diff(bounds, axis=0)
                lead[i : i + len(taken)] = (taken.cumsum(1) - taken)[:, queues]
            return edges, lead

        def work(batch):
            queue = np.array([index[q] for q in batch.column("queue").to_pylist()], dtype=np.int64)
            start = batch.column("base").to_numpy() + batch.column("local_start").to_numpy()
            size = batch.column("n_tokens").to_numpy()
            first, last = np.empty_like(start), np.empty_like(start)
            for q in np.unique(queue):
                own = queue == q
                first[own] = np.maximum(about(q, start[own]) - 2, 0)
                last[own] = np.minimum(about(q, start[own] + size[own] - 1) + 3, windows)
            doc_ids, columns = batch.column("doc_id").to_pylist(), [[] for _ in names]
            raw = batch.column("ids")
            at = 0
            while at < len(queue):
                end, width = at, 0
                while end < len(queue) and (
                    end == at or (width + last[end] - first[end]) * min(end - at + 1, len(n)) < _CELLS
                ):
                    width += last[end] - first[end]
                    end += 1
                need = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first[at:end], last[at:end], strict=True)]))
                own, column_of = np.unique(queue[at:end], return_inverse=True)
                bounds, lead = boundaries(need, own)
                for i in range(at, end):
                    ids, q, lo = np.frombuffer(raw[i].as_py(), dtype=dtype).astype("<u4"), column_of[i - at], int(start[i])
                    k = np.searchsorted(need, first[i])
                    edge = bounds[k : k + last[i] - first[i] + 1, q]
                    j = int(np.searchsorted(edge, lo, "right")) - 1
                    pos, total = 0, len(ids)
                    while pos < total:
                        take = min(total - pos, int(edge[j + 1]) - lo - pos)
                        if take:
                            window = int(first[i]) + j
                            row = (
                                doc_ids[i], pos, take, zlib.crc32(ids[pos : pos + take].tobytes()), total,
                                window, int(lead[k + j, q]) + lo + pos - int(edge[j]), order[queue[i]],
                            )
                            for c, x in zip(columns, row, strict=True):
                                c.append(x)
                            pos += take
                        j += 1
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        return work

    joined = ids_table.join(bases, ["part", "queue"])
    return per_batch(joined, make, PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 2,
    length: int = 4096,
    queue_col: str = "source",
    weights: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pieces (``PIECES``) of all documents in sequences of ``length`` tokens; each but the last
    is full. ``weights``: target share of each source (null under ``None``), by default the
    share of its tokens, so that all queues last to the end. Tokenizers of up to 65536 ids."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    if vocabulary_size(path) > 1 << 16 or end_id >= 1 << 16:
        raise ValueError("ids are kept in two bytes")
    ids = written(tokenised(queued(docs, queue_col), path, end_id), "pack-ids")
    by_part = ids.groupBy("part", "queue").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a written table has a known size, by which Spark chooses between broadcast and shuffle
    bases = written(by_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-bases")
    sizes = {r.queue: r.n for r in bases.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # one row for each source
    if not sizes:
        return docs.sparkSession.createDataFrame([], PIECES)
    own = {("null" if k is None else f"={k}"): v for k, v in (weights or {}).items()}
    return cut(ids, bases.drop("n"), sizes, length, own)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    from cauce.llm.base import documents

    return pack(documents(spark, sf_dir))
