"""Token ids in files of frequency-ranked, byte-aligned variable-length codes.

Ids are replaced by their rank in the corpus (0 the most frequent), and a rank is written in as
few whole bytes as it needs. The byte counts are kept apart in control bytes: one bit each (1 or
2 bytes) for up to 65536 ids, else two bits (1 to 4 bytes). Decoding looks each control byte up
in a numpy table that gives the lengths of all values it covers.

A data set is a folder of ``*.frq`` files and ``ranks.bin`` (the id of each rank, uint32), plus a
manifest with one row per block: path, place, shard and block number, tokens. Blocks hold whole
documents in ascending doc_id order (nulls first, repeated ids in any order), and so do files by
name. A block is: magic, code bits, three counts, crc32 of what follows; doc_id validity bytes,
doc_ids, token counts, control bytes, data bytes.

A task writes files under names no other attempt uses; only those that the manifest lists count,
so lost or repeated tasks leave no trace in the data.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cauce.llm.base import documents, partitions, per_batch, plain, written
from cauce.llm.tokens import encoder, id_dtype, tokenizer_path, vocabulary_size
from cauce.session import scratch_dir

HEAD = struct.Struct("<4sBIQQQI")  # magic, code bits, documents, tokens, control bytes, data bytes, crc32
MAGIC = b"FRQ1"
BLOCK_TOKENS = 1 << 20
MANIFEST = "path string, shard int, block int, at long, size long, n_docs long, n_tokens long"


# -- the code ------------------------------------------------------------------------------


def code_bits(vocabulary: int) -> int:
    return 1 if vocabulary <= 1 << 16 else 2


def pack_codes(ranks: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below ``256 ** 2 ** bits``."""
    ranks = ranks.astype(np.uint32)
    codes = np.zeros(len(ranks), dtype=np.uint8)
    for k in range(1, 1 << bits):
        codes += ranks >= 1 << 8 * k
    per = 8 // bits
    padded = np.zeros(-(-len(ranks) // per) * per, dtype=np.uint8)
    padded[: len(ranks)] = codes
    shifts = (np.arange(per) * bits).astype(np.uint8)
    control = (padded.reshape(-1, per) << shifts).sum(1, dtype=np.uint8)
    ends = np.cumsum(codes.astype(np.int64) + 1)
    data = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    starts = ends - codes - 1
    for k in range(1 << bits):
        own = codes >= k
        data[starts[own] + k] = (ranks[own] >> 8 * k) & 255
    return control.tobytes(), data.tobytes()


def length_table(bits: int) -> np.ndarray:
    """For each control byte, the byte lengths of the values it covers."""
    per = 8 // bits
    return ((np.arange(256)[:, None] >> np.arange(per) * bits) & ((1 << bits) - 1)).astype(np.int64) + 1


def unpack_codes(control: bytes, data: bytes, n: int, bits: int) -> np.ndarray:
    lengths = length_table(bits)[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths) - lengths
    raw, out = np.frombuffer(data, dtype=np.uint8), np.zeros(n, dtype=np.uint32)
    for k in range(1 << bits):
        own = lengths > k
        out[own] |= raw[starts[own] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(doc_ids: list[int | None], counts: np.ndarray, ranks: np.ndarray, bits: int) -> bytes:
    control, data = pack_codes(ranks, bits)
    valid = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    ids = np.array([x or 0 for x in doc_ids], dtype="<i8")
    body = b"".join((valid.tobytes(), ids.tobytes(), counts.astype("<i8").tobytes(), control, data))
    return HEAD.pack(MAGIC, bits, len(doc_ids), len(ranks), len(control), len(data), zlib.crc32(body)) + body


def read_block(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, token counts and ranks."""
    magic, bits, docs, tokens, n_control, n_data, crc = HEAD.unpack_from(raw)
    body = raw[HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != crc or len(body) != docs * 17 + n_control + n_data:
        raise OSError("damaged token block")
    valid = np.frombuffer(body, np.uint8, docs)
    ids = np.frombuffer(body, "<i8", docs, docs)
    counts = np.frombuffer(body, "<i8", docs, 9 * docs)
    at = 17 * docs
    ranks = unpack_codes(body[at : at + n_control], body[at + n_control :], tokens, bits)
    return [int(i) if v else None for v, i in zip(valid, ids, strict=True)], counts, ranks


# -- the data set --------------------------------------------------------------------------


def _tokenised(docs: DataFrame, path: str, end_id: int, dtype: str) -> DataFrame:
    """Blocks of whole documents in doc_id order, numbered within ranges of doc_id."""
    ordered = docs.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    names = ["shard", "block", "doc_ids", "counts", "ids"]
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        shard, block = TaskContext.get().partitionId(), 0
        encode, end = encoder(path, dtype).encode, np.array([end_id], dtype=dtype).tobytes()
        width = len(end)
        doc_ids, counts, ids, held = [], [], [], 0

        def row():
            values = [[shard], [block], [doc_ids], [counts], [b"".join(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for at in range(0, len(keys), 4096):
                for doc, own in zip(keys[at : at + 4096], encode(texts[at : at + 4096]), strict=True):
                    doc_ids.append(doc)
                    counts.append(len(own) // width + 1)
                    ids += (own, end)
                    held += counts[-1]
                    if held >= BLOCK_TOKENS:
                        yield row()
                        block += 1
                        doc_ids, counts, ids, held = [], [], [], 0
        if doc_ids:
            yield row()

    return ordered.mapInArrow(run, "shard int, block int, doc_ids array<long>, counts array<long>, ids binary")


def frequencies(blocks: DataFrame, dtype: str, size: int) -> np.ndarray:
    """How often each id occurs in the whole corpus; one row per id reaches the driver."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                total += np.bincount(np.frombuffer(raw, dtype=dtype), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["id", "n"])

    out = np.zeros(size, dtype=np.int64)
    for r in blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out


def _writer(folder: str, rank_of: np.ndarray, bits: int, dtype: str):
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    types = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4]

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        out, path, last, at = None, "", None, 0
        for batch in batches:
            for row in batch.to_pylist():
                here = (row["shard"], row["block"])
                if out is None or last != (here[0], here[1] - 1):  # a file holds consecutive blocks
                    if out:
                        out.close()
                    path = f"{root}/{here[0]:06d}-{here[1]:06d}-{uuid.uuid4().hex[:12]}.frq"
                    out, at = store.open_output_stream(path), 0
                ranks = rank_of[np.frombuffer(row["ids"], dtype=dtype)]
                raw = write_block(row["doc_ids"], np.array(row["counts"]), ranks, bits)
                out.write(raw)
                values = (path, *here, at, len(raw), len(row["doc_ids"]), len(ranks))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)
                at, last = at + len(raw), here
        if out:
            out.close()

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2
) -> DataFrame:
    """Encodes all documents into ``folder`` (a URI that every executor reaches) and returns the
    manifest. Null text counts as empty and keeps the end id; an empty table gives an empty
    manifest; columns besides doc_id and text are ignored."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    size = max(vocabulary_size(path), end_id + 1)
    dtype, bits = id_dtype(size), code_bits(size)
    blocks = written(_tokenised(plain(docs), path, end_id, dtype), "token-blocks")
    n = frequencies(blocks, dtype, size)
    by_rank = np.lexsort((np.arange(size), -n)).astype("<u4")
    rank_of = np.empty(size, dtype=np.uint32)
    rank_of[by_rank] = np.arange(size)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/ranks.bin") as f:
        f.write(by_rank.tobytes())
    return written(blocks.mapInArrow(_writer(folder, rank_of, bits, dtype), MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents read back from the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 and, if asked for, the ids."""
    spark = manifest.sparkSession
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    placed = manifest.join(shards.select("shard", "base"), "shard").withColumn(
        "start", F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    )
    placed = placed.select("path", "at", "size", "start").repartition(max(partitions(spark), 1), "path", "at")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        id_of = None
        for batch in batches:
            for row in batch.to_pylist():
                if id_of is None:
                    with store.open_input_file(f"{root}/ranks.bin") as f:
                        id_of = np.frombuffer(f.read(), dtype="<u4")
                with store.open_input_file(row["path"]) as f:
                    f.seek(row["at"])
                    doc_ids, counts, ranks = read_block(f.read(row["size"]))
                ids, start, at = id_of[ranks], row["start"], 0
                columns = [[] for _ in names]
                for doc, n in zip(doc_ids, counts.tolist(), strict=True):
                    own = ids[at : at + n]
                    values = (doc, start + at, n, zlib.crc32(own.tobytes()), own)
                    for c, v in zip(columns, values, strict=False):
                        c.append(v)
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return placed.mapInArrow(run, schema)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    if "://" not in folder:
        folder = folder.removeprefix("file:")
        folder = f"file://{folder}"
    manifest = write_tokens(documents(spark, sf_dir), folder)
    return read_tokens(manifest, folder, with_ids=False)
