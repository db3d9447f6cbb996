"""SimHash near-duplicates found with Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments (22, 21, 21 bits), each padded with zeros to
the 23 bits of the perfect Golay code. If two fingerprints differ in at most two bits, some
segment ``i`` is the same in both while segment ``j = i + 1`` (cyclic) differs in at most one:
with both errors in one segment choose ``i`` so that ``j`` is an error-free one, with errors in
two choose the third as ``i``. Decoding a segment gives the index of its nearest codeword; a
segment one bit away decodes to one of the indices of the words next to it (up to six distinct
ones). So each fingerprint gives, for every ``i``, one left key (segment ``i`` as it is, decoded
index of ``j``) and a few right keys (segment ``i``, each nearby index of ``j``); every link
meets in a left and a right key, and the join's pairs are verified by their bit distance.

Equal fingerprints are one node from the start. A key under which more than ``MAX_PAIRS`` pairs
would meet is not paired: its fingerprints give all words at most one bit away, and those that
share such a word (they differ in at most two bits) are linked to the least of them. That is
exact and linear in their number. Components follow from alternating large-star and small-star
steps on the links, written to shared storage after each round.

Defined results: null text counts as empty; texts without words have fingerprint zero and link
like any other; a null doc_id is a component's id only if it has no other; repeated rows are
members each; an empty table gives no row; other columns are ignored, or travel with
``distinct_documents``, whatever their names; very long texts must fit in a task's memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import documents, per_batch, plain, with_uid, written

MAX_PAIRS = 1024
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits

# -- Golay code ----------------------------------------------------------------------------

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, fixed value


def _parity_table() -> np.ndarray:
    """Remainder of m * x^11 by the generator for each 12-bit m."""
    out = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        out ^= ((out >> bit) & 1) * (GENERATOR << (bit - 11))
    return out


def _leader_table(parity: np.ndarray) -> np.ndarray:
    """The error of at most three bits with each syndrome; the code is perfect, so all occur once."""
    bits = [1 << i for i in range(23)]
    errors = {0}
    for _ in range(3):
        errors |= {e | b for e in errors for b in bits}
    words = np.array(sorted(errors), dtype=np.int64)
    out = np.zeros(1 << 11, dtype=np.int64)
    out[parity[words >> 11] ^ (words & 2047)] = words
    return out


PARITY = _parity_table()
LEADER = _leader_table(PARITY)


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 message bits) of the codeword nearest to each 23-bit word."""
    return (words ^ LEADER[PARITY[words >> 11] ^ (words & 2047)]) >> 11


def nearby(words: np.ndarray) -> np.ndarray:
    """Indices of each word and of the 23 words one bit away; repeats are -1. Shape (n, 24)."""
    flips = np.concatenate([[0], 1 << np.arange(23)])
    out = np.sort(decode(words[:, None] ^ flips), axis=1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return out


# -- fingerprints --------------------------------------------------------------------------


def fingerprint(text: bytes, size: int = 3, seed: int = 42, step: int = 1 << 16) -> int:
    """SimHash of the word shingles of a text whose A-Z are lower-cased."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, step):
        some = words[at : at + step + size - 1]
        if len(some) <= size:
            shingles = [b" ".join(some)]
        else:
            shingles = map(b" ".join, zip(*(some[k:] for k in range(size)), strict=False))
        h = np.array([xxh64_intdigest(s, seed) for s in shingles], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint32)
    set_bits = np.flatnonzero(2 * ones > n)
    return sum(1 << int(b) for b in set_bits)


def fingerprints(rows: DataFrame, size: int = 3) -> DataFrame:
    """uid, doc_id and fp (the fingerprint's bits as a signed long) of rows uid, doc_id, text."""
    names, types = ["uid", "doc_id", "fp"], [pa.int64()] * 3

    def make():
        def work(batch):
            texts = batch.column("text").cast(pa.binary())
            fps = np.array([fingerprint(texts[i].as_py(), size) for i in range(len(texts))], dtype="<u8").view("<i8")
            columns = [batch.column("uid"), batch.column("doc_id"), pa.array(fps)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, types, strict=True)], names)

        return work

    return per_batch(rows, make, "uid long, doc_id long, fp long")


# -- links ---------------------------------------------------------------------------------


def _keys(nodes: DataFrame) -> DataFrame:
    """key, fp, side (0: left, one for each segment; 1: right, one for each nearby index)."""
    names = ["key", "fp", "side"]

    def make():
        def work(batch):
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
            bits = fps.view("<u8")
            parts = [((bits >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
            for i in range(3):
                same, near = parts[i], parts[(i + 1) % 3]
                head = (i << 34) | (same << 12)
                index = nearby(near)
                rows, cols = np.nonzero(index >= 0)
                key = np.concatenate([head | decode(near), head[rows] | index[rows, cols]])
                side = np.repeat(np.array([0, 1], dtype=np.int32), [len(fps), len(rows)])
                own = np.concatenate([fps, fps[rows]])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own), pa.array(side, pa.int32())], names)

        return work

    return per_batch(nodes, make, "key long, fp long, side int")


def _midpoints(fps: DataFrame) -> DataFrame:
    """word, fp: each fingerprint and all words one bit away from it."""

    def make():
        flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype("<u8")

        def work(batch):
            own = batch.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(own), 4096):
                some = own[at : at + 4096]
                words = (some.view("<u8")[:, None] ^ flips).reshape(-1).view("<i8")
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.repeat(some, 65))], ["word", "fp"])

        return work

    return per_batch(fps, make, "word long, fp long")


def links(nodes: DataFrame) -> DataFrame:
    """Links (u, v), u > v, that join every two of the distinct ``fp`` at most two bits apart,
    directly or over others that are. The bit distance is 2: the segments rest on it."""
    keys = written(_keys(nodes), "simhash-keys")
    sides = keys.groupBy("key").agg(
        F.sum(F.lit(1) - F.col("side")).alias("n_left"), F.sum("side").alias("n_right")
    ).where("n_left > 0 AND n_right > 1")
    sides = written(sides.select("key", (F.col("n_left") * F.col("n_right") > MAX_PAIRS).alias("crowded")), "simhash-sides")
    met = keys.join(sides, "key")
    few = met.where("NOT crowded")
    pairs = (
        few.where("side = 0").select("key", F.col("fp").alias("a"))
        .join(few.where("side = 1").select("key", F.col("fp").alias("b")), "key")
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
    )
    crowd = met.where("crowded").select("fp").distinct()
    near = written(_midpoints(crowd), "simhash-midpoints")
    least = near.groupBy("word").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    stars = near.join(least, "word").where("fp > low").select(F.col("fp").alias("u"), F.col("low").alias("v"))
    both = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).unionByName(stars)
    return both.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node with a link (u, v)."""

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(edges.select("u", "v"), "links")
    before = state(now)
    while before[0]:
        # large star: every larger neighbour of a node moves to the node's least neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(rows: DataFrame, size: int = 3) -> DataFrame:
    """uid, doc_id, fp, component_id (least doc_id of the component), keep_uid (its row)."""
    own = written(fingerprints(rows, size), "simhash-fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")).alias("first")
    nodes = written(own.groupBy("fp").agg(first), "simhash-nodes")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "simhash-roots")
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    of_fp = written(rooted.join(best, "root").select("fp", "best"), "simhash-components")
    return own.join(of_fp, "fp").select(
        "uid", "doc_id", "fp", F.col("best.doc_id").alias("component_id"), F.col("best.uid").alias("keep_uid")
    )


def simhash(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = plain(docs).withColumn("uid", F.monotonically_increasing_id())
    return grouped(rows, size).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def distinct_documents(docs: DataFrame, size: int = 3) -> DataFrame:
    """One row of each component, with all its columns: that with the least doc_id."""
    staged, uid = with_uid(docs, "simhash-rows")
    rows = staged.select(
        F.col(uid).alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dropped = grouped(rows, size).where("uid != keep_uid").select(F.col("uid").alias(uid))
    return staged.join(written(dropped, "simhash-dropped"), uid, "left_anti").select(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir))
