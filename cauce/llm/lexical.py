"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time.

A set of query items is ranked against every document. One pass over the texts counts each
document's terms and notes how often it holds the terms of the items (postings, in rows of arrays).
Corpus figures (documents, terms, documents per term) are summed over all of it. A second pass takes
the postings in shards of documents; in each shard and for each item

1. the short lists are added up term at a time into one list of accumulators, and the least of its
   ``k`` highest sums is a first threshold (the long lists only add to a score);
2. accumulators and long lists go through the documents together, window by window. Every
   iterator, the accumulators included, has an upper bound in each window. Windows whose bounds do not
   reach the threshold are skipped. In the others the iterators of the largest bounds are evaluated
   until the rest cannot lift an unseen document over the threshold; the rest are only searched for
   documents that can still reach it, largest bound first.

Each shard hands on its ``k`` best of each item, and a window function ranks those of all shards.

Items are a stated query set: they are read in blocks of about ``BLOCK_BYTES`` of text, chosen by
hash, and each block runs over all documents. The driver and every task hold one block's terms.

Defined results: null or empty texts have no terms; a document without terms counts neither in N nor
in L and is never returned; an item without terms, or whose terms no document holds, has no rows;
repeated rows (items or documents) are separate; of equal scores the smaller doc_id comes first, a null
doc_id last; an empty table gives no row; other columns are ignored whatever their names. A text must
fit in a task's memory.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cauce.llm.base import documents, plain, written

BLOCK_BYTES = 16 << 20
STRETCH = 4 << 20  # bytes of text in one row of postings
SHARD_POSTINGS, SHARD_DOCS = 1 << 22, 1 << 17
WINDOW = 4096  # documents
LAST_ID = (1 << 63) - 1

#: Every ASCII byte but letters and digits parts terms; A-Z is lower-cased. Bytes from 128 on stay.
TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

_POSTINGS = "doc array<long>, n array<int>, term array<int>, at array<int>, tf array<int>, n_docs long, n_terms long"
_BEST = "item_uid long, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """How often each document holds each term of the vocabulary; a row holds many documents."""
    types = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4, pa.int64(), pa.int64()]
    names = [x.split()[0] for x in _POSTINGS.split(", ")]

    def row(held):
        ids, sizes, found, n_docs, n_terms = held
        counts = np.array([len(x) for x in found], dtype=np.int64)
        term = np.concatenate([np.zeros(0, np.int64), *found])
        at = np.repeat(np.arange(len(found)), counts)
        key, tf = np.unique(at * max(1, len(vocabulary)) + term, return_counts=True)
        at, term = np.divmod(key, max(1, len(vocabulary)))
        values = (ids, sizes, term.astype(np.int32), at.astype(np.int32), tf.astype(np.int32), n_docs, n_terms)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def run(batches):
        get = vocabulary.get
        held, size = ([], [], [], 0, 0), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = texts[i].as_py()
                words = terms(text)
                ids, sizes, found, n_docs, n_terms = held
                own = np.array([x for x in map(get, words) if x is not None], dtype=np.int64)
                if len(own):
                    ids.append(doc)
                    sizes.append(len(words))
                    found.append(own)
                held = (ids, sizes, found, n_docs + bool(words), n_terms + len(words))
                size += len(text)
                if size >= STRETCH:
                    yield row(held)
                    held, size = ([], [], [], 0, 0), 0
        if held[3]:
            yield row(held)

    return plain(docs).mapInArrow(run, _POSTINGS)


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; at most one row per term of the block reaches the driver."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for own in batch.column("term"):
                total += np.bincount(own.values.to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["term", "n"])

    out = np.zeros(size, dtype=np.int64)
    for r in rows.select("term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


class Shard:
    """Inverted lists of some documents: positions (in the order of doc_id) and what a posting
    gives per unit of weight, with the largest of each window."""

    def __init__(self, rows: list, n_docs: int, n_terms: int):
        doc = [r["doc"] for r in rows]
        n = np.concatenate([x.to_numpy(zero_copy_only=False) for x in (r["n"] for r in rows)]).astype(np.int64)
        base = np.cumsum([0, *(len(x) for x in doc)])
        term = np.concatenate([r["term"].to_numpy() for r in rows])
        at = np.concatenate([r["at"].to_numpy() + b for r, b in zip(rows, base, strict=False)]).astype(np.int64)
        tf = np.concatenate([r["tf"].to_numpy() for r in rows]).astype(np.int64)
        ids = pa.concat_arrays(doc)
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        key = ids.fill_null(LAST_ID).to_numpy()
        order = np.lexsort((key, self.null))
        self.ids, self.null = key[order], self.null[order]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        m = 100 - 75 + (75 * n * n_docs) // n_terms
        gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[at])
        at = place[at]
        by = np.lexsort((at, term))
        self.at, self.gain, term = at[by], gain[by], term[by]
        starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        ends = np.append(starts[1:], len(term))
        self.lists = {t: (a, b) for t, a, b in zip(term[starts].tolist(), starts.tolist(), ends.tolist(), strict=True)}
        self.edges = np.append(np.arange(0, len(order), WINDOW), len(order))
        self.cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def windows(self, at: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each window begins in a list, and the largest gain in it."""
        cuts = np.searchsorted(at, self.edges)
        top = np.zeros(len(cuts) - 1, dtype=np.int64)
        some = np.flatnonzero(cuts[1:] > cuts[:-1])
        top[some] = np.maximum.reduceat(gain, cuts[some])
        return cuts, top

    def search(self, wanted: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents for (term, weight) pairs, best first."""
        lists = sorted((b - a, t, w) for t, w in wanted if w > 0 and t in self.lists for a, b in [self.lists[t]])
        none = np.zeros(0, dtype=np.int64)
        # short lists: term at a time, into one list of accumulators
        limit, taken, parts = max(WINDOW, len(self.ids) // 4), 0, []
        while lists and taken + lists[0][0] <= limit:
            size, t, w = lists.pop(0)
            a, b = self.lists[t]
            parts.append((self.at[a:b], self.gain[a:b] * w))
            taken += size
        iterators = []
        threshold = 0
        if parts:
            at = np.concatenate([x for x, _ in parts])
            gain = np.concatenate([g for _, g in parts])
            by = np.argsort(at, kind="stable")
            at, gain = at[by], gain[by]
            start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            at, gain = at[start], np.add.reduceat(gain, start)
            iterators.append((at, gain, 1, *self.windows(at, gain)))
            if len(gain) >= k:
                threshold = int(np.partition(gain, len(gain) - k)[len(gain) - k])
        for _, t, w in lists:
            a, b = self.lists[t]
            if t not in self.cuts:
                self.cuts[t] = self.windows(self.at[a:b], self.gain[a:b])
            cuts, top = self.cuts[t]
            iterators.append((self.at[a:b], self.gain[a:b], w, cuts, top * w))
        if not iterators:
            return none, none
        bounds = np.stack([x[4] for x in iterators])
        whole = bounds.sum(0)
        best_at, best = none, none
        for window in range(len(whole)):
            if whole[window] < threshold or not whole[window]:
                continue
            own = bounds[:, window]
            order = np.argsort(-own, kind="stable")
            rest = whole[window] - np.cumsum(own[order])  # what the iterators after each can add
            base = int(self.edges[window])
            scores = np.zeros(int(self.edges[window + 1]) - base, dtype=np.int64)
            used = 0
            for used, i in enumerate(order.tolist()):  # noqa: B007
                at, gain, w, cuts, _ = iterators[i]
                a, b = cuts[window], cuts[window + 1]
                scores[at[a:b] - base] += gain[a:b] * w
                if rest[used] < threshold:
                    break
            seen = np.flatnonzero((scores > 0) & (scores + rest[used] >= threshold))
            score = scores[seen]
            for j in range(used + 1, len(order)):
                if not len(seen) or not own[order[j]]:
                    break
                at, gain, w, cuts, _ = iterators[order[j]]
                a, b = cuts[window], cuts[window + 1]
                place = np.searchsorted(at[a:b], seen + base)
                hit = np.minimum(place, b - a - 1)
                score = score + np.where(at[a:b][hit] == seen + base, gain[a:b][hit] * w, 0)
                alive = score + rest[j] >= threshold
                seen, score = seen[alive], score[alive]
            if not len(seen):
                continue
            best_at, best = np.concatenate([best_at, seen + base]), np.concatenate([best, score])
            by = np.lexsort((best_at, -best))[:k]
            best_at, best = best_at[by], best[by]
            if len(best) == k:
                threshold = max(threshold, int(best[-1]))
        return best_at, best


def _searched(rows: DataFrame, queries: list[tuple], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The ``k`` best documents of each shard for each query (uid, item_id, (term, weight) pairs)."""
    columns = ["doc", "n", "term", "at", "tf"]

    def best(held):
        shard = Shard(held, n_docs, n_terms)
        for uid, item, wanted in queries:
            at, score = shard.search(wanted, k)
            if len(at):
                ids = pa.array(shard.ids[at], pa.int64(), mask=shard.null[at])
                own = [pa.array([uid] * len(at), pa.int64()), pa.array([item] * len(at), pa.int64()), ids, pa.array(score)]
                yield pa.RecordBatch.from_arrays(own, [x.split()[0] for x in _BEST.split(", ")])

    def run(batches):
        held, size, docs = [], 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in columns}
                if not len(row["doc"]):
                    continue
                held.append(row)
                size += len(row["term"])
                docs += len(row["doc"])
                if size >= SHARD_POSTINGS or docs >= SHARD_DOCS:
                    yield from best(held)
                    held, size, docs = [], 0, 0
        if held:
            yield from best(held)

    return rows.select(*columns).mapInArrow(run, _BEST)


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` highest-scoring documents of every item."""
    spark = docs.sparkSession
    stated = written(
        items.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("item_id").cast("long").alias("item_id"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ),
        "search-items",
    )
    total = stated.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = -(-total // BLOCK_BYTES)
    found = spark.createDataFrame([], _BEST)
    for block in range(blocks):
        own = stated.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES of text
        counted = [(r.uid, r.item_id, Counter(terms(r.text.encode("utf-8")))) for r in own]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for _, _, c in counted))))}
        if not vocabulary:
            continue
        rows = written(postings(docs, vocabulary), f"search-postings-{block}")
        figures = rows.agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
        if not figures.t:
            continue
        held_by = document_counts(rows, len(vocabulary))
        weight = [math.floor(1000 * math.log((2 * figures.d + 2) / (2 * int(n) + 1))) for n in held_by]
        queries = [(uid, item, [(vocabulary[t], q * weight[vocabulary[t]]) for t, q in c.items()]) for uid, item, c in counted]
        part = written(_searched(rows, queries, figures.d, figures.t, k), f"search-best-{block}")
        found = part if block == 0 else found.unionByName(part)
    order = Window.partitionBy("item_uid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), q AS (
  SELECT row_number() OVER () AS uid, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), g AS (
  SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0
), p AS (
  SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(words) AS term FROM d) GROUP BY uid, term
), w AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g
), t AS (
  SELECT uid, item_id, term, count(*) AS q FROM (SELECT uid, item_id, unnest(words) AS term FROM q) GROUP BY ALL
), s AS (
  SELECT t.uid AS item_uid, t.item_id, d.doc_id, d.uid,
         sum(t.q * w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * len(d.words) * g.n_docs) // g.n_terms))))::BIGINT AS score
  FROM t JOIN w USING (term) JOIN p USING (term) JOIN d ON d.uid = p.uid, g
  GROUP BY t.uid, t.item_id, d.doc_id, d.uid
), r AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_uid ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
