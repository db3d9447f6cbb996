"""Trie of conversation prefixes in flat node tables addressed by a minimal perfect hash.

A turn travels as two 64-bit hashes of (role, text) and its number of code points; no text is moved.
A prefix's digest is the sum over its turns of a mix of (turn hash, depth), twice 64 bits, so running
sums give the digests of all prefixes of a conversation.

1. Rebuilt conversations (``rebuilt``): first turns of the base conversation, then the own turns after
   as many, sorted over all partitions by (conversation, turn). A conversation may span
   partitions: what those before hold of it (counts, sums; one row for each end of a partition)
   is carried on by the driver.
2. Nodes under which more than ``LIGHT_ROWS`` prefixes lie are heavy; there are few (the limit rises
   until at most ``HEAVY_NODES`` are left), so they are broadcast. What hangs under them falls into
   whole subtrees, dealt by their topmost node. A first turn that a third of all conversations share
   is heavy, and its subtrees are spread.
3. A shard enumerates the distinct digests of its subtrees, gives each a slot by a minimal perfect
   hash (levels of collision-free positions; a looked-up digest must be the one stored in its slot),
   scatters counts into flat arrays by slot, and adds leaves and saved tokens to parent slots, depth
   by depth from the deepest. The heavy nodes are one more shard, which starts from their subtrees' totals.
4. Ids of the conversations that end in a node are hashed in ascending order. Those that end in
   heavy nodes are sorted over all partitions and strung together in blocks; only the blocks meet.

Defined results: null role or text counts as empty; rows without conv_id are ignored; null turns come
first; rows of one conversation with equal turns follow in the order of their hashes; repeated rows
are separate turns; an empty table gives no node; other columns are ignored whatever their names. A
subtree under no heavy node has to fit in a task, so the longest conversation does too (70 bytes a turn).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cauce.llm.base import importable, partitions, written

MOST_HEAD = 5  # turns taken from the base conversation at most
LIGHT_ROWS, HEAVY_NODES = 1 << 12, 1 << 17
GROUP_ROWS = 1 << 16
BLOCK_IDS = 1 << 13
NO_IDS = hashlib.sha256(b"").hexdigest()

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One 64-bit number of two."""
    x = (x ^ (y * _A)) * _B
    x ^= x >> np.uint64(31)
    x = (x + y) * _C
    return x ^ (x >> np.uint64(29))


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


# -- rebuilt conversations -----------------------------------------------------------------


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Rows of all rebuilt conversations in order (kind 0: its beginning, 1: turns of the base
    conversation, 2: all own turns), with the numbers of turns that decide on their depth."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.length(text).cast("long").alias("n"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "h1", "h2")
    first = turns.where("conv % 100 = 0").withColumn("at", F.row_number().over(order)).where(F.col("at") <= MOST_HEAD)
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "h1", "h2", "n"))).alias("heads"))
    convs = turns.groupBy("conv").agg(F.count("*").alias("own")).select(
        "conv", "own", F.expr("conv - conv % 100").alias("base"), (F.crc32(F.col("conv").cast("string")) % 6).cast("int").alias("wanted")
    )
    convs = convs.join(heads, "base", "left").withColumn("heads", F.expr("slice(coalesce(heads, array()), 1, wanted)"))
    convs = convs.withColumn("taken", F.size("heads").cast("long")).withColumn(
        "total", F.col("taken") + F.greatest(F.col("own") - F.col("wanted"), F.lit(0))
    )
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    numbers = [F.col("wanted").cast("long").alias("wanted"), "taken", "total"]
    starts = convs.select("conv", F.lit(0).alias("kind"), none.alias("turn"), zero.alias("h1"), zero.alias("h2"), zero.alias("n"), *numbers)
    taken = convs.select("conv", *numbers, F.explode("heads").alias("x")).select(
        "conv", F.lit(1).alias("kind"), F.col("x.at").cast("long").alias("turn"), "x.h1", "x.h2", "x.n", *[F.lit(None).cast("long").alias(c) for c in ("wanted", "taken", "total")]
    )
    own = turns.select("conv", F.lit(2).alias("kind"), "turn", "h1", "h2", "n", *[none.alias(c) for c in ("wanted", "taken", "total")])
    keys = ["conv", "kind", F.asc_nulls_first("turn"), "h1", "h2"]
    ordered = starts.unionByName(taken).unionByName(own).repartitionByRange(partitions(conversations.sparkSession), *keys).sortWithinPartitions(*keys)
    return ordered.withColumn("part", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id())


def _ends(rows: DataFrame, *aggregates) -> list:
    """The aggregates of each partition's first and last conversation, in the order of partitions."""
    bounds = rows.groupBy("part").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi"))  # a row for each partition
    return (
        rows.join(F.broadcast(bounds), "part").where("conv = lo OR conv = hi")
        .groupBy("part", "conv").agg(*aggregates).orderBy("part", "conv").collect()
    )


_PREFIX = "part int, conv long, depth long, n long, last boolean, left long, d1 long, d2 long, p1 long, p2 long"


def prefixes(ordered: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation: its digest, its parent's, the code
    points of its last turn, whether the conversation ends there, and how many turns are left."""
    ordered = written(ordered, "trie-turns")
    count = lambda kind: F.sum((F.col("kind") == kind).cast("long"))
    carried, running = {}, None
    for r in _ends(ordered, count(2).alias("own"), F.max("wanted").alias("wanted"), F.max("taken").alias("taken"), F.max("total").alias("total")):
        if running and running[0] == r.conv:
            carried[r.part] = running
            running = (r.conv, running[1] + r.own, *running[2:])
        else:
            running = (r.conv, r.own, r.wanted, r.taken, r.total)

    def run(batches):
        state = None  # part, conv, own turns so far, wanted, taken, total, sums of the digests
        for batch in batches:
            if not batch.num_rows:
                continue
            part, conv, kind, turn, n, own_wanted, own_taken, own_total = (
                batch.column(c).fill_null(0).to_numpy() for c in ("part", "conv", "kind", "turn", "n", "wanted", "taken", "total")
            )
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (conv[1:] != conv[:-1])])
            start = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            known = np.stack([np.zeros(len(start), np.int64), own_wanted[start], own_taken[start], own_total[start]])
            sums = np.zeros((2, len(start)), dtype=np.uint64)
            for g in np.flatnonzero(kind[start] != 0):  # begun in an earlier batch or partition
                i = start[g]
                if state and state[:2] == (part[i], conv[i]):
                    known[:, g], sums[:, g] = state[2:6], state[6]
                else:
                    known[:, g] = carried[int(part[i])][1:]
            mine = (kind == 2).astype(np.int64)
            at = np.cumsum(mine)
            at = at - (at[start] - mine[start])[group] + known[0][group]
            wanted, taken, total = (x[group] for x in known[1:])
            depth = np.where(kind == 0, 0, np.where(kind == 1, turn, taken + at - wanted))
            kept = (kind != 2) | (at > wanted)
            digests, before = [], []
            for k, h in enumerate((h1, h2)):
                x = np.where(kept & (kind != 0), mixed(h, depth.astype(np.uint64) + np.uint64(k << 40)), np.uint64(0))
                total_x = np.cumsum(x)
                digest = total_x - (total_x[start] - x[start])[group] + sums[k][group]
                digests.append(digest)
                before.append(digest - x)
            state = (part[-1], conv[-1], int(at[-1]), *known[1:, -1].tolist(), np.array([d[-1] for d in digests]))
            rows = np.flatnonzero(kept)
            columns = (part, conv, depth, n, depth == total, total - depth, *(x.view(np.int64) for x in (*digests, *before)))
            yield _batch(_PREFIX, *(c[rows] for c in columns))

    n_parts = partitions(ordered.sparkSession)
    dealt = ordered.repartitionById(n_parts, F.expr(f"part % {n_parts}")).sortWithinPartitions("part", "i")
    local = written(dealt.mapInArrow(run, _PREFIX), "trie-prefixes")
    sums, running = {}, None
    if carried:
        for r in _ends(local, F.max_by("d1", "depth").alias("d1"), F.max_by("d2", "depth").alias("d2")):
            own = np.array([r.d1, r.d2]).view(np.uint64)
            if running and running[0] == r.conv:
                sums[r.part] = running
                running = (r.conv, running[1] + own)
            else:
                running = (r.conv, own)
    if not sums:
        return local

    def shifted(batches):
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            part, conv = columns[:2]
            for p in set(np.unique(part).tolist()) & set(sums):
                own = np.flatnonzero((part == p) & (conv == sums[p][0]))
                for c in (6, 7, 8, 9):
                    values = columns[c].copy()
                    values[own] = (values[own].view(np.uint64) + sums[p][1][c % 2]).view(np.int64)
                    columns[c] = values
            yield _batch(_PREFIX, *columns)

    return local.mapInArrow(shifted, _PREFIX)


# -- node tables ---------------------------------------------------------------------------


class Slots:
    """Minimal perfect hash of distinct two-word keys: each level places the keys that alone take a
    position and leaves the others to the next; a slot is a position's rank among those taken."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        rest, placed = np.arange(len(a)), 0
        while len(rest):
            at = self._position(a[rest], b[rest], len(self.levels), 2 * len(rest))
            taken = np.bincount(at, minlength=2 * len(rest)) == 1
            rank = np.cumsum(taken) - 1 + placed
            self.levels.append((taken, rank))
            alone = taken[at]
            slot = rank[at[alone]]
            self.a[slot], self.b[slot] = a[rest[alone]], b[rest[alone]]
            placed += len(slot)
            rest = rest[~alone]

    @staticmethod
    def _position(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64(level * int(_C) % (1 << 64))
        return (mixed(a + seed, b) % np.uint64(size)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        out, rest = np.full(len(a), -1, dtype=np.int64), np.arange(len(a))
        for level, (taken, rank) in enumerate(self.levels):
            at = self._position(a[rest], b[rest], level, len(taken))
            hit = taken[at]
            out[rest[hit]] = rank[at[hit]]
            rest = rest[~hit]
        known = np.flatnonzero(out >= 0)
        wrong = (self.a[out[known]] != a[known]) | (self.b[out[known]] != b[known])
        out[known[wrong]] = -1
        return out


def accumulate(depth: np.ndarray, parent: np.ndarray, *values: np.ndarray) -> None:
    """Adds each node's values to its parent's (slot -1: none), from the deepest depth up."""
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        own = level[parent[level] >= 0]
        for v in values:
            np.add.at(v, parent[own], v[own])


def _unsigned(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy().view(np.uint64) for c in names]


_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, p1 long, p2 long"
)


def _subtrees(table: pa.Table) -> pa.RecordBatch:
    """Nodes of whole subtrees from the rows of their prefixes; the topmost carry their parents' digests."""
    d1, d2, p1, p2 = _unsigned(table, "d1", "d2", "p1", "p2")
    conv, depth, n, last = (table.column(c).to_numpy() for c in ("conv", "depth", "n", "last"))
    order = np.lexsort((d2, d1))
    first = order[np.concatenate([[True], (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])])]
    slots = Slots(d1[first], d2[first])
    at = slots.find(d1, d2)
    if (at < 0).any():
        raise ValueError("a digest has no slot")
    size = len(first)
    own = np.empty(size, dtype=np.int64)
    own[at[first]] = first  # a row of each node
    n_convs = np.bincount(at, minlength=size)
    smallest = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(smallest, at, conv)
    parent = slots.find(p1[own], p2[own])
    n_children = np.bincount(parent[parent >= 0], minlength=size)
    leaves = (n_children == 0).astype(np.int64)
    saved = (n_convs - 1) * n[own]
    accumulate(depth[own], parent, leaves, saved)
    ends = [NO_IDS] * size
    rows = np.flatnonzero(last)
    rows = rows[np.lexsort((conv[rows], at[rows]))]
    cuts = np.flatnonzero(np.diff(at[rows])) + 1
    for group in np.split(rows, cuts) if len(rows) else []:
        ends[at[group[0]]] = hashlib.sha256(",".join(map(str, conv[group].tolist())).encode()).hexdigest()
    top = parent < 0
    above = table.column("above").to_numpy()[own]
    return _batch(
        _NODE, smallest, depth[own], np.where(top, above, smallest[parent]), n_convs, n_children, leaves, saved, ends,
        pa.array(p1[own].view(np.int64), mask=~top), pa.array(p2[own].view(np.int64), mask=~top),
    )


def _light(rows: DataFrame) -> DataFrame:
    """Nodes of all subtrees under heavy nodes (``rows``: r1, r2 name the subtree)."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= GROUP_ROWS:
                table = pa.Table.from_batches(held)
                r1, r2 = table.column("r1").to_numpy(), table.column("r2").to_numpy()
                cuts = np.flatnonzero((r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1]))
                if len(cuts):  # the last subtree may go on
                    yield _subtrees(table.slice(0, int(cuts[-1]) + 1))
                    rest = table.slice(int(cuts[-1]) + 1)
                    held, size = rest.to_batches(), rest.num_rows
        if held:
            yield _subtrees(pa.Table.from_batches(held))

    dealt = rows.repartition(partitions(rows.sparkSession), "r1", "r2").sortWithinPartitions("r1", "r2")
    return dealt.mapInArrow(run, _NODE)


_TOP = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, d1 long, d2 long"


def _heavy_nodes(rows: DataFrame) -> DataFrame:
    """The heavy nodes (at most ``HEAVY_NODES``), given the totals of the subtrees under them."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        d1, d2, p1, p2 = _unsigned(table, "d1", "d2", "p1", "p2")
        conv, depth, n, n_convs, children, leaves, saved = (
            table.column(c).to_numpy().copy() for c in ("conv", "depth", "n", "n_convs", "children", "leaves", "saved")
        )
        slots = Slots(d1, d2)
        at = slots.find(d1, d2)
        place = np.empty(len(at), dtype=np.int64)
        place[at] = np.arange(len(at))
        parent = np.where(depth > 0, slots.find(p1, p2), -1)
        parent = np.where(parent >= 0, place[parent], -1)  # row numbers
        children += np.bincount(parent[parent >= 0], minlength=len(at))
        leaves += children == 0
        saved += (n_convs - 1) * n
        accumulate(depth, parent, leaves, saved)
        above = pa.array(conv[parent], mask=parent < 0)
        yield _batch(_TOP, conv, depth, above, n_convs, children, leaves, saved, d1.view(np.int64), d2.view(np.int64))

    return rows.repartition(1).mapInArrow(run, _TOP)


def _ends_of_heavy(rows: DataFrame) -> DataFrame:
    """d1, d2, ends: the hash of the ids, however many conversations end in one node."""
    block = "d1 long, d2 long, first long, ids binary"

    def strung(batches):
        for batch in batches:
            d1, d2, conv = (batch.column(c).to_numpy() for c in ("d1", "d2", "conv"))
            new = np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])]) if len(d1) else np.zeros(0, bool)
            for own in np.split(np.arange(len(d1)), np.flatnonzero(new)[1:]) if len(d1) else []:
                starts = own[::BLOCK_IDS]
                ids = [",".join(map(str, conv[a : min(a + BLOCK_IDS, own[-1] + 1)].tolist())).encode() for a in starts]
                yield _batch(block, d1[starts], d2[starts], conv[starts], ids)

    def hashed(batches):
        key, sha = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if key != (r["d1"], r["d2"]):
                    if key:
                        yield _batch("d1 long, d2 long, ends string", [key[0]], [key[1]], [sha.hexdigest()])
                    key, sha = (r["d1"], r["d2"]), hashlib.sha256(r["ids"])
                else:
                    sha.update(b"," + r["ids"])
        if key:
            yield _batch("d1 long, d2 long, ends string", [key[0]], [key[1]], [sha.hexdigest()])

    n = partitions(rows.sparkSession)
    blocks = rows.repartitionByRange(n, "d1", "d2", "conv").sortWithinPartitions("d1", "d2", "conv").mapInArrow(strung, block)
    dealt = blocks.repartition(n, "d1", "d2").sortWithinPartitions("d1", "d2", "first")
    return dealt.mapInArrow(hashed, "d1 long, d2 long, ends string")


def _heavy(rows: DataFrame) -> DataFrame:
    """Digests of the heavy nodes, the root always among them."""
    size = F.sum(F.col("left") + 1)
    big = written(rows.groupBy("depth", "d1", "d2").agg(size.alias("size")).where((F.col("size") > LIGHT_ROWS) | (F.col("depth") == 0)), "trie-sizes")
    limits = [LIGHT_ROWS << k for k in range(0, 50)]
    counts = big.agg(*[F.count(F.when(F.col("size") > x, 1)).alias(f"n{k}") for k, x in enumerate(limits)]).first()
    limit = next((x for k, x in enumerate(limits) if counts[k] <= HEAVY_NODES), limits[-1])
    return big.where((F.col("size") > limit) | (F.col("depth") == 0)).select("depth", "d1", "d2")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie."""
    rows = prefixes(rebuilt(conversations))
    keys = ["depth", "d1", "d2"]
    heavy = rows.join(F.broadcast(_heavy(rows)), keys)
    stats = heavy.groupBy(*keys, "p1", "p2").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("n").alias("n"))
    stats = written(stats, "trie-heavy")
    marked = rows.join(F.broadcast(stats.select(*keys, F.lit(True).alias("big"))), keys, "left")
    above = stats.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv").alias("above"))
    light = marked.where(F.col("big").isNull()).drop("big").join(F.broadcast(above), ["depth", "p1", "p2"], "left")
    light = written(light, "trie-light")
    roots = light.where(F.col("above").isNotNull()).select("conv", F.col("d1").alias("r1"), F.col("d2").alias("r2"))
    shards = light.join(roots, "conv").withColumn("above", F.coalesce("above", F.lit(0)))
    columns = ["r1", "r2", "conv", "depth", "n", "last", "above", "d1", "d2", "p1", "p2"]
    nodes = written(_light(shards.select(*columns)), "trie-nodes")
    under = nodes.where(F.col("p1").isNotNull()).groupBy("depth", "p1", "p2").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    under = under.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"), "children", "leaves", "saved")
    tops = stats.join(under, keys, "left").fillna(0, ["children", "leaves", "saved"])
    ends = _ends_of_heavy(heavy.where("last").select("d1", "d2", "conv"))
    top = _heavy_nodes(tops).join(ends, ["d1", "d2"], "left")
    names = [x.split()[0] for x in _NODE.split(", ")][:7]
    top = top.select(*names, F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"))
    return nodes.select(*names, "ends_sha256").unionByName(top)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id
), c AS (
  SELECT conv_id, turns, xor(4294967295::BIGINT, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda x, bit: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT)) % 6 AS h
  FROM l
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:c.h], c.turns[c.h + 1:]) AS turns
  FROM c LEFT JOIN l b ON b.conv_id = c.conv_id - c.conv_id % 100
), p AS (
  SELECT conv_id, len(turns) AS n, d AS depth, md5(turns[:d]::VARCHAR) AS own, md5(turns[:d - 1]::VARCHAR) AS up,
         CASE WHEN d = 0 THEN 0 ELSE length(turns[d].text) END AS size
  FROM r, (SELECT unnest(range(0, 1000)) AS d) WHERE d <= len(turns)
), nodes AS (
  SELECT depth, own, any_value(CASE WHEN depth > 0 THEN up END) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, own
), k AS (
  SELECT depth - 1 AS depth, up AS own, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), v AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN k USING (depth, own)
), s AS (
  SELECT a.depth, a.own, sum((v.n_children = 0)::INT)::BIGINT AS n_leaves, sum((v.n_convs - 1) * v.size)::BIGINT AS saved_tokens
  FROM v JOIN p a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.depth, a.own
)
SELECT v.conv_id, v.depth, o.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s USING (depth, own) LEFT JOIN nodes o ON o.depth = v.depth - 1 AND o.own = v.up
"""
