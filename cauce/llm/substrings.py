"""Repeated-substring removal by suffix sorting (deep-shallow).

Every byte that lies in a string of ``LENGTH`` bytes which also starts in a document with a
smaller doc_id is removed. A suffix need only be ordered to that depth, and only suffixes that can
have an equal in another document need ordering at all:

1. Anchors. Each string of ``LENGTH`` bytes names its least-hashed ``GRAM``-byte gram (leftmost of
   equals) as its anchor; equal strings name equal grams at equal places. The strings that name
   one anchor start next to each other; together they cover a context of the text.
2. Anchors are dealt by the gram's hash. If the whole context is the same as in a document with a
   smaller id, all its strings repeat: done, without looking at text. Of the rest only contexts
   that share their gram with another document's, different context go on (the edges of repeats).
   Tasks first settle equal contexts among their own rows, so what many documents share is sent
   on once per task, not once per document.
3. The suffixes of those contexts are sorted (deep-shallow): multikey partitioning by eight-byte
   symbols to the shallow depth, then blind tries for the groups that are still equal: a node
   skips to the first byte in which any member differs from its leader and branches there. Suffixes
   that are equal to ``LENGTH`` bytes end in one leaf; all but those of the least doc_id repeat.
   A gram with more than ``HOT_CONTEXTS`` such contexts is not sorted in one task: its strings are
   dealt by all their bytes, with the least doc_id taken before the shuffle, so only equals meet.
4. The ranges of all repeats of a document are joined to its text, merged and cut out.

Contexts are compared by 64-bit hashes of gram and of first and last string together (118 bits).

Defined results: null text counts as empty; texts shorter than ``LENGTH`` bytes lose nothing;
rows with one doc_id, or without, do not repeat each other, and a null doc_id counts as larger
than any; an empty table gives no row; other columns are ignored whatever their names. A text
must fit in a task's memory; hashing works on stretches of it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import documents, partitions, plain, with_uid, written

LENGTH, GRAM = 50, 24
SHALLOW = 24
LAST_ID = (1 << 63) - 1
PART = 1 << 16  # strings hashed at once

# -- hashing -------------------------------------------------------------------------------

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _C
    return x ^ (x >> np.uint64(29))


def gram_hashes(raw: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """64-bit hashes of the grams of each size starting at each byte, by doubling."""
    level, width = raw.astype(np.uint64) + np.uint64(1), 1
    out: list[np.ndarray | None] = [None] * len(sizes)
    done = [0] * len(sizes)
    while width <= max(sizes):
        for i, size in enumerate(sizes):
            n = len(raw) - size + 1
            if size & width and n > 0:
                part = level[done[i] : done[i] + n]
                out[i] = part.copy() if out[i] is None else (out[i] ^ (out[i] >> np.uint64(31))) * _A + part
                done[i] += width
        if width * 2 > max(sizes) or len(level) <= width:
            break
        m = len(level) - width
        twice = level[:m] * _A
        twice ^= twice >> np.uint64(29)
        level, width = twice + level[width:] * _B, width * 2
    return [np.zeros(0, np.uint64) if x is None else _mixed(x) for x in out]


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    n = len(x) - size + 1
    while width * 2 <= size:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    return x[:n] if width == size else np.minimum(x[:n], x[size - width : size - width + n])


def anchors(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the texts that lie one after another in ``raw`` (``starts``: where each begins,
    and the end): gram hash, context hash, text, first string's start in the text."""
    if len(raw) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    n = len(raw) - LENGTH + 1  # strings; hashed part by part, so that a part stays in the processor's cache
    gram, whole = np.empty(len(raw) - GRAM + 1, np.uint64), np.empty(n, np.uint64)
    place = np.empty(n, np.int64)
    low = np.uint64((1 << (PART + LENGTH).bit_length()) - 1)
    for at in range(0, n, PART):
        size = min(PART, n - at)
        own, whole[at : at + size] = gram_hashes(raw[at : at + size + LENGTH - 1], GRAM, LENGTH)
        gram[at : at + len(own)] = own
        packed = (own & ~low) | np.arange(len(own), dtype=np.uint64)
        place[at : at + size] = (sliding_min(packed, LENGTH - GRAM + 1) & low).astype(np.int64) + at
    # strings that do not run over the end of their text
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + LENGTH <= starts[1:][text])
    if not len(inside):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    named = place[inside]
    new = np.flatnonzero(np.concatenate([[True], (named[1:] != named[:-1]) | (text[inside][1:] != text[inside][:-1])]))
    first, last = inside[new], inside[np.concatenate([new[1:], [len(inside)]]) - 1]
    at = named[new]
    context = _mixed(whole[first] * _A ^ (whole[last] + _B))
    shape = ((at - first) << 5 | (last - first)).astype(np.uint64)  # both below 32
    context = (context & ~np.uint64(1023)) | shape
    own = text[first]
    return gram[at].view(np.int64), context.view(np.int64), own, first - starts[own]


# -- passes over the anchors ---------------------------------------------------------------

# Anchors with at >= 0; ranges settled before the shuffle carry their uid as h, their length as c
# and -1 - at as at, so that no column is there for them alone. What one stretch sends to one
# partition travels as one row of arrays: columns of like values compress far better than rows.
_ROW = ("h", "c", "doc", "uid", "at")
_BLOCK = "part int, h array<long>, c array<long>, doc array<long>, uid array<long>, at array<int>"
_TYPES = [pa.int64()] * 4 + [pa.int32()]
STRETCH = 4 << 20  # bytes whose anchors travel together
WHOLE, EDGE, HOT = 2, 3, 4
HOT_CONTEXTS = 1 << 15
MOST_ANCHORS = 1 << 21  # of one gram held at once


def _batch(names: str, types: list, *columns) -> pa.RecordBatch:
    fields = [x.split()[0] for x in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], fields)


def _settle(h, c, doc):
    """In the order (h, c, doc): that order, the least doc of each row's context, group starts."""
    order = np.lexsort((doc, c, h))
    h, c, doc = h[order], c[order], doc[order]
    new_h = np.concatenate([[True], h[1:] != h[:-1]])
    new_c = new_h | np.concatenate([[True], c[1:] != c[:-1]])
    least = doc[np.flatnonzero(new_c)][np.cumsum(new_c) - 1]
    return order, least, new_h, new_c


def _blocks(n: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (``_ROW``) as one row of arrays for each of the ``n`` partitions by h that gets any."""
    part = (columns[0].view(np.uint64) % np.uint64(n)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    ends = pa.array(np.append(starts, len(part)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[order], t)) for x, t in zip(columns, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(part[starts]), *lists], ["part", *_ROW])


def _found(rows: DataFrame, n: int) -> DataFrame:
    """Anchors of all documents as blocks for ``n`` partitions; where contexts are those of an earlier document of the same
    stretch, the range that they cover is sent on by its uid, only to be passed through."""

    def flush(held):
        texts, docs, uids, bases = held
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        h, c, text, at = anchors(raw, starts)
        if not len(h):
            return
        doc, uid = np.array(docs, dtype=np.int64)[text], np.array(uids, dtype=np.int64)[text]
        at = at + np.array(bases, dtype=np.int64)[text]
        order, least, _, _ = _settle(h, c, doc)
        whole = np.zeros(len(h), dtype=bool)
        whole[order] = doc[order] > least
        open_rows = np.flatnonzero(~whole)
        sent = [x[open_rows] for x in (h, c, doc, uid, at.astype(np.int32))]
        hit = np.flatnonzero(whole)
        if len(hit):  # contexts next to each other in one text overlap: one range
            edge = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(text[hit]) != 0)])
            first, last = hit[edge], hit[np.concatenate([np.flatnonzero(edge)[1:], [len(hit)]]) - 1]
            size = at[last] + (c[last] & 31) + LENGTH - at[first]
            settled = (uid[first], size, doc[first], uid[first], (-1 - at[first]).astype(np.int32))
            sent = [np.concatenate(x) for x in zip(sent, settled, strict=True)]
        yield _blocks(n, sent)

    def run(batches):
        held, size = ([], [], [], []), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, (doc, uid) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("uid").to_pylist(), strict=True)):
                text = texts[i].as_py()
                # a long text in stretches that overlap by all but the first byte of a string
                for at in range(0, max(1, len(text) - LENGTH + 1), STRETCH):
                    part = text[at : at + STRETCH + LENGTH - 1]
                    for column, x in zip(held, (part, doc, uid, at), strict=True):
                        column.append(x)
                    size += len(part)
                    if size >= STRETCH:
                        yield from flush(held)
                        held, size = ([], [], [], []), 0
        if size:
            yield from flush(held)

    return rows.mapInArrow(run, _BLOCK)


_RANGE = "uid long, at int, size int, h long, doc long, kind int"
_RANGE_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]


def _groups(batches, key: str, limit: int, most: int | None = None):
    """Record batches joined into tables that hold whole runs of equal ``key``, each with the keys
    whose run is not whole in it as it has ``most`` rows or more."""
    held: list[pa.RecordBatch] = []
    torn: list[int] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        if held and sum(b.num_rows for b in held) + len(keys) >= limit:
            cut = int(np.searchsorted(keys != held[-1].column(key)[-1].as_py(), True)) if keys[0] == held[-1].column(key)[-1].as_py() else 0
            if cut < len(keys):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)]), torn
                held, torn = [], []
                batch = batch.slice(cut)
        held.append(batch)
        if most and sum(b.num_rows for b in held) >= most:
            last = batch.column(key)[-1].as_py()
            yield pa.Table.from_batches(held), [*torn, last]
            held, torn = [], [last]
    if held:
        yield pa.Table.from_batches(held), torn


def _whole(uid, at, size):
    """Settled ranges; only those to be sorted need their gram and doc."""
    none = np.zeros(len(uid), np.int64)
    yield _batch(_RANGE, _RANGE_TYPES, uid, at, size, none, none, np.full(len(uid), WHOLE, np.int32))


def _judged(blocks: DataFrame, n: int) -> DataFrame:
    """Ranges that repeat as a whole (WHOLE) and those whose strings are to be compared, by sorting
    (EDGE) or, for grams of too many contexts, one by one (HOT)."""
    most, hot_contexts = MOST_ANCHORS, HOT_CONTEXTS

    def run(batches):
        for table, torn in _groups(batches, "h", 1 << 20, most):
            h, c, doc, uid, at = (table.column(x).to_numpy() for x in ("h", "c", "doc", "uid", "at"))
            ready = np.flatnonzero(at < 0)
            if len(ready):
                yield from _whole(uid[ready], -1 - at[ready], c[ready].astype(np.int32))
            size = ((c & 31) + LENGTH).astype(np.int32)
            open_rows = np.flatnonzero(at >= 0)
            if not len(open_rows):
                continue
            order, least, new_h, new_c = _settle(h[open_rows], c[open_rows], doc[open_rows])
            order = open_rows[order]
            start = np.flatnonzero(new_h)
            group = np.cumsum(new_h) - 1
            own = doc[order]
            several = (np.maximum.reduceat(own, start) > np.minimum.reduceat(own, start))[group]
            contexts = np.add.reduceat(new_c.astype(np.int64), start)[group]
            whole = own > least
            # of a torn run this table cannot tell: all that is not settled goes on
            part = np.isin(h[order], np.array(torn, dtype=np.int64))
            edge = ~whole & (several & (contexts > 1) | part)
            hot = part | (np.add.reduceat(edge.astype(np.int64), start)[group] > hot_contexts)
            i = order[whole]
            if len(i):
                yield from _whole(uid[i], at[i], size[i])
            i = order[edge]
            if len(i):
                yield _batch(_RANGE, _RANGE_TYPES, uid[i], at[i], size[i], h[i], doc[i], np.where(hot[edge], HOT, EDGE).astype(np.int32))

    rows = blocks.repartitionById(n, "part").select(F.inline(F.arrays_zip(*_ROW)))
    return rows.sortWithinPartitions("h").mapInArrow(run, _RANGE)


# -- deep-shallow sorting ------------------------------------------------------------------


def _symbols(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number."""
    padded = np.concatenate([raw, np.zeros(LENGTH + 8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(raw) + LENGTH].copy().view(">u8")[:, 0].astype(np.uint64)


def _common(a: np.ndarray, b: np.ndarray, symbols: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, knowing that they share ``depth``."""
    out = depth.copy()
    open_rows = np.flatnonzero(out < LENGTH)
    while len(open_rows):
        x = symbols[a[open_rows] + out[open_rows]] ^ symbols[b[open_rows] + out[open_rows]]
        same = np.full(len(x), 8, dtype=np.int64)
        for k in range(8):  # bytes from the front until one differs
            byte = (x >> np.uint64(56 - 8 * k)) & np.uint64(255)
            same = np.where((byte != 0) & (same == 8), k, same)
        out[open_rows] = np.minimum(out[open_rows] + same, LENGTH)
        open_rows = open_rows[(same == 8) & (out[open_rows] < LENGTH)]
    return out


def sort_suffixes(raw: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``LENGTH`` bytes, and the number of each one's group
    of equals, in that order. Every suffix has ``LENGTH`` bytes in ``raw``."""
    symbols = _symbols(raw)
    order = np.arange(len(suffixes))
    group = np.zeros(len(suffixes), dtype=np.int64)  # group number by place in the order
    for depth in range(0, SHALLOW, 8):  # shallow: multikey partitioning
        key = symbols[suffixes[order] + depth]
        by = np.lexsort((key, group))
        order, key, group = order[by], key[by], group[by]
        group = np.cumsum(np.concatenate([[False], (group[1:] != group[:-1]) | (key[1:] != key[:-1])]))
    # deep: blind tries, all groups level by level; node members are places in the order
    sizes = np.bincount(group, minlength=1)
    members = np.flatnonzero(sizes[group] > 1)
    known = np.full(len(members), SHALLOW, dtype=np.int64)
    new = np.concatenate([[True], group[1:] != group[:-1]])  # a group of equals begins here
    while len(members):
        node = group[members]
        first = np.concatenate([[True], node[1:] != node[:-1]])
        start, number = np.flatnonzero(first), np.cumsum(first) - 1
        suffix = suffixes[order[members]]
        shared = _common(suffix, suffix[start][number], symbols, known)
        skip = np.minimum.reduceat(shared, start)[number]  # where the node branches
        going = np.flatnonzero(skip < LENGTH)
        if not len(going):
            break
        members, node, skip, suffix = members[going], node[going], skip[going], suffix[going]
        branch = raw[suffix + skip].astype(np.int64)
        by = np.lexsort((branch, node))
        order[members] = order[members][by]
        branch = branch[by]  # nodes keep their places, as members of one lie together
        child = np.concatenate([[True], (node[1:] != node[:-1]) | (branch[1:] != branch[:-1])])
        new[members[child]] = True
        group = np.cumsum(new)
        sizes = np.bincount(group)
        deeper = sizes[group[members]] > 1
        members, known = members[deeper], skip[deeper] + 1
    return order, np.cumsum(new)


_EDGE = "h long, doc long, uid long, at int, context binary"


def _contexts(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """The bytes of each edge range."""
    wanted = edges.groupBy("uid").agg(F.collect_list(F.struct("at", "size", "h")).alias("edges"))  # of one text

    def run(batches):
        types = [pa.int64()] * 3 + [pa.int32(), pa.binary()]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            marked, docs, uids = batch.column("edges"), batch.column("doc"), batch.column("uid")
            for i in range(batch.num_rows):
                text, own = texts[i].as_py(), marked[i].values
                at, size = own.field("at").to_pylist(), own.field("size").to_pylist()
                n = len(at)
                yield _batch(
                    _EDGE, types, own.field("h"), [docs[i].as_py()] * n, [uids[i].as_py()] * n, at,
                    [text[a : a + s] for a, s in zip(at, size, strict=True)],
                )

    return rows.join(wanted, "uid").select("uid", "doc", "text", "edges").mapInArrow(_gathered(run), _EDGE)


def _gathered(run, rows: int = 20_000):
    """Joins many small record batches into larger ones."""

    def outer(batches):
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return outer


_CUT = "uid long, at int, size int"
_STRING = "string binary, doc long, uid long, at int"


def _sorted_edges(contexts: DataFrame) -> DataFrame:
    """Ranges of the strings that a smaller doc_id has too."""

    def run(batches):
        for table, _ in _groups(batches, "h", 1 << 15):
            doc, uid, at = (table.column(x).to_numpy() for x in ("doc", "uid", "at"))
            parts = table.column("context").to_pylist()
            sizes = np.array([len(p) for p in parts], dtype=np.int64)
            raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
            starts = np.cumsum(sizes) - sizes
            counts = sizes - LENGTH + 1
            row = np.repeat(np.arange(len(parts)), counts)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            order, group = sort_suffixes(raw, starts[row] + inner)
            own = doc[row[order]]
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            number = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
            repeats = np.zeros(len(row), dtype=bool)
            repeats[order] = own > np.minimum.reduceat(own, start)[number]
            hit = np.flatnonzero(repeats)
            if len(hit):  # runs of strings that start next to each other in one context
                edge = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)])
                first, last = hit[edge], hit[np.concatenate([np.flatnonzero(edge)[1:], [len(hit)]]) - 1]
                i = row[first]
                yield _batch(_CUT, [pa.int64(), pa.int32(), pa.int32()], uid[i], at[i] + inner[first], last - first + LENGTH)

    n = partitions(contexts.sparkSession)
    return contexts.repartition(n, "h").sortWithinPartitions("h").mapInArrow(run, _CUT)


def _equal_strings(contexts: DataFrame) -> DataFrame:
    """The same ranges, string by string: rows of a hot gram meet only where all bytes are equal."""

    def run(batches):
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int32()]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                parts = part.column("context").to_pylist()
                counts = np.array([len(p) - LENGTH + 1 for p in parts], dtype=np.int64)
                row = np.repeat(np.arange(len(parts)), counts)
                inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                doc, uid, first = (part.column(x).to_numpy()[row] for x in ("doc", "uid", "at"))
                strings = [p[k : k + LENGTH] for p in parts for k in range(len(p) - LENGTH + 1)]
                yield _batch(_STRING, types, strings, doc, uid, (first + inner).astype(np.int32))

    strings = written(contexts.mapInArrow(run, _STRING), "substring-strings")
    least = strings.groupBy("string").agg(F.min("doc").alias("least"), F.max("doc").alias("last")).where("least < last")
    return strings.join(least, "string").where("doc > least").select("uid", "at", F.lit(LENGTH).alias("size"))


# -- the operator --------------------------------------------------------------------------

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written texts (uid, doc_id, doc, text) and all ranges to remove."""
    staged, uid = with_uid(plain(docs), "substring-rows")
    rows = staged.select(
        F.col(uid).alias("uid"), "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), "text"
    )
    n = partitions(docs.sparkSession)
    judged = written(_judged(_found(rows.select("uid", "doc", "text"), n), n), "substring-anchors")
    contexts = _contexts(rows, judged.where(F.col("kind") == EDGE))
    cuts = written(_sorted_edges(contexts), "substring-cuts")
    hot = judged.where(F.col("kind") == HOT)
    if not hot.isEmpty():
        cuts = cuts.unionByName(written(_equal_strings(_contexts(rows, hot)), "substring-hot-cuts"))
    return rows, judged.where(F.col("kind") == WHOLE).select("uid", "at", "size").unionByName(cuts)


def merged(at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that the ranges cover."""
    by = np.argsort(at, kind="stable")
    at, end = at[by].astype(np.int64), (at[by] + size[by]).astype(np.int64)
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], at[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(at)]]) - 1
    return at[new], reach[last]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every document with what stays of its bytes (``RESULT``)."""
    return _cut_out(docs, RESULT, lambda b: b, pa.binary())


def _cut_out(docs: DataFrame, schema: str, last, last_type) -> DataFrame:
    rows, ranges = _ranges(docs)
    by_doc = ranges.groupBy("uid").agg(F.collect_list(F.struct("at", "size")).alias("cuts"))  # of one text
    types = [pa.int64()] * 4 + [last_type]

    def run(batches):
        for batch in batches:
            texts, cuts, out = batch.column("text").cast(pa.binary()), batch.column("cuts"), []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = texts[i].as_py()
                if not cuts[i].is_valid:
                    out.append((doc, len(text), 0, 0, last(text)))
                    continue
                own = cuts[i].values
                a, b = merged(own.field("at").to_numpy(), own.field("size").to_numpy())
                kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True))
                out.append((doc, len(text), len(text) - len(kept), len(a), last(kept)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield _batch(schema, types, *map(list, columns))

    return rows.select("uid", "doc_id", "text").join(by_doc, "uid", "left").mapInArrow(run, schema)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of what stays is taken where the text is cut."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _cut_out(documents(spark, sf_dir), schema, lambda b: hashlib.sha256(b).hexdigest(), pa.string())


#: DuckDB SQL: every 50-byte string of every text, as hexadecimal digits (parts of 512 starts are cut first),
#: with the smallest doc_id that has it.
OP10_SQL = """
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, hex(coalesce(text, '')) AS h FROM documents),
c AS (
    SELECT doc_id, j, substr(h, 1024 * j + 1, 1024 + 98) AS part
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 1024 + 1)) AS j FROM d)),
g AS (
    SELECT doc_id, 512 * j + i AS i, substr(part, 2 * i + 1, 100) AS s
    FROM (SELECT doc_id, j, part, unnest(range(0, greatest(least(512, len(part) // 2 - 49), 0))) AS i FROM c)),
f AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT g.doc_id, g.i FROM g JOIN f USING (s) WHERE f.first < g.doc_id),
marked AS (
    SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS opens FROM hit),
numbered AS (SELECT doc_id, i, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, span),
pieces AS (
    SELECT s.doc_id, s.a, s.b, substr(d.h, 2 * coalesce(lag(s.b) OVER w, 0) + 1,
           2 * (s.a - coalesce(lag(s.b) OVER w, 0))) AS piece
    FROM spans s JOIN d USING (doc_id) WINDOW w AS (PARTITION BY s.doc_id ORDER BY s.a)),
cut AS (
    SELECT doc_id, string_agg(piece, '' ORDER BY a) AS kept, max(b) AS stop, count(*) AS n, sum(b - a) AS removed
    FROM pieces GROUP BY doc_id)
SELECT d.doc_id, len(d.h) // 2 AS n_bytes, CAST(coalesce(cut.removed, 0) AS BIGINT) AS n_removed,
       coalesce(cut.n, 0) AS n_spans,
       sha256(unhex(coalesce(cut.kept, '') || substr(d.h, 2 * coalesce(cut.stop, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
