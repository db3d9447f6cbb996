"""Byte-level BPE by replaying the merges over all distinct words at once.

Texts are cut into words by the public pattern of this tokenizer family. A stretch of texts gives
the distinct words that are not known yet; their bytes lie one after another in flat numpy arrays
(symbol, next, previous), a separator between words. An inverted index maps each pair's rank to the
positions at which the pair stands. Ranks are taken in order; all positions of the rank merge in one
step (of overlapping ones the leftmost first), only the pairs on both sides of a merged symbol are
looked up anew, and their positions join the index.

A word in itself a token is that token, as in the library. Should a merge give rise to a pair of
a smaller rank than its own, the order over all words could differ from the order within the word:
such words are merged again one by one (``least_first``). Decoding concatenates the tokens' bytes.

Ranks come in the public ``.tiktoken`` form: a token's bytes in base64, and its rank, which is its id.

Defined results: null text counts as empty and has no ids; repeated rows are encoded each; an empty
table gives no row; columns besides doc_id and text are ignored whatever their names. A text must
fit in a task's memory; words are replayed in stretches of ``STRETCH`` bytes of text.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from cauce.llm.base import documents, per_batch, plain
from cauce.llm.tokens import tokenizer_path

STRETCH = 8 << 20
MAX_CHUNKS = 1_000_000
ENDS = (".", ",")  # a word's last letter and these never make one word
NONE = np.int32((1 << 31) - 1)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


class MergeReplay:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.strings = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.strings[rank] = token
        self.separator = len(self.strings)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pair_rank = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        self.pattern = regex.compile(pattern)
        self.chunks: dict[str, bytes | None] = {}  # None: with white space at an end

    def _looked_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the two do not merge."""
        if not len(self.keys):
            return np.full(len(a), NONE, np.int32)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def least_first(self, word: bytes) -> list[int]:
        """Ids of one word: the least rank merges first, the leftmost of equals."""
        ids = [int(self.first[b]) for b in word]
        while len(ids) > 1:
            rank, at = min((self.pair_rank.get(a << 32 | b, NONE), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == NONE:
                break
            ids[at : at + 2] = [int(rank)]
        return ids

    def replay(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (none of them empty)."""
        raw = np.frombuffer(b"\x00" + b"\x00".join(words) + b"\x00", dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes + 1)])  # places of the separators
        ids = self.first[raw]
        ids[ends] = self.separator
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[-1], before[0] = n - 1, 0
        alive = np.ones(n, dtype=bool)
        alive[ends] = False
        pair = np.full(n, NONE, dtype=np.int32)
        pair[:-1] = self._looked_up(ids[:-1], ids[1:])
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        odd: list[np.ndarray] = []

        def add(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for start, end, rank in zip(starts, [*starts[1:], len(ranks)], ranks[starts].tolist(), strict=True):
                if rank not in index:
                    index[rank] = []
                    heappush(queue, rank)
                index[rank].append(positions[start:end])

        some = np.flatnonzero(pair != NONE)
        if len(some):
            add(some, pair[some])
            heapify(queue)
        while queue:
            rank = heappop(queue)
            parts = index.pop(rank)
            left = parts[0] if len(parts) == 1 else _distinct(np.concatenate(parts))
            left = left[pair[left] == rank]  # the others have merged since
            if not len(left):
                continue
            right = after[left]
            if len(left) > 1:
                tied = left[1:] == right[:-1]
                if tied.any():  # of a run of overlapping pairs every second merges
                    start = np.concatenate([[True], ~tied])
                    number = np.arange(len(left))
                    keep = (number - np.maximum.accumulate(np.where(start, number, 0))) % 2 == 0
                    left, right = left[keep], right[keep]
            beyond = after[right]
            ids[left] = rank
            after[left] = beyond
            before[beyond] = left
            alive[right] = False
            pair[right] = NONE
            touched = np.concatenate([before[left], left])
            if len(left) > 1:
                touched = _distinct(touched)
            found = self._looked_up(ids[touched], ids[after[touched]])
            pair[touched] = found
            some = found != NONE
            if some.any():
                touched, found = touched[some], found[some]
                if found.min() < rank:
                    odd.append(touched[found < rank])
                add(touched, found)
        kept = np.flatnonzero(alive)
        flat = ids[kept]
        cuts = np.searchsorted(kept, ends)
        out = [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        if odd:
            for i in np.unique(np.searchsorted(ends, np.concatenate(odd)) - 1).tolist():
                out[i] = np.array(self.least_first(words[i]), dtype=np.int64)
        return out

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        ranks = self.ranks
        out = [None if (rank := ranks.get(w)) is None else rank.to_bytes(4, "little") for w in words]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            ids = self.replay([words[i] for i in rest])
            flat = np.concatenate(ids).astype("<u4").tobytes()
            end = 0
            for i, own in zip(rest, ids, strict=True):
                start, end = end, end + 4 * len(own)
                out[i] = flat[start:end]
        return out

    def _learn(self, new: set[str], heads: list[str]) -> list[bytes]:
        """Adds the chunks to those known; ids of the texts' heads, which no space precedes."""
        chunks = self.chunks
        cores, ends, others = set(), [], []
        for c in new:
            if c.isalpha():
                cores.add(c)
            elif c[-1:] in ENDS and c[:-1].isalpha():
                ends.append(c)
                cores.add(c[:-1])
            else:
                others.append(c)
        found = [self.pattern.findall(f" {c}") for c in others]
        first = [self.pattern.findall(h) for h in heads]
        words = {*chain.from_iterable(found), *chain.from_iterable(first), *ENDS}.difference([""])
        fresh = [c for c in cores if c not in chunks]
        words = list(words)
        ids = self._merged([f" {c}".encode() for c in fresh] + [w.encode() for w in words])
        chunks.update(zip(fresh, ids, strict=False))
        known = dict(zip(words, ids[len(fresh) :], strict=True))
        for c in ends:
            chunks[c] = chunks[c[:-1]] + known[c[-1]]
        for c, own in zip(others, found, strict=True):
            apart = c and not c[0].isspace() and not c[-1].isspace()
            chunks[c] = b"".join(map(known.__getitem__, own)) if apart else None
        return [b"".join(map(known.__getitem__, own)) for own in first]

    def _whole(self, text: str) -> bytes:
        words = self.pattern.findall(text)
        new = list(set(words))
        return b"".join(map(dict(zip(new, self._merged([w.encode() for w in new]), strict=True)).__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. A single space between two
        characters that are no white space begins a word whatever stands around it, so texts are
        cut there and the chunks looked up; a text with other spaces is cut into words as a whole."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= STRETCH):
                size += len(texts[end])
                end += 1
            if len(self.chunks) > MAX_CHUNKS:
                self.chunks.clear()
            parts = [t.split(" ") for t in texts[at:end]]
            heads = [p.pop(0) for p in parts]
            new = set()
            for own in parts:
                new.update(own)
            first = self._learn(new.difference(self.chunks), heads)
            get = self.chunks.__getitem__
            for text, head, own, ids in zip(texts[at:end], heads, parts, first, strict=True):
                found = list(map(get, own))
                cut = None not in found and not (own and head[-1:].isspace())
                out.append(ids + b"".join(found) if cut else self._whole(text))
            at = end
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_REPLAYS: dict[tuple[str, str], MergeReplay] = {}


def replayer(path: str | None = None, pattern: str | None = None) -> MergeReplay:
    """One per worker process, kept from task to task."""
    import public_tokenizers

    key = (path or tokenizer_path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    if key not in _REPLAYS:
        _REPLAYS[key] = MergeReplay(*key)
    return _REPLAYS[key]


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array<long>) of every text."""

    def make():
        replay = replayer(path, pattern)

        def work(batch):
            found = [np.frombuffer(ids, "<u4").astype(np.int64) for ids in replay.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "ids"])

        return work

    return per_batch(plain(docs), make, "doc_id long, ids array<long>")


def decoded(rows: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and bytes of rows doc_id, ids (null ids: empty)."""

    def make():
        replay = replayer(path, pattern)

        def work(batch):
            found = [replay.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "bytes"])

        return work

    return per_batch(rows.select("doc_id", "ids"), make, "doc_id long, bytes binary")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Digests of each text's ids and of the bytes that they decode to (``DIGEST``)."""
    names = [x.split()[0] for x in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def make():
        replay = replayer(path, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()

        def work(batch):
            docs = batch.column("doc_id")
            for at in range(0, len(docs), 4096):
                ids = replay.encode(batch.column("text")[at : at + 4096].to_pylist())
                columns = [docs[at : at + 4096], [len(x) // 4 for x in ids], [sha(x) for x in ids], [sha(replay.decode(x)) for x in ids]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        return work

    return per_batch(plain(docs), make, DIGEST)


def op12_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
