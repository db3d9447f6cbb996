"""Byte-level BPE encoding and decoding.

A word's symbols form a doubly linked list. A priority queue holds the merge rank of every
neighbouring pair; the lowest rank (leftmost on ties) merges first, and entries whose symbols
have changed since are skipped. Decoding concatenates the vocabulary's strings.

Texts are cut at the strings of special tokens, then into words by the public pattern of this
tokenizer family; each distinct word is merged once per worker (at most ``MAX_WORDS`` are kept).

Defined results: null text counts as empty and has no ids; repeated rows are encoded each; an
empty table gives no row; columns besides doc_id and text are ignored whatever their names. A
text must fit in a task's memory; its words are looked up in stretches.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from cauce.llm.base import documents, per_batch, plain
from cauce.llm.tokens import tokenizer_path

MAX_WORDS = 500_000

#: The pattern that splits text before the merges, fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        vocab = spec["model"]["vocab"]
        self.first = [vocab[c] for c in symbols]  # id of each byte
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        strings = dict.fromkeys(range(max([*vocab.values(), *self.special.values()]) + 1), b"")
        for token, i in vocab.items():
            strings[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.special.items():
            strings[i] = token.encode()
        self.strings = [strings[i] for i in range(len(strings))]
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.words = regex.compile(WORDS)
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word."""
        ids = [self.first[b] for b in word]
        n, merges = len(ids), self.merges
        if n < 2:
            return tuple(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, new = heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two has merged since
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((new, ids[k])):
                    heappush(queue, (found[0], i, new, ids[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], new))):
                heappush(queue, (found[0], h, ids[h], new, found[1]))
        return tuple(x for x in ids if x >= 0)

    def _ids(self, text: str) -> list[int]:
        words, known = self.words.findall(text), self.known
        new = set(words)
        if len(known) + len(new) > MAX_WORDS:
            known.clear()
        for w in new:
            if w not in known:
                known[w] = self.merge(w.encode("utf-8"))
        return list(chain.from_iterable(map(known.__getitem__, words)))

    def encode(self, text: str) -> list[int]:
        if not any(t in text for t in self.special):
            return self._ids(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._ids(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._ids(text[at:])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", errors="replace")


_CODERS: dict[str, Bpe] = {}


def coder(path: str) -> Bpe:
    """One per worker process, kept from task to task."""
    if path not in _CODERS:
        _CODERS[path] = Bpe(path)
    return _CODERS[path]


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every text."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def make():
        bpe = coder(path)

        def work(batch):
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, len(texts), 64):
                found = [bpe.encode(t) for t in texts[at : at + 64].to_pylist()]
                yield pa.RecordBatch.from_arrays([ids[at : at + 64], pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

        return work

    return per_batch(plain(docs), make, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and text of rows doc_id, ids (null ids: empty)."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def make():
        bpe = coder(path)

        def work(batch):
            texts = [bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

        return work

    return per_batch(rows.select("doc_id", "ids"), make, "doc_id long, text string")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Digests of each text's ids and of what they decode to (``DIGEST``), in one pass."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    names = [x.split()[0] for x in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def make():
        bpe = coder(path)
        decimal = [str(i) for i in range(len(bpe.strings))]
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()

        def work(batch):
            rows, texts = [], batch.column("text")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids = bpe.encode(texts[i].as_py())
                rows.append((doc, len(ids), sha(",".join(map(decimal.__getitem__, ids))), sha(bpe.decode(ids))))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

        return work

    return per_batch(plain(docs), make, DIGEST)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
