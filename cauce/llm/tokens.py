"""Token ids of whole texts by the tokenizers library.

The tokenizer of ``word_bpe_49k.json`` drops white space and never joins symbols across it, so the
ids of a text are those of its chunks between spaces one after another (``tests/llm`` compares with
whole-text encoding). A stretch of texts is split and its distinct chunks are found in Arrow; each is
looked up, and numpy gathers the ids of all chunks in order.

Of a chunk that is a word of Latin letters followed by punctuation the library encodes both apart, and
lower-cases the word. Such words are encoded many at a time, as one text whose ids are parted
where the vocabulary marks a word's end; all other chunks are encoded one by one as they are.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII punctuation that can follow a word without joining it; no apostrophe (contractions).
TAIL = b'!"#$%&()*+,-./:;<=>?@[]^_`{|}~'
#: Lower-case Latin letters that normalising leaves as they are.
WORD = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
#: Lower-casing A-Z leaves a text's ids as they are unless it makes the string of a special token, or a
#: combining mark (U+0300 to U+037F) then joins the small letter that has no capital form.
CASED = (b"<|", b"\xcc", b"\xcd")
STRETCH = 16 << 20  # bytes split at once
TOGETHER = 64  # words in one text


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    ids = [*data["model"]["vocab"].values(), *(t["id"] for t in data.get("added_tokens", []))]
    return max(ids) + 1


class ChunkEncoder:
    """Texts -> ids as little-endian bytes of ``dtype``. Holds at most ``max_entries`` chunks besides
    those of one stretch (it is emptied beyond that; results do not depend on it)."""

    def __init__(self, path: str, dtype: str = "<u2", max_entries: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the same merges without the steps that leave lower-case Latin words as they are
        bytes_alone = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        steps = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_alone]}
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": steps, "added_tokens": []}))
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True
        self.parted = bool(suffix)
        self.dtype = np.dtype(dtype)
        self.max_entries = max_entries
        self.chunks: dict[bytes, bytes] = {}

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that ``WORD`` matches."""
        out = []
        for at in range(0, len(words), 1 << 16):
            some = words[at : at + (1 << 16)]
            texts = [" ".join(some[i : i + TOGETHER]) for i in range(0, len(some), TOGETHER)]
            found = self.bare.encode_batch_fast(texts, add_special_tokens=False)
            flat = np.fromiter(chain.from_iterable(e.ids for e in found), dtype=np.int64)
            ends = ((np.flatnonzero(self.ends[flat]) + 1) * self.dtype.itemsize).tolist()
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not mark the ends of words")
            raw = flat.astype(self.dtype).tobytes()
            out += [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        return out

    def _others(self, chunks: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(chunks), 2048):
            for e in self.tokenizer.encode_batch_fast(chunks[at : at + 2048], add_special_tokens=False):
                out.append(np.array(e.ids, dtype=self.dtype).tobytes())
        return out

    def _learn(self, new: list[bytes]) -> None:
        matches = WORD.fullmatch if self.parted else lambda core: None
        split, words, others, ids = {}, set(), set(), {}
        known = self.chunks.get
        for chunk in new:
            parts = []
            for piece in chunk.split():  # by white space other than the space
                core = piece.rstrip(TAIL)
                lowered = core.decode("utf-8").lower()
                if matches(lowered):
                    if (own := known(lowered.encode())) is not None:
                        ids[lowered] = own
                    else:
                        words.add(lowered)
                    parts.append(lowered)
                    if len(core) < len(piece):
                        others.add(tail := piece[len(core) :].decode("utf-8"))
                        parts.append(tail)
                else:
                    others.add(own := piece.decode("utf-8"))
                    parts.append(own)
            split[chunk] = parts
        words, others = list(words), list(others.difference(words, ids))
        ids.update(zip(words, self._words(words), strict=True))
        ids.update(zip(others, self._others(others), strict=True))
        self.chunks.update((chunk, b"".join([ids[x] for x in parts])) for chunk, parts in split.items())

    def encode(self, texts: list[bytes] | pa.Array) -> list[bytes]:
        """Ids of each text. Texts are taken together up to some MB, so that the words they
        share are met once and memory stays bounded."""
        column = texts.cast(pa.large_binary()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_binary())
        sizes = pc.binary_length(column).to_numpy()
        out: list[bytes] = []
        at = 0
        while at < len(column):
            size, end = 0, at
            while end < len(column) and (end == at or size + sizes[end] <= STRETCH):
                size += int(sizes[end])
                end += 1
            some = [t if any(x in t for x in CASED) else t.lower() for t in column[at:end].to_pylist()]
            out += self._stretch(pa.array(some, pa.large_binary()))
            at = end
        return out

    def _stretch(self, column: pa.Array) -> list[bytes]:
        split = pc.split_pattern(column, b" ")
        starts = split.offsets.to_numpy()
        coded = split.values[int(starts[0]) : int(starts[-1])].dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.chunks
        new = [x for x in distinct if x not in known]
        if new:
            if len(known) > self.max_entries:  # what this stretch uses stays
                known = self.chunks = {x: known[x] for x in distinct if x in known}
            self._learn(new)
        own = [known[x] for x in distinct]
        size = self.dtype.itemsize
        counts = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) // size
        begin = np.cumsum(counts) - counts
        flat = np.frombuffer(b"".join(own), dtype=self.dtype)
        codes = coded.indices.to_numpy()
        taken = counts[codes]
        ends = np.concatenate([[0], np.cumsum(taken)])
        place = np.arange(ends[-1]) + np.repeat(begin[codes] - ends[:-1], taken)
        raw = flat[place].tobytes()
        cuts = (ends[starts - starts[0]] * size).tolist()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, dtype: str = "<u2") -> ChunkEncoder:
    """One per worker process, kept from task to task."""
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = ChunkEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def id_dtype(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"
