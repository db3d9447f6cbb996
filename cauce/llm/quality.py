"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of its language's common words are
compared with those of the language as a whole by Jensen-Shannon distance (base 2, so 0 to 1). A
document further away than a threshold, with an allowance for the sampling noise of short texts,
is rejected; texts too short for a histogram to say
anything are not judged by it (the guards), only by the base rule.

The references are counts over all documents. Common words are found exactly in two passes: a
word whose share of a language reaches ``SHARE`` cannot stay below a tenth of that share in the
units that counted it and below it in all others, so each unit (a stretch of one task's rows)
reports only words above that tenth, and the sums bound every word's share from above; the words
that may reach ``SHARE`` (at most 1 / (0.9 SHARE) of a language) are then counted over all
documents. Only these counts reach the driver, one reference for each language that holds ``SHARE_OF_ALL`` of all
words, so at most 1 / ``SHARE_OF_ALL`` of them at any size of the corpus.

A document is judged by its own language's reference, less the document itself. The allowance grows
with the doubt about a small reference, which a few odd texts can spoil, and vanishes with its size.
Where that reference could decide nothing (the only texts of a language; a mistyped, missing or very rare
lang), the document counts as written in that language whose common words cover most of it: it is
judged by words only if they cover at least ``WRITTEN_IN`` of what they cover of that language, and
by classes only if both are of one script. So a clean text in a language that nothing else is written
in has no word verdict by a foreign reference. Around ``2 * REFERENCE_WORDS`` words of a language the
rule is lenient: junk of that language may stay there.

Defined results: null text has no words and fails the base rule; a null lang is a language of its
own; repeated rows are judged each; an empty table gives no row; other columns are ignored, or
travel with ``kept_documents``, whatever their names; very long texts must fit in a task's memory.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import documents

SHARE = 1 / 500
#: A language with a smaller share of all words has no reference of its own.
SHARE_OF_ALL = 1 / 1000
UNIT_WORDS = 2_000_000

#: Character classes by byte; bytes that continue a character belong to none.
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PUNCTUATION = b".,;:!?'\"()-"
CLASSES = 8

MIN_CHARS = 250
MIN_WORDS = 50  # where the base rule ends
#: Largest distance of a text of endless length, and what sampling noise may add: c / sqrt(n).
MAX_CHAR_DISTANCE, CHAR_NOISE = 0.20, 2.0
MAX_WORD_DISTANCE, WORD_NOISE = 0.33, 0.5
#: Below so many words a histogram is coarser still; labelled clean texts reach c = 0.60, junk begins at 1.0.
SHORT_WORDS, SHORT_NOISE = 80, 0.8
#: What a reference of n words may add, since a few odd texts can spoil a small one: (c / n) ** 2. At 1 it decides nothing.
REFERENCE_WORDS = 4000
#: Share of a reference's own cover by its common words from which a text counts as written in its language.
WRITTEN_IN = 2 / 3


def _class_matrix() -> np.ndarray:
    of = np.full(256, 6)  # other ASCII
    of[ord("a") : ord("z") + 1] = 0
    of[ord("A") : ord("Z") + 1] = 1
    of[ord("0") : ord("9") + 1] = 2
    for k, chars in ((3, SPACES), (4, PUNCTUATION), (5, SYMBOLS)):
        of[list(chars)] = k
    of[0xC0:] = 7  # the first byte of any other character
    out = np.zeros((256, CLASSES), dtype=np.int64)
    kept = [b for b in range(256) if not 0x80 <= b < 0xC0]
    out[kept, of[kept]] = 1
    return out


CLASS_OF = _class_matrix()


def byte_counts(text: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    raw = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, len(raw), 1 << 22):
        out += np.bincount(raw[at : at + (1 << 22)], minlength=256)
    return out


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found twice or more in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    if n < 100_000 and len(set(zip(words, words[1:], words[2:], strict=False))) == n:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    keys = pairs[:-1].astype(np.int64) * len(known) + ids[2:]
    inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)[1:]
    again = counts[inverse] > 1
    cover = np.zeros(len(words), dtype=bool)
    for k in range(3):
        cover[k : k + n] |= again
    return int(cover.sum())


def measures(text: bytes) -> tuple[int, int, int, int, int, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, counts of character classes."""
    by_byte, words = byte_counts(text), text.split()
    chars = int(by_byte.sum() - by_byte[0x80:0xC0].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        chars - int(by_byte[list(SPACES)].sum()),
        int(by_byte[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeat_words(words),
        by_byte @ CLASS_OF,
    )


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two count vectors (0 where one is all zero)."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda x: float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])))
    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


# -- references ----------------------------------------------------------------------------

_COUNTS = "lang string, kind string, word binary, cls int, n long"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("null")).alias("lang"),
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.binary(), pa.int32(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["lang", "kind", "word", "cls", "n"]
    )


def _survey(batches):
    """Class counts, word totals and the words above a tenth of ``SHARE`` of each unit."""
    classes: dict[str, np.ndarray] = {}
    words: dict[str, Counter] = {}
    sizes: Counter = Counter()

    def unit(lang: str) -> pa.RecordBatch:
        size, counts = sizes.pop(lang), words.pop(lang)
        least = size * SHARE / 10
        out = [(lang, "word", w, None, n) for w, n in counts.items() if n >= least]
        return _rows([*out, (lang, "total", None, None, size)])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i, lang in enumerate(batch.column("lang").to_pylist()):
            text = texts[i].as_py()
            classes[lang] = classes.get(lang, 0) + byte_counts(text) @ CLASS_OF
            own = text.lower().split()
            words.setdefault(lang, Counter()).update(own)
            sizes[lang] += len(own)
            if sum(sizes.values()) >= UNIT_WORDS:
                for x in list(sizes):
                    yield unit(x)
            if len(classes) > 10_000:
                yield _rows([(x, "class", None, k, int(n)) for x, c in classes.items() for k, n in enumerate(c)])
                classes = {}
    for x in list(sizes):
        yield unit(x)
    yield _rows([(x, "class", None, k, int(n)) for x, c in classes.items() for k, n in enumerate(c)])


def references(docs: DataFrame, share: float = 0.0) -> dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """Per language that holds ``share`` of all words, and a word at least: class counts, common words and their places, counts
    of these and of all others."""
    keyed = _keyed(docs)
    found = keyed.mapInArrow(_survey, _COUNTS).groupBy("lang", "kind", "word", "cls").agg(F.sum("n").alias("n"))
    found = found.persist()
    totals = found.where("kind = 'total'").select("lang", F.col("n").alias("total"))
    every = totals.agg(F.sum("total")).first()[0] or 0
    large = {r.lang: r.total for r in totals.where(F.col("total") >= max(1, share * every)).collect()}
    if not large:
        found.unpersist()
        return {}
    named = F.col("lang").isin(list(large))
    classes = {x: np.zeros(CLASSES, dtype=np.int64) for x in large}
    for r in found.where(named & (F.col("kind") == "class")).collect():
        classes[r.lang][r.cls] = r.n
    # counted n of a word, and less than a tenth of SHARE of every unit that did not report it
    maybe = found.where(named & (F.col("kind") == "word")).join(totals, "lang")
    maybe = maybe.where(F.col("n") >= F.col("total") * SHARE * 0.9).select("lang", "word")
    candidates: dict[str, set[bytes]] = {x: set() for x in large}
    for r in maybe.collect():
        candidates[r.lang].add(bytes(r.word))
    found.unpersist()

    def count(batches):
        out: Counter = Counter()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                if own := candidates.get(lang):
                    out.update((lang, w) for w in texts[i].as_py().lower().split() if w in own)
        yield _rows([(lang, "word", w, None, n) for (lang, w), n in out.items()])

    exact = keyed.where(named).mapInArrow(count, _COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    by_lang: dict[str, list] = {x: [] for x in large}
    for r in exact:
        by_lang[r.lang].append(r)
    out = {}
    for lang, total in large.items():
        common = sorted((-r.n, bytes(r.word)) for r in by_lang[lang] if r.n >= SHARE * total)
        counts = np.array([-n for n, _ in common] + [total + sum(n for n, _ in common)], dtype=np.int64)
        out[lang] = (classes[lang], {w: i for i, (_, w) in enumerate(common)}, counts)
    return out


# -- verdicts ------------------------------------------------------------------------------


def _less(reference, classes: np.ndarray, words: np.ndarray):
    """The reference's counts without those of one of its documents."""
    return np.maximum(reference[0] - classes, 0), np.maximum(reference[2] - words, 0)


def _binned(own: Counter, common: dict[bytes, int]) -> np.ndarray:
    counts = np.zeros(len(common) + 1, dtype=np.int64)
    for w, n in own.items():
        counts[common.get(w, len(common))] += n
    return counts


def _doubt(reference, without: int = 0) -> float:
    """What a reference may add to a distance, a text of so many words left out."""
    return (REFERENCE_WORDS / max(1, int(reference[2].sum()) - without)) ** 2


def _covering(own: Counter, others):
    """The reference whose common words cover most of the text beyond doubt (the first of equals), or None."""
    size = max(1, sum(own.values()))
    cover = lambda ref: sum(own[w] for w in ref[1] if w in own) / size - _doubt(ref)
    return max(others, key=cover, default=None)


def judge(text: bytes, own=None, others=()) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and both
    distances (null where a guard holds the rule back), by the reference of the text's own language,
    which counts the text itself, or else by one of ``others``."""
    n_words, word_chars, symbols, dup_lines, repeats, classes = measures(text)
    base_failed = n_words < 50 or 100 * repeats > 50 * n_words
    n_chars = int(classes.sum())
    words = Counter(text.lower().split())
    by_class = by_word = None
    far = False
    foreign = own is None or _doubt(own, n_words) >= 1 - MAX_WORD_DISTANCE
    reference = _covering(words, others) if foreign else own
    if reference is not None:
        counts = _binned(words, reference[1])
        ref_classes, ref_words = (reference[0], reference[2]) if foreign else _less(reference, classes, counts)
        ref_chars, total = int(ref_classes.sum()), int(ref_words.sum())
        doubt = _doubt(reference, 0 if foreign else n_words)
        if n_chars >= MIN_CHARS and ref_chars:
            by_class = js_distance(classes, ref_classes)
            one_script = not foreign or abs(classes[7] / n_chars - ref_classes[7] / ref_chars) < 0.5
            far |= bool(one_script and by_class > MAX_CHAR_DISTANCE + CHAR_NOISE / n_chars**0.5 + doubt)
        written = not foreign or counts[:-1].sum() * total >= WRITTEN_IN * ref_words[:-1].sum() * n_words
        if n_words >= MIN_WORDS and total and written:
            by_word = js_distance(counts, ref_words)
            noise = WORD_NOISE if n_words >= SHORT_WORDS else SHORT_NOISE
            far |= by_word > MAX_WORD_DISTANCE + noise / n_words**0.5 + doubt
    kept = bool(not base_failed and not far)
    return n_words, word_chars, symbols, dup_lines, repeats, base_failed, kept, by_class, by_word


VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict (``VERDICT``) of every document."""
    refs = references(docs, SHARE_OF_ALL)
    others = lambda lang: [ref for x, ref in refs.items() if x != lang]
    names = [x.split()[0] for x in VERDICT.split(", ")]
    types = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def run(batches):
        for batch in batches:
            texts, out = batch.column("text").cast(pa.binary()), []
            langs = batch.column("lang").to_pylist()
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                out.append((doc, *judge(texts[i].as_py(), refs.get(langs[i]), others(langs[i]))))
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("null")).alias("lang"),
    )
    return rows.mapInArrow(run, VERDICT)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    refs = references(docs, SHARE_OF_ALL)
    others = lambda lang: [ref for x, ref in refs.items() if x != lang]

    def run(batches):
        for batch in batches:
            texts, langs = batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist()
            keep = []
            for i, lang in enumerate(langs):
                key = "null" if lang is None else f"={lang}"
                keep.append(judge(texts[i].as_py() or b"", refs.get(key), others(key))[6])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))
