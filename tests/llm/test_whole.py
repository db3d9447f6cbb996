"""Cases that an operator once left out."""

import numpy as np
import pytest

from cauce.llm import licenses, packing, quality, substrings

from .test_operators import brute_removal, tally

LABELLED = "/root/testdata/sf0.1"


def test_quality_judges_words_from_fifty_on(spark):
    rows = quality.op9_quality(spark, LABELLED).where("NOT base_failed AND n_words < 80")
    rows = rows.join(spark.read.parquet(f"{LABELLED}/labels.parquet"), "doc_id").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert len(clean) > 100 and len(junk) > 10
    assert all(r.kept for r in clean) and not any(r.kept for r in junk)


def test_quality_judges_documents_of_small_languages(spark):
    """Junk in languages of a few texts goes and clean texts stay, whatever the share of all words."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    odd_lang = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("x"), F.col("doc_id"))).otherwise(F.col("lang"))
    rows = quality.quality(docs.withColumn("lang", odd_lang)).where("NOT base_failed AND doc_id % 2 = 0")
    rows = rows.join(labels, "doc_id").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert len(junk) > 3 and not any(r.kept for r in junk)
    assert len(clean) > 50 and sum(r.kept for r in clean) >= 0.99 * len(clean)
    alone = docs.limit(8).withColumn("lang", F.concat(F.lit("x"), F.col("doc_id")))
    assert all(r.class_distance for r in quality.quality(alone).where("n_words >= 80").collect())


def test_quality_leaves_clean_texts_of_rare_languages_alone(spark):
    """German texts where nothing else, or next to nothing, is German, and a script that nothing else has."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{LABELLED}/documents.parquet").join(spark.read.parquet(f"{LABELLED}/labels.parquet"), "doc_id")
    few = docs.where("lang = 'de' AND doc_id % 16 = 3").cache()
    rest = docs.where("lang <> 'de'")
    single = few.withColumn("lang", F.concat(F.lit("x"), F.col("doc_id")))
    letters = "".join(chr(0x430 + k) for k in range(26))
    script = few.withColumn("text", F.translate("text", "abcdefghijklmnopqrstuvwxyz", letters)).withColumn("lang", F.lit("ru"))
    for rare in (few, few.limit(3), single, script.limit(1)):
        rows = quality.quality(rest.unionByName(rare)).join(rare.select("doc_id", "quality"), "doc_id").where("NOT base_failed").collect()
        clean = [r for r in rows if r.quality == 1]
        assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    few.unpersist()


def test_wrapped_license_notices(spark):
    """Each template, broken at every place and set among other lines."""
    rows, want = [], {}
    for k, (template, label) in enumerate(licenses.TEMPLATES):
        words = template.split()
        for at in range(1, len(words)):
            for lead in (0, 9, 23):
                broken = "\n * ".join([" ".join(words[:at]), " ".join(words[at:])])
                want[len(rows)] = label
                rows.append((len(rows), "some other word\n" * lead + broken + "\nmore text" * 30))
        want[len(rows)] = label
        rows.append((len(rows), "\n".join(words)))
    apart = len(rows)  # the words are there, but far from each other
    rows += [(apart + k, ("\n" + "word " * 40 + "\n").join(t.split())) for k, (t, _) in enumerate(licenses.TEMPLATES)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, label in want.items():
        assert label in found[k].labels.split(","), rows[k]
        assert found[k].score == 1.0
    assert all(not found[k].labels for k in range(apart, len(rows)))


@pytest.mark.parametrize("weighted", [False, True])
def test_packing_keeps_every_source(spark, weighted):
    """1500 sources, each within a token of its share in all windows while it lasts."""
    rng = np.random.default_rng(6)
    sources = [None, *(f"s{i}" for i in range(1499))]
    rows = [(i, " ".join(["word"] * int(rng.integers(1, 25))), s) for i, s in enumerate(sources)]
    own = {s: float(rng.integers(1, 4)) for s in sources} if weighted else None
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, length=512, weights=own).collect()
    sizes = {p.doc_id: p.doc_tokens for p in pieces}
    assert len(sizes) == len(rows) and sum(p.length for p in pieces) == sum(sizes.values())
    n = np.array([sizes[i] for i in range(len(rows))])
    w = np.array([own[s] for s in sources]) if weighted else n.astype(float)
    assert {p.queue for p in pieces} == {"null", *(f"={s}" for s in sources[1:])}
    held = np.zeros((1 + max(p.sequence_id for p in pieces), len(rows)), dtype=np.int64)
    ends = {}
    for p in pieces:
        held[p.sequence_id, p.doc_id] += p.length
        ends.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert (held[:-1].sum(1) == 512).all()
    taken = held.cumsum(0)
    lasting = (taken < n).all(1)
    assert lasting.any()
    share = taken[lasting].sum(1, keepdims=True) * w / w.sum()
    assert np.abs(taken[lasting] - share).max() < 1.5


@pytest.mark.parametrize("most", [1 << 21, 64])
def test_substrings_of_a_hot_gram(spark, monkeypatch, most):
    """A phrase with different text around it, some of which a few documents share."""
    monkeypatch.setattr(substrings, "HOT_CONTEXTS", 30)
    monkeypatch.setattr(substrings, "MOST_ANCHORS", most)
    calls, own = [], substrings._equal_strings
    monkeypatch.setattr(substrings, "_equal_strings", lambda c: calls.append(1) or own(c))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnop ")
    sides = ["".join(rng.choice(letters, 60)) for _ in range(40)]
    rows = []
    for i in range(400):
        before, after = "".join(rng.choice(letters, 60)), "".join(rng.choice(letters, 60))
        if i % 3 == 0:
            before = before[:40] + sides[i % 40][:20]
        if i % 5 == 0:
            after = sides[i % 40][: 10 + i % 30] + after
        rows.append((int(rng.integers(0, 300)) if i % 50 else None, before + "https://www.example.org/index?page=" + after))
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        out = substrings.remove_repeats(docs).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert calls and sum(r.n_removed for r in out) > 1000
    assert tally((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == tally(brute_removal(rows))
