"""The pipeline's stages against brute force on what each stage is given."""

import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from cauce.llm import pii, quality
from cauce.llm.base import documents, written

from .conftest import SF
from .test_operators import WORD_BPE, brute_components, brute_fingerprint, library


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "simhash", "pii", "packing"]
    docs = documents(spark, SF)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == documents(spark, SF).columns
        kept.append(rows_of(docs))
    first = rows_of(documents(spark, SF))

    refs = quality.references(documents(spark, SF))
    assert kept[0] == [r for r in first if quality.judge(r[1].encode(), refs.get(f"={r[2]}"))[6]]

    seen, distinct = set(), []
    for r in kept[0]:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r[1])
        if text not in seen:
            distinct.append(r)
        seen.add(text)
    assert kept[1] == distinct

    roots = brute_components([brute_fingerprint(r[1]) for r in distinct])
    assert kept[2] == [r for i, r in enumerate(distinct) if roots[i] == i]

    assert [(r[0], *r[2:4]) for r in kept[3]] == [(r[0], *r[2:4]) for r in kept[2]]
    for before, after in zip(kept[2], kept[3], strict=True):
        assert not any(pii.base_spans(after[1]).values()) and after[4] == len(after[1])
        if not pii.DIGIT_OR_AT.search(before[1]):
            assert before == after

    pieces = corpus_pipeline.packing_stage(spark, docs, SF).collect()
    t, total = library(WORD_BPE), 0
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for doc, text, *_ in kept[3]:
        ids, at = t.encode(text, add_special_tokens=False).ids + [2], 0
        for p in sorted(by_doc.pop(doc), key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
        total += at
    assert not by_doc
    fill = Counter()
    for p in pieces:
        fill[p.sequence_id] += p.length
    assert sum(fill.values()) == total and sum(n != 4096 for n in fill.values()) <= 1

    assert Counter(corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()) == Counter(
        spark.createDataFrame(pieces).select("doc_id", "doc_tokens").distinct().collect()
    )
