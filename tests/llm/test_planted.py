"""The tagger's own work: personal data in forms that the base patterns miss, planted in held-out texts."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from cauce.llm import pii

DOCUMENTS = "/root/testdata/sf0.1/documents.parquet"


@pytest.fixture(scope="module")
def halves():
    rows = pq.read_table(DOCUMENTS, columns=["doc_id", "text"]).to_pylist()
    texts = [(r["doc_id"], r["text"]) for r in rows if r["text"] and len(r["text"]) < pii.TRAIN_CHARS]
    texts = [(d, t) for d, t in texts if pii.PLACE.search(t)]
    return [t for d, t in texts if d % 2], [t for d, t in texts if not d % 2]


@pytest.fixture(scope="module")
def tagger(halves):
    return pii.taught(halves[0][: pii.TRAIN_DOCUMENTS])


def added(text, tagger):
    base, every = pii.find([text], tagger)[0]
    own = {(k, a, b) for k, kind in enumerate(pii.KINDS) for a, b in base[kind]}
    assert own <= set(every)
    return set(every) - own, own


def test_planted_forms_are_found_in_held_out_texts(halves, tagger):
    rng = np.random.default_rng(99)
    hit = total = wrong = 0
    by_kind = np.zeros((len(pii.KINDS), 2), int)
    for text in halves[1] * 3:
        changed, spans = pii.planted(text, rng)
        found, own = added(changed, tagger)
        want = set(spans) - own
        hit, total, wrong = hit + len(found & want), total + len(want), wrong + len(found - want)
        for k, a, b in want:
            by_kind[k] += ((k, a, b) in found, 1)
    print("held out:", hit, total, wrong, by_kind.tolist())
    assert total > 400
    assert hit >= 0.8 * total and hit >= 0.95 * (hit + wrong)
    assert (by_kind[:, 0] >= 0.6 * by_kind[:, 1]).all()


def test_look_alikes_are_left_alone(halves, tagger):
    rng = np.random.default_rng(5)
    wrong = 0
    for text in halves[1]:
        left = text[:60].rsplit(" ", 1)[0]
        found, _ = added(f"{left} {pii.look_alike(rng)} {text[60:120]}", tagger)
        wrong += len(found)
    assert wrong <= 0.02 * len(halves[1])


@pytest.mark.parametrize(
    "text, kind",
    [
        ("please write to ann.b (at) mail.example.org before the next meeting of the board", "email"),
        ("contact jean.lopez [at] uni.fr for the plan of the house and the garden", "email"),
        ("they paid with 4111.1111.1111.1111 in the shop and went home after that", "card"),
        ("the server at 10-0-0-255 was down for the most part of the year and", "ip"),
        ("you can call 0049/301/555/9312 in the morning or in the evening of the", "phone"),
    ],
)
def test_forms_without_the_generator(tagger, text, kind):
    """Written by hand, in plain sentences of no corpus text."""
    found, _ = added(text, tagger)
    assert kind in {pii.KINDS[k] for k, _, _ in found}


def test_query_adds_planted_spans(spark, halves):
    """Through Spark: what is planted comes out of ``pii`` and goes from ``redacted``."""
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for i, text in enumerate(halves[0][:250]):
        changed, spans = pii.planted(text, rng)
        own = {(k, a, b) for k, kind in enumerate(pii.KINDS) for a, b in pii.base_spans(changed)[kind]}
        rows.append((i, changed))
        want[i] = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in set(spans) - own}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: set(r.spans.split(",")) for r in pii.pii(docs).collect()}
    hit, total = sum(len(want[i] & found[i]) for i in want), sum(map(len, want.values()))
    assert total > 80 and hit >= 0.8 * total
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    for i, text in rows:
        for span in want[i] & found[i]:
            _, a, b = span.split(":")
            assert text[int(a) : int(b)] not in clean[i]
