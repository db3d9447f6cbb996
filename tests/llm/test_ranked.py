"""Ranked search, merge replay and the prefix trie against brute force, on rows with nulls, ties,
repeated rows, long texts, hot groups and clashing column names."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import lexical, merge_replay, pii, prefix_trie

from .test_operators import TRICKY, tally

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# -- ranked search ---------------------------------------------------------------------------


def split_terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_ranking(rows, items, k):
    docs = [(d, split_terms(t)) for d, t in rows]
    n_docs, n_terms = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in items:
        want, found = Counter(split_terms(text)), []
        for doc, words in docs:
            score = 0
            for t, tf in Counter(words).items():
                if t in want:
                    m = 100 - 75 + (75 * len(words) * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += want[t] * w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        best = sorted(found, key=lambda x: x[:3])[:k]
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(best)]
    return out


def random_texts(rng, n):
    """Words of very different frequency; many equal scores."""
    words = [f"w{i}" for i in range(60)]
    chance = 1.0 / np.arange(1, 61)
    chance /= chance.sum()
    return [" ".join(rng.choice(words, int(rng.integers(0, 40)), p=chance)) for _ in range(n)]


@pytest.mark.parametrize(("window", "shard", "block"), [(4096, 1 << 22, 16 << 20), (16, 500, 200), (5, 1, 40)])
def test_ranked_search(spark, monkeypatch, window, shard, block):
    monkeypatch.setattr(lexical, "WINDOW", window)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "STRETCH", 2000)
    rng = np.random.default_rng(window)
    texts = random_texts(rng, 400)
    rows = [(int(rng.integers(0, 200)) if i % 40 else None, t) for i, t in enumerate(texts)]
    rows += [(900, None), (901, ""), (902, " ,.;"), (903, "W1 w2\tÉW3 " * 3000), (904, texts[3]), (904, texts[3])]
    items = [(i, t) for i, t in enumerate(random_texts(rng, 12))] + [(50, None), (51, "absent words"), (3, texts[3]), (None, "w1 w1 w30")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("score", F.lit("clash")).withColumn("tf", F.lit(1)).withColumn("term", F.lit(2))
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("uid", F.lit("clash"))
    out = lexical.rank(docs, wanted)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert tally(out.collect()) == tally(brute_ranking(rows, items, 10))
    assert tally(lexical.rank(docs, wanted, 3).collect()) == tally(brute_ranking(rows, items, 3))


def test_ranked_search_skips_what_cannot_reach_the_threshold(monkeypatch):
    """Long lists are searched, not read, once the accumulators give a threshold."""
    import pyarrow as pa

    monkeypatch.setattr(lexical, "WINDOW", 64)
    n = 5000
    row = {"doc": pa.array(range(n)), "n": pa.array([5] * n, pa.int32())}
    rare = list(range(0, n, 400))
    row["term"] = pa.array([0] * n + [1] * len(rare), pa.int32())
    row["at"] = pa.array([*range(n), *rare], pa.int32())
    row["tf"] = pa.array([1] * (n + len(rare)), pa.int32())
    shard = lexical.Shard([row], n, 5 * n)
    at, score = shard.search([(0, 10), (1, 5000)], 3)
    assert at.tolist() == rare[:3] and len(set(score.tolist())) == 1


def test_ranked_search_without_rows(spark, none):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.rank(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lexical.rank(docs, items.limit(0)).count() == 0
    assert lexical.rank(docs.where("doc_id = 2"), items).count() == 0
    assert [tuple(r)[:3] for r in lexical.rank(docs, items).collect()] == [(1, 1, 1)]


# -- merge replay ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("text", [*TRICKY, "日本語 '’s'S 12345 ½x q", "\x00\x1c\x85​", "   a  \n\n b", "x \n y", " lead", "trail "])
def test_replay_is_the_librarys(library, text):
    own = merge_replay.replayer()
    ids = np.frombuffer(own.encode([text])[0], "<u4").tolist()
    assert ids == library.encode_ordinary(text)
    assert own.decode(np.array(ids, "<u4").tobytes()) == text.encode()


def test_replay_of_random_texts(library):
    rng = np.random.default_rng(0)
    parts = ["a", "b", "aa", " ", "  ", "\n", "'s", "1", "é", "é", "日", "😀", ".", ",", "the", "ing", "\xa0", "A", "ß"]
    own = merge_replay.replayer()
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 40)))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_replay_of_ranks_out_of_order(tmp_path):
    """A merge that makes a pair of a smaller rank than its own; overlapping equal pairs."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"aa", b"aaaa", b"bca", b"ca"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    own = merge_replay.MergeReplay(str(path), r"\w+|\W+")
    rng = np.random.default_rng(2)
    words = [bytes(rng.choice(list(b"abc"), int(rng.integers(1, 30))).astype(np.uint8)) for _ in range(3000)]
    for word, ids in zip(words, own.replay(words), strict=True):
        assert ids.tolist() == own.least_first(word)


def test_replay_round_trip(odd, odd_rows, none, library, monkeypatch):
    monkeypatch.setattr(merge_replay, "STRETCH", 5000)
    want = []
    for doc, text, *_ in odd_rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        want.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert tally(merge_replay.round_trip(odd).collect()) == tally(want)
    back = merge_replay.decoded(merge_replay.encoded(odd)).collect()
    assert tally((r.doc_id, bytes(r.bytes).decode()) for r in back) == tally((r[0], r[1] or "") for r in odd_rows)
    assert merge_replay.round_trip(none).count() == 0


# -- prefix trie -----------------------------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[p]]
        saved = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        totals[p] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
    return [
        (min(c), len(p), min(members[p[:-1]]) if p else None, len(c), len(children[p]), *totals[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, c in members.items()
    ]


def conversations(rng):
    rows = []
    for c in range(260):
        size = int(rng.integers(1, 9))
        for t in range(size):
            text = f"hello {rng.integers(0, 3)}é" if t < 4 else f"text {rng.integers(0, 50)}"
            rows.append((c, t if t or c % 3 else None, ["user", "assistant", None][t % 3], text if c % 11 else None))
    rows += [(300, t, "user", f"long {t}") for t in range(700)]  # no base; one conversation of many turns
    rows += [(c, t, "user", "same") for c in range(400, 480) for t in range(6)]  # equal conversations
    rows += [(501, 0, "user", "x"), (502, 0, "", ""), (505, 3, None, None), (None, 1, "user", "lost")]
    rows += rows[:5]  # repeated rows
    return rows


@pytest.mark.parametrize(("light", "heavy", "group"), [(1 << 12, 1 << 17, 1 << 16), (20, 1 << 17, 50), (1, 1 << 17, 1), (5, 10, 300)])
def test_prefix_trie(spark, monkeypatch, light, heavy, group):
    for name, value in (("LIGHT_ROWS", light), ("HEAVY_NODES", heavy), ("GROUP_ROWS", group), ("BLOCK_IDS", 7)):
        monkeypatch.setattr(prefix_trie, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    rows = conversations(np.random.default_rng(light))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("conv", "depth", "part", "d1", "h", "own"):
        table = table.withColumn(name, F.lit("clash"))
    try:
        out = prefix_trie.prefix_trie(table)
        found = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert out.columns == names
    assert tally(found) == tally(brute_trie(rows))


def test_prefix_trie_of_few_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    for rows in ([(7, 0, "a", "b")], [(200, None, None, None)], [(-150, 1, "u", "x"), (-100, 1, "u", "y")], [(None, 1, "u", "x")]):
        out = prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()
        if rows[0][0] != -150:  # a remainder takes the sign of its number in SQL
            assert tally(out) == tally(brute_trie(rows))


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in "ab")
    slots = prefix_trie.Slots(a, b)
    assert sorted(slots.find(a, b).tolist()) == list(range(5000))
    assert (slots.find(a, b + np.uint64(1)) == -1).all()


# -- base patterns of personal data ----------------------------------------------------------


def test_numbers_of_thousands_of_digits():
    for zeros in (3, 5000, 200_000):
        text = f"x {'0' * zeros}.1.1.1 y {'9' * zeros}.1.1.1"
        assert pii.base_spans(text)["ip"] == [(2, 2 + zeros + 6)]
