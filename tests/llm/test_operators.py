"""Each operator against a brute-force version on rows with nulls, ties, repeats and long texts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from cauce.llm import bpe, exact_dedup, licenses, packing, pii, quality, simhash, substrings, token_files, url_rules
from cauce.llm.tokens import encoder, tokenizer_path
from cauce.session import scratch_dir

WORD_BPE, BYTE_BPE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
SPACE_WORDS = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def low(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def tally(rows):
    return Counter(map(tuple, rows))


# -- tokens, packing, token files ------------------------------------------------------------

TRICKY = [
    "it's don't we'RE the,. A.,b $$$x 12 İstanbul ΣΑΣ a\x1cb é é ́", "<|endoftext|>, X<|ENDOFTEXT|> foo<|startoftext|>bar ",
    "", " \n\t", "J̌ K \x85 　", "abc!? !!a 's 't", "a" * 400,
]


@pytest.mark.parametrize("text", TRICKY)
def test_chunk_ids_are_whole_text_ids(text):
    ids = np.frombuffer(encoder(WORD_BPE).encode([text.encode()])[0], "<u2").tolist()
    assert ids == library(WORD_BPE).encode(text, add_special_tokens=False).ids


def test_packing_holds_every_id_once(odd, odd_rows):
    t = library(WORD_BPE)
    rows = packing.pack(odd, length=512).collect()
    by_sequence, found = defaultdict(list), Counter()
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        found[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    sizes = []
    for s in sorted(by_sequence):
        at = 0
        for r in sorted(by_sequence[s], key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        sizes.append(at)
    assert all(n == 512 for n in sizes[:-1]) and 0 < sizes[-1] <= 512
    total = 0
    for doc, text, *_ in odd_rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        at = 0
        while at < len(ids):  # some chain of pieces of this document, each used once
            piece = next(k for k, n in found.items() if n and k[0] == doc and k[1] == at and k[4] == len(ids) and k[3] == crc(ids[at : at + k[2]]))
            found[piece] -= 1
            at += piece[2]
    assert not +found and total == sum(sizes)


def test_windows_hold_the_target_mixture():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 100_000, 40)
    weights = rng.random(40) + 0.01
    weights *= sizes.sum() / weights.sum()
    totals = np.arange(0, sizes.sum() + 4096, 4096)
    taken = packing.served(weights, sizes, totals)
    assert (taken.sum(1) == np.minimum(totals, sizes.sum())).all()
    assert (np.diff(taken, axis=0) >= 0).all() and (taken <= sizes).all()
    lasting = (taken < sizes).all(1)  # while all queues last, each is within a token of its share
    share = totals[lasting, None] * weights / weights.sum()
    assert np.abs(taken[lasting] - share).max() < 1.5


def test_weights_must_be_positive(odd):
    with pytest.raises(ValueError, match="weight"):
        packing.pack(odd, weights={"s0": 1.0}).count()


@pytest.mark.parametrize("bits", [1, 2])
def test_codes_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ranks = (2 ** (rng.random(n) * (16 if bits == 1 else 31))).astype(np.uint32) - 1
        control, data = token_files.pack_codes(ranks, bits)
        assert (token_files.unpack_codes(control, data, n, bits) == ranks).all()
    raw = token_files.write_block([None, 5], np.array([2, 1]), np.array([1, 300, 2]), bits)
    ids, counts, ranks = token_files.read_block(raw)
    assert (ids, counts.tolist(), ranks.tolist()) == ([None, 5], [2, 1], [1, 300, 2])
    with pytest.raises(OSError):
        token_files.read_block(raw[:-1] + bytes([raw[-1] ^ 1]))


def test_token_files_read_back(spark, odd, odd_rows):
    t = library(WORD_BPE)
    folder = "file://" + scratch_dir(spark, "t").removeprefix("file://").removeprefix("file:")
    rows = token_files.read_tokens(token_files.write_tokens(odd, folder), folder).collect()
    want = tally((d, len(i), tuple(i)) for d, i in ((r[0], t.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in odd_rows))
    assert tally((r.doc_id, r.n_tokens, tuple(r.ids)) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


# -- BPE -------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", [*TRICKY, "日本語 '’s'S 12345 ½x q", "\x00\x1c\x85​", "   a  \n\n b"])
def test_bpe_is_the_librarys(text):
    own, t = bpe.coder(BYTE_BPE), library(BYTE_BPE)
    ids = t.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip(odd, odd_rows):
    t = library(BYTE_BPE)
    want = []
    for doc, text, *_ in odd_rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert tally(bpe.round_trip(odd).collect()) == tally(want)
    back = bpe.decoded(bpe.encoded(odd)).collect()
    assert tally(back) == tally((r[0], r[1] or "") for r in odd_rows)


# -- dedup -----------------------------------------------------------------------------------


def test_exact_dedup(odd, odd_rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in odd_rows]
    groups = defaultdict(list)
    for r, t in zip(odd_rows, norm, strict=True):
        groups[t].append(r[0])
    rows = exact_dedup.exact_dedup(odd).collect()
    least = {t: min((x for x in ids if x is not None), default=None) for t, ids in groups.items()}
    want = tally((r[0], least[t], len(groups[t]), sha(t)) for r, t in zip(odd_rows, norm, strict=True))
    assert tally((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    out = exact_dedup.distinct_documents(odd)
    assert out.columns == odd.columns and out.count() == len(groups)


def brute_fingerprint(text):
    words = re.findall(SPACE_WORDS, low(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Least index reachable over links of at most two bits."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash(odd, odd_rows):
    fps = [brute_fingerprint(r[1]) for r in odd_rows]
    roots = brute_components(fps)
    least = {}
    for r, c in zip(odd_rows, roots, strict=True):
        known = least.get(c)
        least[c] = r[0] if known is None else known if r[0] is None else min(known, r[0])
    want = tally((r[0], f"{f:016x}", least[c]) for r, f, c in zip(odd_rows, fps, roots, strict=True))
    assert tally(simhash.simhash(odd).collect()) == want
    out = simhash.distinct_documents(odd)
    assert out.columns == odd.columns and out.count() == len(set(roots))


def test_golay_code_is_perfect_and_keys_meet():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 2000)
    index = simhash.decode(words)
    near = simhash.nearby(words)
    assert ((near >= 0).sum(1) <= 7).all() and (near == index[:, None]).any(1).all()
    code = (index << 11) | simhash.PARITY[index]
    assert (np.bitwise_count(code ^ words) <= 3).all()
    flipped = words ^ (1 << rng.integers(0, 23, 2000))
    assert (near == simhash.decode(flipped)[:, None]).any(1).all()


@pytest.mark.parametrize("limit", [1024, 0])
def test_links_join_all_near_fingerprints(spark, monkeypatch, limit):
    """Both ways, pairs and shared words one bit away, give the components of all pairs."""
    monkeypatch.setattr(simhash, "MAX_PAIRS", limit)
    rng = np.random.default_rng(8)
    seeds = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    fps = {0, (1 << 64) - 1}
    for s in seeds:
        for _ in range(12):
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                s ^= 1 << int(b)
            fps.add(s)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(nodes)).collect()}
    mine = defaultdict(set)
    for x in signed:
        mine[found.get(x, x)].add(x)
    want = defaultdict(set)
    for x, c in zip(signed, brute_components(fps), strict=True):
        want[c].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def brute_removal(rows):
    first = {}
    texts = [(substrings.LAST_ID if d is None else d, (t or "").encode()) for d, t, *_ in rows]
    for d, t in texts:
        for p in range(len(t) - 49):
            s = t[p : p + 50]
            first[s] = min(d, first.get(s, d))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < d:
                gone[p : p + 50] = True
        kept = np.frombuffer(t, np.uint8)[~gone[:-1]].tobytes()
        out.append((None if d == substrings.LAST_ID else d, len(t), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), kept))
    return out


@pytest.mark.parametrize("stretch", [4 << 20, 900])
def test_substrings(odd, odd_rows, monkeypatch, stretch):
    monkeypatch.setattr(substrings, "STRETCH", stretch)
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.remove_repeats(odd).collect()]
    assert tally(rows) == tally(brute_removal(odd_rows))


def test_suffix_order():
    rng = np.random.default_rng(1)
    for top in (98, 100, 256):
        base = rng.integers(97 if top < 256 else 0, top, 400).astype(np.uint8).tobytes()
        raw = base + base[40:200] + bytes(50)
        starts = rng.permutation(len(raw) - 50)[:400]
        order, group = substrings.sort_suffixes(np.frombuffer(raw, np.uint8), starts)
        keys = [raw[s : s + 50] for s in starts[order]]
        assert keys == sorted(keys)
        assert all((a == b) == (g == h) for a, b, g, h in zip(keys, keys[1:], group, group[1:], strict=False))


# -- URL rules -------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme/org", "http://", "http://ORG/", "https://www.Example.ORG/es/x?y://z", "http://example.org/en/12#f",
    "http://xexample.org/es/", "http://com/de/", "http://a.com/fr/b", "http://a.b.com?x=/de/", "ftp://example.org.:80/es/",
    "http://u@example.org/es/\nz", "a://b://org/", "http://a..com/de/", "http://example.org/es/",
]


def test_url_rules(spark):
    from cauce.llm.url_rules import RULES, judged

    rules = [*RULES, ("block", "b.com", ""), ("allow", "www.example.org", "/es"), ("block", "org", "/longer/path/than/others")]
    pages = [(i, u) for i, u in enumerate(URLS * 40)] + [(None, URLS[5])] * 3
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "1 AS range", "'x' AS verdict")
    want = []
    for i, u in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (low(m[1]), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1])), default=None)
        want.append((i, host, path, best[1] + best[2] if best else None, best[0] if best else "allow"))
    out = judged(df, spark.createDataFrame(rules, "verdict string, host string, path string"))
    assert tally(out.collect()) == tally(want)
    with pytest.raises(ValueError):
        judged(df, spark.createDataFrame([("block", None, "/")], "verdict string, host string, path string"))


def test_url_query_against_its_sql(spark):
    import duckdb

    from .conftest import SF

    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    assert tally(url_rules.op3_url_rules(spark, SF).collect()) == tally(con.sql(url_rules.OP3_SQL).fetchall())


# -- PII -------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")))
                or (kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)))
                or (kind == "phone" and not 9 <= len(digits) <= 15)
            ):
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_are_leftmost_matches():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        text = "".join(rng.choice(list("aZ.@+-12 05()é_"), rng.integers(0, 60)))
        found = pii.base_spans(text)
        assert [(k, a, b) for k in pii.KINDS for a, b in found[k]] == brute_spans(text), text


def test_pii_keeps_base_spans(odd, odd_rows):
    rows = pii.pii(odd).collect()
    want = []
    for d, t, *_ in odd_rows:
        spans = brute_spans(t or "")
        counts = Counter(k for k, _, _ in spans)
        want.append((d, *(counts[k] for k in pii.KINDS), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    assert tally(tuple(r)[:6] for r in rows) == tally(want)
    text = next(r[1] for r in odd_rows if r[0] == 108)
    own = next(r for r in rows if r.doc_id == 108)
    assert {f"{k}:{a}:{b}" for k, a, b in brute_spans(text)} <= set(own.spans.split(","))
    out = pii.redacted(odd)
    clean = next(r for r in out.collect() if r.doc_id == 108)
    assert out.columns == odd.columns and out.count() == len(odd_rows)
    assert clean.text == "mail [email] or [phone], card [card], ip [ip]" and clean.n_chars == len(clean.text)


def test_tagger_gradient_and_held_out_accuracy():
    rng = np.random.default_rng(4)
    words = "the of den para ligne 2020 v3 id=77 token".split()

    def text():
        out = list(rng.choice(words, 25))
        out[5] = f"{rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)}"
        out[15] = f"{rng.choice(['ann', 'bo', 'cy'])}.{rng.integers(9, 99)}@mail{rng.integers(9)}.example.com"
        return " ".join(out)

    x, y = pii.training_set([text() for _ in range(150)])
    tagger = pii.Tagger()
    tagger.train(x, y)
    hit = total = 0
    for t in (text() for _ in range(40)):
        starts = pii.windows(t)
        tags, chance = tagger.decode(pii.window_codes(t, starts))
        found = {(pii.KINDS[k], a, b) for k, a, b in pii.added_spans(t, tagger, starts, tags, chance)}
        want = {(k, a, b) for k, a, b in brute_spans(t)}
        hit, total = hit + len(found & want), total + len(want)
    assert hit >= 0.9 * total


# -- licenses --------------------------------------------------------------------------------


def test_licenses(spark, odd, odd_rows):
    extra = [(200, "CC by cc\n by ALL rights, reserved \u212ac İcc by ", "en", "x", 3), (201, "cc bys xcc by", None, None, None)]
    rows = [*odd_rows, *extra]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    want = []
    for d, t, *_ in rows:
        t = low(t or "")
        w, places = re.findall(word, t), []
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        found, best = set(), 0.0
        for line in t.split("\n"):
            block = set(re.findall(word, line))
            for template, label in licenses.TEMPLATES:
                own = set(licenses.words_of(template))
                share = len(own & block) / len(own)
                if share >= licenses.THRESHOLD - 1e-9:
                    found.add(label)
                    best = max(best, share)
        base = {label for _, label in places}
        ends = (min(places)[0], max(places)[0]) if places else (None, None)
        want.append((d, len(w), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if places else best))
    assert tally(licenses.scan(df).collect()) == tally(want)


def test_license_plan_has_no_python(odd, capsys):
    licenses.scan(odd).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


# -- quality ---------------------------------------------------------------------------------


def test_quality_measures(odd, odd_rows):
    want = []
    for d, t, *_ in odd_rows:
        t = t or ""
        w = re.findall(SPACE_WORDS, t)
        triples, cover, seen, dup = Counter(zip(w, w[1:], w[2:], strict=False)), set(), set(), 0
        for i in range(len(w) - 2):
            if triples[tuple(w[i : i + 3])] > 1:
                cover |= {i, i + 1, i + 2}
        for line in t.split("\n"):
            if re.search(SPACE_WORDS, line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), failed))
    rows = quality.quality(odd).collect()
    assert tally(tuple(r)[:7] for r in rows) == tally(want)
    assert all(not r.kept for r in rows if r.base_failed)
    out = quality.kept_documents(odd)
    assert out.columns == odd.columns and out.count() == sum(r.kept for r in rows)


def test_references_count_all_documents(odd, odd_rows):
    refs = quality.references(odd)
    for key, lang in (("=en", "en"), ("null", None)):
        words = Counter(w for r in odd_rows if r[2] == lang for w in (r[1] or "").encode().lower().split())
        total = sum(words.values())
        classes, common, counts = refs[key]
        assert {w: int(counts[i]) for w, i in common.items()} == {w: n for w, n in words.items() if n >= quality.SHARE * total}
        assert counts.sum() == total
        assert classes.sum() == sum(len(r[1] or "") for r in odd_rows if r[2] == lang)


def test_quality_verdicts_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = quality.op9_quality(spark, sf).where("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) == len(clean)
    assert sum(not r.kept for r in junk) >= 0.8 * len(junk)


def test_js_distance():
    assert quality.js_distance(np.array([1, 0]), np.array([0, 5])) == pytest.approx(1.0)
    assert quality.js_distance(np.array([2, 2]), np.array([5, 5])) == pytest.approx(0.0)


# -- empty tables ----------------------------------------------------------------------------


def test_empty_tables(spark, none):
    folder = "file://" + scratch_dir(spark, "e").removeprefix("file://").removeprefix("file:")
    for out in (
        packing.pack(none), exact_dedup.exact_dedup(none), exact_dedup.distinct_documents(none), bpe.round_trip(none),
        token_files.read_tokens(token_files.write_tokens(none, folder), folder), simhash.simhash(none),
        simhash.distinct_documents(none), pii.pii(none), pii.redacted(none), licenses.scan(none), quality.quality(none),
        quality.kept_documents(none), substrings.remove_repeats(none),
    ):
        assert out.count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(list(url_rules.RULES), "verdict string, host string, path string")
    assert url_rules.judged(pages, rules).count() == 0
