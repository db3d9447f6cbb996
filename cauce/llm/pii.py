"""Personal data by a character-level bidirectional LSTM with CRF transitions, in numpy.

Base rules (patterns with digit counts, ranges and the Luhn check) give the certain spans. The
tagger is trained to find what they miss: ``planted`` sets personal data in forms of its own (``ann (at)
mail.example.org``, ``10-0-0-255``, ``4111.1111.1111.1111``, ``0049/30/1234567``), and look-alikes
such as dates, times, amounts and item numbers, into stretches of a bounded sample of the corpus
(``TRAIN_DOCUMENTS`` texts of less than ``TRAIN_CHARS`` characters that hold a digit, an ``@`` or a
bracketed "at"). The planted spans and the base spans are its labels. Places of the corpus that could be such forms,
but that nothing labels, are left out; all else are negatives. It
reads windows around every such place; stretches without one carry no span, and every stretch with
one is covered. Long stretches are cut into overlapping windows, decoded by Viterbi, and reconciled over
the whole text: each character takes its tag from the window in which it lies furthest from an
edge, runs of one kind become spans, and spans that touch a base span give way to it.

Added spans must pass the checks of their kind (an address with its mark and a dot in it; four numbers up
to 255; 13 to 19 digits and Luhn; 9 to 15 digits; letters only in addresses) and have a mean tag
probability of at least ``MIN_SCORE``; one that fails its own but passes those of a card or ip is of that kind.

Defined results: null text counts as empty and has no spans; repeated rows are scanned each; an
empty table gives no row and trains nothing; where no text holds a place only the base
rules apply; other columns are ignored, or travel with ``redacted``, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import documents, plain

KINDS = ("email", "ip", "card", "phone")

# -- base rules ----------------------------------------------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT_OR_AT = re.compile(r"[0-9@]")
#: Where the tagger looks: also at ``(at)`` and the like. The same pattern serves Spark.
PLACES = r"[0-9@]|[\[({] ?[aA][tT] ?[\])}]"
PLACE = re.compile(PLACES)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` so that long runs of letters cost nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        before = text[last:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def _octet(digits: str) -> bool:
    """At most 255, with any number of leading zeros."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") < 256


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    if not DIGIT_OR_AT.search(text):
        return {k: [] for k in KINDS}
    out = {"email": emails(text)}
    out["ip"] = [m.span() for m in IP.finditer(text) if all(_octet(x) for x in m[0].split("."))]
    out["card"], out["phone"] = [], []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out["phone"].append(m.span())
    return out


# -- windows -------------------------------------------------------------------------------

WINDOW, STRIDE, MARGIN = 96, 64, 24
CHARS = 100  # ASCII from space on, one code each for line breaks, other white space, letters, the rest


def codes(text: str) -> np.ndarray:
    """Character codes for the tagger; 0 is padding."""
    raw = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    out = np.where((raw >= 32) & (raw < 127), raw - 31, 99)
    out[(raw == 10) | (raw == 13)] = 96
    out[raw == 9] = 97
    out[raw >= 160] = 98
    return out


def windows(text: str) -> list[int]:
    """Starts of the windows: every stretch around a place, cut with overlap."""
    starts: list[int] = []
    lo = hi = -1
    for m in PLACE.finditer(text):
        if hi >= 0 and m.start() - MARGIN <= hi:
            hi = m.start() + MARGIN
            continue
        if hi >= 0:
            starts += _cut(lo, hi)
        lo, hi = max(0, m.start() - MARGIN), m.start() + MARGIN
    if hi >= 0:
        starts += _cut(lo, hi)
    return starts


def _cut(lo: int, hi: int) -> list[int]:
    out = [lo]
    while out[-1] + WINDOW < hi:
        out.append(out[-1] + STRIDE)
    return out


# -- the tagger ----------------------------------------------------------------------------

HIDDEN, EMBED = 16, 12
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
STEPS, RATE, BATCH = 900, 0.02, 32
TRAIN_DOCUMENTS = 600
TRAIN_CHARS = 20_000
TRAIN_WINDOWS = 900
PLANTED = 3000
MIN_SCORE = 0.9


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer and CRF transitions."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        p = {"embed": rng.normal(0, 0.3, (CHARS, EMBED))}
        for d in "fb":
            p["w" + d] = rng.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
            p["b" + d] = np.zeros(4 * HIDDEN)
            p["b" + d][HIDDEN : 2 * HIDDEN] = 1  # the forget gate starts open
        p["out"] = rng.normal(0, 0.25, (2 * HIDDEN, TAGS))
        p["bias"] = np.zeros(TAGS)
        p["move"] = np.zeros((TAGS, TAGS))
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    # forward and backward passes work on (time, batch) so that each step is one product

    def _run(self, x: np.ndarray, d: str, keep: bool):
        steps, n, _ = x.shape
        w, b = self.p["w" + d], self.p["b" + d]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        given = x @ w[:EMBED] + b
        out, memory = np.empty((steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            z = given[t] + h @ w[EMBED:]
            g = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :]
            u = np.tanh(z[:, 3 * HIDDEN :])
            past, c = c, f * c + i * u
            tc = np.tanh(c)
            if keep:
                memory.append((h, past, i, f, o, u, tc))
            h = o * tc
            out[t] = h
        return out, memory

    def _back(self, x, grad, memory, d):
        w = self.p["w" + d]
        gw, gb, gx = np.zeros_like(w), np.zeros_like(self.p["b" + d]), np.empty_like(x)
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, past, i, f, o, u, tc = memory[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * u * i * (1 - i), dc * past * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], 1)
            gw[:EMBED] += x[t].T @ dz
            gw[EMBED:] += h.T @ dz
            gb += dz.sum(0)
            gx[t] = dz @ w[:EMBED].T
            dh, dc = dz @ w[EMBED:].T, dc * f
        return gw, gb, gx

    def scores(self, x: np.ndarray, keep: bool = False):
        """Tag scores (time, batch, TAGS) of codes (batch, time)."""
        e = self.p["embed"][x.T]
        hf, mf = self._run(e, "f", keep)
        hb, mb = self._run(e[::-1], "b", keep)
        h = np.concatenate([hf, hb[::-1]], 2)
        return h @ self.p["out"] + self.p["bias"], (e, h, mf, mb)

    def _marginals(self, s: np.ndarray):
        """Forward-backward: log partition, tag and transition probabilities summed as needed."""
        steps, n, _ = s.shape
        move = self.p["move"]
        fwd, bwd = np.empty_like(s), np.zeros_like(s)
        fwd[0] = s[0]
        for t in range(1, steps):
            a = fwd[t - 1][:, :, None] + move
            m = a.max(1)
            fwd[t] = s[t] + m + np.log(np.exp(a - m[:, None]).sum(1))
        for t in range(steps - 2, -1, -1):
            a = (bwd[t + 1] + s[t + 1])[:, None, :] + move
            m = a.max(2)
            bwd[t] = m + np.log(np.exp(a - m[:, :, None]).sum(2))
        top = fwd[-1].max(1)
        z = top + np.log(np.exp(fwd[-1] - top[:, None]).sum(1))
        return fwd, bwd, z

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        """Adam on the CRF's log-likelihood of codes and tags (batch, time)."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            some = rng.choice(len(x), BATCH, replace=len(x) < BATCH)
            rate = RATE * (1 - step / (STEPS + 1)) / (1 - 0.9**step)
            for k, g in self._gradient(x[some], y[some]).items():
                g = np.clip(g, -5, 5)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                self.p[k] -= (rate * mean[k] / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)

    def _gradient(self, x, y):
        s, (e, h, mf, mb) = self.scores(x, keep=True)
        fwd, bwd, z = self._marginals(s)
        n, tags = len(x), y.T
        ds = np.exp(fwd + bwd - z[:, None])  # tag probabilities
        move = np.zeros_like(self.p["move"])
        for t in range(1, len(s)):
            pair = fwd[t - 1][:, :, None] + self.p["move"] + (s[t] + bwd[t])[:, None, :] - z[:, None, None]
            move += np.exp(pair).sum(0)
            np.add.at(move, (tags[t - 1], tags[t]), -1)
        ds[np.arange(len(s))[:, None], np.arange(n)[None, :], tags] -= 1
        g = {"move": move / n, "out": np.einsum("tnh,tnk->hk", h, ds) / n, "bias": ds.sum((0, 1)) / n}
        dh = ds @ self.p["out"].T / n
        g["wf"], g["bf"], gx = self._back(e, dh[:, :, :HIDDEN], mf, "f")
        g["wb"], g["bb"], back = self._back(e[::-1], dh[::-1, :, HIDDEN:], mb, "b")
        g["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(g["embed"], x.T, gx + back[::-1])
        return g

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags by Viterbi (batch, time) and the probability of each."""
        s, _ = self.scores(x)
        steps, n, _ = s.shape
        best, back = s[0], np.empty((steps, n, TAGS), np.int64)
        for t in range(1, steps):
            a = best[:, :, None] + self.p["move"]
            back[t] = a.argmax(1)
            best = a.max(1) + s[t]
        out = np.empty((steps, n), np.int64)
        out[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = back[t][np.arange(n), out[t]]
        fwd, bwd, z = self._marginals(s)
        chance = np.exp(fwd + bwd - z[:, None])
        return out.T, chance[np.arange(steps)[:, None], np.arange(n)[None, :], out].T


def window_codes(text: str, starts: list[int]) -> np.ndarray:
    all_codes = np.zeros(len(text) + WINDOW, dtype=np.int64)
    all_codes[: len(text)] = codes(text)
    return all_codes[np.array(starts)[:, None] + np.arange(WINDOW)]


#: What could be personal data in a form of its own: nine digits, four numbers, a mark of an address.
MAYBE = re.compile(r"[0-9](?:[^A-Za-z0-9]{0,3}[0-9]){8,}|[0-9]{1,3}(?:[^A-Za-z0-9]{1,3}[0-9]{1,3}){3}|@|[\[({] ?[aA][tT] ?[\])}]")


def unlabelled(text: str) -> list[tuple[int, int]]:
    """Places that could be personal data but lie in no base span: no examples of either sort."""
    known = sorted(x for spans in base_spans(text).values() for x in spans)
    return [m.span() for m in MAYBE.finditer(text) if not any(a <= m.start() and m.end() <= b for a, b in known)]


def training_set(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags as the base rules label them, without those that hold unlabelled places."""
    xs, ys = [], []
    for text in texts:
        unsure = unlabelled(text)
        starts = [x for x in windows(text) if not any(a < x + WINDOW and b > x for a, b in unsure)]
        if not starts:
            continue
        tags = np.zeros(len(text) + WINDOW, dtype=np.int64)
        for k, kind in enumerate(KINDS):
            for a, b in base_spans(text)[kind]:
                tags[a:b] = 2 + 2 * k
                tags[a] = 1 + 2 * k
        xs.append(window_codes(text, starts))
        ys.append(tags[np.array(starts)[:, None] + np.arange(WINDOW)])
    if not xs:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.concatenate(xs)[:TRAIN_WINDOWS], np.concatenate(ys)[:TRAIN_WINDOWS]


# -- labels beyond the base rules ------------------------------------------------------------

_HOSTS = ("mail", "example", "post", "uni", "corp", "web", "home", "data")
_ENDS = ("com", "org", "net", "de", "fr", "es", "io", "co.uk")
_NAMES = ("ann", "bo", "carla", "d", "erik", "info", "jean", "kontakt", "lopez", "maria", "office", "q")


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def card_number(rng, n: int = 16) -> str:
    """Random digits with a check digit that passes Luhn."""
    head = str(rng.integers(1, 10)) + _digits(rng, n - 2)
    return next(head + str(d) for d in range(10) if luhn(head + str(d)))


def odd_email(rng) -> str:
    mark = rng.choice([" (at) ", "(at)", " [at] ", "[at]", " {at} ", " @ ", " (AT) ", "( at )"])
    dot = rng.choice([".", ".", " . ", " dot ", " [dot] ", "(dot)"])
    name = rng.choice(_NAMES) + rng.choice(["", ".", "_", "-"]) + rng.choice(_NAMES) + rng.choice(["", _digits(rng, 2)])
    host = rng.choice(_HOSTS) + rng.choice(["", _digits(rng, 1)])
    return name + mark + host + rng.choice(["", dot + rng.choice(_HOSTS)]) + dot + rng.choice(_ENDS)


def odd_ip(rng) -> str:
    return rng.choice(["-", "_", " . ", ". ", "[.]", ", ", ":"]).join(str(x) for x in rng.integers(0, 256, 4))


def odd_card(rng) -> str:
    number = card_number(rng, int(rng.choice([16, 16, 16, 15, 14, 19])))
    cuts = (0, 4, 10, 15) if len(number) == 15 else (*range(0, len(number), 4), len(number))
    parts = [number[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return rng.choice([".", "/", "_", "  ", " - ", ". ", ":"]).join(parts)


def odd_phone(rng) -> str:
    sep = rng.choice([" ", "-", "/", ".", " / "])
    parts = [_digits(rng, n) for n in [(3, 3, 4), (3, 7), (2, 3, 2, 2), (4, 6)][rng.integers(0, 4)]]
    head = rng.choice(["00" + str(rng.integers(1, 100)) + sep, "(0" + _digits(rng, 2) + ") ", "+" + str(rng.integers(1, 100)) + "/"])
    return head + sep.join(parts)


def look_alike(rng) -> str:
    """Numbers and addresses that are nobody's: dates, times, amounts, item numbers, versions, places."""
    year, month, day = rng.integers(1950, 2030), rng.integers(1, 13), rng.integers(1, 29)
    some = lambda n: _digits(rng, n)
    return str(
        rng.choice(
            [
                f"{year}-{month:02}-{day:02} {rng.integers(0, 24):02}:{rng.integers(0, 60):02}:{some(2)}",
                f"{day}.{month}.{year}", f"{day}/{month}/{year}", f"{year}{month:02}{day:02}{some(6)}",
                f"{rng.integers(1, 999)},{some(3)},{some(3)}.{some(2)}", f"{some(3)} {some(3)} {some(3)} EUR",
                f"978-{some(1)}-{some(2)}-{some(6)}-{some(1)}", f"id={some(12)}", f"#{some(9)}", f"no. {some(4)}-{some(4)}-{some(4)}",
                f"v{rng.integers(0, 20)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}", f"{some(4)}-{some(4)}", f"0.{some(12)}",
                f"{rng.integers(1, 99)}, {rng.integers(1, 99)}, {rng.integers(1, 99)} and {rng.integers(1, 99)}",
                f"{some(2)}:{some(2)}:{some(2)}.{some(3)}", f"see (at) page {some(2)}", f"pay @ {some(2)}.{some(2)} each",
            ]
        )
    )


ODD = (odd_email, odd_ip, odd_card, odd_phone)


def planted(text: str, rng) -> tuple[str, list[tuple[int, int, int]]]:
    """A stretch of the text with one odd form, look-alike or pair of them, and its spans (kind index, start, end)."""
    at = int(rng.integers(0, len(text) + 1))
    while at < len(text) and not text[at].isspace():
        at += 1
    left, right = text[max(0, at - 40) : at], text[at : at + 40]
    left, right = ("" if unlabelled(x) else x for x in (left, right))
    kind = int(rng.integers(0, len(KINDS) + 2))
    form = ODD[kind](rng) if kind < len(KINDS) else look_alike(rng)
    lead = left + " "
    # punctuation that follows a form is not part of it
    out = lead + form + rng.choice(["", "", ",", ".", ";", ")"]) + " " + right.lstrip()
    spans = [(kind, len(lead), len(lead) + len(form))] if kind < len(KINDS) else []
    for k, name in enumerate(KINDS):
        for a, b in base_spans(out)[name]:
            if kind >= len(KINDS) or b <= spans[0][1] or a >= spans[0][2]:
                spans.append((k, a, b))
    return out, spans


def planted_set(texts: list[str], count: int = PLANTED, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows around planted forms and their tags."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for k in range(count):
        text, spans = planted(texts[k % len(texts)], rng)
        tags = np.zeros(len(text) + WINDOW, dtype=np.int64)
        for kind, a, b in spans:
            tags[a:b] = 2 + 2 * kind
            tags[a] = 1 + 2 * kind
        starts = windows(text)[:1]
        if starts:
            xs.append(window_codes(text, starts))
            ys.append(tags[np.array(starts)[:, None] + np.arange(WINDOW)])
    if not xs:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.concatenate(xs), np.concatenate(ys)


def taught(texts: list[str]) -> Tagger | None:
    """A tagger for the texts of a sample: their windows under the base rules, and planted forms."""
    if not texts:
        return None
    parts = [training_set(texts), planted_set(texts)]
    x, y = (np.concatenate(p) for p in zip(*parts, strict=True))
    if not (y > 0).any():
        return None
    tagger = Tagger()
    tagger.train(x, y)
    return tagger


def fitted(docs: DataFrame) -> Tagger | None:
    """A tagger trained on at most ``TRAIN_DOCUMENTS`` rows, chosen by a hash of their text."""
    rows = plain(docs).where(F.col("text").rlike(PLACES) & (F.length("text") < TRAIN_CHARS))
    keyed = rows.select(F.xxhash64("text").alias("h"), "text")
    last = keyed.select("h").distinct().orderBy("h").limit(TRAIN_DOCUMENTS).agg(F.max("h")).first()[0]
    if last is None:
        return None
    picked = keyed.where(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text")).orderBy("h")
    return taught([r.text for r in picked.collect()])


ADDRESS = re.compile(
    r"[A-Za-z0-9._%+-]+ ?(?:@|[\[({] ?[aA][tT] ?[\])}]) ?[A-Za-z0-9-]+(?:(?:\.| \. | dot | ?[\[(]dot[\])] ?)[A-Za-z0-9-]+)+"
)
LETTER = re.compile(r"[^\W\d_]")


def added_spans(text: str, tagger: Tagger, starts: list[int], tags: np.ndarray, chance: np.ndarray):
    """Reconciles overlapping windows and returns spans (kind index, start, end) of one text."""
    n = len(text)
    tag, score, depth = np.zeros(n, np.int64), np.zeros(n), np.full(n, -1)
    inner = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    for start, own, p in zip(starts, tags, chance, strict=True):
        end = min(n, start + WINDOW)
        size = end - start
        place = inner[:size].copy()
        if start == 0:
            place = np.maximum(place, np.arange(WINDOW)[::-1][:size])
        better = place > depth[start:end]
        tag[start:end][better] = own[:size][better]
        score[start:end][better] = p[:size][better]
        depth[start:end][better] = place[better]
    out, at = [], 0
    marked = np.flatnonzero(tag)
    while at < len(marked):
        a = int(marked[at])
        kind = (tag[a] - 1) // 2
        b = a + 1
        while b < n and tag[b] and (tag[b] - 1) // 2 == kind and tag[b] % 2 == 0:
            b += 1
        at = int(np.searchsorted(marked, b))
        part = text[a:b]
        digits = "".join(c for c in part if "0" <= c <= "9")
        numbers = [int(x) for x in re.findall("[0-9]{1,9}", part)]
        right = (
            ADDRESS.fullmatch(part) is not None,
            len(numbers) == 4 and max(numbers) < 256,
            13 <= len(digits) <= 19 and luhn(digits),
            9 <= len(digits) <= 15,
        )
        # the checks of ip and card are strict enough to name the kind of a span that was found as another
        kind = next((k for k in (int(kind), 2, 1) if right[k] and (k == 0 or not LETTER.search(part))), None)
        if kind is not None and score[a:b].mean() >= MIN_SCORE:
            out.append((kind, a, b))
    return out


def find(texts: list[str], tagger: Tagger | None) -> list[tuple[dict, list[tuple[int, int, int]]]]:
    """Base spans by kind and all spans, sorted by kind and start, of each text."""
    base = [base_spans(t) for t in texts]
    more: list[list] = [[] for _ in texts]
    if tagger is not None:
        places = [windows(t) for t in texts]
        which = [i for i, p in enumerate(places) if p]
        held: list[int] = []
        size = 0
        for i in [*which, None]:
            if held and (i is None or size + len(places[i]) > 512):
                tags, chance = _decoded(tagger, np.concatenate([window_codes(texts[j], places[j]) for j in held]))
                at = 0
                for j in held:
                    k = at + len(places[j])
                    more[j] = added_spans(texts[j], tagger, places[j], tags[at:k], chance[at:k])
                    at = k
                held, size = [], 0
            if i is not None:
                held.append(i)
                size += len(places[i])
    out = []
    for spans, extra in zip(base, more, strict=True):
        every = [(k, a, b) for k, kind in enumerate(KINDS) for a, b in spans[kind]]
        taken = sorted((a, b) for _, a, b in every)
        ends = np.maximum.accumulate([b for _, b in taken]) if taken else []
        for k, a, b in extra:
            i = np.searchsorted([x for x, _ in taken], b)
            if i == 0 or ends[i - 1] <= a:
                every.append((k, a, b))
        out.append((spans, sorted(every)))
    return out


def _decoded(tagger: Tagger, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [tagger.decode(x[at : at + 512]) for at in range(0, len(x), 512)]
    return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def pii(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document (``FOUND``)."""
    tagger = fitted(docs)
    names = [x.split()[0] for x in FOUND.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches):
        for batch in batches:
            rows, ids, texts = [], batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), 256):
                found = find(texts[at : at + 256].to_pylist(), tagger)
                for doc, (base, every) in zip(ids[at : at + 256], found, strict=True):
                    own = [(k, a, b) for k, kind in enumerate(KINDS) for a, b in base[kind]]
                    digest = hashlib.sha256(_joined(own).encode()).hexdigest()
                    rows.append((doc, *(len(base[k]) for k in KINDS), digest, _joined(every)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return plain(docs).mapInArrow(run, FOUND)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets (overlapping ones as one)."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += (text[at:a], f"[{KINDS[k]}]")
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns, the spans in ``text`` replaced and ``n_chars``, if there, counted anew."""
    tagger = fitted(docs)
    schema = docs.schema
    counted = next((f.name for f in schema if f.name.lower() == "n_chars"), None)

    def run(batches):
        for batch in batches:
            texts, out = batch.column("text"), []
            for at in range(0, len(texts), 256):
                some = texts[at : at + 256].to_pylist()
                for t, (_, spans) in zip(some, find([t or "" for t in some], tagger), strict=True):
                    out.append(redact(t, spans) if spans else t)
            place = batch.schema.get_field_index("text")
            new = batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))
            if counted:
                place = batch.schema.get_field_index(counted)
                old = batch.column(place).to_pylist()
                sizes = [o if a == b else len(b) for o, a, b in zip(old, texts.to_pylist(), out, strict=True)]
                new = new.set_column(place, batch.schema.field(place), pa.array(sizes, batch.schema.field(place).type))
            yield new

    return docs.mapInArrow(run, schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(documents(spark, sf_dir))
