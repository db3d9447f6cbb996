"""URL allow and block rules by a sort-merge range join.

A host is keyed by its labels in reverse, each followed by a dot (``www.example.org`` becomes
``org.example.www.``), so the hosts a rule fits, its own and all subdomains, are exactly the keys
that begin with its key: an interval. Intervals of two rules nest or are apart. Urls and rules are
range-partitioned by key and sorted; each partition sweeps once over both with a stack of the
host rules that are open at the current key. Every open host holds its path prefixes; a url takes
the longest rule (host and path together; of equal ones that with the longer host) among the open
hosts whose path its own begins with.

Range bounds come from the quantiles of a bounded sample of keys; they decide only who sweeps
what. The bounds cut by (key, path, page id), so the rows of a hot host are spread over many
partitions; a rule goes to each partition that its interval meets. A partition needs the open
hosts (nested, so one for each label at most) and their path prefixes in memory, nothing else.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule and takes
``default``; empty path rules fit all urls of the host; repeated rows are judged each; of rules
given twice with one host and path, block wins; rules with a null host, path or verdict are
refused; an empty table gives no row; other columns are ignored whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import ascii_lower, importable, partitions

SAMPLE_ROWS = 20_000

#: The production list: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def parts(url) -> tuple:
    """Host and path columns of a url column."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(url, whole, 1)), F.regexp_extract(url, whole, 2)


def host_key(host):
    """Labels in reverse order, each with a dot after it; empty for no host."""
    reverse = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(reverse)


def _bounds(rows: DataFrame, n: int) -> list[tuple[str, str, int]]:
    """Up to ``n - 1`` places (key, path, page id) that cut the rows into like shares."""
    total = rows.count()
    if total <= n:
        return []
    share = min(1.0, 2 * SAMPLE_ROWS / total)
    # pages are picked by a hash of their id and url, the same ones on every attempt
    picked = rows.where(F.pmod(F.xxhash64("page_id", "host_key", "path"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    some = picked.select("host_key", "path", F.coalesce("page_id", F.lit(-1 << 63)).alias("id")).limit(4 * SAMPLE_ROWS)
    # compared as Spark sorts text: by UTF-8 bytes
    places = sorted((r.host_key.encode(), r.path.encode(), r.id) for r in some.collect())
    if not places:
        return []
    cuts = sorted({places[len(places) * i // n] for i in range(1, n)})
    return [(a.decode(), b.decode(), i) for a, b, i in cuts]


def _dealt(rows: DataFrame, bounds: list[tuple[str, str, int]]) -> DataFrame:
    """The range of each page."""
    edges = [(a.encode(), b.encode(), i) for a, b, i in bounds]

    def run(batches):
        from bisect import bisect_right

        for batch in batches:
            keys, paths = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("host_key", "path"))
            ids = [-1 << 63 if i is None else i for i in batch.column("page_id").to_pylist()]
            place = [bisect_right(edges, x) for x in zip(keys, paths, ids, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int32())], [*batch.schema.names, "range"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, range int")


def _rules_by_range(rules: DataFrame, bounds: list[tuple[str, str, int]]) -> DataFrame:
    """A copy of each rule for every range that its interval of keys meets."""
    edges = [a.encode() for a, _, _ in bounds]
    columns = ["host_key", "path", "verdict", "range"]

    def run(batches):
        from bisect import bisect_left, bisect_right

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                low = r["host_key"].encode()
                high = low[:-1] + bytes([low[-1] + 1])  # the first key past all that begin so
                for place in range(bisect_left(edges, low), bisect_right(edges, high) + 1):
                    out.append((r["host_key"], r["path"], r["verdict"], place))
            types = [pa.string()] * 3 + [pa.int32()]
            cols = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], columns)

    return rules.mapInArrow(run, "host_key string, path string, verdict string, range int")


class Sweep:
    """The open host rules at the current key."""

    def __init__(self):
        self.open: list[tuple[str, dict[str, str], list[int]]] = []  # key, verdict by path, path lengths

    def close(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, key: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, {}, []))
        _, by_path, lengths = self.open[-1]
        if by_path.get(path) != "block":
            by_path[path] = verdict
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def match(self, key: str, path: str) -> tuple[str, str, str] | None:
        """Host key, path and verdict of the longest rule."""
        self.close(key)
        best = None
        for own, by_path, lengths in self.open:  # from the shortest host to the longest
            for n in lengths:
                if n <= len(path) and (prefix := path[:n]) in by_path:
                    if best is None or len(own) + n >= len(best[0]) + len(best[1]):
                        best = (own, prefix, by_path[prefix])
                    break
        return best


JUDGED = "page_id long, host string, path string, rule string, verdict string"


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every url of ``pages`` (page_id, url) with the longest rule of ``rules`` (verdict, host,
    path) that fits it, or null and ``default``."""
    spark = pages.sparkSession
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("host_key", host_key(F.col("host")))
    n = partitions(spark)
    bounds = _bounds(rows, n)
    ruled = rules.select(
        host_key(ascii_lower(F.col("host"))).alias("host_key"),
        F.col("path").cast("string").alias("path"),
        F.col("verdict").cast("string").alias("verdict"),
    )
    if ruled.where("host_key IS NULL OR host_key = '' OR path IS NULL OR verdict IS NULL").limit(1).count():
        raise ValueError("every rule needs a host, a path and a verdict")
    both = _dealt(rows, bounds).select(
        "range", "host_key", F.lit(1).alias("kind"), "path", "page_id", "host", F.lit(None).cast("string").alias("verdict")
    ).unionByName(
        _rules_by_range(ruled, bounds).select(
            "range", "host_key", F.lit(0).alias("kind"), "path", F.lit(None).cast("long").alias("page_id"),
            F.lit(None).cast("string").alias("host"), "verdict",
        )
    )
    swept = both.repartition(max(n, len(bounds) + 1), "range").sortWithinPartitions("range", "host_key", "kind")
    names = [x.split()[0] for x in JUDGED.split(", ")]
    types = [pa.int64()] + [pa.string()] * 4

    def run(batches):
        at, sweep = None, Sweep()
        for batch in batches:
            out = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("range", "host_key", "kind", "path", "page_id", "host", "verdict")), strict=True):
                place, key, kind, url_path, page, own, verdict = r
                if place != at:
                    at, sweep = place, Sweep()
                if kind == 0:
                    sweep.add(key, url_path, verdict)
                    continue
                best = sweep.match(key, url_path)
                rule = ".".join(reversed(best[0][:-1].split("."))) + best[1] if best else None
                out.append((page, own, url_path, rule, best[2] if best else default))
            cols = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

    return swept.mapInArrow(run, JUDGED)


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judged(pages, spark.createDataFrame(list(RULES), "verdict string, host string, path string"))


OP3_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT page_id, host, path, r.h || r.p AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.h || r.p) DESC, length(r.h) DESC) AS k
  FROM p JOIN rules r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN fits f ON f.k = 1 AND f.page_id = p.page_id AND f.host = p.host AND f.path = p.path
"""
