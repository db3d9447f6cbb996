"""License scans by an exact set-similarity join, in DataFrame operations only.

Blocks are the lines of a text up to twice the longest template's words and, for longer lines and
notices that are wrapped over lines, windows of that many words that overlap by half, so that any
stretch of that template's length lies in one of them whole. No block is longer, so words scattered over a
long line don't make a notice. Blocks are taken as sets of words (ASCII lower-cased runs of letters, digits
and characters beyond ASCII). Windows are formed only in texts that hold enough words of some
template as a whole; no other text can have a matching window. A block matches a template if it holds at least ``THRESHOLD`` of the
template's distinct words. The join is exact:

* the words of all templates are ordered by their number of blocks in the whole corpus, rarest
  first; other words cannot take part in a match, so blocks keep only template words;
* prefix filter: a block that holds enough of a template of ``m`` words holds one of its first
  ``m - need + 1`` in that order, so only these words are joined on;
* length filter: a block keeps at least ``need`` template words, or it is dropped;
* positional filter: from the first common word on, both sides must have enough words left;
* what remains is verified by the size of the intersection.

Besides templates there are base phrases: words that stand one after another. Template words are a
parameter, so their table, their counts and their order are small whatever the corpus; blocks
never meet each other, and no block or word is a group that one task would have to hold.

Defined results: null text counts as empty (no words, no labels, score 0); repeated rows are
scanned each; a word in a block counts once; an empty table gives no row; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import ascii_lower, documents, plain, written

THRESHOLD = 0.8

#: Words that stand one after another, and their label.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Usual wordings of license notices, and their label.
TEMPLATES = (
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("You can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("under the terms of the GNU Lesser General Public License", "lgpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
)

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing


def lowered(text: Column) -> Column:
    """A-Z lower-cased; ``lower`` is faster and differs for ASCII results only where a text has
    one of the two characters whose lower case begins with an ASCII letter."""
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, ascii_lower(text)).otherwise(F.lower(text))


def words_of(text: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[0-9A-Za-z]+", text)]


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _places(words: Column, phrase: list[str], label: str) -> Column:
    """label and start of every place where the phrase stands."""
    last = F.size(words) - len(phrase)
    here = lambda i: F.reduce(
        F.array(*[F.get(words, i + k) == F.lit(w) for k, w in enumerate(phrase)]), F.lit(True), lambda a, b: a & b
    )
    starts = F.filter(F.sequence(F.lit(0), last), here)
    found = F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("at")))
    return F.when(last >= 0, found).otherwise(F.array().cast("array<struct<label:string,at:bigint>>"))


def measured(docs: DataFrame, phrases, sets: list[tuple[list[str], int]], longest: int) -> DataFrame:
    """One row per document: words, places of the phrases, and its blocks' template words. ``sets``:
    each template's words and how many of them a block needs; ``longest``: words of the longest."""
    vocabulary = sorted({w for own, _ in sets for w in own})
    text = lowered(F.col("text"))
    lines = F.regexp_replace(text, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    rows = plain(docs).select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        lines.alias("lines"),
    )
    empty = F.array().cast("array<struct<label:string,at:bigint>>")
    any_phrase = "|".join("[ \\n]+".join(map(re.escape, p.split())) for p, _ in phrases)
    words = F.split(F.trim(F.regexp_replace("lines", r"[ \n]+", " ")), " ")
    places = F.flatten(F.array(*[_places(F.col("words"), p.split(), label) for p, label in phrases]))
    hit = F.col("lines").rlike(any_phrase)
    most = 2 * longest + 2  # a line's outer blanks count as two words at most
    blocks = F.transform(
        F.transform(F.split("lines", "\n"), lambda x: F.split(x, " ")),
        lambda x: F.struct(F.array_intersect(x, _literal(vocabulary)).alias("own"), (F.size(x) <= most).alias("short")),
    )
    held = F.array_distinct(F.flatten("blocks.own"))
    whole = F.transform(F.filter("blocks", lambda b: b["short"] & (F.size(b["own"]) > 0)), lambda b: b["own"])
    may = F.lit(False)
    for own, need in sets:
        may = may | (F.size(F.array_intersect("held", _literal(own))) >= need)
    starts = F.sequence(F.lit(0), F.greatest(F.size("all_words") - longest - 1, F.lit(0)), F.lit(longest))
    windows = F.transform(
        starts, lambda i: F.array_intersect(F.slice("all_words", i + 1, F.lit(2 * longest)), _literal(vocabulary))
    )
    none = F.array().cast("array<array<string>>")
    # the words of a text are split again only where a phrase occurs, or a notice may be wrapped or in a long line
    return (
        rows.withColumn("words", F.when(hit, words))
        .withColumn("places", F.when(F.col("words").isNull(), empty).otherwise(places))
        .withColumn("blocks", blocks)
        .withColumn("held", held)
        .withColumn("all_words", F.when(may & (F.col("lines").contains("\n") | (F.col("n_words") > 2 * longest)), words))
        .withColumn("windows", F.when(F.col("all_words").isNull(), none).otherwise(windows))
        .select("uid", "doc_id", "n_words", "places", F.concat(whole, F.filter("windows", lambda b: F.size(b) > 0)).alias("blocks"))
    )


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score (the largest
    share of a matched template's words in a block; 1 for a base phrase; 0 for none)."""
    sets = [(sorted(set(words_of(t))), label) for t, label in templates]
    needs = [(words, math.ceil(threshold * len(words) - 1e-9)) for words, _ in sets]
    longest = max(len(words_of(t)) for t, _ in templates)
    rows = written(measured(docs, phrases, needs, longest), "license-rows")
    blocks = rows.select("uid", F.posexplode("blocks").alias("block", "words"))
    counts = {  # one row per template word
        r.word: r.n for r in blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    }
    order = sorted({w for s, _ in sets for w in s}, key=lambda w: (counts.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    index = []
    for k, (words, label) in enumerate(sets):
        ranked = sorted(words, key=place.__getitem__)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        for i, w in enumerate(ranked[: len(ranked) - need + 1]):
            index.append((w, k, i, ranked, need, label))
    spark = docs.sparkSession
    entries = [
        F.struct(
            F.lit(w).alias("word"), F.lit(k).alias("template"), F.lit(i).alias("i"), _literal(ranked).alias("own"),
            F.lit(need).alias("need"), F.lit(label).alias("label"),
        )
        for w, k, i, ranked, need, label in index
    ]
    table = spark.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    least = min(n[4] for n in index)
    # a block's words in the global order, then the prefix words among them
    ranked_blocks = blocks.where(F.size("words") >= least).withColumn("words", F.array_intersect(_literal(order), F.col("words")))
    prefix = _literal(sorted({n[0] for n in index}))
    probes = ranked_blocks.withColumn("word", F.explode(F.array_intersect(F.col("words"), prefix)))
    met = probes.withColumn("j", F.array_position("words", F.col("word")) - 1).join(F.broadcast(table), "word")  # one row for each template prefix word
    met = met.where(F.size("words") >= F.col("need"))
    first = met.groupBy("uid", "block", "template").agg(
        F.min("i").alias("i"), F.min("j").alias("j"), *[F.first(c).alias(c) for c in ("words", "own", "need", "label")]
    )
    rest = 1 + F.least(F.size("own") - F.col("i") - 1, F.size("words") - F.col("j") - 1)
    shared = F.size(F.array_intersect("words", "own"))
    matches = first.where(rest >= F.col("need")).withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    by_doc = matches.groupBy("uid").agg(
        F.collect_set("label").alias("found"), F.max(F.col("shared") / F.size("own")).alias("best")  # a few labels
    )
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    starts = F.transform("places", lambda p: p["at"])
    every = F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>"))))
    return rows.join(by_doc, "uid", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w + "'" for w in words) + "]"


def _sql(templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for the rows of ``scan``: every block of every text is compared with every template."""
    longest = max(len(words_of(t)) for t, _ in templates)
    own = [sorted(set(words_of(t))) for t, _ in templates]
    rules = ", ".join(
        f"({k}, '{label}', {_sql_list(words)}, {math.ceil(threshold * len(words) - 1e-9)})"
        for k, (words, (_, label)) in enumerate(zip(own, templates))
    )
    base = ", ".join(f"('{label}', {_sql_list(p.split())})" for p, label in phrases)
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS uid, CAST(doc_id AS BIGINT) AS doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
d AS (SELECT uid, doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs),
phrases(label, p) AS (VALUES {base}),
places AS (
    SELECT uid, label, i
    FROM (SELECT uid, label, w, p, unnest(range(0, greatest(len(w) - len(p) + 1, 0))) AS i FROM d, phrases)
    WHERE w[i + 1 : i + len(p)] = p),
lines AS (
    SELECT uid, string_split(line, ' ') AS b
    FROM (SELECT uid, unnest(string_split(
              regexp_replace(t, '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), chr(10))) AS line FROM d)),
blocks AS (
    SELECT uid, list_distinct(b) AS b FROM lines WHERE len(b) <= {2 * longest + 2}
    UNION ALL
    SELECT uid, list_distinct(w[i + 1 : i + {2 * longest}]) AS b
    FROM (SELECT uid, w, unnest(range(0, greatest(len(w) - {longest} - 1, 0) + 1, {longest})) AS i
          FROM d WHERE contains(t, chr(10)) OR len(w) > {2 * longest})),
templates(k, label, own, need) AS (VALUES {rules}),
matches AS (
    SELECT uid, label, shared / len(own) AS share
    FROM (SELECT uid, label, own, need, len(list_intersect(b, own)) AS shared FROM blocks, templates)
    WHERE shared >= need),
base AS (
    SELECT uid, count(*) AS n, min(i) AS first_word, max(i) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM places GROUP BY uid),
every AS (
    SELECT uid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT uid, label FROM places UNION SELECT uid, label FROM matches) GROUP BY uid),
best AS (SELECT uid, max(share) AS share FROM matches GROUP BY uid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(base.n, 0) AS n_base, base.first_word, base.last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (uid) LEFT JOIN every USING (uid) LEFT JOIN best USING (uid)
"""


OP8_SQL = _sql()
