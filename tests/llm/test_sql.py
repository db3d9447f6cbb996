"""The SQL of the training-data queries on rows made for its edges, against brute force and the operator."""

import hashlib

import duckdb
import numpy as np

from cauce.llm import licenses, substrings

from .test_operators import brute_removal, tally


def _table(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[d, t] for d, t, *_ in rows])
    return con


def test_removal_sql():
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdé ñ語"), 3000))
    rows = [(1, base), (2, None), (3, ""), (4, base[:49]), (5, base[100:150]), (6, base[100:150] + base[400:450])]
    # runs that touch, overlap, cross a part of the cut text, or end the text; a text that repeats itself
    rows += [(7, "x" + base[200:1900] + "y" + base[5:70]), (8, base), (9, "q" * 700), (10, "q" * 49 + "r" + "q" * 51)]
    rows += [(0, base[900:960] + "z" * 20 + base[1000:1049])]
    got = _table(rows).execute(substrings.OP10_SQL).fetchall()
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute_removal(rows)]
    assert tally(got) == tally(want)


def test_licenses_sql(spark, odd_rows):
    """Lines at and beyond a block's length, wrapped and scattered notices, odd characters."""
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    words = notice.split()
    longest = max(len(licenses.words_of(t)) for t, _ in licenses.TEMPLATES)
    rows = [(i, t) for i, (_, t, *_) in enumerate(odd_rows)]
    texts = [notice, notice.upper(), notice.replace(" ", "\n"), "\n".join(" ".join(words[i : i + 3]) for i in range(0, 20, 3))]
    texts += [" ".join(w + " filler" * k for w in words) for k in (1, 2, 5)]
    texts += [("w " * n) + notice + (" v" * n) for n in range(2 * longest)]
    texts += [" ".join(["a"] * (2 * longest + k)) + " cc by" for k in range(-3, 4)]
    texts += ["ÀCC BY", "CC\n\nBY cc_by cc by", "Kind of İ general PUBLIC license", "  all  rights\treserved  ", "\x0ball rights", "by cc"]
    rows += [(1000 + i, t) for i, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    rel = _table(rows).execute(licenses.OP8_SQL)
    columns = [d[0] for d in rel.description]
    assert tally(got.select(*columns).collect()) == tally(rel.fetchall())
