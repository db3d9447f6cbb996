"""Generated inputs: the lenient parser against pandas' own coercion, and the fast accent
fold against full NFKD, on every string at once (one Spark job per property)."""

import math
import unicodedata

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cauce.functions import numbers as N
from cauce.functions import text as X

NUMERIC_TEXT = st.text(alphabet="0123456789.-+eE ,ax", min_size=0, max_size=8)
# the whole folded range, Latin-1 through Latin Extended-B
LATIN_TEXT = st.text(
    alphabet=st.characters(min_codepoint=0x20, max_codepoint=0x24F, blacklist_categories=("Cs",)),
    min_size=0, max_size=12,
)


def _pandas_coerce(s: str):
    v = pd.to_numeric(pd.Series([s], dtype=object), errors="coerce").iloc[0]
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NUMERIC_TEXT, min_size=200, max_size=400))
def test_to_double_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(N.to_double("s")).collect()]
    for v, g in zip(values, got):
        want = _pandas_coerce(v)
        assert (g is None and want is None) or (g is not None and want is not None and math.isclose(g, want)), (v, g, want)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LATIN_TEXT, min_size=200, max_size=400))
def test_fold_matches_nfkd(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(X.fold_upper("s")).collect()]
    for v, g in zip(values, got):
        want = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).strip().upper()
        assert g == want, (v, g, want)


CODE_TEXT = st.text(alphabet="0123456789 -abc/#", min_size=0, max_size=12)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CODE_TEXT, min_size=200, max_size=400))
def test_codes_match_regex_rules(spark, values):
    import re

    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(X.extract_code("s").alias("code"), X.postcode("s").alias("cp")).collect()
    for v, r in zip(values, rows):
        m = re.search(r"[0-9]{5}", v)
        assert r["code"] == (m.group(0) if m else None), v
        digits = re.sub(r"[^0-9]", "", v)
        assert r["cp"] == (digits.rjust(5, "0")[:5] if digits else None), v


def test_exact_fold_agrees_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    diff = docs.select(X.fold_upper("text").alias("a"), X.fold_upper("text", exact=True).alias("b")).where("a <> b")
    assert diff.count() == 0
