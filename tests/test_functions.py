"""Scalar functions (X1-X15) on hand-written cases, including the gaps listed in FIXTURES."""

from pyspark.sql import functions as F

from cauce.functions import numbers as N
from cauce.functions import text as X


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {dtype}")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_local_number_placeholders(spark):
    got = _eval(spark, [".", "", "abc", "1.234,56", "13.999", "15.500", "-2,5", None], N.local_number)
    assert got == [None, None, None, 1234.56, 13999.0, 15500.0, -2.5, None]


def test_postcode(spark):
    got = _eval(spark, ["8001", "28001-3", "", "abc", None, "280011"], X.postcode)
    assert got == ["08001", "28001", None, None, None, "28001"]


def test_extract_and_strip_code(spark):
    vals = ["28001 Acebeda, La", "Madrid", "x 123456 y", None]
    assert _eval(spark, vals, X.extract_code) == ["28001", None, "12345", None]
    assert _eval(spark, vals, X.strip_code)[:2] == ["Acebeda, La", "Madrid"]


def test_fold_upper(spark):
    got = _eval(spark, ["Alcalá de Henares", "ñandú", "Straße", None, " \tÀvila ", "¼ Ĳssel"], X.fold_upper)
    assert got == ["ALCALA DE HENARES", "NANDU", "STRASSE", "", "AVILA", "1⁄4 IJSSEL"]


def test_unwrap_bytes(spark):
    assert _eval(spark, ["b'AAA'", " b'BB' ", "CCC", None], X.unwrap_bytes) == ["AAA", "b'BB'", "CCC", None]


def test_trim_ws(spark):
    assert _eval(spark, ["\t x \n", " y ", "z"], X.trim_ws) == ["x", "y", "z"]


def test_to_double_lenient(spark):
    vals = ["1d", ".", "", "2,5", "1e3", "-.5", "5.", " 7 ", "abc", "inf", "-Infinity", None]
    got = _eval(spark, vals, N.to_double)
    assert got == [None, None, None, None, 1000.0, -0.5, 5.0, 7.0, None, float("inf"), float("-inf"), None]
    assert _eval(spark, ["2,5"], lambda c: N.to_double(c, decimal=",")) == [2.5]


def test_to_int(spark):
    assert _eval(spark, ["2019", "2019.0", "2019.5", "x", None], N.to_int) == [2019, 2019, None, None, None]


def test_null_markers(spark):
    vals = ["NA", "null", "", "N/A", "ok", "nan", None, "NaN "]
    assert _eval(spark, vals, X.null_markers) == [None, None, None, None, "ok", None, None, "NaN "]


def test_zfill_and_round(spark):
    assert _eval(spark, ["1", "123456", None], lambda c: X.zfill(c, 5)) == ["00001", "123456", None]
    got = _eval(spark, [2.345, 2.355, 2.5], lambda c: N.round_to(c.cast("decimal(10,3)"), 2), "double")
    assert [float(v) for v in got] == [2.34, 2.36, 2.5]


def test_fold_upper_exact_matches_fast_on_latin_and_handles_other_scripts(spark):
    vals = ["Alcalá de Henares", "ñandú", "Straße", None, " Ávila ", "Łódź", "Ελλάδα", "Tiếng Việt"]
    fast = _eval(spark, vals[:5], X.fold_upper)
    exact = _eval(spark, vals, lambda c: X.fold_upper(c, exact=True))
    assert exact[:5] == fast
    assert exact[6:] == ["ΕΛΛΑΔΑ", "TIENG VIET"]


def test_decimal_comma_options(spark):
    from cauce.plans import etl

    raw = spark.createDataFrame([("b'A'", "2,5", 1)], "sessionID string, duration_call_mins string, _ord long")
    assert etl.clean_sessions(raw).first()["duration_call_mins"] is None
    assert etl.clean_sessions(raw, decimal=",").first()["duration_call_mins"] == 2.5
    wide = spark.createDataFrame([("M", "2,5")], "Municipio string, `2020` string")
    assert etl.clean_crime(wide, decimal=",").first()["tasa"] == 2.5


def test_income_indicator_filter(spark):
    from cauce.plans import etl

    raw = spark.createDataFrame(
        [("28001 A", "Renta neta media por persona", "2020", "10", 1), ("28001 A", "Renta bruta", "2020", "20", 2)],
        "Municipios string, `Indicadores de renta media y mediana` string, Periodo string, Total string, _ord long",
    )
    assert etl.clean_income(raw).count() == 2
    kept = etl.clean_income(raw, indicator="Renta neta media por persona").collect()
    assert [r["renta_media"] for r in kept] == [10.0]


def test_fold_upper_over_all_characters(spark):
    """Every character whose fold is one character or none, against Python."""
    import sys
    import unicodedata

    def fold(text):
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))

    chars = [chr(c) for c in range(0x20, sys.maxunicode) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    values = [f"x{c}y" for c in chars if len(fold(c)) < 2]
    want = [fold(v).strip().upper() for v in values]
    got = _eval(spark, values, X.fold_upper)
    assert [v for v, a, b in zip(values, got, want) if a != b] == []
    assert _eval(spark, ["ế ώ ﬁ", "Tiếng Việt", "Ελλάδα", "plain"], X.fold_upper) == ["E Ω FI", "TIENG VIET", "ΕΛΛΑΔΑ", "PLAIN"]


def test_row_numbers_keep_clashing_columns(spark):
    from cauce.operators.latest import number_rows, stable_sort

    df = spark.range(0, 500, 1, 7).selectExpr("id AS _ord", "if(id % 3 = 0, null, id % 5) AS place_0", "id AS `a.b`", "1 AS PLACE_2")
    rows = number_rows(stable_sort(df, ["place_0"]), "n").orderBy("n").collect()
    want = sorted(((r % 5 if r % 3 else 9), r) for r in range(500))
    assert [r["_ord"] for r in rows] == [r for _, r in want] and [r["n"] for r in rows] == list(range(1, 501))
    assert number_rows(df.limit(0).orderBy("_ord")).count() == 0
