"""The jobs on small exports, with exact expected values, plus the edge cases
(null period, ties, null answers, collisions, fan-out, unmatched keys)."""

import os

import pytest
from pyspark.sql import functions as F

from cauce.operators.latest import latest_per_key
from cauce.plans import etl
from cauce.sources.layout import Layout


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_load_all_then_one(spark, inputs):
    out = etl.load_raw(spark, inputs, only="all", level=3)
    assert set(out) == {"renta", "delitos", "contact"}
    for path in out.values():
        assert spark.read.parquet(path).count() > 0
        assert any(".zstd." in f for f in os.listdir(path))
    for src in ("renta", "delitos", "contact"):
        assert set(etl.load_raw(spark, inputs, only=src)) == {src}
    with pytest.raises(ValueError):
        etl.load_raw(spark, inputs, only="everything")


def test_clean_income(spark, inputs):
    etl.load_raw(spark, inputs, only="renta")
    clean = etl.clean_income(spark.read.parquet(inputs.raw("renta")))
    assert clean.columns[:4] == ["codigo_postal", "municipio", "periodo", "renta_media"]
    assert _rows(clean, ["codigo_postal", "municipio", "periodo", "renta_media"]) == [
        ("42020", "Losilla, La", 2018, 9870.0),
        ("42020", "Losilla, La", 2021, 12406.0),
        ("42134", "Ólvega", 2021, 18055.0),
    ]


def test_fractional_period_stays_before_the_next_year(spark):
    raw = spark.createDataFrame(
        [("42020 A", "2020", "2.000", 0), ("42020 A", "2019.5", "1.000", 1)],
        "Municipios string, Periodo string, Total string, _ord long",
    )
    latest = latest_per_key(etl.clean_income(raw), "codigo_postal", "periodo")
    assert [r["renta_media"] for r in latest.collect()] == [2000.0]


def test_clean_crime(spark, inputs):
    etl.load_raw(spark, inputs, only="delitos")
    clean = etl.clean_crime(spark.read.parquet(inputs.raw("delitos")))
    assert clean.columns == ["municipio", "anio", "tipo_delito", "tasa"]
    rows = _rows(clean, clean.columns)
    assert len(rows) == 6 and {r[1] for r in rows} == {2020, 2021}
    assert {r[2] for r in rows} == {"total"}
    assert ("ÁGREDA", 2021, "total", 4.0) in rows


def test_clean_crime_without_years(spark):
    raw = spark.createDataFrame([("A", "1")], "Municipio string, enero string")
    clean = etl.clean_crime(raw)
    assert clean.columns == ["municipio", "anio", "tipo_delito", "tasa"] and clean.count() == 0


def test_clean_sessions(spark, inputs):
    etl.load_raw(spark, inputs, only="contact")
    clean = etl.clean_sessions(spark.read.parquet(inputs.raw("contact")))
    assert clean.columns == ["sessionID", "DNI", "Telef", "CP", "duration_call_mins", "Producto",
                             "Garaje", "Trastero", "Ático"]
    assert _rows(clean, clean.columns) == [
        ("s-07", "D18", "655010203", "42134", 6.75, "Plan Auto", 1, 1, 0),
        ("s-09", "D31", "655040506", "42020", 0.5, "Plan Vida", 1, 0, 1),
        ("s-11", "D44", "655070809", "42999", 1.0, None, None, None, None),
    ]


def test_sessions_null_answers_and_collision(spark):
    raw = spark.createDataFrame(
        [("b'A'", "x", None, 1), ("b'B'", "y", "Piso", 2), ("b'A'", None, None, 3)],
        "sessionID string, DNI string, funnel_Q string, _ord long",
    )
    rows = {r["sessionID"]: r for r in etl.clean_sessions(raw).collect()}
    assert rows["A"]["Piso"] is None and rows["A"]["DNI"] == "x"
    assert rows["B"]["Piso"] == 1
    lower = raw.withColumn("funnel_Q", F.lit("dni"))
    with pytest.raises(ValueError):
        etl.clean_sessions(lower)
    clash = raw.withColumn("funnel_Q", F.lit("DNI"))
    with pytest.raises(ValueError):
        etl.clean_sessions(clash)
    pref = etl.clean_sessions(clash, flag_prefix="q_")
    assert "q_DNI" in pref.columns


def test_latest_null_period_and_tie(spark):
    df = spark.createDataFrame(
        [("k", 2021, "a", 1), ("k", None, "b", 2), ("t", 2020, "first", 3), ("t", 2020, "second", 4),
         (None, 2020, "nokey", 5)],
        "key string, p int, v string, _ord long",
    )
    got = {r["key"]: r["v"] for r in latest_per_key(df, "key", "p").collect()}
    assert got == {"k": "b", "t": "second"}
    dropped = {r["key"]: r["v"] for r in latest_per_key(df, "key", "p", nulls="drop").collect()}
    assert dropped["k"] == "a"


def test_integration_fixture(spark):
    contact = spark.createDataFrame(
        [("s-09", "D31", "655", "42020", 0.5, "Plan Vida", 1)],
        "sessionID string, DNI string, Telef string, CP string, duration_call_mins double, Producto string, Garaje int",
    )
    renta = spark.createDataFrame([("42020", "Losilla, La", 2021, 12406.0)],
                                  "codigo_postal string, municipio string, periodo int, renta_media double")
    delitos = spark.createDataFrame([("lósilla, la", 2018, "total", 7.5)],
                                    "municipio string, anio int, tipo_delito string, tasa double")
    final = etl.integrate(contact, renta, delitos)
    assert final.columns == contact.columns + ["municipio_renta", "municipio_norm", "periodo_renta",
                                               "renta_media", "anio", "tipo_delito", "tasa"]
    (row,) = final.collect()
    assert (row["municipio_renta"], row["municipio_norm"], row["periodo_renta"], row["renta_media"],
            row["anio"], row["tipo_delito"], row["tasa"]) == ("Losilla, La", "LOSILLA, LA", 2021, 12406.0,
                                                              2018, "total", 7.5)


def test_integration_fanout_and_unmatched(spark):
    contact = spark.createDataFrame([("S1", "28001"), ("S2", "99999")], "sessionID string, CP string")
    renta = spark.createDataFrame([("28001", "Ávila", 2019, 1.0), ("28001", "Ávila", 2020, 2.0)],
                                  "codigo_postal string, municipio string, periodo int, renta_media double")
    delitos = spark.createDataFrame([("AVILA", y, "total", float(y)) for y in (2019, 2020, 2021)],
                                    "municipio string, anio int, tipo_delito string, tasa double")
    for mode in ("auto", "no"):
        final = etl.integrate(contact, renta, delitos, broadcast=mode)
        s1 = final.where("sessionID = 'S1'").collect()
        assert len(s1) == 3 and {r["periodo_renta"] for r in s1} == {2020}
        (s2,) = final.where("sessionID = 'S2'").collect()
        assert s2["renta_media"] is None and s2["tasa"] is None


def test_full_run_writes_csv(spark, inputs):
    out = etl.run_all(spark, inputs)
    df = spark.read.option("header", True).csv(out)
    assert {"renta_media", "tasa"} <= set(df.columns)
    assert df.count() == 3


def test_layout_precedence(monkeypatch):
    monkeypatch.setenv("DATA_DIR", "/d")
    monkeypatch.delenv("DATA_IN_DIR", raising=False)
    monkeypatch.delenv("DATA_OUT_DIR", raising=False)
    lay = Layout.resolve()
    assert lay.in_root == "/d" and lay.out_root == "/d/output"
    monkeypatch.setenv("DATA_OUT_DIR", "/o")
    assert Layout.resolve().raw("renta") == "/o/raw/renta_RAW.parquet"
    assert Layout.resolve(in_root="/i").csv("contact") == "/i/contac_center_data.csv"


def test_join_helpers(spark):
    from cauce.operators import joins
    from cauce.operators.latest import with_row_number

    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    plain = {r["x"]: r["y"] for r in joins.left_join(left, right, "k").collect()}
    safe = {r["x"]: r["y"] for r in joins.left_join(left, right, "k", null_safe=True).collect()}
    assert plain == {1: 10, 2: None, 3: None} and safe == {1: 10, 2: 20, 3: None}
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, y int")
    with pytest.raises(ValueError):
        joins.lookup_join(left, dup, "k", check_unique=True)
    ranked = with_row_number(spark.range(1000).selectExpr("id % 7 AS g", "id"), ["g", "id"]).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 1001))
    first = min(ranked, key=lambda r: r["rank"])
    assert (first["g"], first["id"]) == (0, 0)


def test_full_run_sequential_equals_parallel(spark, inputs):
    out_p = etl.run_all(spark, inputs, parallel=True)
    rows_p = sorted(map(tuple, spark.read.option("header", True).csv(out_p).collect()))
    out_s = etl.run_all(spark, inputs, parallel=False)
    rows_s = sorted(map(tuple, spark.read.option("header", True).csv(out_s).collect()))
    assert rows_p == rows_s and len(rows_p) == 3
    with pytest.raises(ValueError):
        etl.run_all(spark, inputs, source="nope")
