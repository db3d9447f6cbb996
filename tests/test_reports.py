"""The notebook flows as reports, and the command-line entry."""

import os

from cauce.__main__ import main
from cauce.plans import etl
from cauce.plans.reports import analysis_report, exploration_report


def test_exploration_report(spark, inputs):
    rep = exploration_report(spark, inputs)
    assert rep["renta_head"].count() == 3
    assert sorted(r[0] for r in rep["renta_periods"].collect()) == ["2018", "2021"]
    assert rep["renta_placeholders"].first()["n_marker"] == 0
    lines = [r["value"] for r in rep["delitos_raw_lines"].collect()]
    assert lines[3] == "Municipio;2020;2021" and len(lines) == 7
    assert rep["rows_per_session"].first()["value"] == "b's-07'"
    assert rep["busiest_session"].count() == 3
    assert rep["answer_frequencies"].count() >= 3
    assert set(rep["pivot_preview"].columns) >= {"sessionID", "Garaje", "Trastero"}


def test_analysis_report(spark, inputs):
    final = spark.read.option("header", True).option("inferSchema", True).csv(etl.run_all(spark, inputs))
    rep = analysis_report(final)
    assert rep["shape"].first()["n_rows"] == 3
    assert {"describe", "correlation", "top_products", "top_municipalities", "null_rates"} <= set(rep)
    assert rep["top_municipalities"].count() >= 2
    assert "income_histogram" in rep and rep["income_histogram"].count() == 30
    assert "income_vs_crime" not in rep  # no crime rows match the fixture's municipalities
    for name, df in rep.items():
        df.collect()


def test_command_line(spark, inputs):
    out = main(["--in", inputs.in_root, "--out", os.path.join(inputs.out_root, "cli"), "--source", "all"])
    assert spark.read.option("header", True).csv(out).count() == 3
