"""Scans, header location, preamble handling, sniffing and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from cauce.sources import delimited as S
from cauce.sources.sinks import guard_overwrite, write_csv, write_parquet
from conftest import write_text


def test_header_index_is_three(spark, inputs):
    row = S.locate_header(spark, inputs.csv("delitos"), max_scan=50).first()
    assert row["header_index"] == 3
    assert row["header"] == "Municipio;2020;2021"


def test_preamble_scan(spark, inputs):
    df = S.read_with_preamble(spark, inputs.csv("delitos"))
    assert df.columns == ["Municipio", "2020", "2021", "_ord"]
    rows = [tuple(r)[:3] for r in df.orderBy("_ord").collect()]
    assert rows == [("SORIA (PROVINCIA DE)", "41", "57"), ("ÁGREDA", "6", "4"), ("COVALEDA", "3", "9")]


def test_no_preamble_and_header_not_found(spark, workdir):
    p1 = write_text(os.path.join(workdir, "a", "x.csv"), "Municipio;2019\nA;1\n")
    assert S.locate_header(spark, p1).first()["header_index"] == 0
    p2 = write_text(os.path.join(workdir, "b", "x.csv"), "foo;bar\nA;1\n")
    df = S.read_with_preamble(spark, p2)
    assert df.columns[:2] == ["foo", "bar"] and df.count() == 1


def test_duplicate_header(spark, workdir):
    p = write_text(os.path.join(workdir, "d.csv"), "Municipio;2019;2019\nA;1;2\n")
    df = S.read_delimited(spark, p)
    assert df.columns[:3] == ["Municipio", "2019", "2019.1"]
    assert S.dedupe_names(["a", "a", "", "a"]) == ["a", "a.1", "Unnamed: 2", "a.2"]


def test_latin1_and_na_words(spark, workdir):
    p = write_text(os.path.join(workdir, "l.csv"), "a;b\nAlcalá;NA\nÑ;\n")
    rows = S.read_delimited(spark, p, encoding="latin1").orderBy("_ord").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("Alcalá", None), ("Ñ", None)]


def test_multi_split_same_result(spark, workdir):
    lines = ["pre", "Municipio;v"] + [f"M{i};{i}" for i in range(20000)]
    p = write_text(os.path.join(workdir, "big.csv"), "\n".join(lines) + "\n")
    one = S.read_with_preamble(spark, p).orderBy("_ord").select("Municipio", "v").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        many = S.read_with_preamble(spark, p)
        assert many.rdd.getNumPartitions() > 1
        many_rows = many.orderBy("_ord").select("Municipio", "v").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert many_rows == one and len(one) == 20000 and one[0]["Municipio"] == "M0"


def test_sniff_and_preview(spark, workdir):
    p = write_text(os.path.join(workdir, "t.csv"), "a\tb\n1\t2\n3\t4\n")
    df, sep = S.read_sniffed(spark, p)
    assert sep == "\t" and df.count() == 2
    prev = S.preview_lines(spark, p, n=2).collect()
    assert [(r["line_no"], r["value"]) for r in prev] == [(1, "a\tb"), (2, "1\t2")]


def test_read_csv_default_missing_path(spark, workdir):
    with pytest.raises(FileNotFoundError):
        S.read_csv_default(spark, os.path.join(workdir, "nope.csv"))


def test_sinks_roundtrip_and_guard(spark, workdir):
    df = spark.createDataFrame([(1, 'say "hi"', ""), (2, None, "x")], "id int, a string, b string")
    out = write_csv(df, os.path.join(workdir, "csv"), single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    text = open(os.path.join(out, files[0])).read()
    assert '"say ""hi"""' in text and "2,,x" in text
    pq = write_parquet(df, os.path.join(workdir, "pq"), codec="zstd", level=7)
    assert any(".zstd." in f for f in os.listdir(pq))
    back = spark.read.parquet(pq)
    with pytest.raises(ValueError):
        guard_overwrite(back, pq)
    assert sorted(r["id"] for r in back.collect()) == [1, 2]


def test_preamble_writer_roundtrip(spark, workdir):
    from cauce.sources.sinks import write_with_preamble

    df = spark.range(100).select(F.col("id").cast("string").alias("Municipio"), (F.col("id") * 2).alias("v"))
    path = write_with_preamble(df.repartition(3), os.path.join(workdir, "pre"), ["l1", "l2"], sep=";")
    back = S.read_with_preamble(spark, path)
    assert back.count() == 100
    heads = S.locate_header(spark, path).collect()
    assert {r["header_index"] for r in heads} == {2}


def test_preamble_files_must_share_header(spark, workdir):
    write_text(os.path.join(workdir, "mix", "a.csv"), "pre\nMunicipio;2019\nA;1\n")
    write_text(os.path.join(workdir, "mix", "b.csv"), "Municipio;2020\nB;2\n")
    with pytest.raises(ValueError):
        S.read_with_preamble(spark, os.path.join(workdir, "mix"))
    write_text(os.path.join(workdir, "same", "a.csv"), "pre\nMunicipio;2019\nA;1\n")
    write_text(os.path.join(workdir, "same", "b.csv"), "Municipio;2019\nB;2\nC;3\n")
    df = S.read_with_preamble(spark, os.path.join(workdir, "same"))
    assert sorted(r["Municipio"] for r in df.collect()) == ["A", "B", "C"]


def test_plain_scan_header_check(spark, workdir):
    write_text(os.path.join(workdir, "h", "a.csv"), "x;y\n1;2\n")
    write_text(os.path.join(workdir, "h", "b.csv"), "x;z\n3;4\n")
    with pytest.raises(Exception, match="header"):
        S.read_delimited(spark, os.path.join(workdir, "h")).collect()
    write_text(os.path.join(workdir, "swapped", "a.csv"), "x;y\n1;2\n")
    write_text(os.path.join(workdir, "swapped", "b.csv"), "y;x\n3;4\n")
    with pytest.raises(Exception, match="header"):
        S.read_delimited(spark, os.path.join(workdir, "swapped")).select("y").collect()
    with pytest.raises(ValueError):
        S.read_delimited(spark, os.path.join(workdir, "h"), check_headers=True)
    write_text(os.path.join(workdir, "k", "a.csv"), "x;y\n1;2\n")
    write_text(os.path.join(workdir, "k", "b.csv"), "x;y\n3;4\n")
    assert S.read_delimited(spark, os.path.join(workdir, "k"), check_headers=True).count() == 2


def test_united_columns():
    names, places = S.united_columns(["a;b ;a", " B;c;a", "﻿a;;C"], ";")
    assert names == ["a", "b ", "a.1", "c", "Unnamed: 1"]
    assert places == [[0, 1, 2, -1, -1], [2, 0, -1, 1, -1], [0, -1, -1, 2, 1]]


def test_files_of_differing_headers(spark, workdir):
    """Repeated and padded names in differing order are read by name; a file that lacks a column has nulls."""
    folder = os.path.join(workdir, "odd")
    write_text(os.path.join(folder, "a.csv"), "x;y;x;z \n1;2;3;4\n5;;7\n")
    write_text(os.path.join(folder, "b.csv"), " z;x;w;y;extra\n40;\"1;0\";NA;20;9;8\n")
    write_text(os.path.join(folder, "c.csv"), "x;y;x;z \n6;6;6;6;6\n")
    want = [("1", "2", "3", "4", None, None), ("5", None, "7", None, None, None),
            ("1;0", "20", None, "40", None, "9"), ("6", "6", "6", "6", None, None)]
    df = S.read_delimited(spark, folder)
    assert df.columns == ["x", "y", "x.1", "z ", "w", "extra", "_ord"]
    assert [tuple(r)[:-1] for r in df.orderBy("_ord").collect()] == want
    with pytest.raises(ValueError, match="header"):
        S.read_delimited(spark, folder, check_headers=True)
    assert S.read_delimited(spark, folder, with_order=False).columns == df.columns[:-1]
    # plain names: the scan refuses by default, by_name unites
    plain = os.path.join(workdir, "plain")
    write_text(os.path.join(plain, "a.csv"), "x;y\n1;2\n")
    write_text(os.path.join(plain, "b.csv"), "y;x\n3;4\n")
    rows = S.read_delimited(spark, plain, by_name=True).orderBy("_ord").select("x", "y").collect()
    assert [tuple(r) for r in rows] == [("1", "2"), ("4", "3")]


@pytest.mark.parametrize("max_files", [100, 1])
def test_preambles_of_differing_headers(spark, workdir, max_files):
    """The header table may be larger than what is collected: it is joined as a table then."""
    folder = os.path.join(workdir, "pre")
    write_text(os.path.join(folder, "a.csv"), "pre\nMunicipio;2019;2020\nA;1;\"a\nb\"\n")
    write_text(os.path.join(folder, "b.csv"), "2020;Municipio\nB;x\n2;B\n")
    write_text(os.path.join(folder, "c.csv"), "one\ntwo\nMunicipio;2019;2020\nC;3;\n")
    with pytest.raises(ValueError, match="header"):
        S.read_with_preamble(spark, folder, max_files=max_files)
    df = S.read_with_preamble(spark, folder, max_files=max_files, by_name=True)
    rows = [tuple(r)[:3] for r in df.orderBy("_ord").collect()]
    assert rows == [("A", "1", "a\nb"), ("x", None, "B"), ("B", None, "2"), ("C", "3", None)]
    same = os.path.join(workdir, "same")
    write_text(os.path.join(same, "a.csv"), "Municipio;v\nA;1\n")
    write_text(os.path.join(same, "b.csv"), "pre\nMunicipio;v\nB;2\n")
    df = S.read_with_preamble(spark, same, max_files=max_files)
    assert [tuple(r)[:2] for r in df.orderBy("_ord").collect()] == [("A", "1"), ("B", "2")]
