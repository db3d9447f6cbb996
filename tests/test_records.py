"""Records that span lines and splits, physical line numbers, quoted separators, typed reads."""

import pytest

from cauce import sources as S
from cauce.sources import delimited as D


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_lines_are_physical(spark, tmp_path):
    path = put(tmp_path / "a.csv", "Título\n\n\nMunicipio;x\nA\x01B;7\n\nC;8\n", "latin-1")
    row = S.locate_header(spark, path).first()
    assert (row.header_index, row.header, row.found) == (3, "Municipio;x", True)
    assert [r.value for r in S.preview_lines(spark, path).collect()] == ["Título", "", "", "Municipio;x", "A\x01B;7", "", "C;8"]
    rows = S.read_with_preamble(spark, path).orderBy(S.ORD).collect()
    assert [(r.Municipio, r.x) for r in rows] == [("A\x01B", "7"), ("C", "8")]
    other = put(tmp_path / "b.csv", "\na;b\n1;2\n")
    row = S.locate_header(spark, other).first()
    assert (row.header_index, row.header, row.found) == (1, "a;b", False)


@pytest.mark.parametrize("split", [None, 64, 16])
def test_quoted_line_breaks_over_many_splits(spark, tmp_path, split):
    want, text = [], 'said "so\nMunicipio;n;t\n'
    for i in range(300):
        value = ["plain", 'two\nlines "quoted"', "a;b", "\n\nlong\n" * 9, "", 'x"\n"y'][i % 6]
        want.append((f"M{i}", str(i), value or None))
        text += f"M{i};{i};" + ('"' + value.replace('"', '""') + '"' if set(value) & set('"\n;') else value) + "\n"
    put(tmp_path / "a.csv", text)
    put(tmp_path / "b.csv", "Municipio;n;t\nZ;1;\"\n;\n\"\n")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = S.read_with_preamble(spark, str(tmp_path), encoding="utf-8")
        rows = [tuple(r)[:3] for r in df.orderBy(S.ORD).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == [*want, ("Z", "1", "\n;\n")]


def test_line_breaks_survive_csv_export(spark, tmp_path):
    rows = [(1, "a\nb", "NA"), (2, 'c "d"\n\n,e', "x"), (3, None, None), (4, "plain", "nan")]
    path = S.write_csv(spark.createDataFrame(rows, "k int, t string, w string").repartition(2), str(tmp_path / "o"))
    got = S.read_csv_default(spark, path, infer_types=True)
    assert dict(got.dtypes) == {"k": "bigint", "t": "string", "w": "string"}
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb", None), (2, 'c "d"\n\n,e', "x"), (3, None, None), (4, "plain", None)]


def test_types_are_the_narrowest_that_hold_all_values(spark):
    rows = [("1", "1.5", "True", "007", "a", None, "9" * 19), (" 2", "NaN"[:0] or None, "False", "1e3", "1", None, "1"), ("-3", ".5", None, "inf", "", None, None)]
    df = D.typed(spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string"))
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "boolean", "d": "double", "e": "string", "f": "double", "g": "double"}
    assert [r.a for r in df.collect()] == [1, 2, -3] and df.first().d == 7.0


def test_separator_in_quotes(spark, tmp_path):
    df, sep = S.read_sniffed(spark, put(tmp_path / "q.csv", 'name,n\n"Acebeda, La",1\n\n"a;b",2\n'))
    assert sep == "," and [(r["name"], r["n"]) for r in df.orderBy(S.ORD).collect()] == [("Acebeda, La", "1"), ("a;b", "2")]
    assert S.read_sniffed(spark, put(tmp_path / "r.csv", "one\ntwo\n")) == (None, None)
