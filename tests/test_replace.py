"""Replace-on-write (K2) on odd paths, and the shuffle form of the joins."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cauce.operators.joins import hot_keys, left_join
from cauce.sources.sinks import write_csv, write_parquet

ODD = ["plain", "with blank", "per%20cent", "100%", "áéñ", "plus+and&", "semi;colon", "dir/sub dir"]


@pytest.mark.parametrize("name", ODD)
@pytest.mark.parametrize("spelling", ["as is", "dots", "relative", "scheme", "link"])
def test_overwriting_the_input_keeps_it(spark, tmp_path, monkeypatch, name, spelling):
    home = str(tmp_path / name)
    spark.range(10).write.parquet(home)
    target = home
    if spelling == "dots":
        target = str(tmp_path / "x" / ".." / name)
    elif spelling == "relative":
        target = os.path.relpath(home)
    elif spelling == "scheme":
        target = f"file://{home}"
    elif spelling == "link":
        target = str(tmp_path / "a link")
        os.symlink(home, target)
    df = spark.read.parquet(home)
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(df, target)
    assert spark.read.parquet(home).count() == 10
    write_parquet(spark.range(3), target)  # another table replaces it whole
    assert sorted(r.id for r in spark.read.parquet(home).collect()) == [0, 1, 2]
    assert not [f for f in os.listdir(os.path.dirname(home)) if f.startswith("_")]


def test_a_failing_write_leaves_the_target(spark, tmp_path):
    path = str(tmp_path / "out put")
    write_parquet(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_parquet(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmp_path) == ["out put"]


def test_input_under_or_above_the_target(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "a b" / "inner"))
    df = spark.read.parquet(str(tmp_path / "a b" / "inner"))
    for target in (tmp_path / "a b", tmp_path / "a b" / "inner" / "more"):
        with pytest.raises(ValueError, match="refusing"):
            write_csv(df, str(target))
    write_csv(df, str(tmp_path / "a b" / "other"))
    write_csv(df.limit(2), str(tmp_path / "a b" / "other"))
    assert spark.read.option("header", True).csv(str(tmp_path / "a b" / "other")).count() == 2


def _rows(df):
    return Counter(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("salt", ["no", "yes"])
def test_shuffle_form_equals_the_plain_join(spark, salt):
    nan = float("nan")
    left = spark.createDataFrame(
        [(nan, 1, 2), (nan, 1, 3), (-0.0, 4, 5), (0.0, 6, 7), (None, 8, 9), (1.5, 1, 1), (2.5, 0, 0)],
        "k double, __key_hash long, salt int",
    )
    right = spark.createDataFrame([(nan, 8), (0.0, 9), (0.0, 10), (None, 11), (1.5, 12)], "k double, hot int")
    plain = left.join(right, "k", "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ours = left_join(left, right, "k", max_broadcast_bytes=0, salt_hot=salt)
        assert ours.columns == ["k", "__key_hash", "salt", "hot"]
        assert _rows(ours) == _rows(plain)
        dotted = left_join(left.withColumnRenamed("k", "a.b"), right.withColumnRenamed("k", "a.b"), "a.b", max_broadcast_bytes=0, salt_hot=salt)
        assert _rows(dotted) == _rows(plain)
        typed = left_join(spark.range(5).selectExpr("cast(id as int) as k"), spark.range(3).selectExpr("id as k", "id as v"), "k", max_broadcast_bytes=0, salt_hot=salt)
        assert typed.where("v is not null").count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_dealt_without_adaptive_execution(spark):
    """A third of all rows hold one key, another third none; no partition gets either whole."""
    left = spark.range(30_000).selectExpr("case id % 3 when 0 then 7 when 1 then null else id end as k", "id % 5 as v", "id")
    right = spark.range(1000).selectExpr("id as k", "id * 2 as w").unionByName(spark.createDataFrame([(7, -1)], "k long, w long"))
    assert [r.k for r in hot_keys(left, ["k"], 8).collect()] == [7]
    for name, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(name, value)
    try:
        out = left_join(left, right, "k", max_broadcast_bytes=0)
        assert out.count() == left.join(right, "k", "left").count()
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert out.where("k = 7").agg(F.sum("w")).first()[0] == 10_000 * 13
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
