"""Incremental raw load: same rows as the batch load; a later file is picked up by the next
run while already-loaded files are not read again."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from cauce.plans import etl
from cauce.sources.layout import Layout
from cauce.streaming.ingest import read_streamed_raw, stream_raw
from conftest import DELITOS_CSV, write_text


def _run(spark, lay, source, ckpt):
    q = stream_raw(spark, lay, source, checkpoint=ckpt)
    q.awaitTermination()
    assert q.exception() is None


def test_stream_matches_batch_and_is_incremental(spark, workdir):
    folder = os.path.join(workdir, "in", "delitos_por_municipio.csv")
    write_text(os.path.join(folder, "part-a.csv"), DELITOS_CSV)
    lay = Layout(in_root=os.path.join(workdir, "in"), out_root=os.path.join(workdir, "out"))
    ckpt = os.path.join(workdir, "ckpt")
    _run(spark, lay, "delitos", ckpt)
    first = read_streamed_raw(spark, lay, "delitos")
    cols = ["Municipio", "2020", "2021"]
    batch = etl.read_raw_source(spark, lay, "delitos")
    assert sorted(tuple(r) for r in first.select(cols).collect()) == sorted(tuple(r) for r in batch.select(cols).collect())

    write_text(os.path.join(folder, "part-b.csv"), DELITOS_CSV.replace("SORIA", "BURGOS"))
    _run(spark, lay, "delitos", ckpt)
    after = read_streamed_raw(spark, lay, "delitos")
    names = sorted(r["Municipio"] for r in after.collect())
    assert names.count("SORIA (PROVINCIA DE)") == 1 and names.count("BURGOS (PROVINCIA DE)") == 1
    clean = etl.clean_crime(after)
    assert clean.count() == 12


def test_next_run_goes_on_and_other_headers_are_refused(spark, workdir):
    folder = os.path.join(workdir, "in", "delitos_por_municipio.csv")
    write_text(os.path.join(folder, "part-a.csv"), DELITOS_CSV)
    lay = Layout(in_root=os.path.join(workdir, "in"), out_root=os.path.join(workdir, "out"))
    _run(spark, lay, "delitos", None)
    first = read_streamed_raw(spark, lay, "delitos").count()
    _run(spark, lay, "delitos", None)  # nothing new: nothing loaded twice
    assert read_streamed_raw(spark, lay, "delitos").count() == first
    write_text(os.path.join(folder, "part-b.csv"), DELITOS_CSV.replace("2020", "2018"))
    with pytest.raises(StreamingQueryException):
        _run(spark, lay, "delitos", None)
    assert read_streamed_raw(spark, lay, "delitos").count() == first
