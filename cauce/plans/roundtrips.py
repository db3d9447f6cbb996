"""Round-trip queries for scans and sinks (S1-S3, S5-S7, K1-K3) and for the file-based
jobs (D1, D6): a whole test table is written in the format under test to a fresh folder
under ``spark.checkpoint.dir`` (shared storage on a cluster), then read back by the
operator. The oracle is the original table, so the check does not depend on our writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.plans import etl
from cauce.plans.catalog import EVENT_TYPES, FINAL_SQL, register
from cauce.plans.renderings import contact_raw, crime_raw, income_raw, table
from cauce.session import scratch_dir
from cauce.sources import delimited as S
from cauce.sources.layout import Layout
from cauce.sources.sinks import write_csv, write_parquet, write_with_preamble

# Three lines above the header, as crime exports have them; any text will do.
PREAMBLE = ["Infracciones penales por municipio", "Segundo trimestre", "Fuente: propia"]

_CUSTOMER_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       replace(lower(c_mktsegment), 'a', 'á') AS c_segment_es
FROM customer
"""


def _customer_es(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.withColumn("c_segment_es", F.replace(F.lower("c_mktsegment"), F.lit("a"), F.lit("á")))


def _customer_typed(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
        "c_segment_es",
    )


@register("S1_csv_scan", _CUSTOMER_SQL)
def s1_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = write_csv(_customer_es(spark, sf), scratch_dir(spark, "s1"), sep=";", encoding="ISO-8859-1")
    return _customer_typed(S.read_delimited(spark, path, sep=";", encoding="latin1"))


@register("S1_mixed_headers", _CUSTOMER_SQL + " UNION ALL SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment, NULL FROM customer")
def s1_mixed_headers(spark, sf):
    """All customers twice: files with a repeated name and one with blanks, and files with other columns
    in another order."""
    c = _customer_es(spark, sf)
    path = scratch_dir(spark, "s1m")
    order = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_segment_es"]
    one = ["c_custkey", "segment", " segment", "c_name", "c_acctbal", "c_nationkey "]
    first = c.select("c_custkey", "c_mktsegment", "c_segment_es", "c_name", "c_acctbal", "c_nationkey")
    write_with_preamble(first.toDF(*one), f"{path}/a", [], sep=";")
    second = c.select("c_nationkey", "c_acctbal", "c_mktsegment", "c_custkey")
    write_with_preamble(second.toDF("c_nationkey", " c_acctbal", "segment", "C_CUSTKEY"), f"{path}/b", [], sep=";")
    df = S.read_delimited(spark, [f"{path}/a", f"{path}/b"], sep=";")
    df = df.toDF("c_custkey", "c_mktsegment", "c_segment_es", "c_name", "c_acctbal", "c_nationkey", S.ORD)
    return _customer_typed(df.select(*order))


# orders in key order, rendered with a preamble in every part file
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_HEADER = ";".join(["Municipio"] + _ORDER_COLS[1:])


def _orders_with_preamble(spark, sf) -> str:
    o = table(spark, sf, "orders").select(*_ORDER_COLS).orderBy("o_orderkey")
    o = o.withColumnRenamed("o_orderkey", "Municipio")
    return write_with_preamble(o, scratch_dir(spark, "preamble"), PREAMBLE, sep=";")


@register("S2_header_locate", f"SELECT 3 AS header_index, '{_HEADER}' AS header")
def s2_header_locate(spark, sf):
    path = _orders_with_preamble(spark, sf)
    return S.locate_header(spark, path, token="Municipio", sep=";").select("header_index", "header").distinct()


@register("S3_preamble_scan", f"SELECT {', '.join(_ORDER_COLS)} FROM orders")
def s3_preamble_scan(spark, sf):
    df = S.read_with_preamble(spark, _orders_with_preamble(spark, sf), token="Municipio", sep=";")
    return df.select(
        F.col("Municipio").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderpriority",
    )


@register(
    "S7_preview",
    f"""
SELECT * FROM (VALUES (1, '{PREAMBLE[0]}'), (2, '{PREAMBLE[1]}'), (3, '{PREAMBLE[2]}'), (4, '{_HEADER}')) t(line_no, value)
UNION ALL
SELECT CAST(4 + row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS line_no,
       concat_ws(';', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority) AS value
FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 16) f
""",
)
def s7_preview(spark, sf):
    return S.preview_lines(spark, _orders_with_preamble(spark, sf), n=20)


_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority
FROM orders
"""


@register("S5_csv_default", _ORDERS_SQL)
def s5_csv_default(spark, sf):
    path = write_csv(table(spark, sf, "orders"), scratch_dir(spark, "s5"))
    df = S.read_csv_default(spark, path)
    return df.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.substring("o_orderdate", 1, 10).alias("o_orderdate"),
        "o_orderpriority",
    )


@register(
    "S5_csv_typed",
    """
SELECT event_id, user_id,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN event_type || chr(10) || '"' || props || '"'
            ELSE event_type || ',' || chr(10) || chr(10) || user_id END AS note,
       value, CASE WHEN event_id % 4 <> 0 THEN value END AS gaps, event_id % 2 = 0 AS even
FROM events
""",
)
def s5_csv_typed(spark, sf):
    """Values with quotes, commas and line breaks, gaps written as missing-value words; types found."""
    e = table(spark, sf, "events")
    kind = F.col("event_id") % 3
    note = F.when(kind == 1, F.concat("event_type", F.lit('\n"'), "props", F.lit('"'))).when(
        kind == 2, F.concat("event_type", F.lit(",\n\n"), F.col("user_id").cast("string"))
    )
    rows = e.select(
        "event_id", "user_id", note.alias("note"), "value",
        F.when(F.col("event_id") % 4 != 0, F.col("value").cast("string")).otherwise("NA").alias("gaps"),
        F.when(F.col("event_id") % 2 == 0, "True").otherwise("False").alias("even"),
    )
    return S.read_csv_default(spark, write_csv(rows, scratch_dir(spark, "s5t")), infer_types=True)


@register("S6_sniffed_scan", f"SELECT *, chr(9) AS sep FROM ({_CUSTOMER_SQL}) c")
def s6_sniffed_scan(spark, sf):
    path = write_csv(_customer_es(spark, sf), scratch_dir(spark, "s6"), sep="\t", encoding="ISO-8859-1")
    df, sep = S.read_sniffed(spark, path)
    return _customer_typed(df).withColumn("sep", F.lit(sep))


_LINEITEM_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
"""


@register("K1_parquet_zstd", _LINEITEM_SQL)
def k1_parquet_zstd(spark, sf):
    path = write_parquet(table(spark, sf, "lineitem"), scratch_dir(spark, "k1"), codec="zstd", level=7)
    back = spark.read.parquet(path)
    return back.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@register("K2_overwrite", _ORDERS_SQL)
def k2_overwrite(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_dir(spark, "k2")
    write_parquet(o.where(F.col("o_orderstatus") == "F"), path)
    write_parquet(o, path)  # replaces the first content entirely
    return spark.read.parquet(path).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@register("K3_csv_export", _CUSTOMER_SQL)
def k3_csv_export(spark, sf):
    path = write_csv(_customer_es(spark, sf), scratch_dir(spark, "k3"))
    return _customer_typed(S.read_csv_default(spark, path))


# ------------------------------------------------------------------ file-based jobs
def render_inputs(spark: SparkSession, sf: str, sources=("renta", "delitos", "contact")) -> Layout:
    """Write the raw inputs, rendered from the test tables, into a fresh layout.
    Rows are sorted by their business order so file order equals that order."""
    root = scratch_dir(spark, "inputs")
    lay = Layout(in_root=f"{root}/data", out_root=f"{root}/output")
    if "renta" in sources:
        income = income_raw(spark, sf, unmatched=True).orderBy("_ord").drop("_ord")
        write_csv(income, lay.csv("renta"), sep=";", encoding="ISO-8859-1")
    if "delitos" in sources:
        write_with_preamble(crime_raw(spark, sf), lay.csv("delitos"), PREAMBLE, sep=";")
    if "contact" in sources:
        contact = contact_raw(spark, sf).orderBy("_ord").drop("_ord")
        write_csv(contact, lay.csv("contact"), sep=";", encoding="ISO-8859-1")
    return lay


@register(
    "D1_selective_load",
    """
SELECT 'b''' || CAST(user_id AS VARCHAR) || '''' AS sessionID,
       CASE WHEN event_type <> 'view' THEN 'D' || CAST(event_id AS VARCHAR) END AS DNI,
       CAST(600000000 + user_id AS VARCHAR) AS Telef,
       CAST(user_id AS VARCHAR) AS CP,
       value AS duration_call_mins,
       event_type AS funnel_Q,
       CASE WHEN event_type = 'purchase' THEN 'P' || CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS Producto
FROM events
""",
)
def d1_selective_load(spark, sf):
    lay = render_inputs(spark, sf)
    written = etl.load_raw(spark, lay, only="contact")
    if set(written) != {"contact"}:
        raise AssertionError(f"selective load wrote {sorted(written)}")
    raw = spark.read.parquet(written["contact"]).drop("_ord")
    return raw.withColumn("duration_call_mins", F.col("duration_call_mins").cast("double"))


@register("D6_full_run", FINAL_SQL)
def d6_full_run(spark, sf):
    lay = render_inputs(spark, sf)
    out = etl.run_all(spark, lay, source="all")
    df = S.read_csv_default(spark, out)
    casts = {"duration_call_mins": "double", "periodo_renta": "int", "renta_media": "double", "anio": "int",
             "tasa": "double", **{t: "int" for t in EVENT_TYPES}}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


_CONTACT_TEXT_SQL = """
SELECT 'b''' || CAST(user_id AS VARCHAR) || '''' AS sessionID,
       CASE WHEN event_type <> 'view' THEN 'D' || CAST(event_id AS VARCHAR) END AS DNI,
       CAST(600000000 + user_id AS VARCHAR) AS Telef,
       CAST(user_id AS VARCHAR) AS CP,
       value AS duration_call_mins,
       event_type AS funnel_Q,
       CASE WHEN event_type = 'purchase' THEN 'P' || CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS Producto
FROM events
"""


@register("D1_stream_load", _CONTACT_TEXT_SQL)
def d1_stream_load(spark, sf):
    """The raw load of the rendered call-centre files as an available-now stream."""
    from cauce.streaming.ingest import read_streamed_raw, stream_raw

    lay = render_inputs(spark, sf, sources=("contact",))
    query = stream_raw(spark, lay, "contact")
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    raw = read_streamed_raw(spark, lay, "contact").drop("_ord")
    return raw.withColumn("duration_call_mins", F.col("duration_call_mins").cast("double"))


@register("S8_layout", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s8_layout(spark, sf):
    """Addressing by layout: roots as URIs (here the shared scratch folder), the clean-table
    path of a source built from them, written and read back through the same layout."""
    root = scratch_dir(spark, "layout")
    lay = Layout.resolve(in_root=f"{root}/in", out_root=f"{root}/out")
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    write_parquet(cust, lay.clean("contact"))
    return spark.read.parquet(lay.clean("contact"))
