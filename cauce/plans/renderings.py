"""Messy inputs rendered from the test tables, in the shape the cleaning jobs expect.

Each rendering is a projection of a test table (its size grows with the table). The SQL
oracles compute the expected result from the *original* columns, so a round trip
(render -> clean) is checked against values that do not depend on this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.operators.reshape import pivot_values


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spanish_number(col) -> F.Column:
    """112946.26 -> '112.946,26' (grouping '.', decimal ',')."""
    return F.translate(F.format_number(col, 2), ",.", ".,")


def mixed_case_accented(name_col, accent: str) -> F.Column:
    """'NATION_7' -> 'N' + 'ation_7' with every 'a' replaced by ``accent``."""
    s = F.concat(F.upper(F.substring(name_col, 1, 1)), F.lower(F.substring(name_col, 2, 1 << 30)))
    return F.replace(s, F.lit("a"), F.lit(accent))


def contact_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call-centre answer per event: ids as bytes literals, unpadded postal codes,
    durations as text, DNI missing on 'view' rows, a product only on purchases."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("b'"), ev.user_id.cast("string"), F.lit("'")).alias("sessionID"),
        F.when(ev.event_type != "view", F.concat(F.lit("D"), ev.event_id.cast("string"))).alias("DNI"),
        (F.lit(600000000) + ev.user_id).cast("string").alias("Telef"),
        ev.user_id.cast("string").alias("CP"),
        ev.value.cast("string").alias("duration_call_mins"),
        ev.event_type.alias("funnel_Q"),
        F.when(
            ev.event_type == "purchase", F.concat(F.lit("P"), F.floor(ev.value).cast("int").cast("string"))
        ).alias("Producto"),
        ev.event_id.alias("_ord"),
    )


def _orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)


def income_raw(spark: SparkSession, sf_dir: str, unmatched: bool = False) -> DataFrame:
    """One income row per order: code + municipality in one field, period = order year,
    amount in Spanish number format, file order = order key. ``unmatched`` leaves household
    customers without income, so that joins meet keys without a partner."""
    j = _orders_by_nation(spark, sf_dir)
    if unmatched:
        j = j.where(F.col("c_mktsegment") != "HOUSEHOLD")
    return j.select(
        F.concat(
            F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit(" "), mixed_case_accented(F.col("n_name"), "á")
        ).alias("Municipios"),
        F.lit("Renta neta media por persona").alias("Indicadores de renta media y mediana"),
        F.year("o_orderdate").cast("string").alias("Periodo"),
        spanish_number(F.col("o_totalprice")).alias("Total"),
        F.col("o_orderkey").alias("_ord"),
    )


def crime_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide crime table: one row per nation (lower case, accented), one text column per
    order year holding that nation's order count."""
    j = _orders_by_nation(spark, sf_dir).select(
        F.replace(F.lower("n_name"), F.lit("a"), F.lit("à")).alias("Municipio"),
        F.year("o_orderdate").cast("string").alias("y"),
    )
    years = pivot_values(j, "y")
    wide = j.groupBy("Municipio").pivot("y", years).count()
    return wide.select("Municipio", *[F.coalesce(F.col(y), F.lit(0)).cast("string").alias(y) for y in years])
