"""Query catalogue over the test tables: one query per operator, each
paired with an ANSI SQL oracle (DuckDB dialect) computed from the original columns.

Every query reads whole tables (no key subsets, no row caps except where a top-k or head
*is* the operator). Outputs are aliased identically on both sides; floating aggregates
are rounded to 6 decimals on both sides so summation order cannot change the hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions import numbers as N
from cauce.functions import text as X
from cauce.operators import aggs, columns, joins, latest, profile, reshape
from cauce.plans import etl
from cauce.plans.renderings import contact_raw, crime_raw, income_raw, spanish_number, table
from cauce.session import release_persisted

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            # data cached by the previous catalogue query (measured join sides, value
            # counts) is released first; a DataFrame still held elsewhere just recomputes
            release_persisted()
            return fn(spark, sf_dir)

        query.__name__ = fn.__name__
        query.__doc__ = fn.__doc__
        QUERIES[key] = query
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def r6(c):
    return F.round(c, 6)


def date_text(c):
    return F.date_format(c, "yyyy-MM-dd")


# ------------------------------------------------------------------ SQL building blocks
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_FLAGS_SQL = ",\n       ".join(
    f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS \"{t}\"" for t in EVENT_TYPES
)

SESSIONS_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS sessionID,
       arg_min('D' || CAST(event_id AS VARCHAR), event_id) FILTER (WHERE event_type <> 'view') AS DNI,
       CAST(600000000 + user_id AS VARCHAR) AS Telef,
       lpad(CAST(user_id AS VARCHAR), 5, '0') AS CP,
       max(value) AS duration_call_mins,
       arg_min('P' || CAST(CAST(floor(value) AS INTEGER) AS VARCHAR), event_id)
           FILTER (WHERE event_type = 'purchase') AS Producto,
       {_FLAGS_SQL}
FROM events GROUP BY user_id
"""

_ORDERS_NATION = """orders o JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN nation n ON c.c_nationkey = n.n_nationkey"""

INCOME_ROWS_SQL = f"""
SELECT lpad(CAST(o.o_custkey AS VARCHAR), 5, '0') AS codigo_postal,
       replace(upper(substr(n.n_name, 1, 1)) || lower(substr(n.n_name, 2)), 'a', 'á') AS municipio,
       CAST(year(o.o_orderdate) AS INTEGER) AS periodo,
       o.o_totalprice AS renta_media,
       o.o_orderkey AS ord
FROM {_ORDERS_NATION}
"""
MATCHED_INCOME_SQL = f"{INCOME_ROWS_SQL}WHERE c.c_mktsegment <> 'HOUSEHOLD'"

CRIME_SQL = f"""
WITH j AS (SELECT replace(lower(n.n_name), 'a', 'à') AS municipio,
                  CAST(year(o.o_orderdate) AS INTEGER) AS anio
           FROM {_ORDERS_NATION}),
     cnt AS (SELECT municipio, anio, count(*) AS k FROM j GROUP BY 1, 2),
     m AS (SELECT DISTINCT municipio FROM j),
     y AS (SELECT DISTINCT anio FROM j)
SELECT m.municipio, y.anio, 'total' AS tipo_delito, CAST(coalesce(cnt.k, 0) AS DOUBLE) AS tasa
FROM m CROSS JOIN y LEFT JOIN cnt ON cnt.municipio = m.municipio AND cnt.anio = y.anio
"""

FINAL_SQL = f"""
WITH s AS ({SESSIONS_SQL}),
     inc AS ({MATCHED_INCOME_SQL}),
     lastinc AS (
       SELECT codigo_postal AS CP, municipio, upper(strip_accents(municipio)) AS municipio_norm,
              periodo, renta_media
       FROM (SELECT *, row_number() OVER (PARTITION BY codigo_postal
                                          ORDER BY periodo DESC NULLS FIRST, ord DESC) AS rn
             FROM inc) t
       WHERE rn = 1),
     cr AS (SELECT upper(strip_accents(municipio)) AS municipio_norm, anio, tipo_delito, tasa
            FROM ({CRIME_SQL}) c0)
SELECT s.*, lastinc.municipio AS municipio_renta, lastinc.municipio_norm,
       lastinc.periodo AS periodo_renta, lastinc.renta_media,
       cr.anio, cr.tipo_delito, cr.tasa
FROM s LEFT JOIN lastinc ON s.CP = lastinc.CP
       LEFT JOIN cr ON cr.municipio_norm = lastinc.municipio_norm
"""


# ------------------------------------------------------------------ D: pipeline stages
def _final(spark: SparkSession, sf: str, attributes: list[str] | None = None) -> DataFrame:
    """The integrated table; ``attributes``: with these session columns only, chosen before the joins."""
    raw = contact_raw(spark, sf)
    if attributes is not None:
        raw = raw.select("sessionID", *attributes, etl.ORD)
    contact = etl.clean_sessions(raw)
    renta = etl.clean_income(income_raw(spark, sf, unmatched=True))
    delitos = etl.clean_crime(crime_raw(spark, sf))
    return etl.integrate(contact, renta, delitos)


@register("D5_integration", FINAL_SQL)
def d5_integration(spark, sf):
    return _final(spark, sf)


@register("D4_clean_sessions", SESSIONS_SQL)
def d4_clean_sessions(spark, sf):
    return etl.clean_sessions(contact_raw(spark, sf))


@register("D3_clean_crime", CRIME_SQL)
def d3_clean_crime(spark, sf):
    return etl.clean_crime(crime_raw(spark, sf))


@register(
    "D2_clean_income",
    f"SELECT codigo_postal, municipio, periodo, renta_media FROM ({INCOME_ROWS_SQL}) t",
)
def d2_clean_income(spark, sf):
    return etl.clean_income(income_raw(spark, sf)).drop("_ord")


# ------------------------------------------------------------------ W / O: latest, sort
_LATEST_SQL = """
SELECT o_custkey, o_orderkey, strftime(d, '%Y-%m-%d') AS o_orderdate, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY d DESC NULLS FIRST, o_orderkey DESC) AS rn
      FROM (SELECT *, {period} AS d FROM orders) t0) t
WHERE rn = 1
"""


def _latest(spark, sf, period):
    o = table(spark, sf, "orders").withColumn("d", period)
    last = latest.latest_per_key(o, "o_custkey", "d", tie="o_orderkey")
    return last.select("o_custkey", "o_orderkey", date_text("d").alias("o_orderdate"), "o_totalprice")


@register("W1_latest_per_key", _LATEST_SQL.format(period="o_orderdate"))
def w1_latest(spark, sf):
    return _latest(spark, sf, F.col("o_orderdate"))


_NULLED_DATE = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END"


def _nulled_date():
    return F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))


@register("W1_latest_null_period", _LATEST_SQL.format(period=_NULLED_DATE))
def w1_latest_null(spark, sf):
    return _latest(spark, sf, _nulled_date())


@register(
    "O1_sort_nulls",
    f"""
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS o_orderdate,
       row_number() OVER (ORDER BY d ASC NULLS LAST, o_orderkey ASC) AS rank
FROM (SELECT o_orderkey, {_NULLED_DATE} AS d FROM orders) t
""",
)
def o1_sort(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _nulled_date().alias("d"))
    ranked = latest.number_rows(latest.stable_sort(o, ["d"], tie="o_orderkey"))
    return ranked.select("o_orderkey", date_text("d").alias("o_orderdate"), "rank")


@register(
    "O2_topn",
    """
SELECT o_orderkey, o_totalprice,
       row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS rank
FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10
""",
)
def o2_topn(spark, sf):
    o = table(spark, sf, "orders")
    top = latest.top_n(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)
    return latest.with_row_number(top.select("o_orderkey", "o_totalprice"),
                                  [F.desc("o_totalprice"), F.asc("o_orderkey")])


@register(
    "O3_head",
    """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS rank
FROM orders ORDER BY o_orderkey LIMIT 10
""",
)
def o3_head(spark, sf):
    h = latest.head(table(spark, sf, "orders"), 10, order="o_orderkey").select("o_orderkey", "o_custkey")
    return latest.with_row_number(h, ["o_orderkey"])


# ------------------------------------------------------------------ J: joins
_HIGH = 200.0
_J1_FLAGS = ",\n       ".join(
    f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS \"{t}\"" for t in EVENT_TYPES
)


@register(
    "J1_attr_flags_join",
    f"""
WITH a AS (SELECT user_id, count(*) AS n_events, max(value) AS max_value FROM events GROUP BY user_id),
     f AS (SELECT user_id, {_J1_FLAGS} FROM events WHERE value > {_HIGH} GROUP BY user_id)
SELECT a.user_id, a.n_events, a.max_value, {", ".join(f'f."{t}"' for t in EVENT_TYPES)}
FROM a LEFT JOIN f ON a.user_id = f.user_id
""",
)
def j1_attr_flags(spark, sf):
    ev = table(spark, sf, "events")
    attrs = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_value"))
    answers = ev.select("user_id", F.when(F.col("value") > _HIGH, F.col("event_type")).alias("answer"))
    flags = reshape.pivot_flags(answers, "user_id", "answer")
    return joins.left_join(attrs, flags, "user_id")


@register(
    "J2_lookup_join",
    """
WITH l AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice
           FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                              ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
                 FROM orders WHERE o_orderstatus = 'O') t WHERE rn = 1)
SELECT c.c_custkey, c.c_name, c.c_mktsegment, l.o_orderkey AS last_open_order,
       strftime(l.o_orderdate, '%Y-%m-%d') AS last_open_date, l.o_totalprice AS last_open_total
FROM customer c LEFT JOIN l ON c.c_custkey = l.o_custkey
""",
)
def j2_lookup(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    last = latest.latest_per_key(o, "o_custkey", "o_orderdate", tie="o_orderkey").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("last_open_order"),
        date_text("o_orderdate").alias("last_open_date"),
        F.col("o_totalprice").alias("last_open_total"),
    )
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.lookup_join(cust, last, "c_custkey")


@register(
    "J3_fanout_join",
    f"""
WITH r AS (SELECT c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS year, count(*) AS n_orders
           FROM {_ORDERS_NATION} WHERE n.n_regionkey <> 0 GROUP BY 1, 2)
SELECT cu.c_custkey, cu.c_nationkey, r.year, r.n_orders
FROM customer cu LEFT JOIN r ON cu.c_nationkey = r.c_nationkey
""",
)
def j3_fanout(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    per_year = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .where(F.col("n_regionkey") != 0)
        .groupBy("c_nationkey", F.year("o_orderdate").cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.left_join(cust, per_year, "c_nationkey")


# ------------------------------------------------------------------ R: reshape
def _orders_wide(spark, sf, label):
    o = table(spark, sf, "orders").select("o_orderpriority", label.alias("y"))
    labels = reshape.pivot_values(o, "y")
    wide = o.groupBy("o_orderpriority").pivot("y", labels).count()
    return wide.select("o_orderpriority", *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("string").alias(v) for v in labels])


@register(
    "R1_unpivot",
    """
WITH cnt AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS k
             FROM orders GROUP BY 1, 2),
     p AS (SELECT DISTINCT o_orderpriority FROM orders),
     y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT p.o_orderpriority, y.year, 'orders' AS kind, CAST(coalesce(cnt.k, 0) AS DOUBLE) AS n_orders
FROM p CROSS JOIN y LEFT JOIN cnt ON cnt.o_orderpriority = p.o_orderpriority AND cnt.year = y.year
""",
)
def r1_unpivot(spark, sf):
    wide = _orders_wide(spark, sf, F.year("o_orderdate").cast("string"))
    return reshape.unpivot_years(wide, "o_orderpriority", var_name="year", value_name="n_orders",
                                 kind_name="kind", kind="orders")


@register(
    "R2_unpivot_empty",
    """
SELECT CAST(o_orderpriority AS VARCHAR) AS o_orderpriority, CAST(NULL AS INTEGER) AS year,
       CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS DOUBLE) AS n_orders
FROM orders WHERE false
""",
)
def r2_unpivot_empty(spark, sf):
    quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string"))
    wide = _orders_wide(spark, sf, quarter)
    return reshape.unpivot_years(wide, "o_orderpriority", var_name="year", value_name="n_orders",
                                 kind_name="kind", kind="orders")


@register(
    "R3_pivot_flags",
    f"SELECT user_id, {_FLAGS_SQL} FROM events GROUP BY user_id",
)
def r3_pivot(spark, sf):
    return reshape.pivot_flags(table(spark, sf, "events"), "user_id", "event_type")


@register("R4_distinct_ids", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS sessionID FROM events")
def r4_distinct_ids(spark, sf):
    return etl.clean_sessions(contact_raw(spark, sf).select("sessionID", "_ord"))


# ------------------------------------------------------------------ A: aggregates
@register(
    "A1_group_agg",
    """
SELECT user_id, count(*) AS n_events, round(sum(value), 6) AS total_value,
       min(value) AS min_value, max(event_type) AS last_type
FROM events GROUP BY user_id
""",
)
def a1_group_agg(spark, sf):
    ev = table(spark, sf, "events")
    return aggs.group_agg(ev, "user_id", [
        F.count(F.lit(1)).alias("n_events"),
        r6(F.sum("value")).alias("total_value"),
        F.min("value").alias("min_value"),
        F.max("event_type").alias("last_type"),
    ])


@register(
    "A2_first_non_null",
    f"""
SELECT user_id,
       arg_min(value, event_id) FILTER (WHERE event_type <> 'view') AS first_value,
       min(event_id) FILTER (WHERE value > {_HIGH}) AS first_high_event
FROM events GROUP BY user_id
""",
)
def a2_first_non_null(spark, sf):
    ev = table(spark, sf, "events")
    nv = F.when(F.col("event_type") != "view", F.col("value"))
    high = F.when(F.col("value") > _HIGH, F.col("event_id"))
    return ev.groupBy("user_id").agg(
        aggs.first_non_null(nv, "event_id").alias("first_value"),
        aggs.first_non_null(high, "event_id").alias("first_high_event"),
    )


@register(
    "A3_max",
    """
SELECT event_type, max(value) AS max_value,
       max(CASE WHEN event_type <> 'view' THEN value END) AS max_non_view
FROM events GROUP BY event_type
""",
)
def a3_max(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("event_type").agg(
        aggs.max_value("value").alias("max_value"),
        aggs.max_value(F.when(F.col("event_type") != "view", F.col("value"))).alias("max_non_view"),
    )


@register("A4_distinct", "SELECT DISTINCT l_partkey FROM lineitem")
def a4_distinct(spark, sf):
    return aggs.distinct_values(table(spark, sf, "lineitem"), "l_partkey")


@register("A5_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def a5_shape(spark, sf):
    return aggs.shape(table(spark, sf, "lineitem"))


@register(
    "A6_top_values",
    """
SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS count
FROM lineitem GROUP BY 1 ORDER BY count DESC, value ASC LIMIT 10
""",
)
def a6_top_values(spark, sf):
    return profile.top_values(table(spark, sf, "lineitem"), "l_partkey", 10)


_CONTACT_RAW_SQL = """
SELECT 'b''' || CAST(user_id AS VARCHAR) || '''' AS sessionID,
       CASE WHEN event_type <> 'view' THEN 'D' || CAST(event_id AS VARCHAR) END AS DNI,
       CAST(600000000 + user_id AS VARCHAR) AS Telef,
       CAST(user_id AS VARCHAR) AS CP,
       value AS duration_call_mins,
       event_type AS funnel_Q,
       CASE WHEN event_type = 'purchase' THEN 'P' END AS Producto,
       event_id AS _ord
FROM events
"""
_A7_COLS = ("sessionID", "DNI", "Telef", "CP", "duration_call_mins", "funnel_Q", "Producto", "_ord")


@register(
    "A7_null_rate",
    "SELECT * FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_rate "
        f"FROM ({_CONTACT_RAW_SQL}) r"
        for c in _A7_COLS
    )
    + "\n) t ORDER BY null_rate DESC, \"column\" LIMIT 20",
)
def a7_null_rate(spark, sf):
    return profile.null_rates(contact_raw(spark, sf), top=20)


_LINE_NUM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax")


@register(
    "A8_describe",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem"""
        for c in _LINE_NUM
    ),
)
def a8_describe(spark, sf):
    d = profile.describe(table(spark, sf, "lineitem"))
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


_EVENT_NULLS = (
    "SELECT CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, "
    "CASE WHEN event_id % 5 <> 0 THEN value END AS value, user_id FROM events"
)


def _event_nulls(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        "user_id",
    )


@register(
    "A8_describe_refined",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM ({_EVENT_NULLS}) e"""
        for c in ("value", "user_id")
    ),
)
def a8_describe_refined(spark, sf):
    """Columns with nulls, selected over several levels."""
    d = profile.describe(_event_nulls(spark, sf), buckets=16, max_sort_rows=20)
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register(
    "A9_histogram",
    """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
     b AS (SELECT least(CAST(floor((e.value - s.lo) * 30.0 / (s.hi - s.lo)) AS BIGINT) + 1, 30) AS bin
           FROM events e, s),
     c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
     bins AS (SELECT CAST(range + 1 AS INTEGER) AS bin FROM range(30))
SELECT bins.bin, round(s.lo + (bins.bin - 1) * (s.hi - s.lo) / 30, 6) AS lo,
       round(s.lo + bins.bin * (s.hi - s.lo) / 30, 6) AS hi, coalesce(c.n, 0) AS count
FROM bins CROSS JOIN s LEFT JOIN c ON c.bin = bins.bin
""",
)
def a9_histogram(spark, sf):
    h = profile.histogram(table(spark, sf, "events"), "value", 30)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register(
    "A10_boxplot",
    """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3
           FROM events WHERE value IS NOT NULL GROUP BY event_type),
     f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT e.event_type, count(*) AS n, round(any_value(f.q1), 6) AS q1, round(any_value(f.median), 6) AS median,
       round(any_value(f.q3), 6) AS q3,
       min(CASE WHEN e.value BETWEEN f.lf AND f.uf THEN e.value END) AS whisker_lo,
       max(CASE WHEN e.value BETWEEN f.lf AND f.uf THEN e.value END) AS whisker_hi,
       count(*) FILTER (WHERE e.value < f.lf OR e.value > f.uf) AS n_outliers
FROM events e JOIN f ON e.event_type = f.event_type
WHERE e.value IS NOT NULL
GROUP BY e.event_type
""",
)
def a10_boxplot(spark, sf):
    b = profile.boxplot_stats(table(spark, sf, "events"), "value", "event_type")
    return b.select("event_type", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"),
                    "whisker_lo", "whisker_hi", "n_outliers")


@register(
    "A10_boxplot_refined",
    f"""
WITH e AS ({_EVENT_NULLS}),
     q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3
           FROM e WHERE value IS NOT NULL GROUP BY event_type),
     f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT e.event_type, count(*) AS n, round(any_value(f.q1), 6) AS q1, round(any_value(f.median), 6) AS median,
       round(any_value(f.q3), 6) AS q3,
       min(CASE WHEN e.value BETWEEN f.lf AND f.uf THEN e.value END) AS whisker_lo,
       max(CASE WHEN e.value BETWEEN f.lf AND f.uf THEN e.value END) AS whisker_hi,
       count(*) FILTER (WHERE e.value < f.lf OR e.value > f.uf) AS n_outliers
FROM e JOIN f ON e.event_type = f.event_type
WHERE e.value IS NOT NULL
GROUP BY e.event_type
""",
)
def a10_boxplot_refined(spark, sf):
    """Null groups and values, selected over several levels."""
    b = profile.boxplot_stats(_event_nulls(spark, sf), "value", "event_type", buckets=16, max_sort_rows=20)
    return b.select("event_type", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"),
                    "whisker_lo", "whisker_hi", "n_outliers")


_CORR_COLS = _LINE_NUM + ("zero_tax",)


_CORR_PAIRS = [(a, b) for a in _CORR_COLS for b in _CORR_COLS]


@register(
    "A11_corr",
    """
WITH base AS (SELECT *, l_tax * 0 AS zero_tax FROM lineitem),
     w AS (SELECT ["""
    + ", ".join(f"'{a}|{b}'" for a, b in _CORR_PAIRS)
    + """] AS names,
                  ["""
    + ",\n                   ".join(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in _CORR_PAIRS)
    + """] AS vals
           FROM base),
     lng AS (SELECT unnest(names) AS name, unnest(vals) AS r FROM w)
SELECT split_part(name, '|', 1) AS column_a, split_part(name, '|', 2) AS column_b,
       CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS corr
FROM lng
""",
)
def a11_corr(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("zero_tax", F.col("l_tax") * 0)
    c = profile.correlation_long(li, list(_CORR_COLS), digits=None)
    return c.select("column_a", "column_b", r6("corr").alias("corr"))


@register(
    "A12_scatter",
    f"SELECT renta_media, tasa FROM ({FINAL_SQL}) f WHERE renta_media IS NOT NULL AND tasa IS NOT NULL",
)
def a12_scatter(spark, sf):
    return profile.scatter_pairs(_final(spark, sf, ["CP"]), "renta_media", "tasa")


# ------------------------------------------------------------------ P / F: projections, predicates
@register(
    "P1_rename",
    "SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type, p_size, p_retailprice FROM part",
)
def p1_rename(spark, sf):
    p = columns.rename(table(spark, sf, "part"), {"p_name": "name", "p_brand": "brand"})
    return columns.rename_first(p, "part_id")


@register("P2_select", "SELECT p_size, p_partkey, p_retailprice FROM part")
def p2_select(spark, sf):
    return columns.select_columns(table(spark, sf, "part"), ["p_size", "p_partkey", "p_retailprice"])


@register("P3_constant", "SELECT c_custkey, 'tpch' AS source, CAST(NULL AS INTEGER) AS missing FROM customer")
def p3_constant(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    return columns.add_constant(columns.add_constant(c, "source", "tpch"), "missing", None, "int")


@register("P4_resolve", f"SELECT codigo_postal, municipio, periodo, renta_media FROM ({INCOME_ROWS_SQL}) t")
def p4_resolve(spark, sf):
    # the same income rows under other header spellings: upper-case names, 'AÑO' for the
    # period and a padded, differently-cased total column that only the trimmed list knows
    raw = income_raw(spark, sf)
    odd = raw.select(
        F.col("Municipios").alias("MUNICIPIOS"),
        F.col("Indicadores de renta media y mediana").alias("indicador"),
        F.col("Periodo").alias("AÑO"),
        F.col("Total").alias(" Renta Neta Media por Persona "),
        F.lit("x").alias("nota"),
        "_ord",
    )
    return etl.clean_income(odd).drop("_ord")


@register(
    "P5_regex_cols",
    "SELECT replace(lower(n.n_name), 'a', 'à') AS Municipio, "
    + ", ".join(f"count(*) FILTER (WHERE year(o.o_orderdate) = {y}) AS \"{y}\"" for y in range(1995, 2002))
    + f" FROM {_ORDERS_NATION} GROUP BY 1",
)
def p5_regex_cols(spark, sf):
    wide = crime_raw(spark, sf)
    typed = wide.select("Municipio", *[F.col(f"`{c}`").cast("long").alias(c) for c in wide.columns[1:]])
    with_extra = typed.withColumn("total", sum(F.col(f"`{c}`") for c in wide.columns[1:]))
    years = columns.columns_matching(with_extra, r"\d{4}")
    return with_extra.select("Municipio", *[columns.q(y) for y in years])


@register("P6_require", "SELECT c_custkey, c_name FROM customer")
def p6_require(spark, sf):
    c = table(spark, sf, "customer")
    columns.require_columns(c, ["c_custkey", "c_name"])
    return c.select("c_custkey", "c_name")


@register("P7_first_present", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS picked FROM orders")
def p7_first_present(spark, sf):
    o = table(spark, sf, "orders")
    name = columns.first_present(o, ["o_date", "o_orderdate", "o_custkey"])
    return o.select(date_text(columns.q(name)).alias("picked"))


@register("P8_numeric", f"SELECT {', '.join(_LINE_NUM)} FROM lineitem")
def p8_numeric(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*columns.numeric_columns(li))


_ORDER_TYPES = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))


@register(
    "P9_schema_report",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS \"rows\" FROM orders"
        for c, t in _ORDER_TYPES
    ),
)
def p9_schema_report(spark, sf):
    return profile.schema_report(table(spark, sf, "orders"))


@register(
    "P10_slice",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus
FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 5
""",
)
def p10_slice(spark, sf):
    # (l_orderkey, l_linenumber) is not unique in the test data: more keys make it a total order
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return columns.head_slice(table(spark, sf, "lineitem"), 5, 10, order)


@register(
    "F1_drop_null",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders WHERE o_orderstatus <> 'P'",
)
def f1_drop_null(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _nulled_date().alias("d"))
    return columns.drop_null(o, ["d"]).select("o_orderkey", date_text("d").alias("o_orderdate"))


@register(
    "F2_most_frequent",
    """
WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey ASC LIMIT 1)
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM top)
""",
)
def f2_most_frequent(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return columns.keep_most_frequent(li, "l_suppkey")


@register("F3_placeholder", "SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS n_marker FROM orders")
def f3_placeholder(spark, sf):
    o = table(spark, sf, "orders")
    total = F.when(F.col("o_orderstatus") == "P", F.lit(".")).otherwise(spanish_number(F.col("o_totalprice")))
    return columns.count_marker(o.select(total.alias("Total")), "Total", ".")


@register(
    "F4_any_value",
    f"""
SELECT count(DNI) > 0 AS DNI, count(Producto) > 0 AS Producto,
       count(CASE WHEN duration_call_mins > 1000 THEN 'X' END) > 0 AS coupon
FROM ({_CONTACT_RAW_SQL}) r
""",
)
def f4_any_value(spark, sf):
    r = contact_raw(spark, sf).withColumn(
        "coupon", F.when(F.col("duration_call_mins").cast("double") > 1000, F.lit("X"))
    )
    return columns.any_present(r, ["DNI", "Producto", "coupon"])


# ------------------------------------------------------------------ X: scalar functions
@register(
    "X1_extract_code",
    """
SELECT c_custkey,
       nullif(regexp_extract(c_mktsegment || ' ' || CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR),
                             '[0-9]{5}', 0), '') AS code
FROM customer
""",
)
def x1_extract_code(spark, sf):
    c = table(spark, sf, "customer")
    txt = F.concat(F.col("c_mktsegment"), F.lit(" "), F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string"))
    return c.select("c_custkey", X.extract_code(txt).alias("code"))


@register(
    "X3_postcode",
    """
SELECT p_partkey,
       lpad(nullif(regexp_replace(p_brand || '/' || CAST(p_partkey AS VARCHAR), '[^0-9]', '', 'g'), ''), 5, '0') AS cp
FROM part
""",
)
def x3_postcode(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.postcode(F.concat("p_brand", F.lit("/"), F.col("p_partkey").cast("string"))).alias("cp"))


@register("X4_unwrap", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def x4_unwrap(spark, sf):
    c = table(spark, sf, "customer")
    wrapped = F.concat(F.lit("b'\t"), F.col("c_mktsegment"), F.lit("  '"))
    return c.select("c_custkey", X.unwrap_bytes(wrapped).alias("segment"))


@register("X5_local_number", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS amount FROM lineitem")
def x5_local_number(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", N.local_number(spanish_number(F.col("l_extendedprice"))).alias("amount"))


def _mangled_price():
    p = F.col("o_orderpriority")
    return (
        F.when(p == "1-URGENT", F.lit("abc"))
        .when(p == "2-HIGH", F.lit("1d"))
        .when(p == "3-MEDIUM", F.lit("."))
        .when(p == "4-NOT SPECIFIED", F.lit("2,5"))
        .otherwise(F.col("o_totalprice").cast("string"))
    )


@register(
    "X6_to_double",
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') THEN NULL
            ELSE o_totalprice END AS price
FROM orders
""",
)
def x6_to_double(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", N.to_double(_mangled_price()).alias("price"))


@register(
    "X7_to_int",
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN NULL
            ELSE CAST(year(o_orderdate) AS INTEGER) END AS year
FROM orders
""",
)
def x7_to_int(spark, sf):
    o = table(spark, sf, "orders")
    y = F.year("o_orderdate").cast("string")
    p = F.col("o_orderpriority")
    txt = (
        F.when(p == "1-URGENT", F.concat(y, F.lit(".0")))
        .when(p == "2-HIGH", F.concat(y, F.lit(".5")))
        .when(p == "3-MEDIUM", F.concat(F.lit("x"), y))
        .otherwise(y)
    )
    return o.select("o_orderkey", N.to_int(txt).alias("year"))


@register(
    "X8_fold",
    r"""
SELECT doc_id, upper(replace(regexp_replace(strip_accents(text), '^\s+|\s+$', '', 'g'), 'ß', 'ss')) AS folded
FROM documents
""",
)
def x8_fold(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.fold_upper("text").alias("folded"))


@register("X9_trim", "SELECT c_custkey, c_name FROM customer")
def x9_trim(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.trim_ws(F.concat(F.lit("\t "), F.col("c_name"), F.lit("\n  "))).alias("c_name"))


@register(
    "X12_fill",
    "SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_nationkey ELSE 0 END AS nation FROM customer",
)
def x12_fill(spark, sf):
    c = table(spark, sf, "customer")
    v = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_nationkey"))
    return c.select("c_custkey", N.fill_zero_int(v).alias("nation"))


@register(
    "X13_round",
    """
SELECT l_orderkey, l_linenumber,
       CAST(round(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4)), 2) AS DOUBLE) AS discount_amount
FROM lineitem
""",
)
def x13_round(spark, sf):
    li = table(spark, sf, "lineitem")
    amount = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
    return li.select("l_orderkey", "l_linenumber",
                     N.round_to(amount, 2, half_even=False).cast("double").alias("discount_amount"))


@register(
    "X13_round_even",
    """
SELECT l_orderkey, l_linenumber,
       CAST(n // 100 + CASE WHEN n % 100 > 50 OR (n % 100 = 50 AND n // 100 % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE)
           / CAST(100 AS DOUBLE) AS discount_amount
FROM (SELECT l_orderkey, l_linenumber,
             CAST(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4)) * 10000 AS BIGINT) AS n
      FROM lineitem) t
""",
)
def x13_round_even(spark, sf):
    li = table(spark, sf, "lineitem")
    amount = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
    return li.select("l_orderkey", "l_linenumber", N.round_to(amount, 2).cast("double").alias("discount_amount"))


@register(
    "X15_na_words",
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN NULL ELSE o_orderstatus END AS status
FROM orders
""",
)
def x15_na_words(spark, sf):
    o = table(spark, sf, "orders")
    p = F.col("o_orderpriority")
    txt = (
        F.when(p == "1-URGENT", F.lit("NA"))
        .when(p == "2-HIGH", F.lit("null"))
        .when(p == "3-MEDIUM", F.lit(""))
        .otherwise(F.col("o_orderstatus"))
    )
    return o.select("o_orderkey", X.null_markers(txt).alias("status"))



# ------------------------------------------------------------------ helpers covered inside the jobs,
# also checked on their own
@register("X2_strip_code", "SELECT c_custkey, c_name FROM customer")
def x2_strip_code(spark, sf):
    c = table(spark, sf, "customer")
    coded = F.concat(F.lpad(F.col("c_custkey").cast("string"), 5, "0"), F.lit("  "), F.col("c_name"))
    return c.select("c_custkey", X.strip_code(coded).alias("c_name"))


@register(
    "X10_to_text",
    "SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_nationkey AS VARCHAR) END AS nation_text "
    "FROM customer",
)
def x10_to_text(spark, sf):
    c = table(spark, sf, "customer")
    v = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_nationkey"))
    return c.select("c_custkey", X.to_text(v).alias("nation_text"))


@register(
    "X11_zfill",
    """
SELECT p_partkey,
       CASE WHEN length(CAST(p_partkey * 997 AS VARCHAR)) < 5 THEN lpad(CAST(p_partkey * 997 AS VARCHAR), 5, '0')
            ELSE CAST(p_partkey * 997 AS VARCHAR) END AS padded
FROM part
""",
)
def x11_zfill(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.zfill((F.col("p_partkey") * 997).cast("string"), 5).alias("padded"))


@register("X14_header_key", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def x14_header_key(spark, sf):
    # upper-case headers found through lower-cased aliases
    c = table(spark, sf, "customer")
    shouting = c.select(*[F.col(n).alias(n.upper()) for n in c.columns])
    picked = [columns.resolve_column(shouting, [a]) for a in ("c_custkey", "c_name", "c_acctbal")]
    return shouting.select(*[F.col(n).alias(n.lower()) for n in picked])


_R5_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register(
    "R5_transpose",
    """
WITH w AS (SELECT ["""
    + ", ".join(f"'{a}|{b}'" for a in _R5_COLS for b in _R5_COLS)
    + "] AS names, ["
    + ", ".join(f"corr({a}, {b})" for a in _R5_COLS for b in _R5_COLS)
    + """] AS vals FROM lineitem),
     lng AS (SELECT split_part(n, '|', 1) AS a, split_part(n, '|', 2) AS b, r
             FROM (SELECT unnest(names) AS n, unnest(vals) AS r FROM w) u)
SELECT a AS "column", """
    + ", ".join(f"round(max(CASE WHEN b = '{c}' THEN r END), 6) AS {c}" for c in _R5_COLS)
    + """
FROM lng GROUP BY a
""",
)
def r5_transpose(spark, sf):
    m = profile.correlation_matrix(table(spark, sf, "lineitem"), list(_R5_COLS), digits=None)
    return m.select("column", *[r6(c).alias(c) for c in _R5_COLS])


@register(
    "S4_parquet_scan",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'
""",
)
def s4_parquet_scan(spark, sf):
    # column pruning and both predicates reach the Parquet reader (ReadSchema / PushedFilters)
    li = table(spark, sf, "lineitem")
    return li.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


# round trips through files register themselves into the same catalogue
from cauce.plans import roundtrips  # noqa: E402,F401
