"""The batch jobs (D1-D6): raw load, income / crime / session cleaning, integration.

Each ``clean_*`` / ``integrate`` function is a pure DataFrame -> DataFrame transformation
(testable on any input); the ``*_task`` wrappers read and write the dataset layout.
Written tables (raw, clean, final) cut the lineage between stages, so a lost executor
recomputes at most one stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions.numbers import local_number, to_double
from cauce.functions.text import extract_code, fold_upper, postcode, strip_code, to_text, trim_ws, unwrap_bytes
from cauce.operators.aggs import first_non_null
from cauce.operators.columns import first_in_order, q, require_columns, resolve_column
from cauce.operators.joins import DEFAULT_BROADCAST_BYTES, left_join, lookup_join
from cauce.operators.latest import latest_per_key
from cauce.operators.reshape import distinct_keys, flag_columns, flag_names, pivot_values, unpivot_years
from cauce.sources.delimited import ORD, read_delimited, read_with_preamble
from cauce.sources.layout import SOURCES, Layout
from cauce.sources.sinks import write_csv, write_parquet
from cauce.session import release_persisted

# Header names the income cleaning recognises.
INCOME_MUNI_ALIASES = ("municipios",)
INCOME_PERIOD_ALIASES = ("periodo", "año", "anio")
INCOME_TOTAL_NAMES = ("total", "total ", "renta neta media por persona", "renta_media", "total,")
# Session attributes in output order; those in SESSION_MAX take the maximum,
# the others the first non-null value in file order.
SESSION_ATTRIBUTES = ("DNI", "Telef", "CP", "duration_call_mins", "Producto")
SESSION_MAX = ("duration_call_mins",)


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ORD]


# --- D1 ------------------------------------------------------------------------------
def read_raw_source(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    """The raw scan of one input: crime files have a preamble, the others do not."""
    if source == "delitos":
        return read_with_preamble(spark, layout.csv(source), token="Municipio", sep=";")
    return read_delimited(spark, layout.csv(source), sep=";")


def load_raw(
    spark: SparkSession,
    layout: Layout,
    only: str = "all",
    codec: str = "zstd",
    level: int | None = 7,
) -> dict[str, str]:
    """Text inputs -> raw Parquet (all text columns + ``_ord``). ``only`` is ``all``
    or one source name; anything else raises ``ValueError``."""
    if only != "all" and only not in SOURCES:
        raise ValueError(f"unknown source {only!r}; expected 'all' or one of {SOURCES}")
    chosen = SOURCES if only == "all" else (only,)
    out = {}
    for source in chosen:
        out[source] = write_parquet(read_raw_source(spark, layout, source), layout.raw(source), codec, level)
    return out


# --- D2 ------------------------------------------------------------------------------
def clean_income(raw: DataFrame, indicator: str | None = None) -> DataFrame:
    """(codigo_postal, municipio, periodo:int, renta_media:double, _ord).

    Municipality column by name (else the first column, code kept in the name); period
    by ``periodo``/``año``/``anio``; amount by the total-name list (else the last
    column), parsed as a Spanish-formatted number. Rows without a 5-digit code are dropped.
    ``indicator`` keeps only rows whose indicator column (first header starting with
    ``indicador``) equals that text; by default every indicator row is kept and, per postal
    code and period, the last one in file order wins downstream.
    """
    if indicator is not None:
        ind = next((c for c in raw.columns if c.strip().lower().startswith("indicador")), None)
        if ind is None:
            raise KeyError("no indicator column to filter on")
        raw = raw.where(trim_ws(q(ind)) == indicator)
    view = raw.select(*[q(c) for c in _data_columns(raw)])
    muni = resolve_column(view, INCOME_MUNI_ALIASES)
    period = resolve_column(view, INCOME_PERIOD_ALIASES)
    total = first_in_order(view, INCOME_TOTAL_NAMES) or view.columns[-1]
    if muni is not None:
        code, name = extract_code(q(muni)), strip_code(q(muni))
    else:
        first = view.columns[0]
        code, name = extract_code(q(first)), to_text(q(first))
    cols = [
        code.alias("codigo_postal"),
        name.alias("municipio"),
        # a fractional period (2019.5) lies in its year; as null it would count as the latest
        (F.floor(to_double(q(period))).try_cast("int") if period else F.lit(None).cast("int")).alias("periodo"),
        local_number(q(total)).alias("renta_media"),
    ]
    if ORD in raw.columns:
        cols.append(F.col(ORD))
    return raw.select(*cols).where(F.col("codigo_postal").isNotNull())


# --- D3 ------------------------------------------------------------------------------
def clean_crime(raw: DataFrame, decimal: str = ".") -> DataFrame:
    """D3: wide crime table -> (municipio, anio:int, tipo_delito='total', tasa:double).
    ``decimal=","`` reads rates such as ``"2,5"``; by default they become null."""
    view = raw.select(*[q(c) for c in _data_columns(raw)])
    first = view.columns[0]
    named = view.withColumnRenamed(first, "municipio").withColumn("municipio", trim_ws(q("municipio")))
    return unpivot_years(named, "municipio", decimal=decimal)


# --- D4 ------------------------------------------------------------------------------
def clean_sessions(
    raw: DataFrame,
    flag_values: Sequence[str] | None = None,
    flag_prefix: str | None = None,
    order: str = ORD,
    decimal: str = ".",
) -> DataFrame:
    """One row per session: attributes plus one 0/1 column per answer value.

    ``DNI``, ``Telef``, ``CP``, ``Producto``: first non-null value in ``order``;
    ``duration_call_mins``: maximum. Flags are null for a session without any answer.
    ``decimal=","`` reads durations such as ``"2,5"`` (default: null).
    Absent attribute columns are skipped; ``sessionID`` is required. Everything is one
    aggregate, i.e. a single shuffle on ``sessionID`` with map-side partial aggregation.
    """
    require_columns(raw, ["sessionID"])
    cols = raw.columns
    prepared = raw.withColumn("sessionID", unwrap_bytes(q("sessionID")))
    if "CP" in cols:
        prepared = prepared.withColumn("CP", postcode(q("CP")))
    if "duration_call_mins" in cols:
        prepared = prepared.withColumn("duration_call_mins", to_double(q("duration_call_mins"), decimal))
    prepared = prepared.where(F.col("sessionID").isNotNull())
    attrs, names = [], []
    for c in SESSION_ATTRIBUTES:
        if c not in cols:
            continue
        names.append(c)
        if c in SESSION_MAX:
            attrs.append(F.max(q(c)).alias(c))
        else:
            attrs.append(first_non_null(q(c), F.col(order)).alias(c))
    flags = []
    if "funnel_Q" in cols:
        values = list(flag_values) if flag_values is not None else pivot_values(prepared, "funnel_Q")
        fnames = flag_names(values, ["sessionID", *names], flag_prefix)
        flags = flag_columns("funnel_Q", values, fnames)
    return prepared.groupBy("sessionID").agg(*attrs, *flags) if (attrs or flags) else (
        distinct_keys(prepared, "sessionID")
    )


# --- D5 ------------------------------------------------------------------------------
def latest_income(renta: DataFrame, nulls: str = "latest") -> DataFrame:
    """Latest income row per postal code, with the normalised municipality key."""
    tie = ORD if ORD in renta.columns else None
    last = latest_per_key(renta, "codigo_postal", "periodo", tie=tie, nulls=nulls)
    return last.select(
        F.col("codigo_postal").alias("CP"),
        "municipio",
        fold_upper(F.col("municipio")).alias("municipio_norm"),
        "periodo",
        "renta_media",
    )


def integrate(
    contact: DataFrame,
    renta: DataFrame,
    delitos: DataFrame,
    broadcast: str = "auto",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """D5 (flagship): sessions + latest income by ``CP`` + crime rows by normalised
    municipality (each session repeats once per matching crime row).

    Both right sides are measured and broadcast when small (then the session table is
    never shuffled); otherwise AQE plans a shuffle join and splits skewed keys.
    """
    income = latest_income(renta)
    merged = lookup_join(
        contact,
        income,
        "CP",
        rename={"municipio": "municipio_renta", "periodo": "periodo_renta"},
        broadcast=broadcast,
        max_broadcast_bytes=max_broadcast_bytes,
        check_unique=False,  # one row per key by construction
    )
    crime = delitos.select(
        fold_upper(F.col("municipio")).alias("municipio_norm"), "anio", "tipo_delito", "tasa"
    )
    return left_join(merged, crime, "municipio_norm", broadcast=broadcast, max_broadcast_bytes=max_broadcast_bytes)


# --- task wrappers / D6 --------------------------------------------------------------
def clean_task(spark: SparkSession, layout: Layout, source: str) -> str:
    raw = spark.read.parquet(layout.raw(source)).drop("batch_id")  # folder column of a streamed load
    fn = {"renta": clean_income, "delitos": clean_crime, "contact": clean_sessions}[source]
    try:
        return write_parquet(fn(raw), layout.clean(source))
    finally:
        release_persisted()


def integrate_task(spark: SparkSession, layout: Layout, single_file: bool = False) -> str:
    read = lambda s: spark.read.parquet(layout.clean(s))
    try:
        final = integrate(read("contact"), read("renta"), read("delitos"))
        return write_csv(final, layout.final(), single_file=single_file)
    finally:
        release_persisted()


def run_all(
    spark: SparkSession, layout: Layout, source: str = "all", parallel: bool = True, single_file: bool = False
) -> str:
    """Load (``source``) -> clean x3 -> integrate. Returns the final CSV path
    (``single_file``: one CSV part, for results known to be small).

    The three loads and the three cleanings are independent, so with ``parallel`` each
    group is submitted as concurrent Spark jobs (one driver thread each); small sources
    then overlap with the large one instead of queueing behind it.
    """
    if source != "all" and source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; expected 'all' or one of {SOURCES}")
    _each(lambda s: load_raw(spark, layout, only=s), SOURCES if source == "all" else (source,), parallel)
    _each(lambda s: clean_task(spark, layout, s), SOURCES, parallel)
    return integrate_task(spark, layout, single_file=single_file)


def _each(fn, items, parallel: bool) -> list:
    if not parallel:
        return [fn(i) for i in items]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(fn, items))
