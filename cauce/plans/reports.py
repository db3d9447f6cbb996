"""The two exploration flows as DataFrame reports (no drawing): each entry is a lazy
DataFrame that a caller shows, saves or plots. Sections whose inputs are missing or empty
are left out, as the notebooks skip those cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cauce.operators import aggs, columns, profile
from cauce.operators.reshape import pivot_flags
from cauce.sources import delimited as S
from cauce.sources.layout import Layout

# Municipality column names tried in order by the analysis report.
MUNICIPALITY_COLUMNS = ("municipio_renta", "municipio", "municipio_delitos")


def analysis_report(df: DataFrame, top: int = 10, bins: int = 30) -> dict[str, DataFrame]:
    """Report over the integrated table: shape, schema, null rates, descriptive statistics,
    top products, income histogram, call duration by product, calls per municipality,
    income vs. crime pairs and the correlation matrix."""
    out: dict[str, DataFrame] = {
        "shape": aggs.shape(df),
        "schema": profile.schema_report(df),
        "null_rates": profile.null_rates(df, top=20),
    }
    numeric = columns.numeric_columns(df)
    if numeric:
        out["describe"] = profile.describe(df, numeric)
        out["correlation"] = profile.correlation_matrix(df, numeric, digits=3)
    present = {}
    wanted = [c for c in ("renta_media", "duration_call_mins", "tasa") if c in df.columns]
    if wanted:
        row = columns.any_present(df, wanted).first()
        present = {c: bool(row[c]) for c in wanted}
    if "Producto" in df.columns:
        out["top_products"] = profile.top_values(df, "Producto", top)
        if present.get("duration_call_mins"):
            out["duration_by_product"] = profile.boxplot_stats(df, "duration_call_mins", "Producto")
    if present.get("renta_media"):
        out["income_histogram"] = profile.histogram(df, "renta_media", bins)
    muni = columns.first_present(df, MUNICIPALITY_COLUMNS)
    if muni:
        out["top_municipalities"] = profile.top_values(df, muni, top)
    if present.get("renta_media") and present.get("tasa"):
        out["income_vs_crime"] = profile.scatter_pairs(df, "renta_media", "tasa")
    return out


def exploration_report(
    spark: SparkSession, layout: Layout, encoding: str = "ISO-8859-1", preview: int = 10
) -> dict[str, DataFrame]:
    """Report over the raw exports: income preview, period values and ``"."`` placeholder
    count; the first raw lines of the crime export; call-centre preview, types, rows per
    session, answer frequencies, the busiest session's rows and a flag-pivot preview."""
    out: dict[str, DataFrame] = {}
    renta, _ = S.read_sniffed(spark, layout.csv("renta"), encoding=encoding)
    if renta is not None:
        out["renta_head"] = renta.orderBy(S.ORD).limit(preview).drop(S.ORD)
        period = columns.resolve_column(renta, ["periodo"])
        if period:
            out["renta_periods"] = aggs.distinct_values(renta, period).orderBy(period).limit(preview)
        total = columns.resolve_column(renta, ["total"])
        if total:
            # the placeholder is counted on the text as read, before missing-value words apply
            raw_total = S.read_delimited(spark, layout.csv("renta"), encoding=encoding, na_words=False)
            out["renta_placeholders"] = columns.count_marker(raw_total, total, ".")
    out["delitos_raw_lines"] = S.preview_lines(spark, layout.csv("delitos"), 20, encoding)
    contact, _ = S.read_sniffed(spark, layout.csv("contact"), encoding=encoding)
    if contact is not None:
        data = contact.drop(S.ORD)
        out["contact_head"] = contact.orderBy(S.ORD).limit(preview).drop(S.ORD)
        out["contact_types"] = profile.schema_report(data)
        if "sessionID" in data.columns:
            out["rows_per_session"] = profile.top_values(data, "sessionID", 15)
            out["busiest_session"] = columns.keep_most_frequent(contact, "sessionID").orderBy(S.ORD).limit(
                preview
            ).drop(S.ORD)
            if "funnel_Q" in data.columns:
                out["answer_frequencies"] = profile.top_values(data, "funnel_Q", 20)
                flags = pivot_flags(data, "sessionID", "funnel_Q")
                out["pivot_preview"] = columns.head_slice(flags, 5, 10, ["sessionID"])
    return out


__all__ = ["analysis_report", "exploration_report"]
