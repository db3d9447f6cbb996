"""cauce: Spark-native ingest, cleaning, reshape, enrichment and profiling operators.

Every operator is a plain function over ``DataFrame`` / ``Column`` built from Spark SQL
built-ins, so Catalyst plans it and whole-stage codegen runs it.

Sub-packages
    functions   scalar Column -> Column helpers (codes, numbers, text folding)
    sources     delimited-text scans, preamble handling, dataset layout, sinks
    operators   projections, joins, aggregates, latest-per-key, reshape, profiling
    plans       the cleaning / integration jobs composed from the operators
    streaming   incremental (file-stream) form of the raw load
"""

from cauce.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
