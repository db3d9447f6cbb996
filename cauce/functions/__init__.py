"""Scalar Column helpers."""

from cauce.functions.numbers import fill_zero_int, local_number, round_to, to_double, to_int
from cauce.functions.text import (
    NA_WORDS,
    extract_code,
    fold_accents,
    fold_upper,
    null_markers,
    postcode,
    strip_code,
    to_text,
    trim_ws,
    unwrap_bytes,
    zfill,
)

__all__ = [
    "NA_WORDS",
    "extract_code",
    "fill_zero_int",
    "fold_accents",
    "fold_upper",
    "local_number",
    "null_markers",
    "postcode",
    "round_to",
    "strip_code",
    "to_double",
    "to_int",
    "to_text",
    "trim_ws",
    "unwrap_bytes",
    "zfill",
]
