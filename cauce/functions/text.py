"""Text scalars: codes, trimming, byte-literal unwrapping, accent folding, null markers.

All helpers take and return ``Column`` and use only JVM built-ins, so they stay inside
whole-stage codegen. Strings may be given for column names.
"""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- X9 ------------------------------------------------------------------------------
# Every character Python's str.strip() removes (str.isspace), generated from that rule.
WHITESPACE = "".join(chr(cp) for cp in range(0x110000) if chr(cp).isspace())


def trim_ws(col: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace exactly as Python's ``str.strip()`` (tab, newline,
    NBSP, ideographic space, ...). ``trim(BOTH chars FROM s)`` looks at the two ends only;
    plain ``F.trim`` would remove the ASCII space alone."""
    return F.trim(_c(col), F.lit(WHITESPACE))


# --- X1 / X2 -------------------------------------------------------------------------
def extract_code(col: ColumnOrName, digits: int = 5) -> Column:
    """First run of ``digits`` consecutive digits anywhere in the text; null when none.

    A longer run yields its first ``digits`` characters.
    """
    return F.regexp_substr(_c(col), F.lit(f"[0-9]{{{digits}}}"))


def strip_code(col: ColumnOrName, digits: int = 5) -> Column:
    """Drop a leading code and the spaces after it, then trim: ``"28001 Acebeda, La"`` ->
    ``"Acebeda, La"``."""
    return trim_ws(F.regexp_replace(_c(col), rf"^[0-9]{{{digits}}}(?U)\s*", ""))


# --- X3 / X11 ------------------------------------------------------------------------
def postcode(col: ColumnOrName, width: int = 5) -> Column:
    """Keep digits only, left-pad with zeros to ``width`` and cut to ``width``.

    Null or digit-free input gives null (``lpad('')`` alone would give ``00000``).
    """
    digits = F.regexp_replace(_c(col), "[^0-9]", "")
    return F.lpad(F.nullif(digits, F.lit("")), width, "0")


def zfill(col: ColumnOrName, width: int = 5) -> Column:
    """Left-pad with zeros up to ``width``; longer values are left untouched."""
    c = _c(col)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


# --- X4 ------------------------------------------------------------------------------
def unwrap_bytes(col: ColumnOrName) -> Column:
    """Text that rendered a bytes literal (``b'AAA'``) back to ``AAA``, trimmed."""
    c = F.regexp_replace(_c(col), "^b'", "")
    return trim_ws(F.regexp_replace(c, "'$", ""))


# --- X10 -----------------------------------------------------------------------------
def to_text(col: ColumnOrName) -> Column:
    """Cast to string; nulls stay null (no ``"nan"`` / ``"None"`` text)."""
    return _c(col).cast("string")


# --- X8 ------------------------------------------------------------------------------
_LAST = 0x30000  # no character beyond has a fold or a case
def _fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    """Build the accent-fold mapping from ``unicodedata`` for every character that has one.

    For each character the NFKD form without combining marks is computed. One-character
    results go into a ``translate`` pair, empty results (the marks) are deleted, longer results of
    Latin text (``¼`` -> ``1⁄4``, ``ﬁ`` -> ``fi``) become ``replace`` calls.
    """
    src, dst, multi, dropped = [], [], [], []
    for cp in range(0x80, _LAST):
        if 0xD800 <= cp < 0xE000 or 0xAC00 <= cp < 0xD7A4:  # surrogates; Hangul syllables fold to several
            continue
        ch = chr(cp)
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if folded == ch:
            continue
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif not folded:
            dropped.append(ch)
        elif cp < 0x250 or 0x1E00 <= cp < 0x1F00 or 0xFB00 <= cp < 0xFB07:
            multi.append((ch, folded))
    # translate(): characters of `from` beyond the length of `to` are deleted
    return "".join(src) + "".join(dropped), "".join(dst), multi


_FOLD_FROM, _FOLD_TO, _FOLD_MULTI = _fold_tables()
_ANY_MULTI = "[" + "".join(ch for ch, _ in _FOLD_MULTI) + "]"
_NOT_ASCII = r"[^\x00-\x7F]"


def fold_accents(col: ColumnOrName) -> Column:
    """NFKD + drop combining marks. ASCII values are returned as they are; only values that hold a
    character with a longer form pay for the replacements. Hangul and the longer forms outside Latin
    text (squared words, say) are left as they are."""
    c = _c(col)
    longer = c
    for ch, rep in _FOLD_MULTI:
        longer = F.replace(longer, F.lit(ch), F.lit(rep))
    folded = F.translate(F.when(c.rlike(_ANY_MULTI), longer).otherwise(c), _FOLD_FROM, _FOLD_TO)
    return F.when(c.rlike(_NOT_ASCII), folded).otherwise(c)


def fold_upper(col: ColumnOrName, exact: bool = False) -> Column:
    """Join key for names: accent fold, trim, upper case; null becomes ``""``.

    ``upper`` follows full case mapping (``ß`` -> ``SS``), like Python's ``str.upper``.
    The default runs inside the JVM and folds every character whose fold is one character or none, and
    Latin text wholly. ``exact=True`` applies full Unicode NFKD through a vectorised pandas UDF, for
    Hangul and rare compatibility forms; it is the slow path (Arrow batches to Python workers).
    """
    if exact:
        return _fold_upper_udf(_c(col))
    folded = trim_ws(fold_accents(col))
    parked = F.translate(folded, _NO_UPPER, _PARKED)
    raised = F.when(folded.rlike(_NOT_ASCII), F.translate(F.upper(parked), _PARKED, _NO_UPPER)).otherwise(F.upper(folded))
    return F.coalesce(raised, F.lit(""))


# Characters that the fold leaves and Python's str.upper doesn't change, though they are lowercase
# letters, generated from Python's Unicode data. The JVM's newer data upper-cases a few of them
# (U+019B), so they are parked on private-use code points while upper() runs.
_NO_UPPER = "".join(
    chr(cp)
    for cp in range(0x20, _LAST)
    if unicodedata.category(chr(cp)) == "Ll" and chr(cp).upper() == chr(cp) and unicodedata.normalize("NFKD", chr(cp)) == chr(cp)
)
_PARKED = "".join(chr(0xE000 + i) for i in range(len(_NO_UPPER)))


_COMBINING = None


def _fold_upper_series(s):
    """pandas side of ``fold_upper(exact=True)``: NFKD, drop combining marks, strip, upper."""
    global _COMBINING
    if _COMBINING is None:
        _COMBINING = {cp: None for cp in range(sys.maxunicode + 1) if unicodedata.combining(chr(cp))}
    folded = s.str.normalize("NFKD").str.translate(_COMBINING).str.strip().str.upper()
    return folded.fillna("")


@F.pandas_udf(StringType())
def _fold_upper_udf(s: pd.Series) -> pd.Series:
    return _fold_upper_series(s)


# --- X15 -----------------------------------------------------------------------------
# The default missing-value words of the pandas CSV reader, which the
# reference applies implicitly at every text load.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_markers(col: ColumnOrName, words: tuple[str, ...] = NA_WORDS) -> Column:
    """Null when the cell is one of the missing-value words, else the cell unchanged."""
    c = _c(col)
    return F.when(~c.isin(*words), c)


def _ship_by_value() -> None:
    """Functions of this module run inside Python workers (mapInPandas / pandas UDF).
    Serialise them by value so executors need numpy/pandas only, not this package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
