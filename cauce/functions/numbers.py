"""Numeric parsing scalars. All lenient: bad input gives null, never an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cauce.functions.text import ColumnOrName, _c

# Decimal text accepted by a lenient numeric parse: optional sign, digits with an optional
# fraction (or a bare fraction), optional exponent, or infinity; blanks around. Spark's
# cast alone would also accept Java float suffixes such as '1d' or '2f' and hex floats.
_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def to_double(col: ColumnOrName, decimal: str = ".") -> Column:
    """Text -> double, null when not a number (pandas ``to_numeric(errors="coerce")``).

    ``decimal=","`` reads ``"2,5"`` as 2.5; by default a comma makes the value null.
    """
    c = _c(col).cast("string")
    if decimal != ".":
        c = F.translate(c, decimal, ".")
    parsed = F.trim(c).try_cast("double")
    # a finite-looking number beyond the double range overflows to infinity in Spark;
    # pandas treats it as unparseable, so only spelled-out infinities stay infinite
    overflow = (F.abs(parsed) == F.lit(float("inf"))) & ~c.rlike("(?i)inf")
    # pandas also rejects a decimal exponent above 308 once adjusted for fraction digits
    # (and for integer digits past 17 significant ones), even for a zero mantissa ('0e309')
    return F.when(c.rlike(_NUMBER) & ~overflow & ~_exponent_too_large(c), parsed)


def _exponent_too_large(c: Column) -> Column:
    int_digits = F.length(F.regexp_extract(c, r"^\s*[+-]?([0-9]*)", 1))
    frac_digits = F.length(F.regexp_extract(c, r"\.([0-9]*)", 1))
    kept_decimals = F.least(frac_digits, F.greatest(F.lit(17) - int_digits, F.lit(0)))
    extra_int = F.greatest(int_digits - 17, F.lit(0))
    exp_text = F.regexp_extract(c, r"[eE]([+-]?[0-9]+)", 1)
    exp_value = exp_text.try_cast("long")
    # an exponent too long for a long is only harmful when positive
    explicit = F.coalesce(exp_value, F.when(~exp_text.startswith("-"), F.lit(10**9)).otherwise(F.lit(-(10**9))))
    effective = explicit - kept_decimals + extra_int
    return c.rlike("[eE]") & (effective > 308)


def to_int(col: ColumnOrName) -> Column:
    """Text -> nullable int. ``"2019.0"`` and ``"2019"`` both give 2019; fractions
    such as ``"2019.5"`` give null."""
    d = to_double(col)
    return F.when(d == F.floor(d), d.try_cast("int"))


def local_number(col: ColumnOrName, decimal: str = ",", grouping: str = ".") -> Column:
    """Locale-formatted number -> double (``"13.999"`` -> 13999.0, ``"1.234,56"`` ->
    1234.56, ``"."`` -> null).

    Grouping marks are removed, the decimal mark becomes ``.``, every other character
    except digits, ``.`` and ``-`` is removed, then the rest is parsed leniently.
    """
    c = _c(col).cast("string")
    # translate maps `decimal` to '.', and deletes `grouping` (no counterpart in `to`)
    c = F.translate(c, decimal + grouping, ".")
    c = F.regexp_replace(c, r"[^0-9.\-]", "")
    return to_double(c)


def fill_zero_int(col: ColumnOrName) -> Column:
    """Null -> 0, as int."""
    return F.coalesce(_c(col), F.lit(0)).cast("int")


def round_to(col: ColumnOrName, digits: int, half_even: bool = True) -> Column:
    """Round to ``digits`` decimals; half-even like pandas/numpy by default."""
    return F.bround(_c(col), digits) if half_even else F.round(_c(col), digits)
