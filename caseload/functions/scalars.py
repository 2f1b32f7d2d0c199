"""Column expressions shared by all layers. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MICROS_PER_DAY = 86_400_000_000
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)$"


def column(ref: Column | str) -> Column:
    return F.col(ref) if isinstance(ref, str) else ref


def ratio(
    numerator: Column | str,
    denominator: Column | str,
    *,
    on_zero: str = "zero",
    scale: float | None = None,
    digits: int | None = None,
) -> Column:
    """numerator / denominator as a double; a missing operand gives NULL.

    A zero denominator gives 0 (`on_zero="zero"`, the published form) or NULL
    (`on_zero="null"`, the form used to validate a source percentage).
    `scale` multiplies the quotient and `digits` rounds it.
    """
    if on_zero not in ("zero", "null"):
        raise ValueError(f"on_zero must be 'zero' or 'null', not {on_zero!r}")
    top, bottom = column(numerator).cast("double"), column(denominator).cast("double")
    zero_case = F.when(top.isNotNull(), F.lit(0.0)) if on_zero == "zero" else F.lit(None)
    quotient = F.when(bottom == 0, zero_case.cast("double")).otherwise(top / bottom)
    if scale is not None:
        quotient = quotient * F.lit(float(scale))
    return quotient if digits is None else F.round(quotient, digits)


def epoch_micros_to_date(micros: Column | str) -> Column:
    """Date of an epoch-microsecond count, whatever the session time zone."""
    value = column(micros).cast("bigint")
    days = (value - F.pmod(value, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def date_to_epoch_micros(day: Column | str) -> Column:
    """Epoch microseconds of a date's midnight UTC, whatever the session time zone."""
    return F.unix_date(column(day)).cast("bigint") * F.lit(MICROS_PER_DAY)


def round_to_long(value: Column | str) -> Column:
    """Integer cast that rounds halves away from zero (a bare Spark cast truncates)."""
    return F.round(column(value)).cast("bigint")


def missing_to_null(value: Column | str) -> Column:
    """NaN marks a missing cell in spreadsheet frames; Spark would keep it as a value."""
    return F.nanvl(column(value), F.lit(None).cast("double"))


def number_or_null(text: Column | str) -> Column:
    """A text cell as a double; NULL unless the whole stripped cell is a plain number."""
    return F.regexp_extract(strip(text), NUMBER, 1).try_cast("double")


def strip(text: Column | str) -> Column:
    """Drop white space of every kind from both ends (a bare `trim` drops blanks only)."""
    return F.trim(column(text), F.lit(WHITE_SPACE))


def clean_text(text: Column | str) -> Column:
    """A cell on one line: newlines become blanks, then both ends are stripped."""
    return strip(F.replace(column(text), F.lit("\n"), F.lit(" ")))


def has_fraction(value: Column | str) -> Column:
    """True when a value is not whole; a missing value counts as whole."""
    return F.coalesce(column(value) % 1 != 0, F.lit(False))
