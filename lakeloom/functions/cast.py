"""Lenient casts: text to number, id, whole number, date and year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.common import as_column

# Decimal text, optionally signed, with an exponent. It shuts out the forms
# Spark's own cast takes but a text file should not mean (12d, 0x1A).
NUMBER_PATTERN = r"\A\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*\z"
INFINITY_PATTERN = r"\A[+-]?(?i:inf|infinity)\z"
WHOLE_PATTERN = r"\A\s*[+-]?[0-9]+\s*\z"
DATE_FORMAT = "yyyy-M-d"


def lenient_double(c: Column | str, default: float | None = None) -> Column:
    """Number from text; anything else is NULL, or ``default`` if given."""
    c = as_column(c)
    number = c.try_cast("double")
    # A number too large for a double is no number.
    value = (F.when(c.rlike(NUMBER_PATTERN) & (F.abs(number) < float("inf")), number)
             .when(c.rlike(INFINITY_PATTERN), number))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def lenient_int(c: Column | str, default: int | None = 0) -> Column:
    """Number from text cut towards zero."""
    value = lenient_double(c).try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def lenient_id(c: Column | str, on_fraction: str = "raise") -> Column:
    """Nullable whole-number id.

    A fractional or infinite id is an error by default; ``on_fraction="null"``
    makes it NULL instead. Whole-number text never passes through a double, so
    ids above 2**53 stay exact.
    """
    c = as_column(c)
    number = lenient_double(c)
    whole = number.try_cast("bigint")
    otherwise = F.lit(None).cast("bigint")
    if on_fraction == "raise":
        otherwise = F.raise_error(F.concat(F.lit("not a whole-number id: "), c)).cast("bigint")
    elif on_fraction != "null":
        raise ValueError("on_fraction must be 'raise' or 'null'")
    return (F.when(c.rlike(WHOLE_PATTERN), c.try_cast("bigint"))
            .when(number.isNull(), F.lit(None).cast("bigint"))
            .when(whole.cast("double") == number, whole)
            .otherwise(otherwise))


def parse_date(c: Column | str) -> Column:
    """X4 as a DATE: ISO order, one- or two-digit month and day, else NULL."""
    return F.try_to_date(as_column(c), DATE_FORMAT)


def iso_date(c: Column | str) -> Column:
    """Date text in ``YYYY-MM-DD`` form, else NULL."""
    return F.date_format(parse_date(c), "yyyy-MM-dd")


def release_year(c: Column | str) -> Column:
    """Year of a date text, 0 when there is none."""
    return F.coalesce(F.year(parse_date(c)), F.lit(0)).cast("bigint")
