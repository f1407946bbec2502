"""Partial registry dates, durations and recruitment velocity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Average days per month and the date that stands for "no date".
DAYS_PER_MONTH = 30.44
NO_DATE = "1970-01-01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partial_date(text: Column | str, strict: bool = False) -> Column:
    """``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` text as a date; anything else is NULL.

    The default reads whatever Spark's own date cast reads once the text is padded.
    ``strict`` trims first and accepts the three spelled-out shapes only.
    """
    text = _col(text)
    if strict:
        text = F.trim(text)
        shape = text.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$")
        text = F.when(shape, text)
    size = F.length(text)
    padded = (
        F.when(size == 4, F.concat(text, F.lit("-01-01")))
        .when(size == 7, F.concat(text, F.lit("-01")))
        .otherwise(text)
    )
    return F.try_to_date(padded)


def has_date(date: Column | str, sentinel_compat: bool = True) -> Column:
    """True for a usable date. ``sentinel_compat`` also rejects the 1970-01-01 placeholder."""
    date = _col(date)
    known = date.isNotNull()
    if sentinel_compat:
        known = known & (date != F.lit(NO_DATE).cast("date"))
    return known


def duration_months(start: Column | str, end: Column | str) -> Column:
    """Length of the enrolment period in months, two decimals."""
    return F.round(F.datediff(_col(end), _col(start)) / F.lit(DAYS_PER_MONTH), 2)


def recruitment_velocity(enrolled: Column | str, months: Column | str) -> Column:
    """Participants per month, four decimals; NULL for a zero duration."""
    return F.round(F.try_divide(_col(enrolled).cast("double"), _col(months)), 4)
