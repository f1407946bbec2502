"""Numeric helpers shared by features, targets and profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_target(value: Column | str) -> Column:
    """log(1 + x), the scale the model is trained on."""
    return F.log1p(_col(value))


def real_units(value: Column | str) -> Column:
    """Inverse of :func:`log_target`."""
    return F.expm1(_col(value))


def flag_int(flag: Column | str) -> Column:
    """Boolean as 0/1 with NULL as 0."""
    return F.coalesce(_col(flag).cast("int"), F.lit(0))


def nan_to_null(value: Column | str) -> Column:
    """NaN as NULL."""
    value = _col(value)
    return F.when(~F.isnan(value), value)


def percent(part: Column | str, whole: Column | str, decimals: int = 1) -> Column:
    """100 * part / whole, rounded; NULL when the whole is zero."""
    return F.round(F.try_divide(_col(part) * F.lit(100.0), _col(whole).cast("double")), decimals)
