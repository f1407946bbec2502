"""Key ranges with near-equal numbers of rows, for scans that are split by predicates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.operators.order_stats import column_ranges, values_at

_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def range_bounds(df: DataFrame, key: str, parts: int) -> list[float]:
    """Lower bounds of the second and later ranges: the keys at every ``1/parts`` of the sorted rows.

    A key that fills several ranges is a bound once, so there may be fewer ranges. Found from counts
    alone, see ``values_at``.
    """
    ranges = column_ranges(df, [key])
    if not ranges:
        return []
    n, low, _ = ranges[key]
    places = [n * i // parts for i in range(1, parts)]
    found = set(values_at(df, {key: places}, ranges).values()) - {low}
    whole = dict(df.dtypes)[key] in _WHOLE
    return sorted(math.ceil(v) if whole else v for v in found)


def range_predicates(df: DataFrame, key: str, parts: int) -> list[str]:
    """SQL predicates that cut the rows by a numeric ``key`` into near-equal ranges.

    Every row passes exactly one, rows without a key the last. A key with more rows than a range should
    have begins a range and shares it with as few others as possible. They suit the ``predicates`` of
    ``read_table``; ``df`` then needs only the key column.
    """
    bounds = range_bounds(df, key, parts)
    ends = [None, *bounds], [*bounds, None]
    found = []
    for low, high in zip(*ends):
        tests = [f"{key} >= {low!r}"] if low is not None else []
        tests += [f"{key} < {high!r}"] if high is not None else []
        found.append(" AND ".join(tests) or f"{key} IS NOT NULL")
    return [*found, f"{key} IS NULL"]


def range_number(key: str, bounds: list[float]) -> Column:
    """The number of a row's range, from 0; NULL without a key."""
    above = sum(((F.col(key) >= F.lit(b)).cast("int") for b in bounds), F.lit(0))
    return F.when(F.col(key).isNotNull(), above)
