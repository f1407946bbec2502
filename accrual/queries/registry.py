"""Where driver queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual.session import prepare

QueryFn = Callable[[SparkSession, str], DataFrame]

# Added before rounding an average: two engines sum in different orders, so a value that lies on a
# rounding boundary would go up in one and down in the other.
NUDGE = 1e-9


def settled(column: str) -> Column:
    """An average at six decimals, equal in both engines."""
    return F.round(F.col(column) + F.lit(NUDGE), 6).alias(column)


_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def prepared(fn: QueryFn) -> QueryFn:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    return run


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = prepared(fn)
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def callables() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
