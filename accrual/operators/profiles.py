"""Column profiles as tidy rows; all columns of one kind share one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrual.functions.numbers import percent
from accrual.operators.order_stats import approximate_quantiles, interpolated_quantiles
from accrual.operators.values import long_counts
from accrual.session import durable

# Profile thresholds.
HIGH_CARDINALITY = 20
DOMINANT_SHARE = 0.95
OUTLIER_FACTOR = 10
QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99}

_NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def column_kinds(df: DataFrame) -> dict[str, list[str]]:
    """Column names by kind: ``numeric``, ``boolean`` or ``categorical`` (everything else)."""
    kinds: dict[str, list[str]] = {"numeric": [], "boolean": [], "categorical": []}
    for name, dtype in df.dtypes:
        if dtype == "boolean":
            kinds["boolean"].append(name)
        elif dtype in _NUMERIC or dtype.startswith("decimal"):
            kinds["numeric"].append(name)
        else:
            kinds["categorical"].append(name)
    return kinds


def _flags(*tests: tuple[Column, str]) -> Column:
    """Texts of the tests that hold, comma-joined; empty text for none."""
    marks = [F.when(test, F.lit(text)) for test, text in tests]
    return F.concat_ws(",", *marks)


def _per_column(df: DataFrame, columns: list[str], stats: dict[str, callable]) -> DataFrame:
    """One aggregation for all columns, spread to one row per column."""
    wide = df.agg(
        F.count("*").alias("_rows"),
        *[
            fn(name).alias(f"_{i}_{stat}")
            for i, name in enumerate(columns)
            for stat, fn in stats.items()
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col("_rows").alias("row_count"),
                *[F.col(f"_{i}_{stat}").alias(stat) for stat in stats],
            )
            for i, name in enumerate(columns)
        ]
    )
    return wide.select(F.inline(rows))


def numeric_profile(
    df: DataFrame, columns: list[str] | None = None, exact: bool = True
) -> DataFrame:
    """Per numeric column: counts, mean, min, max, quartiles, p99 and flags.

    Flags: ENTIRELY NULL, CONSTANT (one distinct value), SURPRISING DISTRIBUTION (the maximum
    is over ten times the 99th percentile). ``exact=False`` estimates the quantiles in the
    scan that computes the rest.
    """
    columns = columns or column_kinds(df)["numeric"]
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    values = values.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns])
    basics = _per_column(
        values,
        columns,
        {
            "n": lambda c: F.count(c),
            "mean": lambda c: F.avg(c),
            "min": lambda c: F.min(c),
            "max": lambda c: F.max(c),
        },
    )
    quantiles = interpolated_quantiles if exact else approximate_quantiles
    # One row per profiled column on both sides.
    profile = basics.join(F.broadcast(quantiles(values, columns, QUANTILES)), "column", "left")
    empty = F.col("n") == 0
    return profile.select(
        "column",
        "row_count",
        "n",
        (F.col("row_count") - F.col("n")).alias("null_count"),
        percent(F.col("row_count") - F.col("n"), "row_count").alias("null_pct"),
        "mean",
        "min",
        "max",
        *QUANTILES,
        _flags(
            (empty, "ENTIRELY NULL"),
            (~empty & (F.col("min") == F.col("max")), "CONSTANT"),
            (
                (F.col("p99") > 0) & (F.col("max") > OUTLIER_FACTOR * F.col("p99")),
                "SURPRISING DISTRIBUTION",
            ),
        ).alias("flags"),
    )


def boolean_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per boolean column: true, false and NULL counts and flags."""
    columns = columns or column_kinds(df)["boolean"]
    counts = _per_column(
        df,
        columns,
        {
            "true_count": lambda c: F.count_if(F.col(c)),
            "false_count": lambda c: F.count_if(~F.col(c)),
        },
    )
    known = F.col("true_count") + F.col("false_count")
    return counts.select(
        "column",
        "row_count",
        "true_count",
        "false_count",
        (F.col("row_count") - known).alias("null_count"),
        percent(F.col("row_count") - known, "row_count").alias("null_pct"),
        _flags(
            (known == 0, "ENTIRELY NULL"),
            (
                (known > 0) & ((F.col("true_count") == 0) | (F.col("false_count") == 0)),
                "CONSTANT",
            ),
        ).alias("flags"),
    )


def categorical_profile(
    df: DataFrame, columns: list[str] | None = None, shown: int = HIGH_CARDINALITY
) -> DataFrame:
    """Per categorical column and value, most frequent first: the column's statistics, the
    value, its count and place.

    A column with more than ``shown`` distinct values lists its ``shown`` most frequent ones and
    is flagged HIGH CARDINALITY. Lists are profiled by their text.
    """
    columns = columns or column_kinds(df)["categorical"]
    counts = long_counts(df, columns)
    stats = counts.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(
            "null_count"
        ),
        F.count("value").alias("n_distinct"),
        F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("_top"),
    )
    # NULL comes last and is left out after ranking: a filter before it would keep the two uses of
    # the counts from sharing one aggregation.
    place = Window.partitionBy("column").orderBy(
        F.col("value").isNull(), F.col("n").desc(), F.col("value")
    )
    listed = (
        counts.withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= shown)
        .filter(F.col("value").isNotNull())
    )
    known = F.col("row_count") - F.col("null_count")
    # Both sides are bounded: one row per column against at most ``shown`` per column.
    return stats.join(F.broadcast(listed), "column", "left").select(
        "column",
        "row_count",
        "null_count",
        percent("null_count", "row_count").alias("null_pct"),
        "n_distinct",
        "place",
        "value",
        F.col("n").alias("value_count"),
        _flags(
            (known == 0, "ENTIRELY NULL"),
            (F.col("n_distinct") == 1, "CONSTANT"),
            (
                (F.col("n_distinct") > 1) & (F.col("_top") >= DOMINANT_SHARE * known),
                "DOMINANT VALUE",
            ),
            (F.col("n_distinct") > HIGH_CARDINALITY, "HIGH CARDINALITY"),
        ).alias("flags"),
    )


def table_profile(df: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """The whole table as (table, column, kind, metric, value) rows, value as text.

    Columns are classified by type, and each kind is profiled in its own way; categorical
    columns add one ``count of <value>`` metric per listed value.
    """
    kinds = column_kinds(df)
    parts = []
    if kinds["numeric"]:
        parts.append(_tidy(numeric_profile(df, kinds["numeric"], exact), "numeric"))
    if kinds["boolean"]:
        parts.append(_tidy(boolean_profile(df, kinds["boolean"]), "boolean"))
    if kinds["categorical"]:
        categories = categorical_profile(df, kinds["categorical"])
        summary = categories.filter(F.col("place").isNull() | (F.col("place") == 1))
        parts.append(_tidy(summary.drop("place", "value", "value_count"), "categorical"))
        parts.append(
            categories.filter(F.col("place").isNotNull()).select(
                "column",
                F.lit("categorical").alias("kind"),
                F.concat(F.lit("count of "), "value").alias("metric"),
                F.col("value_count").cast("string").alias("value"),
            )
        )
    tidy = parts[0]
    for part in parts[1:]:
        tidy = tidy.unionByName(part)
    return tidy.select(F.lit(table).alias("table"), "column", "kind", "metric", "value")


def _tidy(profile: DataFrame, kind: str) -> DataFrame:
    metrics = [c for c in profile.columns if c != "column"]
    text = profile.select("column", *[F.col(c).cast("string").alias(c) for c in metrics])
    return text.unpivot(["column"], metrics, "metric", "value").select(
        "column", F.lit(kind).alias("kind"), "metric", "value"
    )


def missing_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows that are NULL or empty text, and their percentage."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return _per_column(
        text,
        columns,
        {"missing": lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == ""))},
    ).select("column", "row_count", "missing", percent("missing", "row_count").alias("missing_pct"))


def list_length_stats(df: DataFrame, lists: list[str]) -> DataFrame:
    """Per list column: min, max, median and 99th percentile of the lengths of non-NULL lists."""
    lengths = df.select(
        *[F.when(F.col(c).isNotNull(), F.size(c)).cast("double").alias(c) for c in lists]
    )
    ends = _per_column(
        lengths,
        lists,
        {"n": lambda c: F.count(c), "min": lambda c: F.min(c), "max": lambda c: F.max(c)},
    )
    # Several rounds read the lengths; the lists are measured once.
    middle = interpolated_quantiles(durable(lengths), lists, {"median": 0.5, "p99": 0.99})
    return ends.join(F.broadcast(middle), "column", "left").select(
        "column",
        F.col("n").alias("n_lists"),
        F.col("min").cast("bigint").alias("min"),
        F.col("max").cast("bigint").alias("max"),
        "median",
        "p99",
    )


def coverage(df: DataFrame, checks: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """Per named check (test, among): rows of ``among`` (all rows if None), rows passing, and the
    percentage. One pass for all checks.
    """
    aggs = []
    for i, (test, among) in enumerate(checks.values()):
        base = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
        aggs.append(F.count_if(base).alias(f"_{i}_whole"))
        aggs.append(F.count_if(base & F.coalesce(test, F.lit(False))).alias(f"_{i}_part"))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.col(f"_{i}_part").alias("part"),
                F.col(f"_{i}_whole").alias("whole"),
            )
            for i, name in enumerate(checks)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows)).withColumn("pct", percent("part", "whole"))


def sum_ratios(df: DataFrame, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """Per named ratio (part, whole): both sums, their percentage and the mean of the part."""
    aggs = []
    for i, (part, whole) in enumerate(ratios.values()):
        aggs += [
            F.sum(part).cast("bigint").alias(f"_{i}_part"),
            F.sum(whole).cast("bigint").alias(f"_{i}_whole"),
            F.avg(part).alias(f"_{i}_mean"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("ratio"),
                F.col(f"_{i}_part").alias("part"),
                F.col(f"_{i}_whole").alias("whole"),
                F.col(f"_{i}_mean").alias("mean_part"),
            )
            for i, name in enumerate(ratios)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows)).withColumn("pct", percent("part", "whole"))


def outlier_share(df: DataFrame, column: str, above: float) -> DataFrame:
    """Non-NULL values, those above the limit, their percentage, and the maximum."""
    return df.agg(
        F.count(column).alias("n"),
        F.count_if(F.col(column) > above).alias("outliers"),
        F.max(column).alias("max"),
    ).select("n", "outliers", percent("outliers", "n").alias("outlier_pct"), "max")
