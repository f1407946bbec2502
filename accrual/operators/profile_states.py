"""Column profiles of tables that grow load by load.

Each load leaves a small state: per column the counts, the sum, the ends and sketches, and per value of
a text or boolean column its count. States combine by adding, comparing and merging, so the profile of
all loads needs no earlier row again, and a load that is stated anew replaces its own state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accrual.functions.numbers import percent
from accrual.operators.profiles import column_kinds
from accrual.operators.values import long_counts

# Sizes of the sketches: relative accuracy of quantiles about 1 %, distinct counts exact to 4096.
QUANTILE_K = 200
DISTINCT_LOG = 12
ABOUT = {"about_p25": 0.25, "about_median": 0.5, "about_p75": 0.75, "about_p99": 0.99}

COLUMN_STATE = (
    "column string, kind string, row_count long, n long, total double, low double, high double, "
    "quantiles binary, distinct_values binary"
)
VALUE_STATE = "column string, value string, n long"


def column_state(df: DataFrame) -> DataFrame:
    """One row per column of ``df`` (see ``COLUMN_STATE``), from one aggregation.

    Sums, ends and quantiles are of numeric columns; NaN counts as NULL.
    """
    kinds = column_kinds(df)
    names = [(c, kind) for kind, columns in kinds.items() for c in columns]
    aggs = [F.count("*").alias("_rows")]
    for i, (c, kind) in enumerate(names):
        value = F.col(c)
        if kind == "numeric":
            value = value.cast("double")
            value = F.when(~F.isnan(value), value)
            aggs += [
                F.sum(value).alias(f"_{i}_total"),
                F.min(value).alias(f"_{i}_low"),
                F.max(value).alias(f"_{i}_high"),
                F.kll_sketch_agg_double(value, QUANTILE_K).alias(f"_{i}_quantiles"),
            ]
        else:
            value = value.cast("string")
        aggs += [
            F.count(value).alias(f"_{i}_n"),
            F.theta_sketch_agg(value, DISTINCT_LOG).alias(f"_{i}_distinct"),
        ]
    numeric = {"total": "double", "low": "double", "high": "double", "quantiles": "binary"}
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("kind"),
            F.col("_rows").alias("row_count"),
            F.col(f"_{i}_n").alias("n"),
            *[
                (F.col(f"_{i}_{x}") if kind == "numeric" else F.lit(None).cast(t)).alias(x)
                for x, t in numeric.items()
            ],
            F.col(f"_{i}_distinct").alias("distinct_values"),
        )
        for i, (c, kind) in enumerate(names)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def write_states(df: DataFrame, folder: str, load: int) -> None:
    """State of one load below ``folder``; writing a load again replaces its state."""
    kinds = column_kinds(df)
    column_state(df).coalesce(1).write.mode("overwrite").parquet(f"{folder}/columns/load={load}")
    listed = [*kinds["boolean"], *kinds["categorical"]]
    counts = long_counts(df, listed) if listed else df.sparkSession.createDataFrame([], VALUE_STATE)
    counts.write.mode("overwrite").parquet(f"{folder}/values/load={load}")


def read_states(spark: SparkSession, folder: str, loads: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(column states, value states) of ``loads``, or of all."""
    found = []
    for part, schema in (("columns", COLUMN_STATE), ("values", VALUE_STATE)):
        states = spark.read.schema(f"{schema}, load long").parquet(f"{folder}/{part}")
        found.append(states if loads is None else states.where(F.col("load").isin(loads)))
    return found[0], found[1]


def combined_columns(states: DataFrame) -> DataFrame:
    """The profile of all loads, one row per column.

    Counts, means, ends and shares are exact; ``about_...`` are sketch estimates, and ``n_distinct`` is
    exact up to 4096 values and an estimate beyond. A column that some loads lack counts only the rows
    of those that have it.
    """
    merged = states.groupBy("column", "kind").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("n").alias("n"),
        (F.sum("total") / F.sum(F.when(F.col("total").isNotNull(), F.col("n")))).alias("mean"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.kll_merge_agg_double("quantiles", QUANTILE_K).alias("_quantiles"),
        F.theta_union_agg("distinct_values", DISTINCT_LOG).alias("_distinct"),
    )
    known = F.col("mean").isNotNull()
    return merged.select(
        "column",
        "kind",
        "row_count",
        "n",
        (F.col("row_count") - F.col("n")).alias("null_count"),
        percent(F.col("row_count") - F.col("n"), "row_count").alias("null_pct"),
        "mean",
        "min",
        "max",
        F.theta_sketch_estimate("_distinct").alias("n_distinct"),
        *[
            F.when(known, F.kll_sketch_get_quantile_double("_quantiles", F.lit(q))).alias(name)
            for name, q in ABOUT.items()
        ],
    )


def combined_values(states: DataFrame, shown: int = 20) -> DataFrame:
    """(column, value, n, place) of the ``shown`` most frequent values of all loads; ties in value order."""
    counts = states.groupBy("column", "value").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("column").orderBy(F.col("n").desc(), "value")
    ranked = counts.where(F.col("value").isNotNull()).withColumn("place", F.row_number().over(place))
    return ranked.where(F.col("place") <= shown)
