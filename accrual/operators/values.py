"""Frequencies of values and of list elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def exploded(df: DataFrame, items: Column | str, out: str = "value", outer: bool = False):
    """One row per list element, with the other columns kept; ``outer`` keeps empty lists."""
    items = F.col(items) if isinstance(items, str) else items
    return df.withColumn(out, F.explode_outer(items) if outer else F.explode(items))


# Values are first counted by a hash with this many results.
CELLS = 1 << 16
# Up to this size of the input one shuffle of all its values is cheaper than reading it again.
PLAIN_BYTES = 256 << 20


def _cell(value: str) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(CELLS)).cast("int")


def input_bytes(df: DataFrame) -> int:
    """Bytes of the inputs that ``df`` reads, as Catalyst knows them; very many where it does not."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def top_values(
    df: DataFrame, value: str, n: int, count: str = "n", plain_bytes: int = PLAIN_BYTES
) -> DataFrame:
    """The ``n`` most frequent values; ties in value order, NULL first.

    Inputs of at most ``plain_bytes`` are counted in one aggregation. Beyond that, rows are counted per hash cell first, which shuffles at most ``CELLS`` counts per task however many
    values there are. No value is more frequent than its cell. The values of the fullest cells are then
    counted exactly; where the n-th of them is not above every other cell, the cells that may still hold
    a better one are counted as well. The answer is the same either way, and exact. ``df`` is then read
    two or three times. Only the cells' counts and the ``n`` rows of the answer come to the driver.
    """
    if input_bytes(df) <= plain_bytes:
        return _first(df.groupBy(value).agg(F.count("*").alias(count)), value, n, count)
    cells = df.groupBy(_cell(value).alias("cell")).agg(F.count("*").alias("n")).collect()
    cells = sorted(((r["n"], r["cell"]) for r in cells), reverse=True)

    def counted(chosen: list[tuple[int, int]]) -> list:
        wanted = df.sparkSession.createDataFrame([(c,) for _, c in chosen], "_cell int")
        # At most CELLS numbers.
        held = df.select(value).join(F.broadcast(wanted), _cell(value) == F.col("_cell"), "left_semi")
        return _first(held.groupBy(value).agg(F.count("*").alias(count)), value, n, count).collect()

    chosen = cells[: 4 * n]
    best = counted(chosen)
    if len(chosen) < len(cells):
        least = best[-1][count] if len(best) == n else 0
        if cells[len(chosen)][0] >= least:
            best = counted([c for c in cells if c[0] >= least])
    schema = StructType([df.schema[value], StructField(count, LongType(), False)])
    return df.sparkSession.createDataFrame([tuple(r) for r in best], schema)


def _first(counts: DataFrame, value: str, n: int, count: str) -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(value).asc()).limit(n)


def top_list_values(
    df: DataFrame, items: str, n: int, lacking: str | None = None, count: str = "n", **options
) -> DataFrame:
    """The ``n`` most frequent list elements; ``lacking`` keeps rows where that other list is
    NULL or empty. ``options`` go to ``top_values``.
    """
    if lacking is not None:
        df = df.filter(F.col(lacking).isNull() | (F.size(lacking) == 0))
    return top_values(df.select(F.explode(items).alias("value")), "value", n, count, **options)


def distinct_list_values(df: DataFrame, items: str, approximate: bool = False) -> DataFrame:
    """One row: the number of different list elements.

    The exact count groups by value first, so it is a plain two-stage distributed count.
    """
    values = df.select(F.explode(items).alias("value"))
    if approximate:
        return values.agg(F.approx_count_distinct("value").alias("n_distinct"))
    return values.filter(F.col("value").isNotNull()).distinct().agg(
        F.count("*").alias("n_distinct")
    )


def top_dimension_values(
    df: DataFrame, ids: str, dim: DataFrame, dim_id: str, dim_name: str, n: int, plain_bytes: int = PLAIN_BYTES
) -> DataFrame:
    """The ``n`` most frequent ids of a list column, with their dimension name.

    Inputs of at most ``plain_bytes`` are counted per id and joined. Beyond that, only the most frequent
    ids meet the dimension; while ids that it lacks leave fewer than ``n`` rows, twice as many are taken.
    """
    items = df.select(F.explode(ids).alias(dim_id))
    names = dim.select(dim_id, dim_name)
    order = [F.col("n_trials").desc(), F.col(dim_id), F.col(dim_name)]
    if input_bytes(items) <= plain_bytes:
        counted = items.groupBy(dim_id).agg(F.count("*").alias("n_trials"))
        return counted.join(names, dim_id).select(dim_id, dim_name, "n_trials").orderBy(*order).limit(n)
    taken = n
    while True:
        best = top_values(items, dim_id, taken, "n_trials", plain_bytes)
        rows = best.join(names, dim_id).select(dim_id, dim_name, "n_trials").orderBy(*order).limit(n)
        found = rows.collect()
        if len(found) == n or best.count() < taken:
            return df.sparkSession.createDataFrame(found, rows.schema)
        taken *= 2


def case_variants(df: DataFrame, value: str, n: int = 15, shown: int = 100) -> DataFrame:
    """Values spelled in more than one letter case: lower-cased form, number of spellings, and
    the first ``shown`` spellings in order, for the ``n`` forms with most of them.

    Spellings are collected only for the ``n`` reported forms, and ranked before they are collected, so a
    list has at most ``shown`` of them.
    """
    spellings = (
        df.select(F.lower(value).alias("normalized"), F.col(value).alias("variant"))
        .filter(F.col("variant").isNotNull())
        .distinct()
    )
    worst = (
        spellings.groupBy("normalized")
        .agg(F.count("*").alias("variant_count"))
        .filter(F.col("variant_count") > 1)
        .orderBy(F.col("variant_count").desc(), F.col("normalized"))
        .limit(n)
    )
    place = Window.partitionBy("normalized").orderBy("variant")
    return (
        spellings.join(F.broadcast(worst), "normalized")
        .withColumn("_place", F.row_number().over(place))
        .filter(F.col("_place") <= shown)
        .groupBy("normalized", "variant_count")
        .agg(F.sort_array(F.collect_list("variant")).alias("variants"))
    )


def sample_rows(df: DataFrame, items: str, n: int, order_by: list[str]) -> DataFrame:
    """``n`` rows with a non-empty list, the first in ``order_by`` order."""
    return df.filter(F.size(items) > 0).orderBy(*order_by).limit(n)


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n, pct): how often each value occurs, NULL included, with its share in
    percent of all rows. One pass for all columns.
    """
    counts = long_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"))
    # One total per profiled column: as many rows as there are names in ``columns``.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", F.round(F.col("n") * 100.0 / F.col("_total"), 1).alias("pct")
    )


def long_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text, n) for every value of every column, NULL as its own value."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def most_frequent(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): the most frequent non-NULL value of each column; ties go to the
    smaller value.
    """
    window = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    return (
        long_counts(df, columns)
        .filter(F.col("value").isNotNull())
        .withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .select("column", "value", "n")
    )
