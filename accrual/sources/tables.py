"""Relational tables, Parquet layers and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual.functions.lists import pipe_joined


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """JDBC table scan, split by ``partition_column`` range or by explicit ``predicates``.

    Without either, JDBC gives one task for the whole table; name one for any large table.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if partition_column:
        lower, upper = bounds
        return spark.read.jdbc(
            url,
            table,
            column=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=num_partitions,
            properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    refresh: bool = False,
) -> None:
    """Append to a JDBC table, or empty it first and keep its definition (``refresh``)."""
    writer = df.write
    if refresh:
        writer.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties)
    else:
        writer.mode("append").jdbc(url, table, properties=properties)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a Parquet layer."""
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def refresh_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet layer as a whole. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def stamped(df: DataFrame, column: str = "transformed_at") -> DataFrame:
    """``df`` with the time of the load."""
    return df.withColumn(column, F.current_timestamp())


def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """CSV with a header; array columns become ``|``-separated text."""
    flat = flatten_lists(df)
    if order_by:
        flat = flat.orderBy(*order_by)
    flat.write.mode("overwrite").option("header", True).csv(path)


def flatten_lists(df: DataFrame) -> DataFrame:
    """Every array column joined with ``|``; other columns unchanged."""
    return df.select(
        *[
            pipe_joined(field.name).alias(field.name)
            if field.dataType.typeName() == "array"
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def load_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, read with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
