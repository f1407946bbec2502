"""Layer tables that are written bucketed and sorted by a key, so that joins on it move nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


# Rows of the largest table that one bucket, and so one task of its joins, should hold.
ROWS_PER_BUCKET = 200_000
FEWEST_BUCKETS = 8


def buckets_for(n_rows: int) -> int:
    """How many buckets a layer of ``n_rows`` rows needs, so that a bucket does not grow with the layer."""
    return max(FEWEST_BUCKETS, -(-n_rows // ROWS_PER_BUCKET))


@dataclass(frozen=True)
class BucketedTable:
    """A catalogue table ``name`` with its files at ``path``, in ``buckets`` by the hash of ``keys``.

    Two tables with equal numbers of buckets on one key are joined, and either is grouped by it, without
    an exchange. Writing pays the one shuffle that every later join would.
    """

    name: str
    path: str
    keys: tuple[str, ...]
    buckets: int = 200

    def write(self, df: DataFrame) -> DataFrame:
        """Replace the table by ``df`` and return it as read back. One task writes one bucket."""
        keys = list(self.keys)
        (
            df.repartition(self.buckets, *keys)
            .write.format("parquet")
            .mode("overwrite")
            .option("path", self.path)
            .bucketBy(self.buckets, *keys)
            .sortBy(*keys)
            .saveAsTable(self.name)
        )
        return self.read(df.sparkSession)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def attach(self, spark: SparkSession, schema: str) -> DataFrame:
        """Name the files in a catalogue that does not know them, for example that of a new application."""
        keys = ", ".join(f"`{key}`" for key in self.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self.read(spark)
