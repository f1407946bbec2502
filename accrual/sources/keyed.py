"""Parquet tables cut by a hash of their key, of which a merge rewrites only the parts it touches.

A batch touches the partitions that its keys fall into, at most one per partition number. Those are
read (by partition filter), merged, and written back with dynamic partition overwrite; all other
partitions keep their files. Merges are idempotent, so a batch that failed half-way is applied again.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual.operators import merge
from accrual.sources.files import delete, names

PART = "key_part"


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with the columns of ``schema`` (DDL) and ``parts`` partitions by the hash of ``keys``.

    The number of parts is fixed when the table is made. Choose it so that a part is some files in
    size; a batch of many keys touches all parts, and then the merge costs as much as a full one.
    """

    path: str
    keys: tuple[str, ...]
    schema: str
    parts: int = 256

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """Write ``rows`` as the whole table; records without a key are left out."""
        self._write(rows.dropna(subset=list(self.keys)), "static")

    def _write(self, rows: DataFrame, mode: str) -> None:
        # Rebalanced, not repartitioned: adaptive execution cuts parts that are too large for a task.
        placed = rows.withColumn(PART, self.part()).hint("rebalance", PART)
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(PART).parquet(self.path)

    def _scan(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.schema}, {PART} int").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._scan(spark).drop(PART)

    def rows_of(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        """The rows of some parts; the scan reads no others."""
        return self._scan(spark).where(F.col(PART).isin(parts)).drop(PART)

    def files(self, spark: SparkSession, part: int) -> set[str]:
        return set(names(spark, f"{self.path}/{PART}={part}"))

    def touched(self, batch: DataFrame) -> list[int]:
        """Numbers of the parts that the batch's keys fall into; there are ``parts`` at most."""
        keyed = batch.dropna(subset=list(self.keys))
        return sorted(r[0] for r in keyed.select(self.part()).distinct().collect())

    def rewrite(self, batch: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the parts that ``batch`` touches by ``merged`` of their rows; returns their numbers.

        ``merged`` must keep every key in its part. A part that is left without rows is deleted.
        """
        spark = batch.sparkSession
        parts = self.touched(batch)
        if not parts:
            return parts
        before = {p: self.files(spark, p) for p in parts}
        self._write(merged(self.rows_of(spark, parts)), "dynamic")
        for part in parts:
            # Written parts have new file names; an unchanged listing means that no row was left.
            if before[part] and self.files(spark, part) == before[part]:
                delete(spark, f"{self.path}/{PART}={part}")
        return parts

    def upsert(self, batch: DataFrame, order: list[str]) -> list[int]:
        """Apply ``merge_upsert``: the record that is newest by ``order`` wins per key."""
        keys = list(self.keys)
        return self.rewrite(batch, lambda rows: merge.merge_upsert(rows, batch, keys, order))

    def insert_absent(self, batch: DataFrame, first: list[str]) -> list[int]:
        """Apply ``insert_absent``: records whose key the table lacks, of several the first."""
        keys = list(self.keys)
        return self.rewrite(batch, lambda rows: merge.insert_absent(rows, batch, keys, first))

    def replace_children(
        self, parents: DataFrame, children: DataFrame, version: str, ordinal: str
    ) -> list[int]:
        """Apply ``replace_children`` to a table of child rows; ``keys`` name the parent."""
        keys = list(self.keys)
        given = parents.select(*keys).unionByName(children.select(*keys))
        return self.rewrite(
            given,
            lambda rows: merge.replace_children(rows, parents, children, keys, version, ordinal),
        )
