"""Batch-into-table merges, as plain functions of the table and the batch.

Every merge reads the table once as the left side of an outer join with the batch. When the batch
is small Catalyst broadcasts it, so the table is merged where it lies; the only other read of
the table takes its key columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.operators.latest import latest_per_key


def _newer_first(order: list[str]) -> list[Column]:
    return [F.col(c).desc() for c in order]


def _absent_from(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks. The target's keys are first cut down to those of ``rows``,
    so a small batch stays the small side of both joins."""
    found = target.select(*keys).join(rows.select(*keys).distinct(), keys, "left_semi")
    return rows.join(found, keys, "left_anti")


def merge_upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Target with the batch applied: the record that is newest by ``order`` wins per key.

    ``target`` holds one row per key, both frames carry the ``order`` columns, and their last one
    should break ties. Duplicate keys inside the batch are fine, records without a key are
    dropped, applying a batch again changes nothing, and an older record never replaces a newer
    one.
    """
    columns = target.columns
    incoming = latest_per_key(
        batch.select(*columns).dropna(subset=keys), keys, _newer_first(order)
    )
    renamed = incoming.select(*keys, F.struct(*columns).alias("_new"))
    # Struct comparison puts NULL parts first, like the sort order above.
    wins = F.coalesce(
        F.struct(*[F.col("_new")[c] for c in order]) >= F.struct(*order), F.lit(False)
    )
    merged = target.join(renamed, keys, "left").select(
        *[
            F.col(c) if c in keys else F.when(wins, F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    return merged.unionByName(_absent_from(incoming, target, keys))


def merge_first(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target with the batch applied: the record that is first by ``order`` wins per key.

    The mirror image of ``merge_upsert``: what is kept does not depend on when it was merged.
    """
    columns = target.columns
    incoming = latest_per_key(
        batch.select(*columns).dropna(subset=keys), keys, [F.col(c).asc() for c in order]
    )
    renamed = incoming.select(*keys, F.struct(*columns).alias("_new"))
    earlier = F.struct(*[F.col("_new")[c] for c in order]) < F.struct(*order)
    wins = F.col("_new").isNotNull() & F.coalesce(earlier, F.lit(False))
    merged = target.join(renamed, keys, "left").select(
        *[
            F.col(c) if c in keys else F.when(wins, F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    return merged.unionByName(_absent_from(incoming, target, keys))


def insert_absent(
    target: DataFrame, batch: DataFrame, keys: list[str], first: list[str]
) -> DataFrame:
    """Target plus batch rows whose key it lacks; of several, the first by ``first``."""
    candidates = latest_per_key(
        batch.select(*target.columns).dropna(subset=keys), keys, [F.col(c).asc() for c in first]
    )
    return target.unionByName(_absent_from(candidates, target, keys))


def replace_children(
    target: DataFrame,
    parents: DataFrame,
    children: DataFrame,
    key: list[str],
    version: str,
    ordinal: str,
) -> DataFrame:
    """Child rows after the children of every parent in the batch were replaced.

    ``parents`` lists (key, version) of the delivered parents, also those left with no children;
    ``children`` and ``target`` carry key, version and the child's ordinal within its parent.
    Only children of a parent's newest version survive, in whatever order and however many
    pieces they arrive, and a repeated delivery changes nothing.
    """

    def newest_version(rows: DataFrame, name: str) -> DataFrame:
        return rows.dropna(subset=key).groupBy(*key).agg(F.max(version).alias(name))

    delivered = (
        newest_version(parents, "_of_parents")
        .join(newest_version(children, "_of_children"), key, "full")
        .select(*key, F.greatest("_of_parents", "_of_children").alias("_delivered"))
    )
    kept = target.join(delivered, key, "left").filter(
        F.col("_delivered").isNull() | (F.col(version) >= F.col("_delivered"))
    )
    stored = newest_version(target.join(delivered.select(*key), key, "left_semi"), "_stored")
    newest = delivered.join(stored, key, "left").select(
        *key, F.greatest("_delivered", "_stored").alias(version)
    )
    identity = [*key, version, ordinal]
    # Of one ordinal delivered with different contents, the smallest content stays.
    rest = [F.col(c).asc() for c in target.columns if c not in identity]
    current = latest_per_key(
        children.select(*target.columns).join(newest, [*key, version], "left_semi"),
        identity,
        rest or [F.col(identity[-1]).asc()],
    )
    return kept.select(*target.columns).unionByName(_absent_from(current, target, identity))


def upsert_raw(target: DataFrame, landed: DataFrame) -> DataFrame:
    """Raw documents by id: the newest delivery replaces payload and hash and bumps
    ``updated_at``; the first ``received_at`` stays.

    ``target`` and ``landed`` carry the columns of ``land_raw``.
    """
    order = ["timestamp", "partition", "offset", "payload_hash"]
    merged = merge_upsert(target, landed, ["nct_id"], order)
    first_seen = target.select("nct_id", F.col("received_at").alias("_first_received"))
    return (
        merged.join(first_seen, "nct_id", "left")
        .withColumn("received_at", F.coalesce("_first_received", "received_at"))
        .select(*target.columns)
    )


def changed_payloads(target: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed documents whose content the table does not hold yet."""
    return landed.join(
        target.select("nct_id", "payload_hash"), ["nct_id", "payload_hash"], "left_anti"
    )
