"""Shards of near-equal size by histogram sort.

Rows are ordered by three 62-bit keys: a hash of the content, a hash of the row's id, and a number
that is unique. Content comes first, so equal texts stand together and are only separated where a
boundary falls into a group and no other cut is near enough.

The cuts between shards are found by counting, not by sampling: every round sums the exact bytes
of each bin of the still open key intervals (at most one interval per cut), and the bin in which a
cut's target falls becomes its next interval. Only those sums come to the driver: at most
``(shards - 1) * bins`` rows a round, whatever the size of the input. A cut is settled when the bytes
below it are within ``tolerance`` of a shard of its target, or when a single row lies in its interval.
Then all rows are exchanged once, by range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import stored

SPACE = 1 << 62
ROWS_PER_SLICE = 200_000
MAX_SLICES = 65_536


@dataclass
class _Cut:
    target: float
    prefix: tuple[int, ...] = ()
    low: int = 0
    high: int = SPACE
    below: int = 0
    at: tuple[int, ...] | None = None


def text_size(text: Column) -> Column:
    """Bytes of the UTF-8 text (none for NULL) and one for the end of the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _hash(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def find_cuts(
    keyed: DataFrame, keys: list[str], size: str, shards: int, tolerance: float, bins: int = 1024
) -> list[tuple[int, ...]]:
    """Lower bounds (as tuples over ``keys``) of shards 1 to ``shards - 1``.

    ``keyed`` must give the same rows on every read. An empty frame gives bounds that no row passes.
    """
    keyed = keyed.select(*keys, size)
    total = keyed.agg(F.sum(size)).first()[0] or 0
    cuts = [_Cut(target=total * i / shards) for i in range(1, shards)]
    slack = tolerance * total / shards
    while open_cuts := [c for c in cuts if c.at is None]:
        intervals = sorted({(c.prefix, c.low, c.high) for c in open_cuts})
        counts = _histogram(keyed, keys, size, intervals, bins)
        for cut in open_cuts:
            place = intervals.index((cut.prefix, cut.low, cut.high))
            _refine(cut, counts.get(place, []), slack, len(keys))
    return [cut.at for cut in cuts]


def _histogram(keyed, keys, size, intervals, bins):
    """Bytes, rows and key bounds of each non-empty bin, by interval and in key order."""
    number, bin_of = None, None
    for i, (prefix, low, high) in enumerate(intervals):
        key = F.col(keys[len(prefix)])
        inside = (key >= low) & (key < high)
        for name, value in zip(keys, prefix):
            inside = inside & (F.col(name) == value)
        step = -(-(high - low) // bins)
        slot = F.expr(f"(`{keys[len(prefix)]}` - {low}L) div {step}L")
        number = F.when(inside, F.lit(i)) if number is None else number.when(inside, F.lit(i))
        bin_of = F.when(inside, slot) if bin_of is None else bin_of.when(inside, slot)
    level = F.lit(None).cast("long")
    for i, (prefix, _, _) in enumerate(intervals):
        level = F.when(F.col("interval") == i, F.col(keys[len(prefix)])).otherwise(level)
    found = (
        keyed.withColumn("interval", number)
        .where(F.col("interval").isNotNull())
        .withColumn("bin", bin_of)
        .groupBy("interval", "bin")
        .agg(
            F.sum(size).alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
            F.min(level).alias("first"),
            F.max(level).alias("last"),
        )
        .collect()
    )
    by_interval: dict[int, list] = {}
    for row in sorted(found, key=lambda r: (r["interval"], r["bin"])):
        by_interval.setdefault(row["interval"], []).append(row)
    return by_interval


def _refine(cut: _Cut, bins: list, slack: float, levels: int) -> None:
    """Settle ``cut``, or narrow it to the bin in which its target falls."""
    below = cut.below
    for row in bins:
        above = below + row["bytes"]
        if above < cut.target:
            below = above
            continue
        left, right = cut.target - below, above - cut.target
        start, end = (*cut.prefix, row["first"]), (*cut.prefix, row["last"] + 1)
        last_level = len(cut.prefix) + 1 == levels
        single = row["rows"] == 1 or (last_level and row["first"] == row["last"])
        if min(left, right) <= slack or single:
            cut.at = start if left <= right else end
        elif row["first"] == row["last"]:
            cut.prefix, cut.low, cut.high, cut.below = start, 0, SPACE, below
        else:
            cut.low, cut.high, cut.below = row["first"], row["last"] + 1, below
        return
    cut.at = (*cut.prefix, cut.high)


def _at_or_above(keys: list[str], bound: tuple[int, ...]) -> Column:
    """True where the row's keys are not before ``bound``."""
    result = F.lit(True)
    for name, value in reversed(list(zip(keys, bound))):
        key = F.col(name)
        result = (key > value) | ((key == value) & result)
    return result


def histogram_shards(
    df: DataFrame,
    shards: int,
    size: str,
    content: Column,
    row_id: Column,
    tolerance: float = 0.005,
) -> DataFrame:
    """Every row of ``df`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0).

    ``size`` names a column of positive sizes; ``content`` and ``row_id`` give the order. Shards
    differ in size by ``tolerance`` of a shard, or by the row in which a target falls if that is
    larger. NULL contents and ids are values like others, repeated rows get slots of their own, an
    empty frame stays empty. Columns named ``shard``, ``slot``, ``_h``, ``_t``, ``_u``, ``_slice`` or
    ``_place`` are replaced.
    """
    keys = ["_h", "_t", "_u"]
    made = ["shard", "slot", *keys, "_slice", "_place"]
    kept = [c for c in df.columns if c.lower() not in made]
    keyed = df.withColumns({"_h": _hash(content), "_t": _hash(row_id)})
    keyed = stored(
        keyed.withColumn("_u", F.monotonically_increasing_id()).select(*kept, *keys), "shard-keys"
    )
    cuts = find_cuts(keyed, keys, size, shards, tolerance)
    shard = sum((_at_or_above(keys, cut).cast("int") for cut in cuts), F.lit(0))
    slices = min(MAX_SLICES, max(shards, -(-keyed.count() // ROWS_PER_SLICE)))
    # The position inside a sorted partition is the lower part of the generated id.
    placed = stored(
        keyed.withColumn("shard", shard)
        .repartitionByRange(slices, "shard", *keys)
        .sortWithinPartitions("shard", *keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "shards",
    )
    # One row per slice and shard: at most MAX_SLICES + shards rows.
    starts = placed.groupBy("shard", "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    before = F.expr("sum(_n) over (partition by shard order by _slice) - _n - _first")
    starts = starts.select("shard", "_slice", before.alias("_start"))
    return (
        placed.join(F.broadcast(starts), ["shard", "_slice"])
        .withColumn("slot", F.col("_start") + F.col("_place"))
        .select(*kept, "shard", "slot")
    )


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """The contract's view of ``documents``: sizes, checksums, shards and slots under law ``bytes``.

    A NULL text has no bytes and a NULL checksum.
    """
    text = F.col("text")
    narrow = documents.select(
        "doc_id",
        text_size(text).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("content"),
    )
    return histogram_shards(narrow, shards, "size", F.col("content"), F.col("doc_id")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
