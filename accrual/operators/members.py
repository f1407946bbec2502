"""Exact membership of whole-number keys as bitmaps, built once per table and stored.

A bitmap row covers 32768 neighbouring keys with one bit each, so a table of dense ids takes about one
bit per key of its range. A key whose bit is set is a member for certain and one whose bit is not set is
none; no false answers, and no shuffle of the asking side while the bitmaps are small enough to be
broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.operators.joins import fk_violations

ROW_BYTES = 4096
MAX_BROADCAST = 64 << 20


def study_number(study_id: Column) -> Column:
    """Registry ids of three letters and eight digits as numbers; NULL for other texts.

    The letters are part of the number, so different ids have different numbers.
    """
    letters = [F.ascii(F.substring(study_id, i, 1)).cast("long") - ord("A") for i in (1, 2, 3)]
    prefix = (letters[0] * 26 + letters[1]) * 26 + letters[2]
    digits = F.substring(study_id, 4, 8).try_cast("long")
    return F.when(study_id.rlike(r"^[A-Z]{3}[0-9]{8}$"), prefix * 100_000_000 + digits)


def member_bitmaps(members: DataFrame, number: Column) -> DataFrame:
    """``block, bits``: bitmaps of all ``number`` of ``members``; NULL is no member."""
    numbers = members.select(number.cast("long").alias("_number")).where(F.col("_number").isNotNull())
    return numbers.groupBy(F.bitmap_bucket_number("_number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits")
    )


def is_set(bits: Column, number: Column) -> Column:
    """Whether a bitmap has the bit of ``number``; a missing bitmap has none."""
    position = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.shiftright(byte, 0).bitwiseAND(F.pow(F.lit(2), position % 8).cast("int"))
    return F.coalesce(bit != 0, F.lit(False))


def unknown_keys(children: DataFrame, number: Column, bitmaps: DataFrame) -> DataFrame:
    """The rows of ``children`` that are not known as members: bit not set, or no number.

    ``bitmaps`` is broadcast while its rows of 4 KB stay within 64 MB (two thousand million dense ids);
    beyond, it is joined by a shuffle of the children, with the same result.
    """
    if bitmaps.count() * ROW_BYTES <= MAX_BROADCAST:
        bitmaps = F.broadcast(bitmaps)
    bitmaps = bitmaps.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    asked = children.withColumn("_number", number.cast("long"))
    found = asked.join(bitmaps, F.bitmap_bucket_number("_number") == F.col("_block"), "left")
    return found.where(~is_set(F.col("_bits"), F.col("_number"))).select(*children.columns)


def fk_violations_by_bitmap(
    children: DataFrame,
    parents: DataFrame,
    child_key: str,
    parent_key: str,
    bitmaps: DataFrame,
    number=lambda key: key,
) -> DataFrame:
    """``fk_violations`` on one key, with known children left out before anything is shuffled.

    ``bitmaps`` are those of ``parents`` by ``number`` of its key. What they do not settle, also keys
    that have no number, meets ``parents`` in an exact anti join.
    """
    open_ = unknown_keys(children.where(F.col(child_key).isNotNull()), number(F.col(child_key)), bitmaps)
    return fk_violations(open_, parents, [child_key], [parent_key])
