"""Packing token sequences into rows of fixed capacity by planning over their length histogram.

Every document becomes token ids with an end id; longer ones are cut into pieces of the capacity (the
first piece takes what is left over). Only the number of pieces of each length comes to the driver, at most
``capacity`` rows. Best fit decreasing then works on counts: sequences filled alike are one group with a
multiplicity, and all pieces of one length are placed group by group, the group with the least room
first. This gives as many sequences, filled alike, as best fit piece by piece, longest first.

The plan is a list of runs: pieces of one length with ranks from ``low`` to ``high`` go to numbered
sequences at an offset that follows from the rank. Pieces are ranked within their length (counted in
slices, so that a length which a third of all pieces have is no single task) and look up their run.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrual.llm.common import free_name, stored
from accrual.llm.word_ids import word_ids

CAPACITY = 1024
END = 2
BATCH_IDS = 1 << 20


@dataclass
class Group:
    """``many`` sequences that hold the same lengths: ``parts`` are (length, times, offset)."""

    many: int
    room: int
    parts: list[tuple[int, int, int]] = field(default_factory=list)

    def take(self, many: int, length: int, times: int, capacity: int) -> Group:
        """``many`` of these sequences, each with ``times`` more pieces of ``length``."""
        part = (length, times, capacity - self.room)
        return Group(many, self.room - times * length, [*self.parts, part])


def plan_groups(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Best fit decreasing over ``histogram`` (pieces of each length from 1 to ``capacity``).

    A length splits at most one group and opens at most two, so there are at most ``4 * capacity``
    groups, whatever the counts.
    """
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths must lie from 1 to {capacity}")
    by_room: dict[int, list[Group]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in sorted(r for r in by_room if r >= length):
            if not left:
                break
            left = _fill(by_room, by_room.pop(room), length, left, capacity)
        if left:
            fresh = Group(-(-left // (capacity // length)), capacity)
            _fill(by_room, [fresh], length, left, capacity)
    return [group for room in sorted(by_room) for group in by_room[room]]


def _fill(by_room: dict, groups: list[Group], length: int, left: int, capacity: int) -> int:
    """Put up to ``left`` pieces into ``groups`` of one room; how many are still left."""
    for group in groups:
        times = group.room // length
        full = min(group.many, left // times)
        rest = min(1, group.many - full) * (left - full * times)
        made = [group.take(full, length, times, capacity)] if full else []
        if rest:
            made.append(group.take(1, length, rest, capacity))
        untouched = group.many - full - bool(rest)
        if untouched:
            made.append(Group(untouched, group.room, group.parts))
        left -= full * times + rest
        for one in made:
            by_room.setdefault(one.room, []).append(one)
    return left


def runs_of(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan as rows (length, low, high, times, base, offset).

    A piece with rank r, low <= r < high, goes to sequence ``base + (r - low) div times`` at
    ``offset + ((r - low) mod times) * length``. A sequence holds at most about ``sqrt(2 * capacity)``
    different lengths, which bounds the rows: 180 000 for a capacity of 1024.
    """
    ranks: dict[int, int] = {}
    base, runs = 0, []
    for group in groups:
        for length, times, offset in group.parts:
            low = ranks.get(length, 0)
            ranks[length] = low + group.many * times
            runs.append((length, low, ranks[length], times, base, offset))
        base += group.many
    return runs


RUNS = "_len int, _low long, _high long, _times long, _base long, _off long"


def best_fit_slots(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (columns so named are replaced).

    ``length`` must lie from 1 to ``capacity``. Sequences are numbered from 0 without gaps; offsets in a
    sequence are gapless from 0. Equal rows get places of their own; an empty frame stays empty. Which
    of several pieces of one length gets which place is free and follows the stored order.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    slice_, row, start, rank = (free_name(pieces, c) for c in ("_slice", "_row", "_start", "_rank"))
    size = free_name(pieces, "_size")
    held = stored(
        pieces.select(
            *kept,
            F.col(length).cast("int").alias(size),
            F.spark_partition_id().alias(slice_),
            F.monotonically_increasing_id().alias(row),
        ),
        "pieces",
    )
    counts = stored(held.groupBy(size, slice_).agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy(size).agg(F.sum("_n")).collect()}
    runs = pieces.sparkSession.createDataFrame(runs_of(plan_groups(histogram, capacity)), RUNS)
    before = Window.partitionBy(size).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(size, slice_, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(size, slice_).orderBy(row)
    ranked = held.withColumn(rank, F.row_number().over(inside) - 1).join(starts, [size, slice_])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(start))
    place = F.col(rank) - F.col("_low")
    found = (F.col(size) == F.col("_len")) & (F.col(rank) >= F.col("_low")) & (F.col(rank) < F.col("_high"))
    return ranked.join(F.broadcast(runs), found).select(
        *kept,
        (F.col("_base") + F.floor(place / F.col("_times"))).alias("sequence_id"),
        (F.col("_off") + place % F.col("_times") * F.col("_len")).alias("offset"),
    )


def cuts_of(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``length`` ids: the first takes the remainder, the others are full."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, at + capacity) for at in range(first, length, capacity))]


def _cut_texts(
    texts: pa.Array, encoder, last: bytes, capacity: int, keep_ids: bool
) -> Iterator[tuple[list[int], dict[str, list]]]:
    """(row of each piece, its columns), for about ``BATCH_IDS`` ids at a time."""
    rows, out, held = [], {c: [] for c in ("piece", "start", "length", "ids_crc32", "ids")}, 0
    for at, text in enumerate(texts):
        ids = memoryview(encoder.encode(text.as_py() or "") + last)
        for number, (low, high) in enumerate(cuts_of(len(ids) // 4, capacity)):
            piece = ids[4 * low : 4 * high]
            rows.append(at)
            out["piece"].append(number)
            out["start"].append(low)
            out["length"].append(high - low)
            out["ids_crc32"].append(zlib.crc32(piece))
            if keep_ids:
                out["ids"].append(np.frombuffer(piece, dtype="<i4"))
        held += len(ids) // 4
        if held >= BATCH_IDS:
            yield rows, out
            rows, out, held = [], {c: [] for c in out}, 0
    if rows:
        yield rows, out


def token_pieces(
    documents: DataFrame,
    serial: str,
    capacity: int = CAPACITY,
    end: int = END,
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces of every row: its columns but ``text``, and ``piece``, ``start``, ``length``, ``ids_crc32``.

    Ids are those of the tokenizer with the JSON text ``serial``, without added special tokens, then
    ``end``. ``ids_crc32`` is over little-endian unsigned 32-bit ids; ``keep_ids=True`` adds ``ids``. A
    NULL or empty text is one piece that holds ``end`` alone. Texts are encoded whole; repeated rows and
    rows without an id keep pieces of their own. Columns with the names of new ones are replaced.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(serial)
    made = {"piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids_crc32": T.LongType()}
    if keep_ids:
        made["ids"] = T.ArrayType(T.IntegerType())
    kinds = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    kinds["ids"] = pa.list_(pa.int32())
    kept = documents.drop(*made)
    source = free_name(kept, "_source")
    names = [c for c in kept.columns if c != text]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = word_ids(shipped.value), np.array([end], dtype="<u4").tobytes()
        for given in batches:
            for rows, out in _cut_texts(given.column(source), encoder, last, capacity, keep_ids):
                columns = [given.column(c).take(pa.array(rows, type=pa.int64())) for c in names]
                columns += [pa.array(out[c], type=kinds[c]) for c in made]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *made])

    schema = T.StructType([*(kept.schema[c] for c in names), *(T.StructField(c, t) for c, t in made.items())])
    return kept.select(*names, F.col(text).alias(source)).mapInArrow(cut, schema)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of every sequence, from pieces with ``offset`` and ``ids``.

    A sequence has at most ``capacity`` ids, so no group is larger than that.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def pack_documents(documents: DataFrame, serial: str, capacity: int = CAPACITY) -> DataFrame:
    """The contract's view of ``documents`` (``doc_id``, ``text``): one row per piece with its place."""
    pieces = token_pieces(documents.select("doc_id", "text"), serial, capacity)
    return best_fit_slots(pieces, "length", capacity)
