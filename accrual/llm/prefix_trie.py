"""The trie of conversation prefixes, built from sorted shards and a skeleton of splitter paths.

A conversation is a path: for each turn 16 bytes of a hash of role and text, and 4 bytes with the length
of the text. Paths sort by bytes, so the members of a node (the conversations that begin with its turns)
are neighbours. Splitters, taken from a sample of distinct paths, cut the order into shards. A node has
members on both sides of a splitter only if it is a proper prefix of it; those prefixes form the
skeleton, a small trie that is broadcast. Each shard is sorted and read once with a stack: every node off
the skeleton is finished there, and of a skeleton node each shard returns a partial aggregate. The
partial ones are reduced by Spark and added up along the skeleton.

Splitters decide how even the shards are, never what comes out.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import stored

TURN = 20
SAMPLE = 16_384
LONGEST_SPLITTER = 512 * TURN
MAX_SKELETON = 1 << 16
ROWS_PER_SHARD = 50_000
MAX_SHARDS = 4_096
BATCH_ROWS = 8_192


def turn_key(role: Column, text: Column) -> Column:
    """A turn as 40 hexadecimal digits: MD5 of role and text, and the text's length in UTF-8 bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(both), F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def _turns(conversations: DataFrame, family: int) -> DataFrame:
    """``base, conv_id, turns``: keys in order of turn (NULL first), then of role and hash."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")), turn_key(F.col("role"), F.col("text")).alias("key"))
    keyed = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("_t")
    )
    base = F.col("conv_id") - F.col("conv_id") % family
    # One exchange by base serves the grouping and the join of a conversation with its base.
    return (
        keyed.withColumn("base", base)
        .repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list("_t"))["key"].alias("turns"))
    )


def _path(turns: Column) -> Column:
    return F.unhex(F.array_join(turns, ""))


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path`` of ``conversations`` (``conv_id, turn, role, text``) as they are.

    Turns are ordered by ``turn``, NULL first; of turns with one number the smaller role, then the
    smaller hash comes first, and repeated rows are turns of their own. NULL role or text counts as
    empty. Turns without a ``conv_id`` belong to no conversation. A path takes 20 bytes a turn.
    """
    return _turns(conversations, 1).select("conv_id", _path(F.col("turns")).alias("path"))


def rebuilt_paths(conversations: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """``conv_id, path`` of rebuilt conversations, which share beginnings within a family.

    Conversation c takes the first h turns of conversation ``c - c % family`` (all it has, none if it is
    absent), then its own turns after its first h; h is the CRC-32 of c in decimal, modulo ``modulus``.
    """
    own = _turns(conversations, family)
    heads = own.where(F.col("conv_id") == F.col("base")).select(
        "base", F.slice("turns", 1, modulus - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % modulus).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv_id", _path(F.concat(head, tail)).alias("path"))


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common at their beginning."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


def choose_splitters(sample: list[tuple[bytes, int]], shards: int) -> list[bytes]:
    """Up to ``shards - 1`` splitters at even steps of weight in ``sample`` (path, weight).

    A splitter is cut after the first turn in which it differs from the path before it. While the
    prefixes of all splitters are more than ``MAX_SKELETON`` nodes, every second splitter goes.
    """
    sample = sorted(sample)
    total, seen, found = sum(w for _, w in sample), 0, []
    for (before, weight), (path, _) in zip(sample, sample[1:]):
        seen += weight
        if seen * shards >= total * (len(found) + 1) and len(found) < shards - 1 and before != path:
            found.append(path[: (_shared(before, path) + 1) * TURN])
    while sum(len(s) // TURN for s in found) > MAX_SKELETON:
        found = found[1::2]
    return found


def skeleton_of(splitters: list[bytes]) -> list[bytes]:
    """All proper prefixes of the splitters, the root included, in sorted order."""
    prefixes = {s[:at] for s in splitters for at in range(0, len(s), TURN)}
    return sorted(prefixes | {b""})


class _Node:
    __slots__ = ("ends", "held", "least", "leaves", "many", "children", "saved", "where")

    def __init__(self, where: int):
        self.where = where
        self.many = self.children = self.leaves = self.saved = 0
        self.least = None
        self.ends = None
        self.held: list[tuple] = []


_EMPTY = hashlib.sha256().hexdigest()
_FIELDS = [
    ("skeleton", pa.int32()),
    ("under", pa.int32()),
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
]
NODES = (
    "skeleton int, under int, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


class _Shard:
    """One pass over sorted paths. Rows go to ``out`` as soon as their parent is known.

    Held are the open nodes of the current path and, for those off the skeleton, one row for each
    finished child.
    """

    def __init__(self, skeleton: dict[bytes, int]):
        self.skeleton = skeleton
        self.path = b""
        self.stack = [_Node(skeleton[b""])]
        self.out: list[tuple] = []

    def add(self, path: bytes, many: int, least: int, ids: str) -> None:
        if path != self.path:
            self.close(_shared(path, self.path))
            for depth in range(len(self.stack), len(path) // TURN + 1):
                above = self.stack[-1].where
                where = self.skeleton.get(path[: depth * TURN], -1) if above >= 0 else -1
                self.stack.append(_Node(where))
            self.path = path
        top = self.stack[-1]
        top.many += many
        top.least = least if top.least is None else min(top.least, least)
        if top.ends is None:
            top.ends = hashlib.sha256()
        else:
            top.ends.update(b",")
        top.ends.update(ids.encode())

    def close(self, depth: int) -> None:
        """Finish the open nodes deeper than ``depth``."""
        while len(self.stack) > depth + 1:
            node, level = self.stack.pop(), len(self.stack)
            ends = node.ends.hexdigest() if node.ends else None
            if node.where >= 0:
                self._partial(node, level, ends)
                continue
            above = self.stack[-1]
            size = int.from_bytes(self.path[level * TURN - 4 : level * TURN])
            node.saved += (node.many - 1) * size
            node.leaves = node.leaves or 1
            for row in node.held:
                self.out.append((None, None, row[0], row[1], node.least, *row[2:]))
            row = (node.least, level, node.many, node.children, node.leaves, node.saved, ends or _EMPTY)
            if above.where >= 0:
                self.out.append((None, above.where, row[0], row[1], None, *row[2:]))
            else:
                above.held.append(row)
            above.many += node.many
            above.least = node.least if above.least is None else min(above.least, node.least)
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved

    def _partial(self, node: _Node, level: int, ends: str | None) -> None:
        """What this shard has of a skeleton node, without its skeleton children."""
        self.out.append(
            (node.where, None, node.least, level, None, node.many, node.children, node.leaves, node.saved, ends)
        )

    def finish(self) -> None:
        self.close(0)
        root = self.stack[0]
        self._partial(root, 0, root.ends.hexdigest() if root.ends else None)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in _FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=t) for c, (_, t) in zip(columns, _FIELDS)], names=[n for n, _ in _FIELDS]
    )


def _roll_up(skeleton: list[bytes], partials: dict[int, dict]) -> list[tuple]:
    """Finished rows of the skeleton's nodes, in the order of ``skeleton``."""
    number = {p: i for i, p in enumerate(skeleton)}
    zero = {"least": None, "many": 0, "children": 0, "leaves": 0, "saved": 0, "ends": None}
    nodes = [{**zero, **partials.get(i, {})} for i in range(len(skeleton))]
    # A prefix sorts before what begins with it, so children come after their parents.
    for i in range(len(skeleton) - 1, -1, -1):
        node, path = nodes[i], skeleton[i]
        if not node["many"]:
            continue
        node["leaves"] = node["leaves"] or 1
        if path:
            node["saved"] += (node["many"] - 1) * int.from_bytes(path[-4:])
            above = nodes[number[path[:-TURN]]]
            above["least"] = min(x for x in (above["least"], node["least"]) if x is not None)
            above["children"] += 1
            for c in ("many", "leaves", "saved"):
                above[c] += node[c]
    rows = []
    for path, node in zip(skeleton, nodes):
        above = nodes[number[path[:-TURN]]]["least"] if path else None
        counts = (node["many"], node["children"], node["leaves"], node["saved"], node["ends"] or _EMPTY)
        rows.append((node["least"], len(path) // TURN, above, *counts))
    return rows


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie over ``paths`` (``conv_id, path``; ids are distinct).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree, members beyond the first times bytes
    of the node's text), ``ends_sha256`` (of the ids that end at the node, ascending, comma-joined). Empty
    paths end at the root; no paths give no rows. A hash needs its ids one after another: they come in
    runs of up to 4096 joined ids and pass through as a stream. ``shards`` defaults to the row count.
    """
    spark = paths.sparkSession
    paths = stored(paths, "conversation-paths")
    rows = paths.count()
    if shards is None:
        shards = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_SHARD))
        shards = min(MAX_SHARDS, shards)
    every = max(1, rows // SAMPLE)
    sample = (
        paths.where(F.pmod(F.xxhash64("path"), F.lit(every)) == 0)
        .select(F.substring("path", 1, LONGEST_SPLITTER).alias("path"), (F.length("path") + TURN).alias("w"))
        .groupBy("path")
        .agg(F.max("w").alias("w"))
    )
    splitters = choose_splitters([(bytes(p), w) for p, w in sample.collect()], shards)
    skeleton = skeleton_of(splitters)
    shipped = spark.sparkContext.broadcast((splitters, {p: i for i, p in enumerate(skeleton)}))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shipped.value[0]
        for batch in batches:
            shard = [bisect.bisect_right(cuts, p) for p in batch.column("path").to_pylist()]
            columns = [*batch.columns, pa.array(shard, type=pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "shard"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "least", "ids"))):
                shard = shard or _Shard(shipped.value[1])
                shard.add(*row)
                if len(shard.out) >= BATCH_ROWS:
                    yield _table(shard.out)
                    shard.out = []
        if shard:
            shard.finish()
            yield _table(shard.out)

    ids = F.sort_array(F.collect_list("conv_id"))
    runs = paths.groupBy("path", F.shiftright("conv_id", 12).alias("run")).agg(ids.alias("_ids"))
    runs = runs.select(
        "path",
        "run",
        F.size("_ids").cast("long").alias("n"),
        F.get("_ids", F.lit(0)).alias("least"),
        F.array_join(F.col("_ids").cast("array<string>"), ",").alias("ids"),
    )
    placed = runs.mapInArrow(place, "path binary, run long, n long, least long, ids string, shard int")
    found = stored(
        placed.repartitionById(len(splitters) + 1, F.col("shard"))
        .sortWithinPartitions("path", "run")
        .mapInArrow(read, NODES),
        "trie-nodes",
    )
    partials = (
        found.where(F.col("skeleton").isNotNull())
        .groupBy("skeleton")
        .agg(
            F.min("conv_id").alias("least"),
            F.sum("n_convs").alias("many"),
            F.sum("n_children").alias("children"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
            F.max("ends_sha256").alias("ends"),
        )
    )
    # At most MAX_SKELETON rows each way.
    held = {r["skeleton"]: r.asDict() for r in partials.collect()}
    tops = _roll_up(skeleton, held) if held else []
    columns = [n for n, _ in _FIELDS[2:]]
    schema = NODES.replace("skeleton int, under int, ", "")
    top = spark.createDataFrame([r for r in tops if r[0] is not None], schema)
    known = spark.createDataFrame([(i, r[0]) for i, r in enumerate(tops)], "under int, _above long")
    local = (
        found.where(F.col("skeleton").isNull())
        .join(F.broadcast(known), "under", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    )
    return local.select(*columns).union(top.select(*columns))
