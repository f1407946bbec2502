"""Near duplicates among vectors by an epsilon grid order join.

For unit vectors, cosine >= c means a distance of at most ``eps = sqrt(2 - 2 c)``. Vectors are projected
on the leading principal axes (of all vectors), put into grid cells of width ``eps`` there, and sorted by
cell. Consecutive vectors form blocks with a bounding box. Two blocks meet only where their cells on the
first two axes touch (an equi-join on cells, never all pairs of a label) and their boxes are within
``eps``; then the two sequences are joined recursively: intervals whose boxes are farther apart are
skipped, small ones are compared by exact cosine in double precision.

Equal vectors are one class with a multiplicity. A block pair returns the number of links of each of its
vectors and only those links that connect something new, so a dense group never becomes a list of
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import stored
from accrual.llm.components import connected_components
from accrual.llm.jaccard_join import forest

COSINE = 0.98
AXES = 8
BLOCK = 512
LEAF = 64
ROWS_PER_PARTITION = 50_000
MAX_PARTITIONS = 65_536
# Distances are rounded; a pair is only skipped when it is farther apart than this beyond eps.
SLACK = 1e-6


def usable(vector: Column) -> Column:
    """True for vectors of finite numbers that are not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows) -> np.ndarray:
    """Unit vectors in double precision; scaled first so that squares stay finite."""
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame, axes: int = AXES) -> dict[int, np.ndarray]:
    """For each vector length, the leading principal axes (length x axes) of all unit vectors.

    One aggregate: every task returns sums and products of its vectors, length squared numbers.
    """

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for frame in frames:
            for length, part in frame.groupby("length"):
                x = _unit(part["embedding"])
                ones = np.column_stack([np.ones(len(x)), x])
                held[length] = held.get(length, 0) + ones.T @ ones
        for length, total in held.items():
            cells = np.arange(total.size)
            yield pd.DataFrame({"length": length, "cell": cells, "value": total.ravel()})

    rows = (
        classes.select("length", "embedding")
        .mapInPandas(sums, "length int, cell int, value double")
        .groupBy("length", "cell")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    found = {}
    for length, part in rows.groupby("length"):
        size = int(length) + 1
        total = np.zeros(size * size)
        total[part["cell"].to_numpy()] = part["value"]
        total = total.reshape(size, size)
        mean = total[0, 1:] / total[0, 0]
        covariance = total[1:, 1:] / total[0, 0] - np.outer(mean, mean)
        found[int(length)] = np.linalg.eigh(covariance)[1][:, ::-1][:, :axes]
    return found


PLACED = "class long, label string, length int, many long, cells array<int>, coords binary, unit binary"
BLOCKS = (
    "block long, label string, length int, low array<double>, high array<double>, "
    "first array<int>, last array<int>, classes binary, many binary, coords binary, unit binary"
)


def _place(axes: dict[int, np.ndarray], eps: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, part in frame.groupby("length"):
                unit = _unit(part["embedding"])
                coords = unit @ axes[int(length)]
                out = part[["class", "label", "length", "many"]].copy()
                out["cells"] = list(np.floor(coords / eps).astype(np.int32))
                out["coords"] = [c.tobytes() for c in coords]
                out["unit"] = [u.tobytes() for u in unit]
                yield out

    return run


def _pack(block: int):
    """Runs of at most ``block`` consecutive rows of one label and length, as one row each."""

    def flush(rows: pd.DataFrame, number: int) -> dict:
        coords = np.array([np.frombuffer(c) for c in rows["coords"]])
        return {
            "block": number,
            "label": rows["label"].iloc[0],
            "length": rows["length"].iloc[0],
            "low": coords.min(axis=0),
            "high": coords.max(axis=0),
            "first": np.array(rows["cells"].tolist()).min(axis=0),
            "last": np.array(rows["cells"].tolist()).max(axis=0),
            "classes": rows["class"].to_numpy(dtype=np.int64).tobytes(),
            "many": rows["many"].to_numpy(dtype=np.int64).tobytes(),
            "coords": coords.tobytes(),
            "unit": b"".join(rows["unit"]),
        }

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            group = (frame[["label", "length"]] != frame[["label", "length"]].shift()).any(axis=1).cumsum()
            made = []
            for _, rows in frame.groupby(group, sort=False):
                at = 0
                ends = rows.index[-1] == frame.index[-1]
                while at < len(rows) and (not ends or len(rows) - at >= block):
                    made.append(flush(rows.iloc[at : at + block], number))
                    number, at = number + 1, at + block
                rest = rows.iloc[at:] if ends else None
            if made:
                yield pd.DataFrame(made)
        if rest is not None and len(rest):
            yield pd.DataFrame([flush(rest, number)])

    return run


def _far(a: np.ndarray, b: np.ndarray, eps: float) -> bool:
    """True where the bounding boxes of two sets of points are more than ``eps`` apart."""
    gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(gap @ gap) > eps * eps


def join_sequences(left: dict, right: dict, same: bool, cosine: float, eps: float) -> tuple:
    """Link counts of both sequences and (left, right) positions of the links that were found."""
    counts = [np.zeros(len(left["unit"]), dtype=np.int64), np.zeros(len(right["unit"]), dtype=np.int64)]
    found = []

    def visit(a0: int, a1: int, b0: int, b1: int) -> None:
        if same and b1 <= a0:
            return  # the mirror image of an interval pair that is visited
        if _far(left["coords"][a0:a1], right["coords"][b0:b1], eps):
            return
        if max(a1 - a0, b1 - b0) <= LEAF:
            close = left["unit"][a0:a1] @ right["unit"][b0:b1].T >= cosine
            if same:
                close &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
            at, to = np.nonzero(close)
            np.add.at(counts[0], at + a0, right["many"][to + b0])
            np.add.at(counts[1], to + b0, left["many"][at + a0])
            found.append(np.column_stack([at + a0, to + b0]))
            return
        halves = [(lo, hi) if hi - lo <= LEAF else None for lo, hi in ((a0, a1), (b0, b1))]
        split = [
            [kept] if kept else [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
            for kept, (lo, hi) in zip(halves, ((a0, a1), (b0, b1)))
        ]
        for x in split[0]:
            for y in split[1]:
                visit(*x, *y)

    visit(0, len(left["unit"]), 0, len(right["unit"]))
    return counts, np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


def _opened(row, side: str, length: int) -> dict:
    return {
        "classes": np.frombuffer(row[f"classes_{side}"], dtype=np.int64),
        "many": np.frombuffer(row[f"many_{side}"], dtype=np.int64),
        "coords": np.frombuffer(row[f"coords_{side}"]).reshape(-1, min(AXES, length)),
        "unit": np.frombuffer(row[f"unit_{side}"]).reshape(-1, length),
    }


def _compare(cosine: float, eps: float):
    """Rows (a, NULL, links of a) and (a, b, NULL) for each pair of blocks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                left, right = (_opened(row, s, row["length"]) for s in "xy")
                same = row["x"] == row["y"]
                counts, links = join_sequences(left, right, same, cosine, eps)
                out = []
                for side, count in zip((left, right), counts):
                    some = np.flatnonzero(count)
                    out.append(pd.DataFrame({"a": side["classes"][some], "links": count[some]}))
                offset = 0 if same else len(left["unit"])
                names = left["classes"] if same else np.concatenate([left["classes"], right["classes"]])
                kept = np.array(forest(links + [0, offset]), dtype=np.int64).reshape(-1, 2)
                out.append(pd.DataFrame({"a": names[kept[:, 0]], "b": names[kept[:, 1]]}))
                made = pd.concat(out, ignore_index=True)
                for c in ("a", "b", "links"):
                    made[c] = made[c].astype("Int64") if c in made else pd.array([None] * len(made), dtype="Int64")
                yield made[["a", "b", "links"]]

    return run


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs ``x <= y`` of blocks of one label whose boxes are within ``eps``."""
    summary = blocks.select("block", "label", "length", "low", "high", "first", "last")

    def cells(side: str, reach: int) -> DataFrame:
        axis = lambda i: F.sequence(
            F.get("first", F.lit(i)) - reach, F.get("last", F.lit(i)) + reach
        )
        second = F.coalesce(axis(1), F.array(F.lit(0)))
        return summary.select(
            F.col("block").alias(side),
            "label",
            "length",
            F.col("low").alias(f"low_{side}"),
            F.col("high").alias(f"high_{side}"),
            F.explode(axis(0)).alias("c0"),
            second.alias("_second"),
        ).withColumn("c1", F.explode("_second")).drop("_second")

    gap = F.zip_with(
        F.zip_with("low_x", "high_y", lambda a, b: a - b),
        F.zip_with("low_y", "high_x", lambda a, b: a - b),
        lambda a, b: F.greatest(a, b, F.lit(0.0)),
    )
    squared = F.aggregate(gap, F.lit(0.0), lambda acc, g: acc + g * g)
    pairs = cells("x", 0).join(cells("y", 1), ["label", "length", "c0", "c1"])
    pairs = pairs.where((F.col("x") <= F.col("y")) & (squared <= eps * eps))
    return pairs.select("x", "y", "length").distinct()


def near_duplicate_vectors(
    embeddings: DataFrame, cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """Per row of ``embeddings`` (``vec_id, embedding, label``): ``vec_id, n_links, component_id, kept``.

    Two vectors link when their labels and lengths are equal, the label is not NULL, and their cosine in
    double precision is at least ``cosine``. Vectors that are NULL, zero, or hold NULL or non-finite
    numbers link with nothing. Repeated rows are vectors like others and link with each other. Rows
    without ``vec_id`` count as links and take part; a component has the smallest ``vec_id`` in it.
    """
    eps = float(np.sqrt(2 - 2 * cosine)) + SLACK
    rows = embeddings.select("vec_id", "embedding", F.col("label").cast("string").alias("label"))
    good = usable(F.col("embedding")) & F.col("label").isNotNull()
    classes = (
        rows.where(good)
        .groupBy("label", "embedding")
        .agg(F.count(F.lit(1)).alias("many"), F.min("vec_id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id())
        .withColumn("length", F.size("embedding"))
    )
    classes = stored(classes, "vector-classes")
    axes = principal_axes(classes)
    placed = classes.select("class", "label", "length", "many", "embedding").mapInPandas(
        _place(axes, eps), PLACED
    )
    partitions = min(MAX_PARTITIONS, max(1, -(-classes.count() // ROWS_PER_PARTITION)))
    order = ["label", "length", "cells", "class"]
    blocks = stored(
        placed.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(_pack(block), BLOCKS),
        "vector-blocks",
    )
    pairs = _block_pairs(blocks, eps)

    def side(name: str) -> DataFrame:
        content = [F.col(c).alias(f"{c}_{name}") for c in ("classes", "many", "coords", "unit")]
        return blocks.select(F.col("block").alias(name), *content)

    compared = pairs.join(side("x"), "x").join(side("y"), "y")
    links = stored(
        compared.mapInPandas(_compare(cosine, eps), "a long, b long, links long"), "vector-links"
    )
    numbers = links.where(F.col("b").isNull()).groupBy(F.col("a").alias("class")).agg(
        F.sum("links").alias("links")
    )
    reached = connected_components(links.where(F.col("b").isNotNull())).withColumnRenamed("node", "class")
    named = (
        classes.select("class", "label", "embedding", "many", "least")
        .join(numbers, "class", "left")
        .join(reached, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select(
        "label",
        "embedding",
        (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id",
    )
    found = rows.where(good).join(named, ["label", "embedding"])
    alone = rows.where(~good).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = found.select("vec_id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
