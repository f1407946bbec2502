"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import stored


PIECES = 256
LEAST_PIECE = 10_000


def _minimum(edges: DataFrame, share: int) -> DataFrame:
    """``edges`` (u, v) with the smallest neighbour of u, or u itself, as m.

    A hub, with more than ``share`` neighbours, is cut into pieces by a hash of the neighbour. At most
    ``PIECES`` or so nodes can be hubs, so their list is broadcast.
    """
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    hubs = F.broadcast(
        smallest.where(F.col("_n") > share).select("u", F.ceil(F.col("_n") / share).alias("_k"))
    )
    pieces = F.coalesce("_k", F.lit(1))
    cut = edges.join(hubs, "u", "left").withColumn("_salt", F.pmod(F.xxhash64("v"), pieces))
    copies = F.sequence(F.lit(0).cast("long"), pieces - 1)
    each = smallest.join(hubs, "u", "left").select("u", "m", F.explode(copies).alias("_salt"))
    joined = cut.select("u", "v", "_salt").join(each, ["u", "_salt"])
    return joined.select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame, share: int) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _minimum(both, share).where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _small_star(edges: DataFrame, share: int) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    ends = F.explode(F.array("u", "v"))
    return _minimum(down, share).select(ends.alias("u"), F.col("m").alias("v"))


def _state(links: DataFrame) -> tuple:
    """Number of links and two hashes of all of them, which cannot overflow."""
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("u", "v")),
            F.bit_xor(F.xxhash64("v", "u", F.lit(1))),
        ).first()
    )


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component``: for every node of a link, the smallest node that links reach.

    Ids are long; links with a NULL end, loops and repeats are ignored. The number of rounds grows with
    the logarithm of the number of nodes; each round is two aggregates with map-side minima and two
    joins, in which hubs are cut into pieces, and is written to the shared folder. No links give no rows.
    """
    links = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
    links = stored(links.where(F.col("u") != F.col("v")).distinct(), "links")
    state = _state(links)
    while True:
        share = max(LEAST_PIECE, 2 * state[0] // PIECES)
        star = _small_star(_large_star(links, share), share).where(F.col("u") != F.col("v"))
        links = stored(star.distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
