"""Skew-safe lookups and referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than one in PIECES of all rows, so there are fewer than PIECES.
PIECES = 256
# Rows without a key match nothing, so their salts need no copies on the other side.
KEYLESS_SALTS = 1 << 20
_HASH = "_key_hash"


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys_of_counts(
    counts: DataFrame, keys: list[str], rows: str, pieces: int = PIECES
) -> DataFrame:
    """Hashes of the hot keys, and into how many salts to cut each so that none stays hot.

    ``counts`` has one row per key with its number of rows. Hot is relative to the sum of all rows, so
    there are fewer than ``pieces`` hot keys at any size, and each gets salts by its own share.
    """
    total = counts.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("total"))
    share = F.greatest(F.lit(1), F.floor(total.scalar() / pieces))
    return (
        counts.filter(F.col(rows) > share)
        .groupBy(_key_hash(keys).alias(_HASH))
        .agg(F.ceil(F.sum(rows) / share).cast("int").alias("_salts"))
    )


def salted_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    hot: DataFrame,
    spread_by: list[str],
    how: str = "left",
) -> DataFrame:
    """``fact.join(lookup, keys, how)`` with the rows of hot keys spread over many tasks.

    ``hot`` is the list of :func:`hot_keys_of_counts`, which is bounded, so broadcasting it is safe at
    any size of ``fact``. Rows of a hot key take a salt from the hash of ``spread_by``; the lookup
    rows of a hot key are repeated once per salt. Rows whose key holds a NULL can match nothing and
    are spread as well, instead of meeting in one task. Two keys with one hash are salted alike on
    both sides.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_lookup supports left and inner joins")
    marked = F.broadcast(hot)
    no_key = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    salts = F.coalesce("_salts", F.when(no_key, F.lit(KEYLESS_SALTS)).otherwise(1))
    left = (
        fact.withColumn(_HASH, _key_hash(keys))
        .join(marked, _HASH, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
        .drop("_salts", _HASH)
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = (
        lookup.withColumn(_HASH, _key_hash(keys))
        .join(marked, _HASH, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_salts", _HASH)
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def pair_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_left: list[str],
    spread_right: list[str],
    pack: int = 0,
) -> DataFrame:
    """``left.join(right, keys)`` where keys have many rows on both sides, spread by rows of the result.

    What a key costs is the product of its rows. A key with more than one in ``PIECES`` of all pairs is
    cut into salts by its share: the side with more rows of it is dealt by the hash of its
    ``spread`` columns and the other side's rows are repeated once per salt, so copies stay few. Keys
    with one hash are cut alike. Both frames are read twice, so costly ones should be stored first.

    With ``pack``, for results far larger than both sides, left rows of a key meet the right rows in lists
    of at most so many, which are taken apart last: a row of the result costs no step of the join, and a
    right row's values follow each other, which columnar files store as one. The tasks are then as many
    as the shuffle partitions, as the bytes that are joined say nothing about the rows that come out.
    """
    mark = _key_hash(keys)
    sizes = (
        left.groupBy(*keys).agg(F.count("*").alias("_left"))
        .join(right.groupBy(*keys).agg(F.count("*").alias("_right")), keys)
        .withColumn("_pairs", F.col("_left") * F.col("_right"))
    )
    total = sizes.agg(F.coalesce(F.sum("_pairs"), F.lit(0)).alias("total"))
    share = F.greatest(F.lit(1), F.floor(total.scalar() / PIECES))
    hot = F.broadcast(
        sizes.filter(F.col("_pairs") > share)
        .groupBy(mark.alias(_HASH))
        .agg(
            F.ceil(F.sum("_pairs") / share).cast("int").alias("_salts"),
            (F.sum("_left") >= F.sum("_right")).alias("_deal_left"),
        )
    )

    def salted(side: DataFrame, dealt: Column, spread_by: list[str]) -> DataFrame:
        own = F.array(F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int"))
        every = F.sequence(F.lit(0), F.col("_salts") - 1)
        salts = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).when(dealt, own).otherwise(every)
        marked = side.withColumn(_HASH, mark).join(hot, _HASH, "left")
        return marked.select(*side.columns, F.explode(salts).alias("_salt"))

    lefts = salted(left, F.col("_deal_left"), spread_left)
    rights = salted(right, ~F.col("_deal_left"), spread_right)
    if not pack:
        return lefts.join(rights, [*keys, "_salt"]).drop("_salt")
    others = [c for c in left.columns if c not in keys]
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*spread_left)) - 1
    lists = (
        lefts.dropna(subset=keys)
        .repartition(tasks, *keys, "_salt")
        .withColumn("_list", F.floor(place / pack))
        .groupBy(*keys, "_salt", "_list")
        .agg(F.collect_list(F.struct(*others)).alias("_packed"))
    )
    met = lists.join(rights.repartition(tasks, *keys, "_salt"), [*keys, "_salt"])
    dealt = [c for c in right.columns if c not in keys]
    return met.select(*keys, F.inline("_packed"), *dealt).select(*keys, *others, *dealt)


def fk_violations(
    children: DataFrame, parents: DataFrame, on: list[str], parent_keys: list[str] | None = None
) -> DataFrame:
    """Child keys that no parent row has, with the number of child rows behind each.

    Children are counted per key before the anti join, so repeated keys cross the network once.
    A key with a NULL part references nothing and is no violation.
    """
    names = parent_keys or on
    present = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in on])
    counted = children.filter(present).groupBy(*on).agg(F.count("*").alias("n_rows"))
    targets = parents.select(*[F.col(p).alias(c) for p, c in zip(names, on, strict=True)])
    return counted.join(targets, on, "left_anti")
