import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from corpora import documents, nothing, prepared, texts  # noqa: F401

from accrual.llm.histogram_sort import find_cuts, histogram_shards, shard_documents, text_size


def checked(rows, sizes, shards):
    """Slots are gapless, and shards differ by no more than the tolerance or the largest row."""
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    for held in slots.values():
        assert sorted(held) == list(range(len(held)))
    total, most = sum(sizes), max(sizes)
    by_shard = Counter()
    for r in rows:
        by_shard[r["shard"]] += r["size"]
    for shard in range(shards):
        assert abs(by_shard[shard] - total / shards) <= most + 0.01 * total / shards


def test_documents(documents):
    given = documents.select("doc_id", "text").collect()
    rows = shard_documents(documents, 4).collect()
    want = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, None if r["text"] is None else zlib.crc32(r["text"].encode()))
        for r in given
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    assert {r["shard"] for r in rows} <= set(range(4))
    checked(rows, [r["size"] for r in rows], 4)


def test_columns_stay_and_clashing_ones_are_replaced(documents):
    clashing = documents.withColumns({"Shard": F.lit("x"), "interval": F.lit(1), "size": text_size(F.col("text"))})
    out = histogram_shards(clashing, 3, "size", F.col("text"), F.col("doc_id"))
    assert out.columns == ["doc_id", "text", "lang", "source", "score", "interval", "size", "shard", "slot"]
    assert out.count() == documents.count()


@pytest.mark.parametrize("repeats", [1, 400])
def test_one_text_and_one_id(spark, repeats):
    """All rows equal: only their number can tell them apart."""
    df = spark.range(repeats).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    rows = shard_documents(df, 8).collect()
    checked(rows, [5] * repeats, 8)


def test_group_stays_together_within_tolerance(spark):
    df = spark.range(3000).select("id", (F.col("id") % 500).alias("g"), F.lit(1).alias("size"))
    out = histogram_shards(df, 4, "size", F.col("g"), F.col("id"), tolerance=0.02)
    assert out.groupBy("g").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_cuts_meet_their_targets(spark):
    keyed = spark.range(5000).select(
        (F.col("id") * 7919).alias("_h"), F.lit(0).cast("long").alias("_t"), F.col("id").alias("_u"), F.lit(2).alias("size")
    )
    cuts = find_cuts(keyed, ["_h", "_t", "_u"], "size", 5, 0.0, bins=16)
    below = [sum(2 for i in range(5000) if (i * 7919, 0, i)[: len(c)] < c) for c in cuts]
    assert below == [2000, 4000, 6000, 8000]


def test_empty(nothing):
    assert shard_documents(nothing).count() == 0
