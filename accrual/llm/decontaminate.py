"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of a benchmark item (a shorter item is one window). A window is
the set of its shingles of ``shingle`` words with their positions, and a document holds the window
only if it holds all of them, so any one shingle is a sufficient prefix; the rarest one over all
documents is taken. Documents and windows meet on that shingle alone, the bounds on position and
length drop candidates that would start before the document or end after it, and what is left is
compared word by word.

The documents are read and split once. That pass joins the hashes of their shingles with the hashes
that occur in the benchmark; each hit keeps the few words around it that any window through it could
cover, so the exact comparison needs no second look at the text. Every later step moves hits only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import free_name, plain_words, stored

WIDTH = 13
SHINGLE = 5
#: A hash takes about 32 bytes in a broadcast table; above this many the join is shuffled instead.
BROADCAST_ROWS = 1_000_000
#: Positions of a document that are looked at together.
SEGMENT = 64


def _shingle_hash(words: Column, start: Column, length: int) -> Column:
    """Hash of ``length`` words from ``start`` (from 0); NULL where they would end after the list."""
    picked = [F.get(words, start + i) for i in range(length)]
    return F.when(start + length <= F.size(words), F.xxhash64(F.lit(length), *picked))


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows (``words``) and the items that have them (``item_id``), one row per pair."""
    words = benchmark.select("item_id", plain_words(F.col("text")).alias("_w"))
    words = words.where(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - width, F.lit(0)))
    windows = F.transform(starts, lambda i: F.slice("_w", i + 1, F.lit(width)))
    return words.select("item_id", F.explode(windows).alias("words")).distinct()


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Shingles of each distinct window: ``window``, ``words``, ``gram`` and its place ``offset``.

    The shingles have ``shingle`` words; a window of fewer words is its own only shingle.
    """
    distinct = windows.select("words").distinct()
    length = F.least(F.size("words"), F.lit(shingle))
    parts = distinct.select(
        F.xxhash64("words").alias("window"),
        "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("offset"),
    )
    gram = F.coalesce(
        _shingle_hash(F.col("words"), F.col("offset"), shingle),
        *(
            F.when(F.size("words") == n, _shingle_hash(F.col("words"), F.lit(0), n))
            for n in range(1, shingle)
        ),
    )
    return parts.withColumn("gram", gram)


def _segments(documents: DataFrame, width: int) -> DataFrame:
    """Documents cut into segments of ``SEGMENT`` words, with the words around that windows may need.

    Columns: ``row`` (a number for the document's row), ``doc_id``, ``n_words``, ``at`` (the segment's
    first position), ``from`` (the position of the first of its ``words``). A document without words has
    one empty segment. No row ever holds more than its own segment.
    """
    listed = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        plain_words(F.col("text")).alias("_w"),
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(SEGMENT))

    def cut(at: Column) -> Column:
        first = F.greatest(at - (width - 1), F.lit(0))
        return F.struct(
            at.alias("at"),
            first.alias("from"),
            F.slice("_w", first + 1, at - first + SEGMENT + width - 1).alias("words"),
        )

    return listed.select(
        "row",
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.explode(F.transform(starts, cut)).alias("_s"),
    ).select("row", "doc_id", "n_words", "_s.*")


def _places(segments: DataFrame, lengths: list[int]) -> DataFrame:
    """Segments with ``pos`` and ``gram`` for each of their positions and shingle lengths.

    The first segment of a document also gives a row with ``pos`` -1, which stands for the document.
    """
    many = len(lengths)
    count = F.least(F.col("n_words") - F.col("at"), F.lit(SEGMENT)).cast("int")
    first = F.when(F.col("at") == 0, -1).otherwise(0)
    numbered = segments.select("*", F.explode(F.sequence(first, count * many - 1)).alias("_i"))
    pos = F.when(F.col("_i") >= 0, F.col("at") + F.floor(F.col("_i") / many)).otherwise(-1).cast("int")
    numbered = numbered.withColumn("pos", pos)
    gram = F.lit(None).cast("long")
    for i, length in enumerate(lengths):
        made = _shingle_hash(F.col("words"), F.col("pos") - F.col("from"), length)
        gram = F.when((F.col("pos") >= 0) & (F.col("_i") % many == i), made).otherwise(gram)
    return numbered.withColumn("gram", gram).drop("_i")


def _hits(documents: DataFrame, grams: DataFrame, lengths: list[int], width: int) -> DataFrame:
    """One row per document (``pos`` -1) and one per place whose shingle is in ``grams``.

    Columns: ``row``, ``doc_id``, ``n_words``, ``pos``, ``gram``, ``from`` (the position of the first kept
    word) and ``near`` (the words that a window through the place could cover).
    """
    known = grams.select("gram", F.lit(True).alias("_known"))
    segments = _segments(documents, width)
    if grams.count() <= BROADCAST_ROWS:
        found = _places(segments, lengths).join(F.broadcast(known), "gram", "left")
    else:
        # Only hashes travel to meet the benchmark's; words follow for segments with a hit.
        segments = stored(segments, "segments")
        met = _places(segments, lengths).select("row", "at", "pos", "gram").join(known, "gram")
        found = _places(segments, lengths).where("pos < 0").select("*", F.lit(None).alias("_known"))
        found = segments.join(met, ["row", "at"]).select(*found.columns).union(found)
    kept = found.where((F.col("pos") < 0) | F.col("_known"))
    near = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    around = F.slice("words", near - F.col("from") + 1, F.lit(2 * width - 1))
    return kept.select(
        "row",
        "doc_id",
        "n_words",
        "pos",
        "gram",
        F.when(F.col("pos") >= 0, near).alias("from"),
        F.when(F.col("pos") >= 0, around).alias("near"),
    )


def find_windows(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """(documents, matches): ``row, doc_id, n_words`` of each, and ``row, start, length, item_id``.

    Both come from one stored pass over the documents. NULL and empty texts have no words and hold
    nothing; NULL and empty items have no windows; repeated rows count as rows of their own; equal
    windows of several items match for each of them.
    """
    windows = stored(benchmark_windows(benchmark, width), "windows")
    shingles = stored(window_shingles(windows, shingle), "window-shingles")
    grams = shingles.select("gram").distinct()
    lengths = sorted(
        r[0]
        for r in shingles.select(F.least(F.size("words"), F.lit(shingle)).alias("n"))
        .distinct()
        .collect()
    )
    hits = stored(_hits(documents, grams, lengths or [shingle], width), "benchmark-hits")
    heads = hits.where(F.col("pos") < 0).select("row", "doc_id", "n_words")
    hits = hits.where(F.col("pos") >= 0)

    # The prefix of a window under rarity order: its rarest shingle over all documents.
    rarity = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("_df"))
    prefix = (
        shingles.join(rarity, "gram", "left")
        .fillna(0, ["_df"])
        .groupBy("window", "words")
        .agg(F.min(F.struct("_df", "gram", "offset")).alias("_p"))
        .select("window", "words", "_p.gram", "_p.offset")
    )
    start = F.col("pos") - F.col("offset")
    there = F.slice("near", start - F.col("from") + 1, F.size("words"))
    matches = (
        hits.join(prefix, "gram")
        .where((start >= 0) & (start + F.size("words") <= F.col("n_words")))
        .where(there == F.col("words"))
        .select("row", start.alias("start"), F.size("words").alias("length"), "window", "words")
    )
    return heads, matches.join(windows, "words").select("row", "start", "length", "item_id")


def _covered(spans: Column) -> Column:
    """Number of words inside any of the spans (structs of start and end, sorted by start)."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("end"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["end"])))
            .cast("long")
            .alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def contamination(documents: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Contaminated means that at least one word in ``share`` is inside a benchmark window. A document
    without hits has the hash of the empty string. See ``find_windows`` for NULLs and ties.
    """
    heads, matches = find_windows(documents, benchmark)
    spans = matches.select(
        "row", F.struct("start", (F.col("start") + F.col("length")).alias("end")).alias("span"), "item_id"
    )
    per_row = spans.groupBy("row").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    joined = heads.join(per_row, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long"))
    return joined.select(
        "row",
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
    ).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated_rows(documents: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """The rows of ``documents`` that are not contaminated themselves, with their columns as they were.

    The decision is joined back by ``doc_id`` and a hash of the text, either of which may be NULL: rows of
    one text have one decision, and a row says nothing about others that share its id or have none.
    """
    kept_id, kept_hash, name = (free_name(documents, c) for c in ("_id", "_kept", "_hash"))
    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash"))
    bad = contamination(documents.select(key.alias("doc_id"), "text"), benchmark, share).where("contaminated")
    bad = bad.select(F.col("doc_id.doc_id").alias(kept_id), F.col("doc_id.text_hash").alias(kept_hash)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(name) == F.col(kept_hash))
    return documents.withColumn(name, F.xxhash64("text")).join(bad, same, "left_anti").drop(name)
