"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams are columns of a 0/1 incidence matrix; the product of the matrix
with its transpose holds all overlaps. Most of it is never formed:

* Documents with equal sets of n-grams are one row (a class).
* Two sets that are similar enough share at least ``SHARED`` of the first ``n - ceil(t n) + SHARED``
  n-grams of each, under any order that is the same for all. The order is by rarity, so only the rarest
  columns of a document are kept. An n-gram is as rare as its words together; words are counted in a
  table of fixed size (``2 ** SKETCH_BITS`` counters that words share by hash): shared counters make
  the order less good, never wrong.
* A kept column with at most ``PAIRED`` rows gives candidate pairs. Pairs whose sizes alone rule out the
  similarity are discarded; overlaps in the kept columns are added up, and pairs with fewer than sets
  of their sizes must share there are discarded. Only what is left is counted on the full sets.
* Longer columns with mostly the same rows are one (a family), so that near copies of one text, which
  share many columns, meet once and not once a column. A family is cut into row blocks, and each pair of
  blocks is one task that multiplies the sets of its documents, column block by column block, and adds
  up the overlaps. This is done twice: on the
  kept columns, to find the documents that share with another what sets of their sizes must share, and
  on the full sets of those, which go only to the block pairs in which they were found, to find the links,
  of which only those come back that connect something new within the block pair. No pair of a frequent
  column is ever written.

Full sets are made only for documents of such pairs and columns. N-grams and classes are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from accrual.llm.common import free_name, lasting, returning_memory, scratch, small, stored
from accrual.llm.components import connected_components

SKETCH_BITS = 18
PAIRED = 128
BLOCK = 512
COLUMNS_AT_ONCE = 4096
PERCENT = 90
WORDS = 3
SHARED = 4

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of ``text`` in order: A-Z is lower-cased, ASCII white space separates."""
    parts = text.encode().translate(_LOWER).split()
    return np.fromiter(map(xxhash.xxh64_intdigest, parts), dtype=np.uint64, count=len(parts))


def _grams(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the runs of ``words`` words; of the only run if there are fewer words."""
    width = min(words, len(hashes))
    count = len(hashes) - width + 1 if width else 0
    mixed = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : count + i]) * _MIX[i % len(_MIX)]
        mixed ^= mixed >> np.uint64(29)
    return mixed


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of ``text``.

    A text of fewer words is one n-gram, one without words has none.
    """
    return np.unique(_grams(word_hashes(text), words))


def kept_grams(text: str, words: int, percent: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set of ``text``, and its rarest n-grams, as many as the similarity demands.

    ``weights`` holds a logarithmic count for each bucket of words.
    """
    hashes = word_hashes(text)
    grams, first = np.unique(_grams(hashes, words), return_index=True)
    load = weights[_buckets(hashes)]
    width = min(words, len(hashes))
    common = sum((load[first + i] for i in range(width)), np.zeros(len(first)))
    return grams, grams[np.lexsort((grams, common))[: prefix_length(len(grams), percent)]]


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _class_of(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes()) - (1 << 63)


def _signed(grams: np.ndarray) -> np.ndarray:
    return grams.view(np.int64)


def prefix_length(n: int, percent: int = PERCENT, shared: int = SHARED) -> int:
    """How many n-grams of a set of ``n`` to keep, so that similar sets share ``shared`` of them."""
    return min(n, n - -(-percent * n // 100) + shared)


def _kept_count(n: Column, percent: int) -> Column:
    """``prefix_length`` as a column."""
    return F.least(n, n - F.ceil(percent * n / 100) + SHARED)


def similar(overlap, a, b, percent: int = PERCENT):
    return 100 * overlap >= percent * (a + b - overlap)


SCAN_SCHEMA = "doc_id long, text_hash long, class long, n long, bucket long, weight long"


def _scan(words: int):
    """Rows of documents (class and size) and, once a task, rows of the rarity table."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for frame in frames:
            made = []
            for at in range(0, len(frame), 256):  # a few texts at a time, to hold few hashes
                hashes = [word_hashes(text) for text in frame["text"].iloc[at : at + 256]]
                weights += np.bincount(_buckets(np.concatenate(hashes)), minlength=len(weights))
                sets = [np.unique(_grams(h, words)) for h in hashes]
                made += [(_class_of(grams) if len(grams) else None, len(grams)) for grams in sets]
            out = frame[["doc_id", "text_hash"]].copy()
            out["class"] = pd.array([c for c, _ in made], dtype="Int64")
            out["n"] = [n for _, n in made]
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out.assign(bucket=pd.array([None] * len(out), dtype="Int64"), weight=0)
        seen = np.flatnonzero(weights)
        none = pd.array([None] * len(seen), dtype="Int64")
        yield pd.DataFrame(
            {"doc_id": none, "text_hash": 0, "class": none, "n": 0, "bucket": seen, "weight": weights[seen]}
        )

    return run


def _prefixes(words: int, percent: int, weights: np.ndarray):
    """The kept columns of each document: its rarest n-grams, as many as the similarity demands."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for frame in frames:
            made = []
            for text in frame["text"]:
                grams, keep = kept_grams(text, words, percent, weights)
                name = _class_of(grams)
                if len(grams) and name not in done:
                    done.add(name)
                    made.append((name, len(grams), np.sort(_signed(keep))))
            yield pd.DataFrame(made, columns=["class", "n", "grams"])

    return run


def _sets(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [np.sort(_signed(shingle_set(text, words))) for text in frame["text"]]
            yield pd.DataFrame({"class": frame["class"], "grams": sets})

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of every set of ``left`` with every set of ``right``.

    The incidence blocks hold only columns that both sides have, ``COLUMNS_AT_ONCE`` at a time.
    """
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    if not left or not right:
        return total
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for at in range(0, len(shared), COLUMNS_AT_ONCE):
        columns = shared[at : at + COLUMNS_AT_ONCE]
        blocks = []
        for side in (left, right):
            block = np.zeros((len(side), len(columns)), dtype=np.float32)
            for row, grams in enumerate(side):
                part = grams[np.searchsorted(grams, columns[0]) : np.searchsorted(grams, columns[-1], "right")]
                place = np.searchsorted(columns, part)
                block[row, place[columns[place] == part]] = 1
            blocks.append(block)
        total += blocks[0] @ blocks[1].T
    return total


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Of (n, 2) index pairs, those that connect something new."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in links.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _bound(a, b, percent: int):
    """How many of their kept n-grams sets of sizes ``a`` and ``b`` must share to be similar."""
    common = np.ceil(percent * (a + b) / (100 + percent))
    lacking = [n - np.minimum(n, n - np.ceil(percent * n / 100) + SHARED) for n in (a, b)]
    return common - np.maximum(*lacking)


def _sides(frame: pd.DataFrame) -> tuple[list[pd.DataFrame], bool]:
    """The two row blocks of a task (one block twice for a block with itself)."""
    frame = frame.drop_duplicates("class")
    first, second = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
    return [frame[frame["block"] == b] for b in (first, second)], first == second


TASK_SCHEMA = "family long, i int, j int, block int, class long"


def _promising(percent: int):
    """The rows of documents that share enough kept n-grams with another one of the task."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        (left, right), same = _sides(frame)
        found = overlaps(left["grams"].tolist(), right["grams"].tolist())
        a, b = left["n"].to_numpy(float)[:, None], right["n"].to_numpy(float)[None, :]
        fits = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        close = fits & (found >= _bound(a, b, percent))
        if same:
            np.fill_diagonal(close, False)
        found = pd.concat([left[close.any(axis=1)], right[close.any(axis=0)]])
        return found[["family", "i", "j", "block", "class"]].drop_duplicates("class")

    return run


def _multiply(percent: int):
    """Links between documents of the task, as many as connect them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        (left, right), same = _sides(frame)
        sets = [side["grams"].tolist() for side in (left, right)]
        sizes = [np.array([len(g) for g in side], dtype=np.float64) for side in sets]
        close = similar(overlaps(*sets), sizes[0][:, None], sizes[1][None, :], percent)
        if same:
            close = np.triu(close, 1)
        at, to = np.nonzero(close)
        names = np.concatenate([left["class"].to_numpy(), right["class"].to_numpy()])
        kept = forest(np.column_stack([at, to + (0 if same else len(left))]))
        return pd.DataFrame(
            {"a": [names[x] for x, _ in kept], "b": [names[y] for _, y in kept]}, dtype="int64"
        )

    return run


def _linked(documents: DataFrame, percent: int, words: int, paired: int, block: int) -> DataFrame:
    """``doc_id, text_hash, n, class, component`` of each row; the last two are NULL without n-grams."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("text_hash"),
    )
    scanned = stored(texts.mapInPandas(returning_memory(_scan(words)), SCAN_SCHEMA), "shingle-scan")
    docs = scanned.where(F.col("bucket").isNull()).select("doc_id", "text_hash", "class", "n")
    counted = scanned.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("weight"))
    weights = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    # Arrow keeps the table at 16 bytes a counter on the driver; rows would take some hundred.
    table = counted.toArrow()
    weights[table.column(0).to_numpy()] = table.column(1).to_numpy()
    weights = np.log2(weights + 1.0)

    kept = stored(
        texts.select("text").mapInPandas(
            returning_memory(_prefixes(words, percent, weights)), "class long, n long, grams array<long>"
        ),
        "kept-columns",
    )
    shared = stored(_shared_columns(kept), "shared-columns")

    pairs = stored(_candidate_pairs(shared, percent, paired), "candidate-pairs")
    families = stored(_families(shared.where(F.col("rows") > paired).select("gram", "class")), "families")
    tasks = _block_tasks(families, _columns_of(families, shared), block)
    promising = stored(tasks.applyInPandas(_promising(percent), TASK_SCHEMA), "promising")

    # One document of each class that is still in question, and its full set.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("class")).union(promising.select("class"))
    chosen = (
        docs.where(F.col("class").isNotNull())
        .join(asked.distinct(), "class")
        .groupBy("class")
        .agg(F.min(F.struct("text_hash", "doc_id")).alias("_d"))
        .select("class", "_d.text_hash", F.col("_d.doc_id").alias("_id"))
    )
    # The texts stay where they lie while the list is small.
    chosen = small(stored(chosen, "chosen"))
    wanted = texts.join(chosen, "text_hash").where(F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = wanted.select("class", "text").mapInPandas(
        returning_memory(_sets(words)), "class long, grams array<long>"
    )
    sets = stored(sets, "full-sets")
    links = _verified(pairs, sets, percent).union(
        _tasks(promising, sets).applyInPandas(_multiply(percent), "a long, b long")
    )
    found = connected_components(links).select(F.col("node").alias("class"), "component")
    return docs.join(found, "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )


def _shared_columns(kept: DataFrame) -> DataFrame:
    """``gram, class, n, rows``: the kept columns that more than one class has, and how many rows they have.

    Most columns have one row. They are told where the rows of a column meet, so cells move once.
    """
    column = Window.partitionBy("gram")
    cells = kept.select(F.explode("grams").alias("gram"), "class", "n").select(
        "*",
        F.count(F.lit(1)).over(column).alias("rows"),
        F.min("class").over(column).alias("_low"),
        F.max("class").over(column).alias("_high"),
    )
    return cells.where(F.col("_low") != F.col("_high")).select("gram", "class", "n", "rows").distinct()


def _candidate_pairs(shared: DataFrame, percent: int, paired: int) -> DataFrame:
    """Pairs of columns with at most ``paired`` rows that share as many of them as they must.

    Similar sets have at least ``least`` n-grams in common. Those that one of them has beyond its kept
    ones may be among them; all others, the rarest, are kept on both sides. A pair that also meets in a
    longer column is compared there.
    """
    lists = (
        shared.where(F.col("rows") <= paired)
        .groupBy("gram")
        .agg(F.sort_array(F.collect_set(F.struct("n", "class"))).alias("m"))
    )
    # Columns with the same rows are one column that counts several times. Smaller sets come first in
    # a list, so the size bound is on the second of a pair.
    lists = lists.groupBy("m").agg(F.count(F.lit(1)).alias("times"))
    pairs = lists.select("m", "times", F.posexplode("m").alias("at", "x")).select(
        "times", "x", F.explode(F.slice("m", F.col("at") + 2, F.size("m"))).alias("y")
    )
    pairs = pairs.where(100 * F.col("x.n") >= percent * F.col("y.n"))
    counted = pairs.groupBy("x", "y").agg(F.sum("times").alias("common"))
    least = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    lacking = lambda n: n - _kept_count(n, percent)
    must = least - F.greatest(lacking(F.col("x.n")), lacking(F.col("y.n")))
    return counted.where(F.col("common") >= must).select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar."""
    sets = sets.dropDuplicates(["class"])
    left = sets.select(F.col("class").alias("a"), F.col("grams").alias("_ga"))
    right = sets.select(F.col("class").alias("b"), F.col("grams").alias("_gb"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("_ga", "_gb"))
    return both.where(similar(overlap, F.size("_ga"), F.size("_gb"), percent)).select("a", "b")


def _families(large: DataFrame) -> DataFrame:
    """``family, class``: longer columns (gram, class), of which those with mostly the same rows are one.

    Columns that have the same busiest row, the one in most longer columns, may be one family. They are if
    the pairs of all its rows are no more than the pairs that its columns have one by one; otherwise each
    column is a family of its own. So every pair of a column meets, and never more often than before.
    """
    busy = large.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("class")))
    # Of columns with the same rows, which have the same signature, one is enough.
    signature = [F.bit_xor(F.xxhash64("class", F.lit(i))).alias(f"_s{i}") for i in range(2)]
    columns = (
        busy.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("_k", "class"))["class"].alias("_busiest"), *signature)
        .groupBy("_n", "_busiest", "_s0", "_s1")
        .agg(F.min("gram").alias("gram"))
    )
    columns = stored(columns.select("gram", "_busiest", F.col("_n").cast("double").alias("_n")), "columns")
    rows = large.join(small(columns), "gram").select("_busiest", "class").distinct()
    united = rows.groupBy("_busiest").agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    apart = columns.groupBy("_busiest").agg(F.sum(F.col("_n") * F.col("_n")).alias("_pairs"))
    one = united.join(apart, "_busiest").where(F.col("_rows") * F.col("_rows") <= F.col("_pairs"))
    named = columns.join(one.select("_busiest", F.col("_busiest").alias("_one")), "_busiest", "left")
    named = stored(named.select("gram", F.coalesce("_one", "gram").alias("family")), "family-names")
    return large.join(small(named), "gram").select("family", "class").distinct()


def _block_tasks(families: DataFrame, sets: DataFrame, block: int) -> GroupedData:
    """The rows of families, cut into blocks, with their sets, grouped by pairs of blocks.

    ``families`` holds different (family, class). A family with one row has no pairs.
    """
    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    blocks = F.ceil(F.col("_n") / block).cast("int")
    placed = families.join(sizes.select("family", blocks.alias("_b")), "family").select(
        "family", "class", "_b", F.pmod(F.xxhash64("class"), "_b").cast("int").alias("block")
    )
    sent = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).select(
        "family",
        F.least("block", "_o").alias("i"),
        F.greatest("block", "_o").alias("j"),
        "block",
        "class",
    )
    return _tasks(sent, sets)


def _tasks(sent: DataFrame, sets: DataFrame) -> GroupedData:
    return sent.join(sets, "class").groupBy("family", "i", "j")


def _columns_of(families: DataFrame, shared: DataFrame) -> DataFrame:
    """``class, n, grams``: for each document of ``families``, the kept columns that it has in common with any
    other. Those of one document, which are most, add nothing to an overlap.

    Cells become one row a document before they meet the families, so what is joined are documents, not cells.
    """
    columns = shared.groupBy("class").agg(F.max("n").alias("n"), F.sort_array(F.collect_list("gram")).alias("grams"))
    # An inner join, as a semi join may be moved below the aggregate, back to the cells.
    return columns.join(families.select("class").distinct(), "class")


def jaccard_components(
    documents: DataFrame, percent: int = PERCENT, words: int = WORDS, paired: int = PAIRED, block: int = BLOCK
) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``): ``doc_id, n_shingles, component_id``.

    Two documents link when ``100 * overlap >= percent * union`` of their sets of ``words``-word
    n-grams; ``component_id`` is the smallest ``doc_id`` that links reach. NULL and empty texts have
    no n-grams and link with nothing; rows without ``doc_id`` take part and get the component of what
    they link with (NULL if all of it has no id). Repeated rows keep a row each.
    """
    with scratch(documents.sparkSession):
        linked = _linked(documents, percent, words, paired, block)
        with lasting():
            linked = stored(linked, "linked")
    smallest = (
        linked.where(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
    )
    return linked.join(smallest, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def drop_near_duplicates(
    documents: DataFrame, percent: int = PERCENT, words: int = WORDS, paired: int = PAIRED, block: int = BLOCK
) -> DataFrame:
    """One row of each group of linked documents, with its columns as they were.

    The row with the smallest ``doc_id`` stays (rows without an id come last; among rows of one id the
    smaller text hash decides, among equal rows any one stays). Rows without words all stay.
    """
    name, chosen_id, chosen_hash, copies = (
        free_name(documents, c) for c in ("_hash", "_id", "_kept", "_copies")
    )
    with scratch(documents.sparkSession):
        linked = _linked(documents, percent, words, paired, block)
        # Rows that repeat id and text are one, with their number.
        rows = linked.where(F.col("component").isNotNull()).groupBy("component", "doc_id", "text_hash")
        order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_hash", "_copies")
        kept = (
            rows.agg(F.count(F.lit(1)).alias("_copies"))
            .groupBy("component")
            .agg(F.min(order).alias("_k"))
            .select(
                F.col("_k.doc_id").alias(chosen_id),
                F.col("_k.text_hash").alias(chosen_hash),
                F.col("_k._copies").alias(copies),
            )
        )
        with lasting():
            kept = small(stored(kept, "kept-documents"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    hashed = documents.where(has_words).withColumn(name, F.xxhash64("text"))
    same = (F.col(name) == F.col(chosen_hash)) & F.col("doc_id").cast("long").eqNullSafe(F.col(chosen_id))
    found = hashed.join(kept, same)
    # Only rows that are there several times have to meet.
    repeated = found.where(F.col(copies) > 1).dropDuplicates(["doc_id", name])
    single = found.where(F.col(copies) == 1)
    chosen = single.union(repeated).select(*documents.columns)
    return chosen.union(documents.where(~has_words))
