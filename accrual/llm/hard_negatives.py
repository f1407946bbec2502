"""Hard negatives by rotated one-bit codes with stored code-vector alignment.

Vectors are whole numbers; a score is an inner product of such vectors and exact. Every vector is turned
by one fixed random rotation (sign flips and Hadamard transforms, so inner products stay) and stored with
one bit per rotated coordinate, its sign, and its alignment: the inner product of the vector with its
code, taken as a unit vector. An anchor is rotated too and its coordinates are rounded to eight bit
planes, so that its product with a code follows from popcounts.

Let a be a vector's alignment and b the anchor's. The parts of both along the code contribute a * b to the
score; what is left of them is orthogonal to the code, and by Cauchy-Schwarz contributes at most
``sqrt(|x|^2 - a^2) * sqrt(|q|^2 - b^2)``. The rounding of the anchor moves b by at most the length of what
was rounded off. So every pair has an interval that holds its score for certain. A pair whose interval lies
outside of what is asked, or below the k best found so far, is skipped; the others are scored in
integers.

Anchors are a stated query set against all rows. They come in rounds of bounded size; in each round the
anchors are broadcast and all rows are read where they lie. A task keeps the k best of what it saw for
each question, and those are merged.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrual.llm.common import new_folder, stored

ROUND = 2_048
PAIRS = 1 << 20
EXACT_PAIRS = 1 << 16
PLANES = 8
SEED = 11
CODES = (
    "row long, vec_id long, label string, length int, anchor boolean, vector binary, code binary, "
    "align double, norm2 double"
)
FOUND = "number int, score long, vec_id long"


def largest(length: int) -> int:
    """The largest component (either sign) with which sums of ``length`` products fit a long."""
    return min(1 << 30, int((2**62 / max(length, 1)) ** 0.5))


@functools.lru_cache(maxsize=8)
def _signs(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice([-1.0, 1.0], size=(3, size))


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` rotated; their length grows to a power of two of 64 or more."""
    size = max(64, 1 << max(0, x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), size))
    out[:, : x.shape[1]] = x
    for signs in _signs(size):
        out *= signs
        step = 1
        while step < size:
            halves = out.reshape(len(x), -1, 2, step)
            left, right = halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]
            out = np.stack([left, right], axis=2).reshape(len(x), size)
            step *= 2
        out /= np.sqrt(size)
    return out


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows of 64-bit words), alignments and squared lengths of whole-number vectors."""
    turned = rotate(x.astype(np.float64))
    code = np.packbits(turned >= 0, axis=1, bitorder="little").view(np.uint64)
    align = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return code, align, (x.astype(np.float64) ** 2).sum(axis=1)


class Anchors:
    """Anchors of one vector length, ready to be compared with codes."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.int64)
        turned = rotate(vectors.astype(np.float64))
        low, high = turned.min(axis=1, initial=0), turned.max(axis=1, initial=0)
        step = np.maximum(high - low, 1e-300) / ((1 << PLANES) - 1)
        level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
        self.off = np.sqrt(((turned - low[:, None] - step[:, None] * level) ** 2).sum(axis=1))
        planes = [np.packbits((level >> p) & 1, axis=1, bitorder="little").view(np.uint64) for p in range(PLANES)]
        self.planes = np.stack(planes)
        self.size, self.low, self.step = turned.shape[1], low, step
        self.total = level.sum(axis=1, dtype=np.int64)
        self.norm2 = (vectors.astype(np.float64) ** 2).sum(axis=1)

    def bounds(self, code: np.ndarray, align: np.ndarray, norm2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (anchors x codes) of the scores."""
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        weighed = np.zeros((len(self.low), len(code)), dtype=np.int64)
        for p in range(PLANES):
            for word in range(code.shape[1]):
                both = self.planes[p][:, word, None] & code[None, :, word]
                weighed += np.bitwise_count(both).astype(np.int64) << p
        # A code's coordinates are +1 and -1, divided by the root of their number.
        b = 2 * self.step[:, None] * weighed + (2 * ones[None] - self.size) * self.low[:, None]
        b = (b - (self.step * self.total)[:, None]) / np.sqrt(self.size)
        off = self.off[:, None]
        rest = np.sqrt(np.maximum(norm2 - align**2, 0))
        left = np.sqrt(np.maximum(self.norm2[:, None] - np.maximum(np.abs(b) - off, 0) ** 2, 0))
        slack = 1e-7 * np.sqrt(self.norm2)[:, None] * np.sqrt(norm2)[None] + 1e-6
        reach = align[None] * off + rest[None] * left + slack
        return align[None] * b - reach, align[None] * b + reach

    def scores(self, at: np.ndarray, vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Exact scores of the pairs (anchor ``at[i]``, row ``to[i]`` of ``vectors``)."""
        out = np.empty(len(at), dtype=np.int64)
        for i in range(0, len(at), EXACT_PAIRS):
            part = slice(i, i + EXACT_PAIRS)
            out[part] = np.einsum("ij,ij->i", self.vectors[at[part]], vectors[to[part]])
        return out


class Best:
    """The ``k`` best (score, vec_id) for each of some questions."""

    def __init__(self, questions: int, k: int):
        self.k = k
        self.asked = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.int64)
        self.vec_id = np.empty(0, dtype=np.int64)
        self.least = np.full(questions, -np.inf)

    def add(self, asked: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        asked = np.concatenate([self.asked, asked])
        score = np.concatenate([self.score, score])
        vec_id = np.concatenate([self.vec_id, vec_id])
        order = np.lexsort([vec_id, -score, asked])
        asked, score, vec_id = asked[order], score[order], vec_id[order]
        place = np.arange(len(asked)) - np.searchsorted(asked, asked)
        kept = place < self.k
        self.asked, self.score, self.vec_id = asked[kept], score[kept], vec_id[kept]
        last = self.asked[place[kept] == self.k - 1]
        # A float may lie above the score that it stands for, so it is moved down.
        self.least[last] = np.nextafter(self.score[place[kept] == self.k - 1].astype(float), -np.inf)

    def table(self) -> pd.DataFrame:
        return pd.DataFrame({"number": self.asked.astype(np.int32), "score": self.score, "vec_id": self.vec_id})


def code_vectors(embeddings: DataFrame, anchor: Column, scale: float = 256) -> DataFrame:
    """Stored codes of the rows of ``embeddings`` (``vec_id, embedding, label``) that take part.

    Components become ``floor(scale * x)`` in double precision. Rows with a NULL id, label or vector, an
    empty vector, a component that is NULL or not finite, or one beyond ``largest`` take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            frame = batch.to_pandas()
            for length, part in frame.groupby("length"):
                x = np.array(part["vector"].tolist(), dtype=np.float64).reshape(len(part), int(length))
                with np.errstate(over="ignore"):
                    x = np.floor(scale * x)
                fits = np.abs(x).max(axis=1) <= largest(int(length))
                part, x = part[fits], x[fits].astype(np.int32)
                if not len(part):
                    continue
                code, align, norm2 = encode(x)
                out = part[["row", "vec_id", "label", "length", "anchor"]].copy()
                out["vector"] = [v.tobytes() for v in x]
                out["code"] = [c.tobytes() for c in code]
                out["align"], out["norm2"] = align, norm2
                yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = (F.size("embedding") > 0) & finite & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = embeddings.where(F.coalesce(good, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.size("embedding").alias("length"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        vector.alias("vector"),
    )
    return stored(rows.mapInArrow(run, CODES), "vector-codes")


def _blocks(batches: Iterator[pa.RecordBatch], anchors: dict[int, pd.DataFrame]) -> Iterator[tuple]:
    """(length, rows, vectors, codes) of blocks that meet the anchors of their length, ``PAIRS`` at a time."""
    for batch in batches:
        frame = batch.to_pandas()
        for length, part in frame.groupby("length"):
            if length not in anchors:
                continue
            step = max(1, PAIRS // len(anchors[length]))
            for at in range(0, len(part), step):
                rows = part.iloc[at : at + step]
                vectors = np.frombuffer(b"".join(rows["vector"]), dtype=np.int32).reshape(len(rows), -1)
                code = np.frombuffer(b"".join(rows["code"]), dtype=np.uint64).reshape(len(rows), -1)
                yield length, rows, vectors.astype(np.int64), code


def _by_length(anchors: pd.DataFrame) -> tuple[dict, dict]:
    groups = {int(n): part for n, part in anchors.groupby("length")}
    made = {
        n: Anchors(np.frombuffer(b"".join(part["vector"]), dtype=np.int32).reshape(len(part), -1))
        for n, part in groups.items()
    }
    return groups, made


def _mine_positives(shipped, k: int):
    """The ``k`` best other rows of an anchor's label, of those in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, made = _by_length(shipped.value)
        best = Best(len(shipped.value), k)
        for length, rows, vectors, code in _blocks(batches, groups):
            asked, anchors = groups[length], made[length]
            low, high = anchors.bounds(code, rows["align"].to_numpy(), rows["norm2"].to_numpy())
            same = asked["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None]
            same &= asked["row"].to_numpy()[:, None] != rows["row"].to_numpy()[None]
            number, ids = asked["number"].to_numpy().astype(np.int64), rows["vec_id"].to_numpy()
            # The most promising pairs are scored first, so that the k best so far rule out the others.
            first = np.argpartition(np.where(same, low, -np.inf), -min(k, len(rows)), axis=1)[:, -k:]
            at, to = np.repeat(np.arange(len(asked)), first.shape[1]), first.ravel()
            at, to = at[same[at, to]], to[same[at, to]]
            best.add(number[at], anchors.scores(at, vectors, to), ids[to])
            same[at, to] = False
            at, to = np.nonzero(same & (high >= best.least[number][:, None]))
            best.add(number[at], anchors.scores(at, vectors, to), ids[to])
        yield pa.RecordBatch.from_pandas(best.table(), preserve_index=False)

    return run


def _mine_negatives(shipped, k: int):
    """The ``k`` best rows of other labels in each window of scores, of those in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors_table, windows = shipped.value
        groups, made = _by_length(anchors_table)
        best = Best(len(windows), k)
        asked_of = windows["number"].to_numpy()
        low_of, high_of = windows["low"].to_numpy(), windows["high"].to_numpy()
        for length, rows, vectors, code in _blocks(batches, groups):
            asked, anchors = groups[length], made[length]
            low, high = anchors.bounds(code, rows["align"].to_numpy(), rows["norm2"].to_numpy())
            other = asked["label"].to_numpy()[:, None] != rows["label"].to_numpy()[None]
            place = np.full(len(anchors_table), -1)
            place[asked["number"].to_numpy()] = np.arange(len(asked))
            mine = np.flatnonzero(place[asked_of] >= 0)
            wanted = np.zeros_like(other)
            for w in mine:
                at = place[asked_of[w]]
                wanted[at] |= (high[at] >= max(low_of[w], best.least[w])) & (low[at] <= high_of[w])
            at, to = np.nonzero(wanted & other)
            scores, ids = anchors.scores(at, vectors, to), rows["vec_id"].to_numpy()[to]
            # Pairs are in order of the anchor, so each window reads its anchor's run of them.
            first, last = (np.searchsorted(at, place[asked_of[mine]], side=s) for s in ("left", "right"))
            parts = [
                (np.full(b - a, w), scores[a:b], ids[a:b], low_of[w], high_of[w])
                for w, a, b in zip(mine, first, last)
            ]
            held = [(n[i], s[i], v[i]) for n, s, v, lo, hi in parts for i in [(s >= lo) & (s <= hi)]]
            if held:
                best.add(*(np.concatenate(c) for c in zip(*held)))
        yield pa.RecordBatch.from_pandas(best.table(), preserve_index=False)

    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all tasks, with ``rank`` from 1."""
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    embeddings: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: float = 256,
    per_round: int = ROUND,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embeddings`` has ``vec_id, embedding, label``; ``anchor`` marks the anchors. Scores are inner products
    of ``floor(scale * x)``. Higher scores come first, then smaller ids. An anchor's positives are its
    first ``positives`` other rows of the same label. For each, the negatives are the first
    ``negatives`` rows of other labels with ``percent * positive <= 100 * negative <= 100 * positive``,
    so a positive below zero has none. Only vectors of one length are compared. Rows that repeat an id are
    rows of their own. Rows that take no part: see ``code_vectors``. No anchors or pairs give no rows.

    The driver sees the anchors of one round and their positives, about ``per_round`` times a few rows.
    """
    spark = embeddings.sparkSession
    codes = code_vectors(embeddings, anchor, scale)
    asked = codes.where("anchor")
    rounds = -(-asked.count() // per_round)
    narrow = codes.select("row", "vec_id", "label", "length", "vector", "code", "align", "norm2")
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    folder = new_folder(spark, "hard-negatives")
    for number in range(rounds):
        chunk = asked.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == number)
        anchors = chunk.select("row", "vec_id", "label", "length", "vector").orderBy("row").toPandas()
        anchors["number"] = np.arange(len(anchors))
        near = narrow.mapInArrow(_mine_positives(spark.sparkContext.broadcast(anchors), positives), FOUND)
        near = _merged(near, positives).toPandas()
        near["low"] = [-(-percent * int(s) // 100) for s in near["score"]]
        near = near[near["low"] <= near["score"]].rename(columns={"score": "high"})
        near["anchor_id"] = anchors["vec_id"].to_numpy()[near["number"]]
        windows = near[["number", "low", "high"]].drop_duplicates().reset_index(drop=True)
        near = near.merge(windows.reset_index(names="window"), on=["number", "low", "high"])
        asking = spark.createDataFrame(
            near[["window", "anchor_id", "vec_id", "high"]].astype("int64"),
            "number int, anchor_id long, positive_id long, positive_score long",
        )
        far = narrow.mapInArrow(
            _mine_negatives(spark.sparkContext.broadcast((anchors, windows)), negatives), FOUND
        )
        far = _merged(far, negatives).select(
            "number", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
        )
        result = far.join(F.broadcast(asking), "number").select(*(f.split()[0] for f in schema.split(", ")))
        result.write.mode("overwrite").parquet(f"{folder}/round={number}")
    if not rounds:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{folder}/round={i}" for i in range(rounds)))


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """The contract's anchors and labels: ids divisible by 100 ask; those divisible by 7 move on a label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10)
    label = moved.otherwise(F.col("label").cast("long"))
    given = embeddings.select("vec_id", "embedding", label.alias("label"))
    return mine_hard_negatives(given, F.col("vec_id") % 100 == 0)
