import numpy as np
import pytest
from corpora import prepared  # noqa: F401
from pyspark.sql import functions as F

from accrual.llm.hard_negatives import Anchors, Best, encode, largest, mine_hard_negatives, rotate

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def vectors():
    dice = np.random.default_rng(8)
    centres = dice.normal(size=(4, 12))
    rows = []
    for i in range(400):
        x = centres[i % 4] + dice.normal(size=12) * (0.3 if i % 3 else 2)
        rows.append((i, x.tolist(), int(dice.integers(0, 4)), "x"))
    rows += [(500 + i, rows[20][1], 1, None) for i in range(15)]  # ties
    rows += [(500, rows[20][1], 2, None), (20, rows[20][1], rows[20][2], None)]  # repeated ids and rows
    rows += [(600, None, 1, None), (601, rows[0][1], None, None), (602, [None] * 12, 1, None), (None, rows[0][1], 1, None)]
    rows += [(603, [float("nan")] * 12, 1, None), (604, [float("inf")] * 12, 1, None), (605, [], 1, None)]
    rows += [(620, [1.0, 2.0], 1, None), (621, [2.0, 1.0], 1, None), (622, [1.5, 1.0], 2, None)]
    rows += [(640, [0.0] * 12, 3, None), (606, [1e300] * 12, 1, None), (660, [-3.0] * 12, 0, None)]
    return rows


def brute(rows, step):
    good = []
    for i, (v, x, label, _) in enumerate(rows):
        if v is None or label is None or not x or None in x or not np.isfinite(x).all():
            continue
        x = [int(np.floor(256 * c)) for c in x]
        if max(map(abs, x)) <= largest(len(x)):
            good.append((i, v, x, label))
    out = []
    for i, v, x, label in good:
        if v % step:
            continue
        scored = [
            (-sum(p * q for p, q in zip(x, y)), w, other == label)
            for j, w, y, other in good
            if j != i and len(x) == len(y)
        ]
        for score, w, _ in sorted(s for s in scored if s[2])[:5]:
            p = -score
            fits = sorted((s, n) for s, n, same in scored if not same and 80 * p <= -100 * s <= 100 * p)[:5]
            out += [(v, w, rank, n, p, -s) for rank, (s, n) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("per_round", [2048, 7])
def test_against_brute_force(spark, per_round):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mine_hard_negatives(df, F.col("vec_id") % 20 == 0, per_round=per_round)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 20)


@pytest.mark.parametrize("length", [1, 3, 64, 100])
def test_intervals_hold_the_score(length):
    dice = np.random.default_rng(length)
    x = np.floor(dice.normal(size=(300, length)) * dice.choice([0, 1, 300, 1e5], size=(300, 1))).astype(np.int64)
    anchors = Anchors(x[:80])
    code, align, norm2 = encode(x)
    low, high = anchors.bounds(code, align, norm2)
    exact = x[:80] @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    assert np.allclose(rotate(x.astype(float)) @ rotate(x.astype(float)).T, x @ x.T)


def test_intervals_skip_most_of_what_is_far():
    dice = np.random.default_rng(3)
    centres = dice.normal(size=(20, 64)) * 300
    x = np.floor(np.repeat(centres, 50, axis=0) + dice.normal(size=(1000, 64)) * 30).astype(np.int64)
    anchors = Anchors(x[::100])
    _, high = anchors.bounds(*encode(x))
    fifth = np.sort(x[::100] @ x.T, axis=1)[:, -5]
    assert (high >= fifth[:, None]).mean() < 0.2


def test_best_keeps_ties_by_id():
    best = Best(2, 3)
    best.add(np.array([0, 0, 1, 0]), np.array([5, 5, 9, 7]), np.array([4, 2, 1, 8]))
    best.add(np.array([0, 0]), np.array([5, 5]), np.array([1, 9]))
    table = best.table()
    assert table[table["number"] == 0][["score", "vec_id"]].values.tolist() == [[7, 8], [5, 1], [5, 2]]
    assert 4 < best.least[0] < 5 and best.least[1] == -np.inf


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mine_hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0
    lone = spark.createDataFrame([(100, [1.0, 2.0], 1, "x")], SCHEMA)
    assert mine_hard_negatives(lone, F.col("vec_id") % 100 == 0).count() == 0
