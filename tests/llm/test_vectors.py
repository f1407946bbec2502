import numpy as np
import pytest
from brute import components
from corpora import prepared  # noqa: F401

from accrual.llm.grid_order_join import near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def vectors():
    dice = np.random.default_rng(2)
    rows = []
    for i in range(160):
        base = dice.normal(size=6)
        rows.append((i, base.astype(np.float32).tolist(), int(i % 3)))
    for i in range(160, 260):  # close to another vector of the same label
        source = rows[int(dice.integers(0, 40))]
        near = np.array(source[1]) * dice.uniform(0.5, 2) + dice.normal(size=6) * 0.12
        rows.append((i, near.astype(np.float32).tolist(), source[2]))
    rows += [(300 + i, rows[7][1], rows[7][2]) for i in range(20)]  # one vector many times
    rows += [(300, rows[7][1], rows[7][2]), (None, rows[7][1], rows[7][2]), (None, None, 1)]
    rows += [(400, rows[7][1], None), (401, None, 0), (402, [0.0] * 6, 0), (403, [float("nan")] + [1.0] * 5, 0)]
    rows += [(404, [float("inf")] + [1.0] * 5, 0), (405, [None] + [1.0] * 5, 0), (406, [], 0)]
    rows += [(407, [1.0, 2.0], 0), (408, [2.0, 4.0], 0), (409, [1e30, 2e30], 0)]
    return rows


def brute(rows, least=0.98):
    links = []
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if la is None or la != lb or not a or not b or len(a) != len(b) or None in a or None in b:
                continue
            x, y = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
            if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
                continue
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links.append((i, j))
    number = np.bincount(np.array(links).ravel(), minlength=len(rows))
    roots = components([r[0] for r in rows], links)
    return sorted(
        ((r[0], int(n), c, r[0] is not None and r[0] == c) for r, n, c in zip(rows, number, roots)), key=repr
    )


@pytest.mark.parametrize("block", [512, 16])
def test_against_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = near_duplicate_vectors(df, block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_empty(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
