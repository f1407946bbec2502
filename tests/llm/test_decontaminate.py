import hashlib

import pytest
from brute import plain_words
from conftest import TESTDATA
from oracle_check import compare, connect
from corpora import documents, nothing, prepared, texts  # noqa: F401

from accrual.llm import decontaminate
from accrual.llm.decontaminate import contamination, drop_contaminated_rows
from accrual.llm.queries import OP4_SQL

LONG = " ".join(f"b{i}" for i in range(30))
ITEMS = [
    (1, LONG), (2, "Short item"), (3, "Short item"), (4, None), (5, "..."), (6, "a a a a a a a a a a a a a a a"),
    (7, "solo"), (8, " ".join(f"b{i}" for i in range(5, 20))), (None, "no id here"),
]
DOCS = [
    (1, LONG), (2, "x " * 300 + " ".join(f"b{i}" for i in range(13)) + " y" * 300),
    (3, "short ITEM, short item!"), (4, None), (5, ""), (6, "a " * 40), (7, "c " * 19 + "solo"), (8, "c " * 20 + "solo"),
    (9, " ".join(f"b{i}" for i in range(12))), (10, "b3 " + LONG), (2, "solo"), (None, "no id here"), (11, "z " * 20_000),
]


def brute(text):
    windows = {}
    for item, t in ITEMS:
        words = plain_words(t)
        for i in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[i : i + 13]), set()).add(item)
    words, hit, items = plain_words(text), set(), set()
    for window, owners in windows.items():
        for i in range(len(words) - len(window) + 1):
            if tuple(words[i : i + len(window)]) == window:
                hit.update(range(i, i + len(window)))
                items |= owners
    names = sorted(str(i) for i in items if i is not None)
    return (
        len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
        len(hit) > 0 and 20 * len(hit) >= len(words),
    )


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame([(*d, 1, "x") for d in DOCS], "doc_id long, text string, n_hit int, _bad string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_against_brute_force(tables, monkeypatch, most):
    """With the hashes broadcast, and with them joined by a shuffle."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
    got = sorted((tuple(r) for r in contamination(*tables).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in DOCS), key=repr)


def test_filter_keeps_clean_rows_whole(tables):
    docs, benchmark = tables
    out = drop_contaminated_rows(docs, benchmark)
    assert out.columns == docs.columns
    want = [(*d, 1, "x") for d in DOCS if not brute(d[1])[-1]]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(tables, nothing):
    docs, benchmark = tables
    assert contamination(nothing, benchmark).count() == 0
    clean = contamination(docs, benchmark.limit(0)).collect()
    assert len(clean) == len(DOCS) and not any(r["contaminated"] for r in clean)


def test_sql_twin(spark):
    from accrual.llm.queries import op4_decontaminate

    sf = str(TESTDATA / "sf0.001")
    assert compare(op4_decontaminate(spark, sf), connect(sf), OP4_SQL) == []
