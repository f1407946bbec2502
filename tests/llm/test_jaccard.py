import numpy as np
import pandas as pd
import pytest
from brute import components, jaccard_links, shingles
from pyspark.sql import functions as F
from corpora import documents, nothing, prepared, texts  # noqa: F401

from accrual.llm.components import connected_components
from accrual.llm.jaccard_join import (
    _block_tasks, _columns_of, _families, _promising, _shared_columns, drop_near_duplicates, forest, jaccard_components,
    overlaps, prefix_length, shingle_set,
)


def expected(rows, percent=90):
    texts = [r["text"] for r in rows]
    roots = components([r["doc_id"] for r in rows], jaccard_links(texts, percent))
    return sorted(((r["doc_id"], len(shingles(r["text"])), c) for r, c in zip(rows, roots)), key=repr)


@pytest.mark.parametrize("paired, block", [(128, 512), (1, 3), (4, 512)])
def test_against_brute_force(documents, paired, block):
    """With pairs from short columns, with products of row blocks, and with both."""
    want = expected(documents.select("doc_id", "text").collect())
    got = jaccard_components(documents, paired=paired, block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_other_similarity(documents):
    want = expected(documents.select("doc_id", "text").collect(), 70)
    got = jaccard_components(documents, percent=70, paired=2, block=4).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_one_row_of_each_group_stays(documents):
    rows = documents.select("doc_id", "text").collect()
    roots = components([r["doc_id"] for r in rows], jaccard_links([r["text"] for r in rows]))
    clashing = documents.withColumns({"_id": F.lit(1), "_kept": F.lit(2), "_hash": F.lit(3)})
    out = drop_near_duplicates(clashing)
    assert out.columns == clashing.columns
    got = sorted((r["doc_id"] for r in out.collect()), key=repr)
    alone = [r["doc_id"] for r in rows if not shingles(r["text"])]
    grouped = {c for r, c in zip(rows, roots) if shingles(r["text"])}
    assert got == sorted([*alone, *grouped], key=repr)


def test_empty(nothing):
    assert jaccard_components(nothing).count() == 0
    assert drop_near_duplicates(nothing).count() == 0


def test_overlaps_of_blocks():
    dice = np.random.default_rng(1)
    sets = [np.unique(dice.integers(-50, 50, 30)) for _ in range(9)]
    got = overlaps(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]
    assert overlaps([], sets).shape == (0, 9)


def test_shingles_and_prefix():
    assert len(shingle_set("")) == 0 and len(shingle_set("a b")) == 1
    assert len(shingle_set("A b c A b c")) == 3
    assert (shingle_set("Éa b c") != shingle_set("éa b c")).all()
    assert prefix_length(100) == 14 and prefix_length(3) == 3


def test_forest_connects():
    links = np.array([(0, 1), (1, 2), (0, 2), (3, 4)])
    assert forest(links) == [(0, 1), (1, 2), (3, 4)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (5, 5), (None, 3), (100, 99), (7, 100)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    nodes = [*range(41), 99, 100]
    assert sorted(tuple(r) for r in got) == [(n, 0) for n in nodes]
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_columns_with_mostly_the_same_rows_are_one(spark):
    """Near copies share many columns; they are dealt out once, and columns with little in common stay apart."""
    copies = [(g, c) for g in range(40) for c in range(300) if (g + c) % 40]
    apart = [(100 + g, c) for g in range(5) for c in [-1, *range(1000 * (g + 1), 1000 * (g + 1) + 200)]]
    large = spark.createDataFrame(copies + apart, "gram long, class long")
    found = {}
    for family, c in _families(large).collect():
        assert c not in found.setdefault(family, set())
        found[family].add(c)
    sizes = sorted(len(rows) for rows in found.values())
    assert sizes[:5] == [201] * 5 and sum(sizes[5:]) < 3 * 300
    for columns in (copies, apart):
        for gram in {g for g, _ in columns}:
            rows = {c for g, c in columns if g == gram}
            assert any(rows <= held for held in found.values())
    sets = spark.range(300).select(F.col("id").alias("class"), F.lit(1).alias("n"))
    sent = _block_tasks(_families(spark.createDataFrame(copies, "gram long, class long")), sets, 100)
    assert sent.agg(F.count("n").alias("rows")).agg(F.sum("rows")).first()[0] <= 3 * 3 * 300


def test_shared_columns_move_cells_once(spark):
    """Columns of one class are left out, also where it is there twice; each cell goes through one exchange."""
    kept = spark.createDataFrame(
        [(1, 5, [1, 2, 3]), (2, 6, [2, 3]), (3, 7, [3, 4]), (4, 8, [5]), (4, 8, [5]), (1, 5, [1, 2, 3])],
        "class long, n long, grams array<long>",
    ).repartition(3)
    shared = _shared_columns(kept)
    want = [(2, 1, 5, 3), (2, 2, 6, 3), (3, 1, 5, 4), (3, 2, 6, 4), (3, 3, 7, 4)]
    assert shared.columns == ["gram", "class", "n", "rows"]
    assert sorted(tuple(r) for r in shared.collect()) == want
    plan = _shared_columns(kept)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_full_sets_go_to_the_tasks_of_their_pairs(spark):
    """Columns of one document are not dealt out, and only rows with a partner in a block pair go there again."""
    shared = spark.createDataFrame([(2, 1, 5, 2), (1, 1, 5, 2), (1, 2, 6, 2), (2, 9, 6, 2)], "gram long, class long, n long, rows long")
    families = spark.createDataFrame([(7, 1), (7, 2), (8, 1)], "family long, class long")
    got = sorted((c, n, grams) for c, n, grams in _columns_of(families, shared).collect())
    assert got == [(1, 5, [1, 2]), (2, 6, [1])]
    sets = {1: range(0, 14), 2: range(0, 14), 3: range(50, 64), 4: range(50, 64)}
    blocks = {1: 0, 2: 1, 3: 0, 4: 0}
    frame = pd.DataFrame(
        [(7, 0, 1, blocks[c], c, 100, np.array(g, dtype=np.int64)) for c, g in sets.items()],
        columns=["family", "i", "j", "block", "class", "n", "grams"],
    )
    found = _promising(90)(frame)
    assert found.values.tolist() == [[7, 0, 1, 0, 1], [7, 0, 1, 1, 2]]


def test_documents_not_cells_meet_the_families(spark):
    """The rows that a join makes are documents: 50 of them with 40 columns each are 50 rows, not 2000."""
    cells = spark.range(50 * 40).selectExpr("id % 40 AS gram", "id div 40 AS class", "40L AS n", "50L AS rows")
    families = spark.range(45).selectExpr("7L AS family", "id AS class")
    made = _columns_of(families, cells)
    assert sorted((r["class"], len(r["grams"])) for r in made.collect()) == [(c, 40) for c in range(45)]
    node = made._jdf.queryExecution().optimizedPlan()
    found = []
    while node.children().size():
        found.append(node.nodeName())
        node = node.children().head()
    # From the top down, the join lies above the aggregate that makes one row a document.
    assert found.index("Join") < found.index("Aggregate")
    assert "Join" not in found[found.index("Aggregate"):]
