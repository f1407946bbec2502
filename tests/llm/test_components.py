import random

from brute import components
from corpora import prepared  # noqa: F401

from accrual.llm import components as module
from accrual.llm.common import delete, lasting, scratch, stored
from accrual.llm.components import connected_components


def found(df):
    return {r["node"]: r["component"] for r in connected_components(df).collect()}


def test_hub_of_many_links(spark):
    """A node with 100 000 neighbours is cut into pieces, and so is a second one that it meets."""
    star = spark.range(100_000).selectExpr("id + 10 AS a", "5 AS b")
    other = spark.range(30_000).selectExpr("7 AS a", "id + 90000 AS b")
    got = connected_components(star.union(other))
    assert got.where("component <> 5").count() == 0
    assert got.count() == 119_992


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(module, "LEAST_PIECE", 2)
    monkeypatch.setattr(module, "PIECES", 4)
    dice = random.Random(5)
    links = [(dice.randint(0, 80) * 3 - 60, dice.choice([0, dice.randint(0, 80) * 3 - 60])) for _ in range(90)]
    df = spark.createDataFrame([*links, (None, 3), (9, 9)], "a long, b long")
    nodes = sorted({x for link in links for x in link})
    roots = components(nodes, [(nodes.index(a), nodes.index(b)) for a, b in links])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found(df) == {n: c for n, c in zip(nodes, roots) if n in linked}


def test_state_does_not_overflow(spark):
    """The sum of numbers up to 2^62 over this many links would."""
    state = module._state(spark.range(3_000_000).selectExpr("id AS u", "id + 1 AS v"))
    assert state[0] == 3_000_000 and all(-(2**63) <= x < 2**63 for x in state)
    assert state != module._state(spark.range(3_000_000).selectExpr("id AS u", "id + 2 AS v"))


def test_scratch_tables_go_and_lasting_ones_stay(spark):
    with scratch(spark):
        first = stored(spark.range(5), "gone")
        with lasting():
            kept = stored(first, "kept")
    assert kept.count() == 5
    path = first.inputFiles()[0].rsplit("/", 1)[0]
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files)
    delete(spark, path)


def test_no_links(spark):
    assert found(spark.createDataFrame([], "a long, b long")) == {}
