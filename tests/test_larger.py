"""What keeps queries whole on larger tables: work per class or per place, tasks that rows fill."""

import subprocess
import sys

import pytest
from conftest import ROOT, TESTDATA, rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from accrual import schemas
from accrual.ml import ranking, training
from accrual.operators import joins
from accrual.queries import gold, growing, model
from accrual.sources import bucketed, landing

AREAS = ["heart"]


def test_pair_join_spreads_by_pairs(spark):
    left = spark.range(4000).select((F.col("id") % 7).alias("k"), F.col("id").alias("a"))
    left = left.unionByName(spark.createDataFrame([(None, -1), (9, -2)], "k bigint, a bigint"))
    right = spark.range(60).select((F.col("id") % 5).alias("k"), F.col("id").alias("b"))
    found = joins.pair_join(left, right, ["k"], ["a"], ["b"])
    assert rows(found, "k", "a", "b") == rows(left.join(right, "k"), "k", "a", "b")


@pytest.mark.parametrize("pack", [1, 3, 64])
def test_packed_pairs_are_those_of_the_join(spark, pack):
    left = spark.range(300).select((F.col("id") % 7).alias("k"), (F.col("id") % 90).alias("a"))
    left = left.unionByName(spark.createDataFrame([(None, -1), (9, -2), (3, None)], "k bigint, a bigint"))
    right = spark.range(60).select((F.col("id") % 5).alias("k"), F.when(F.col("id") > 9, F.col("id")).alias("b"))
    right = right.unionByName(spark.createDataFrame([(None, -1)], "k bigint, b bigint"))
    found = joins.pair_join(left, right, ["k"], ["a"], ["b"], pack)
    assert rows(found, "k", "a", "b") == rows(left.join(right, "k"), "k", "a", "b")


def test_a_site_meets_many_plans_at_once(spark):
    choices = spark.range(500).select(F.col("id").cast("string").alias("plan_id"), F.lit("Rome").alias("city"))
    sites = spark.range(40).select(F.lit("Rome").alias("city"), F.col("id").alias("zip"))
    found = [(r["plan_id"], r["zip"]) for r in ranking.candidates_of_plans(choices, sites).collect()]
    assert sorted(found) == sorted((str(p), z) for p in range(500) for z in range(40))
    # Rows of one site follow each other, so a columnar file holds its values once for all of them.
    assert sum(x[1] != y[1] for x, y in zip(found, found[1:], strict=False)) < len(found) / 2


def test_candidates_are_counted_without_pairs(spark):
    sites = spark.createDataFrame(
        [("IT", "Rome", 1), ("IT", "Rome", 2), ("IT", None, 3), ("FR", "Rome", 4)],
        "country string, city string, n int",
    )
    choices = spark.createDataFrame(
        [("a", "IT", None), ("a", None, "Rome"), ("a", "IT", "Rome"), ("b", "FR", "Rome"), ("c", "DE", None)],
        "plan_id string, country string, city string",
    )
    counts = ranking.candidate_counts(choices, sites)
    pairs = ranking.candidates_of_plans(choices, sites).groupBy("plan_id").count()
    assert rows(counts) == rows(pairs) == [("a", 4), ("b", 1)]


class Counted:
    """A model that predicts a site's number of trials and notes how many rows it was given."""

    def transform(self, given):
        self.given = given.count()
        return given.withColumn("prediction", F.log1p("n_trials"))


def test_equal_plans_share_one_ranking(spark):
    plan = ("INTERVENTIONAL", "TREATMENT", "PHASE1", 50, None, None, None, None, ["asthma"], None)
    plans = spark.createDataFrame([(f"p{i}", *plan) for i in range(40)], schemas.PLANS)
    choices = spark.createDataFrame([(f"p{i}", "AB"[i % 2]) for i in range(40)], "plan_id string, city string")
    sites = spark.createDataFrame(
        [("X", "A", "1", 5, 1.0), ("X", "A", "2", 9, 1.0), ("X", "B", "3", 4, 1.0), ("X", "A", "4", None, None)],
        "country string, city string, zip string, n_trials int, avg_velocity double",
    )
    defaults = spark.createDataFrame([("OTHER", "ALL")], "lead_sponsor_class string, sex string")
    model = Counted()
    found = ranking.rank_sites(plans, choices, sites, model, defaults, None, AREAS)
    assert model.given == 3
    places = {0: [("2", 1), ("1", 2)], 1: [("3", 1)]}
    want = sorted((f"p{i}", z, r) for i in range(40) for z, r in places[i % 2])
    assert rows(found.ranked, "plan_id", "zip", "rank") == want
    assert rows(found.cold, "plan_id", "zip") == sorted((f"p{i}", "4") for i in range(0, 40, 2))


def test_columns_of_candidates_are_made_once_per_class(spark):
    plan = ("INTERVENTIONAL", "TREATMENT", "PHASE1", 50, None, None, None, None, ["asthma"], None)
    plans = spark.createDataFrame([(f"p{i}", *plan) for i in range(40)], schemas.PLANS)
    choices = spark.createDataFrame([(f"p{i}", "A") for i in range(40)], "plan_id string, city string")
    sites = spark.createDataFrame(
        [("X", "A", str(i), i, 1.0) for i in range(6)],
        "country string, city string, zip string, n_trials int, avg_velocity double",
    )
    defaults = spark.createDataFrame([("OTHER", "ALL")], "lead_sponsor_class string, sex string")
    given = []

    def finish(ranked):
        given.append(ranked.count())
        return ranked.select("plan_id", "zip", F.round("predicted_velocity", 1).alias("v"))

    found = ranking.rank_sites(plans, choices, sites, Counted(), defaults, None, AREAS, finish).ranked
    assert given == [6]
    assert rows(found) == sorted((f"p{i}", str(z), float(z)) for i in range(40) for z in range(6))


@pytest.mark.parametrize("n_rows, tasks", [(90, 1), (100, 1), (101, 2), (1000, 10)])
def test_fit_has_as_many_tasks_as_rows_fill(spark, monkeypatch, n_rows, tasks):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    many = spark.range(n_rows).repartition(64).withColumnRenamed("id", "nct_id")
    cut = training.in_full_tasks(many, n_rows)
    assert cut.rdd.getNumPartitions() == tasks
    assert rows(cut) == [(i,) for i in sorted(range(n_rows), key=lambda i: repr((i,)))]


def test_rejects_store_no_candidates(spark, monkeypatch):
    def stored(df):
        raise AssertionError("rejected plans need nothing stored")

    monkeypatch.setattr(ranking, "durable", stored)
    monkeypatch.setattr(gold, "durable", stored)
    assert model.ranking_rejects(spark, str(TESTDATA / "sf0.001")).count() > 0


def test_landing_infers_no_schema_of_each_document(spark):
    values = ['{"a": {"id": "x"}}', '[{"a": {"id": "y"}}]', '{"a": [{"id": "z"}]}', '"x"', "7", "null", "no", None, '{"a": {"id": ""}}']
    topic = spark.createDataFrame([(None, v, None, 0, i) for i, v in enumerate(values)], schemas.TOPIC)
    landed = landing.land_variants(topic, "$.a.id")
    assert rows(landed, "nct_id", "offset") == [("x", 0)]
    assert "schema_of_variant" not in landed._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_do_not_grow_with_the_layer(spark, monkeypatch):
    assert [bucketed.buckets_for(n) for n in (0, 1_600_000, 1_600_001, 36_000_000)] == [8, 8, 9, 180]
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 500)
    made = []
    monkeypatch.setattr(gold.gold, "write_bucketed_gold", lambda *given: made.append(given[-1]) or given[0].limit(0))
    monkeypatch.setattr(growing, "settled", lambda column: F.lit(0.0))
    sf = str(TESTDATA / "sf0.001")
    growing.bucketed_features(spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert made == [-(-lines // 500)] and made[0] > 8


def small_features(spark):
    data = [
        (f"N{i}", "INTERVENTIONAL", "TREATMENT", "INDUSTRY", "ALL", f"PHASE{i % 3}", i % 50 + 5, i % 9 + 1, 12.0,
         [f"D{i % 4}"], i % 5 == 0, float(i % 7 + 1), float(i % 11), float(i % 11 + i % 50) if i % 25 else None)
        for i in range(200)
    ]
    return spark.createDataFrame(data, schemas.GOLD_TRIAL_FEATURES)


def test_training_keeps_no_rows_of_its_own_on_disk(spark, monkeypatch):
    kind, levels = type(spark.range(1)), []
    persist = kind.persist

    def noted(self, *level):
        kept = persist(self, *level)
        levels.append(kept.storageLevel)
        return kept

    monkeypatch.setattr(kind, "persist", noted)
    area_map = spark.createDataFrame([("heart", "D1")], schemas.AREA_MAP)
    trained = training.train(small_features(spark), area_map, AREAS, max_iter=2, max_depth=2)
    assert [level.useDisk for level in levels] == [False]
    found = trained.metrics.first()
    assert (found["loaded_count"], found["dropped_count"]) == (200, 8)
    assert trained.predictions.count() == found["test_count"] == 192 - found["train_count"]


LET_GO = """
import sys, time
from pyspark.sql import functions as F
from accrual import session
spark = session.build_session("let-go", "local[2]", **{
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.local.dir": sys.argv[1]})
blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
moved = spark.range(10_000).repartition(7, "id").groupBy(F.col("id") % 100).count()
moved.write.format("noop").mode("overwrite").save()
before = blocks.getAllBlocks().size()
time.sleep(3)
kept = blocks.getAllBlocks().size()
del moved
session.release(spark)
until = time.time() + 30
while blocks.getAllBlocks().size() and time.time() < until:
    time.sleep(0.2)
print("blocks", before > 0, kept == before, blocks.getAllBlocks().size())
spark.stop()
"""


def test_unused_shuffle_files_are_let_go(tmp_path):
    """In an application of its own, where nothing else comes and goes."""
    run = [sys.executable, "-c", LET_GO, str(tmp_path)]
    said = subprocess.run(run, cwd=ROOT, capture_output=True, text=True, timeout=120, check=False)
    assert "blocks True True 0" in said.stdout, said.stderr[-2000:]


def test_stored_model_is_compared_on_features_and_predictions_made_once(spark, monkeypatch):
    features, train, transform = model._features, training.train, PipelineModel.transform
    made, asked = [], []
    monkeypatch.setattr(model, "_models", {})
    monkeypatch.setattr(model, "_features_of", {}, raising=False)
    monkeypatch.setattr(model, "_features", lambda *given: made.append(given) or features(*given))
    monkeypatch.setattr(training, "train", lambda *given: train(*given, max_iter=2, max_depth=2))
    monkeypatch.setattr(PipelineModel, "transform", lambda self, *given: asked.append(self) or transform(self, *given))
    found = model.model_store(spark, str(TESTDATA / "sf0.001"))
    n = features(spark, str(TESTDATA / "sf0.001")).count()
    assert rows(found, "step", "promoted", "served", "n_rows", "n_same") == [
        ("first", True, "first", n, n),
        ("much worse", False, "slightly worse", n, n),
        ("slightly worse", True, "slightly worse", n, n),
    ]
    # Features: once. Predictions: of the test rows, of all rows, and of each of the three served models.
    assert len(made) == 1 and len(asked) == 5
