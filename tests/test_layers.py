"""The layers end to end: topic files to silver, gold, exports, reports and continuous loads."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_silver import study, topic

from accrual import schemas
from accrual.plans import gold, reports, silver
from accrual.sources.tables import load_csv
from accrual.sources.topics import decode_json, keyed_json, read_topic, topic_columns
from accrual.streaming import loads


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layers"))
    documents = [
        study("A", conditions=["Asthma", "asthma"]),
        study("B", count=50, sex=None, meshes=[], conditions=["Flu"]),
        study("C", count=20, phases=["PHASE3"], meshes=[{"id": "D2", "term": "Flu"}]),
    ]
    topic(spark, [(d, 0, i) for i, d in enumerate(documents)]).write.json(f"{path}/topic")
    silver.write_silver(read_topic(spark, "t", files=f"{path}/topic"), path)
    gold.write_gold(
        spark.read.parquet(f"{path}/trials"), spark.read.parquet(f"{path}/trial_sites"), path
    )
    return path


def test_dashboard_lists(spark, folder, tmp_path):
    tables = ["trial_features", "site_history", "site_conditions_history", "dim_mesh_conditions"]
    reports.write_dashboard(*[spark.read.parquet(f"{folder}/{t}") for t in tables], str(tmp_path))

    def csv(name, schema):
        return rows(load_csv(spark, f"{tmp_path}/{name}", schema))

    assert csv("sexes", "sex string") == [("ALL",), ("FEMALE",)]
    assert csv("phases", "phase string") == [("PHASE2",), ("PHASE3",)]
    assert csv("countries", "country string") == [("Italy",)]
    assert csv("cities", "city string") == [("Rome",)]
    assert csv("conditions", "id string, name string") == [("D1", "Asthma"), ("D2", "Flu")]
    assert csv("cond_count", "id string, name string, n int") == [("D1", "Asthma", 1), ("D2", "Flu", 1)]
    site = load_csv(
        spark, f"{tmp_path}/site_history",
        "country string, city string, state string, zip string, site string, n_trials int",
    )
    assert rows(site, "site", "n_trials") == [("Clinic", 3)]


def test_conditions_report(spark, folder):
    decoded = decode_json(read_topic(spark, "t", files=f"{folder}/topic"), schemas.STUDY)
    documents = silver.flatten_studies(decoded).select("nct_id", "conditions", "meshes")
    report = reports.conditions_report(
        documents,
        spark.read.parquet(f"{folder}/trial_features"),
        spark.read.parquet(f"{folder}/dim_mesh_conditions"),
    )
    assert rows(report["coverage"], "check", "part", "whole") == [("coded features", 2, 3), ("coded", 2, 3)]
    assert rows(report["distinct_conditions"]) == [(3,)]
    assert rows(report["case_variants"], "normalized", "variants") == [("asthma", ["Asthma", "asthma"])]
    assert rows(report["top_uncoded"]) == [("Flu", 1)]
    assert rows(report["top_coded"], "mesh_condition_id", "n_trials") == [("D1", 1), ("D2", 1)]
    assert rows(report["dimension_size"]) == [(2,)]
    lengths = {r["column"]: r for r in report["list_lengths"].collect()}
    assert (lengths["conditions"]["min"], lengths["conditions"]["max"]) == (1, 2)
    assert lengths["meshes"]["min"] == 0
    assert report["feature_list_lengths"].first()["min"] == 1
    assert report["condition_sample"].count() == 3 and report["coded_sample"].count() == 2


def test_gold_report(spark, folder):
    report = reports.gold_report(
        spark.read.parquet(f"{folder}/trial_features"), spark.read.parquet(f"{folder}/site_history")
    )
    assert rows(report["row_counts"]) == [("site_history", 1), ("trial_features", 3)]
    assert report["target"].first()["n"] == 3
    flags = {(r["table"], r["column"]): r["flags"] for r in report["flags"].collect()}
    assert flags[("trial_features", "study_type")] == "CONSTANT"
    assert ("trial_features", "phase") not in flags


def test_continuous_loads_reach_the_batch_tables(spark, folder, tmp_path):
    """Silver and gold rows sent through topics and loaded give the batch tables back."""
    arrived = F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp")

    def send(df, key, name):
        records = keyed_json(df, key).select(
            "key", "value", arrived.alias("timestamp"), F.lit(0).alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
        )
        topic_columns(records).write.json(f"{tmp_path}/{name}/in")

    studies = silver.clean_studies(
        read_topic(spark, "t", files=f"{folder}/topic"), keep_version=True
    )
    features = spark.read.parquet(f"{folder}/trial_features")
    dim = spark.read.parquet(f"{folder}/dim_mesh_conditions")
    send(silver.trials_table(studies), "nct_id", "trials")
    send(silver.sites_table(studies, keep_ordinal=True), "nct_id", "sites")
    send(features, "nct_id", "features")
    send(dim, "mesh_condition_id", "conditions")
    for name in loads.LOADS:
        query = loads.start(spark, name, f"{tmp_path}/{name}", files=f"{tmp_path}/{name}/in")
        assert query.awaitTermination(120)
    assert rows(loads.current(spark, "trials", f"{tmp_path}/trials"), *silver.TRIAL_COLUMNS) == rows(
        silver.trials_table(studies)
    )
    place = ["nct_id", "facility_name", "zip", "site_ordinal"]
    assert rows(loads.current(spark, "sites", f"{tmp_path}/sites"), *place) == rows(
        silver.sites_table(studies, keep_ordinal=True), *place
    )
    assert rows(loads.current(spark, "features", f"{tmp_path}/features"), *features.columns) == rows(features)
    assert rows(loads.current(spark, "conditions", f"{tmp_path}/conditions"), *dim.columns) == rows(dim)
    query = loads.start(spark, "raw", f"{tmp_path}/raw", files=f"{folder}/topic")
    assert query.awaitTermination(120)
    assert rows(loads.current(spark, "raw", f"{tmp_path}/raw"), "nct_id") == [("A",), ("B",), ("C",)]


@pytest.fixture()
def job(spark, monkeypatch):
    """Runs a job of the command line in the tests' session, which stays open."""
    from accrual import __main__ as command

    class Session:
        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(command, "build_session", lambda name: Session())
    return lambda *arguments: command.main([str(a) for a in arguments])


def test_check_fails_on_broken_references(spark, folder, job, tmp_path):
    job("check", folder)
    for name in ("trials", "trial_sites", "trial_features", "site_conditions_history", "site_history"):
        kept = spark.read.parquet(f"{folder}/{name}")
        kept = kept.where("nct_id <> 'A'") if name == "trials" else kept
        kept = kept.limit(0) if name == "site_history" else kept
        kept.write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(SystemExit, match="references name nothing"):
        job("check", tmp_path)


def test_profile_and_sample_jobs(spark, folder, job, tmp_path):
    job("profile", folder, tmp_path / "p", "--files", f"{folder}/topic")
    assert load_csv(spark, f"{tmp_path}/p/top_conditions", "value string, n long").count() == 3
    assert load_csv(spark, f"{tmp_path}/p/row_counts", "t string, n long").count() == 2
    job("sample", tmp_path / "s", "--files", f"{folder}/topic")
    schema = "report string, name string, value string, part long, whole long, pct double, amount double"
    report = load_csv(spark, f"{tmp_path}/s/sample", schema)
    assert {r["report"] for r in report.collect()} == {"coverage", "missing", "share", "enrollment"}
    assert report.where("name = 'mesh terms'").first()["part"] == 2
    assert report.where("name = 'max'").first()["amount"] == 100.0
