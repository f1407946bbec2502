import datetime
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from accrual import schemas
from accrual.sources.topics import stream_topic
from accrual.streaming import loader

TRIAL = "nct_id string, enrollment_count int"


def deliver(spark, folder, name, records):
    """One topic file; records are (value, minute, offset)."""
    data = [
        ("k", v if isinstance(v, str) else json.dumps(v),
         datetime.datetime(2024, 1, 1, 0, minute), 0, offset)
        for v, minute, offset in records
    ]
    frame = spark.createDataFrame(data, schemas.TOPIC).coalesce(1)
    frame.write.mode("append").json(f"{folder}/in")


def drain(spark, folder, apply_batch, per_trigger=1, source="in"):
    stream = stream_topic(spark, "t", files=f"{folder}/{source}", max_per_trigger=per_trigger)
    query = loader.stream_load(stream, apply_batch, f"{folder}/checkpoint")
    assert query.awaitTermination(120)
    assert query.exception() is None


RECORDS = [
    ({"nct_id": "A", "enrollment_count": 1}, 1, 1),
    ({"nct_id": "A", "enrollment_count": 3}, 3, 3),
    ({"value": {"nct_id": "B", "enrollment_count": 5}}, 1, 4),
    ({"value": json.dumps({"nct_id": "A", "enrollment_count": 2})}, 2, 2),
    ({"enrollment_count": 9}, 1, 5),
    ("junk", 1, 6),
]


@pytest.mark.parametrize("pieces", [1, 2, 3])
def test_any_split_gives_the_batch_answer(spark, tmp_path, pieces):
    folder = str(tmp_path)
    for i in range(pieces):
        deliver(spark, folder, i, RECORDS[i::pieces])
    apply = loader.record_changes(folder, TRIAL, ["nct_id"])
    drain(spark, folder, apply)
    current = loader.current_rows(spark, folder, ["nct_id"])
    assert rows(current, "nct_id", "enrollment_count") == [("A", 3), ("B", 5)]
    bad = spark.read.parquet(f"{folder}/quarantine")
    assert rows(bad, "offset", "reason") == [(5, "missing nct_id"), (6, "undecodable")]
    # A restart finds nothing new.
    drain(spark, folder, apply)
    assert rows(loader.current_rows(spark, folder, ["nct_id"])) == rows(current)


def test_replayed_batch_and_compaction(spark, tmp_path):
    folder = str(tmp_path)
    apply = loader.record_changes(folder, TRIAL, ["nct_id"])
    deliver(spark, folder, 0, RECORDS[:2])
    drain(spark, folder, apply)
    # The same batch again, as after a failure between write and commit.
    batch = spark.read.schema(schemas.TOPIC).json(f"{folder}/in")
    apply(batch, 0)
    assert spark.read.parquet(f"{folder}/changes").count() == 2
    before = rows(loader.current_rows(spark, folder, ["nct_id"]), "nct_id", "enrollment_count")
    newest = lambda upto=None: loader.current_rows(spark, folder, ["nct_id"], upto=upto)
    reached = loader.compact(spark, folder, newest)
    assert loader.compact(spark, folder, newest) == reached
    assert loader.changes(spark, folder).count() == 0
    assert rows(loader.current_rows(spark, folder, ["nct_id"]), "nct_id", "enrollment_count") == before
    deliver(spark, folder, 1, RECORDS[2:4])
    drain(spark, folder, apply)
    assert loader.changes(spark, folder).count() == 2
    current = loader.current_rows(spark, folder, ["nct_id"])
    assert rows(current, "nct_id", "enrollment_count") == [("A", 3), ("B", 5)]
    assert loader.compact(spark, folder, newest) > reached
    assert rows(newest(), "nct_id", "enrollment_count") == [("A", 3), ("B", 5)]


def test_first_name_wins(spark, tmp_path):
    folder = str(tmp_path)
    named = [
        ({"mesh_condition_id": "D1", "mesh_condition_name": "first"}, 1, 1),
        ({"mesh_condition_id": "D1", "mesh_condition_name": "second"}, 2, 2),
        ({"mesh_condition_id": "D2"}, 1, 3),
    ]
    deliver(spark, folder, 0, named[1:])
    deliver(spark, folder, 1, named[:1])
    required = ["mesh_condition_id", "mesh_condition_name"]
    drain(spark, folder, loader.record_changes(folder, schemas.GOLD_DIM_CONDITIONS, required))
    current = loader.current_rows(spark, folder, ["mesh_condition_id"], first_wins=True)
    assert rows(current, *required) == [("D1", "first")]
    assert spark.read.parquet(f"{folder}/quarantine").count() == 1


@pytest.mark.parametrize("compact_after", [(), (0,), (1,), (0, 1)])
def test_first_name_does_not_depend_on_snapshots(spark, tmp_path, compact_after):
    folder, key = str(tmp_path), ["mesh_condition_id"]
    late = {"mesh_condition_id": "D1", "mesh_condition_name": "late"}
    early = {"mesh_condition_id": "D1", "mesh_condition_name": "early"}
    required = ["mesh_condition_id", "mesh_condition_name"]
    apply = loader.record_changes(folder, schemas.GOLD_DIM_CONDITIONS, required)
    current = lambda upto=None: loader.current_rows(spark, folder, key, True, upto)
    for batch, record in enumerate([(late, 5, 5), (early, 1, 1)]):
        deliver(spark, folder, batch, [record])
        drain(spark, folder, apply)
        if batch in compact_after:
            loader.compact(spark, folder, current, f"{folder}/checkpoint")
            loader.prune(spark, folder, keep_snapshots=1)
    assert rows(current(), *required) == [("D1", "early")]


def test_compaction_takes_committed_batches_only(spark, tmp_path):
    folder = str(tmp_path)
    apply = loader.record_changes(folder, TRIAL, ["nct_id"])
    deliver(spark, folder, 0, RECORDS[:2])
    drain(spark, folder, apply)
    assert loader.committed(spark, f"{folder}/checkpoint") == 0
    # A batch that is written and not committed, as while a load is running.
    deliver(spark, folder, 1, RECORDS[2:4])
    apply(spark.read.schema(schemas.TOPIC).json(f"{folder}/in"), 1)
    newest = lambda upto=None: loader.current_rows(spark, folder, ["nct_id"], upto=upto)
    assert loader.compact(spark, folder, newest, f"{folder}/checkpoint") == 0
    assert loader.batches(spark, folder) == [0, 1]
    loader.prune(spark, folder)
    assert loader.batches(spark, folder) == [1]
    assert rows(newest(), "nct_id", "enrollment_count") == [("A", 3), ("B", 5)]


def test_raw_snapshot_and_quarantine(spark, tmp_path):
    folder = str(tmp_path)
    study = {"protocolSection": {"identificationModule": {"nctId": "N1"}}}
    deliver(spark, folder, 0, [(study, 1, 1), ({}, 1, 2)])
    drain(spark, folder, loader.record_raw(folder))
    assert rows(spark.read.parquet(f"{folder}/quarantine"), "offset", "reason") == [(2, "missing id")]
    current = lambda upto=None: loader.current_raw(spark, folder, upto)
    before = current().first()["received_at"]
    loader.compact(spark, folder, current)
    deliver(spark, folder, 1, [(study | {"extra": 1}, 2, 3)])
    drain(spark, folder, loader.record_raw(folder))
    assert rows(current(), "nct_id", "offset") == [("N1", 3)]
    assert current().first()["received_at"] == before


def test_children_follow_their_parents_newest_version(spark, tmp_path):
    folder = str(tmp_path)
    site = "nct_id string, version int, site_ordinal int, city string"

    def sites(version, *cities):
        return [
            ({"nct_id": "A", "version": version, "site_ordinal": i, "city": c}, version, 10 * version + i)
            for i, c in enumerate(cities)
        ]

    deliver(spark, folder, 0, sites(2, "Rome", "Rome")[1:])
    deliver(spark, folder, 1, sites(1, "Oslo", "Bari", "Pisa"))
    deliver(spark, folder, 2, sites(2, "Rome", "Rome")[:1])
    drain(spark, folder, loader.record_changes(folder, site, ["nct_id"]))

    def current(*versions):
        parents = spark.createDataFrame([("A", v) for v in versions], "nct_id string, version int")
        return loader.current_children(spark, folder, parents, ["nct_id"], "version", "site_ordinal")

    assert rows(current(1, 2), "site_ordinal", "city") == [(0, "Rome"), (1, "Rome")]
    loader.compact(spark, folder, lambda upto: current(1, 2))
    assert rows(current(1, 2), "site_ordinal", "city") == [(0, "Rome"), (1, "Rome")]
    assert current(1, 2, 3).count() == 0


def test_raw_landing(spark, tmp_path):
    folder = str(tmp_path)
    study = {"protocolSection": {"identificationModule": {"nctId": "N1"}}}
    deliver(spark, folder, 0, [(study, 1, 1), ({}, 1, 2)])
    deliver(spark, folder, 1, [(study | {"extra": 1}, 2, 3)])
    drain(spark, folder, loader.record_raw(folder))
    current = loader.current_raw(spark, folder)
    assert rows(current, "nct_id", "offset") == [("N1", 3)]
    first = spark.read.parquet(f"{folder}/changes").agg(F.min("received_at")).first()[0]
    assert current.first()["received_at"] == first


def test_failfast_stops_the_query(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, 0, [("junk", 1, 1)])
    apply = loader.record_changes(folder, TRIAL, ["nct_id"], envelope=False, mode="FAILFAST")
    stream = stream_topic(spark, "t", files=f"{folder}/in")
    query = loader.stream_load(stream, apply, f"{folder}/checkpoint")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        query.awaitTermination(120)


def test_streaming_latest(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, 0, RECORDS[:2])
    deliver(spark, folder, 1, [RECORDS[2]])
    stream = stream_topic(spark, "t", files=f"{folder}/in", max_per_trigger=1)
    records = stream.select(
        F.coalesce(F.get_json_object("value", "$.nct_id"), F.lit("B")).alias("nct_id"),
        "value", "timestamp", "offset",
    )
    newest = loader.streaming_latest(records, ["nct_id"], ["timestamp", "offset"])
    query = (
        newest.writeStream.format("memory").queryName("newest").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert rows(spark.table("newest"), "nct_id", "offset") == [("A", 3), ("B", 4)]
