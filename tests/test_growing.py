"""Keyed, bucketed and day-partitioned tables, streams with ending state, stored states and members."""

import datetime
import json
import random

import pytest
from conftest import TESTDATA, rows
from pyspark.sql import functions as F
from test_silver import study, topic

from accrual.operators import members, profile_states
from accrual.operators.latest import latest_per_key
from accrual.plans import gold, silver
from accrual.queries import shapes
from accrual.sources import landing
from accrual.sources.bucketed import BucketedTable
from accrual.sources.files import delete, names
from accrual.sources.keyed import KeyedTable
from accrual.sources.ranges import range_bounds, range_number, range_predicates
from accrual.sources.topics import read_topic, spread
from accrual.streaming import quiet

SF = str(TESTDATA / "sf0.001")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- streams whose state ends ---

RECORD = "id string, at timestamp, n int"
ORDER = ["at", "n"]


def minute(m):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)


def feed(spark, folder, records, quiet_for="10 minutes", late="5 minutes"):
    frame = spark.createDataFrame([(k, minute(m), n) for k, m, n in records], RECORD)
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(RECORD).parquet(f"{folder}/in")
    query = quiet.append_when_quiet(stream, folder, ["id"], ORDER, "at", quiet_for, late)
    assert query.awaitTermination(120) and query.exception() is None
    return query


def appended(spark, folder):
    return rows(spark.read.schema(f"{RECORD}, quiet_since timestamp, n_records long").parquet(f"{folder}/rows"),
                "id", "n", "n_records")


def test_state_falls_when_keys_are_quiet(spark, tmp_path):
    folder = str(tmp_path)
    held = quiet.held_keys(feed(spark, folder, [(f"k{i}", i % 5, i) for i in range(50)]))
    assert held == 50
    query = feed(spark, folder, [("a", 60, 1)])
    assert quiet.held_keys(query) == 1
    assert len(appended(spark, folder)) == 50
    # A key that returns is held anew; its second spell follows the first.
    query = feed(spark, folder, [("k7", 61, 99), ("b", 120, 2)])
    assert quiet.held_keys(query) == 1
    found = quiet.newest_of(spark.read.parquet(f"{folder}/rows"), ["id"], ORDER)
    assert dict(rows(found.where("id IN ('k7', 'k8')"), "id", "n")) == {"k7": 99, "k8": 8}


def test_late_records_are_left_out_and_counted(spark, tmp_path):
    folder = str(tmp_path)
    feed(spark, folder, [("a", 100, 1)])
    # The watermark is at 95: one record is late, one is older than "a" but in time.
    query = feed(spark, folder, [("late", 80, 1), ("a", 97, 7), ("b", 98, 3)])
    assert quiet.dropped_late(query) == 1
    query = feed(spark, folder, [("end", 200, 0)])
    assert appended(spark, folder) == [("a", 1, 2), ("b", 3, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_inside_the_watermark_gives_the_batch_answer(spark, tmp_path, seed):
    dice = random.Random(seed)
    records = [(f"k{dice.randint(0, 9)}", dice.randint(0, 200), n) for n in range(120)]
    records.sort(key=lambda r: r[1] + dice.randint(0, 20))  # up to 20 minutes out of order
    folder, cuts = str(tmp_path), sorted(dice.sample(range(1, 120), 2))
    for a, b in zip([0, *cuts], [*cuts, 120]):
        query = feed(spark, folder, records[a:b], quiet_for="15 minutes", late="25 minutes")
        assert quiet.dropped_late(query) == 0
    feed(spark, folder, [("end", 900, 0)], quiet_for="15 minutes", late="25 minutes")
    found = quiet.newest_of(spark.read.parquet(f"{folder}/rows"), ["id"], ORDER)
    batch = spark.createDataFrame([(k, minute(m), n) for k, m, n in records], RECORD)
    want = latest_per_key(batch, ["id"], [F.col(c).desc() for c in ORDER])
    assert rows(found, "id", "at", "n") == rows(want, "id", "at", "n")


def test_records_without_key_or_time_are_left_out(spark, tmp_path):
    folder = str(tmp_path)
    frame = spark.createDataFrame([(None, minute(1), 1), ("a", None, 2), ("a", minute(1), 3), ("z", minute(99), 4)], RECORD)
    frame.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(RECORD).parquet(f"{folder}/in")
    quiet.append_when_quiet(stream, folder, ["id"], ORDER, "at", "5 minutes", "1 minute").awaitTermination(120)
    assert appended(spark, folder) == [("a", 3, 1)]


# --- tables of which a batch rewrites what it touches ---

ROWS = "id long, version int, item int, text string"


@pytest.fixture()
def keyed(spark, tmp_path):
    made = KeyedTable(f"{tmp_path}/t", ("id",), ROWS, parts=16)
    made.create(spark.createDataFrame([(i, 1, 0, "old") for i in range(200)] + [(None, 1, 0, "x")], ROWS))
    return made


def files_by_part(spark, keyed):
    return {p: keyed.files(spark, p) for p in range(keyed.parts)}


def test_upsert_rewrites_only_touched_parts(spark, keyed):
    before = files_by_part(spark, keyed)
    batch = spark.createDataFrame([(3, 2, 0, "new"), (3, 1, 0, "older"), (900, 1, 0, "added"), (None, 9, 0, "x")], ROWS)
    touched = keyed.upsert(batch, ["version", "text"])
    after = files_by_part(spark, keyed)
    assert {p for p in before if before[p] != after[p]} == set(touched) and len(touched) <= 2
    got = dict(rows(keyed.read(spark), "id", "text"))
    assert len(got) == 201 and got[3] == "new" and got[900] == "added" and got[4] == "old"
    assert keyed.upsert(batch, ["version", "text"]) == touched
    assert dict(rows(keyed.read(spark), "id", "text")) == got
    assert keyed.upsert(batch.limit(0), ["version", "text"]) == []


def test_merge_reads_only_touched_parts(spark, keyed):
    plan = plan_of(keyed.rows_of(spark, [3]))
    assert "PartitionFilters: [isnotnull(key_part" in plan and "key_part#" in plan.split("PartitionFilters")[1]


def test_part_left_without_rows_is_deleted(spark, tmp_path):
    made = KeyedTable(f"{tmp_path}/t", ("id",), ROWS, parts=64)
    made.create(spark.createDataFrame([(i, 1, n, "old") for i in range(5) for n in range(3)], ROWS))
    parents = spark.createDataFrame([(2, 2), (3, 2)], "id long, version int")
    children = spark.createDataFrame([(3, 2, 0, "new")], ROWS)
    touched = made.replace_children(parents, children, "version", "item")
    assert rows(made.read(spark).where("id IN (2, 3)")) == [(3, 2, 0, "new")]
    assert made.read(spark).count() == 10
    there = set(names(spark, made.path))
    alone = [p for p in touched if f"key_part={p}" not in there]
    assert len(touched) == 2 and len(alone) == 1


def test_keyed_merges_equal_whole_table_merges(spark, keyed):
    batch = spark.createDataFrame([(i, i % 3, 0, f"b{i}") for i in range(150, 260)], ROWS)
    whole = keyed.read(spark)
    whole = spark.createDataFrame(whole.collect(), whole.schema)
    from accrual.operators.merge import insert_absent

    keyed.insert_absent(batch, ["version"])
    assert rows(keyed.read(spark)) == rows(insert_absent(whole, batch, ["id"], ["version"]))


def test_empty_keyed_table(spark, tmp_path):
    made = KeyedTable(f"{tmp_path}/t", ("id",), ROWS, parts=4)
    made.create(spark.createDataFrame([], ROWS))
    assert made.read(spark).count() == 0
    made.upsert(spark.createDataFrame([(1, 1, 0, "a")], ROWS), ["version"])
    assert rows(made.read(spark), "id") == [(1,)]


# --- bucketed layers ---


def test_bucketed_layers_join_without_exchange(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = gold.write_bucketed_gold(shapes.trials(spark, SF), shapes.sites(spark, SF), str(tmp_path), "t1_", 4)
        assert "Exchange" not in plan_of(features)
        joined = gold.sites_with_velocity(spark.table("t1_trial_sites"), spark.table("t1_trials"))
        assert "Exchange" not in plan_of(joined)
        stats = gold.trial_site_stats(
            gold.usable_sites(shapes.sites(spark, SF)), spark.read.parquet(f"{tmp_path}/site_history")
        )
        plain = gold.trial_features(shapes.trials(spark, SF), stats)
        assert "Exchange" in plan_of(plain)
        assert features.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_table_is_attached_again(spark, tmp_path):
    made = BucketedTable("t2_rows", f"{tmp_path}/rows", ("id",), 3)
    made.write(spark.range(20).select("id", F.lit("x").alias("text")))
    spark.sql("DROP TABLE t2_rows")
    back = made.attach(spark, "id long, text string")
    assert back.count() == 20 and "Exchange" not in plan_of(back.groupBy("id").count())


# --- landing ---


def delivered(spark):
    first, second = study("A"), study("B")
    second["protocolSection"]["statusModule"]["overallStatus"] = "RECRUITING"
    second["protocolSection"]["statusModule"]["lastUpdatePostDateStruct"] = {"date": "2024-03-02"}
    first["protocolSection"]["statusModule"]["lastUpdatePostDateStruct"] = {"date": "2024-03-01"}
    third = json.loads(json.dumps(first))
    third["protocolSection"]["identificationModule"]["nctId"] = "C"
    third["protocolSection"]["statusModule"]["lastUpdatePostDateStruct"] = {"date": "junk"}
    return topic(spark, [(d, 0, i) for i, d in enumerate([first, second, third, "junk"])])


def test_landing_by_day_is_pruned(spark, tmp_path):
    folder = str(tmp_path)
    landing.land_by_day(delivered(spark), folder)
    assert len([n for n in names(spark, folder) if n.startswith("update_day=")]) == 3
    chosen = landing.select_landed(spark, folder, "2024-03-02", daily=True)
    assert rows(chosen, "nct_id") == [("A",)]
    plan = plan_of(chosen)
    assert "update_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "overall_status" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert rows(landing.select_landed(spark, folder, "2024-03-03", daily=True)) == []
    assert landing.select_landed(spark, folder, "2024-03-03", daily=False, max_rows=1).count() == 1


def test_variants_give_the_same_trials(spark, tmp_path):
    odd = study("D")
    odd["protocolSection"]["designModule"]["enrollmentInfo"] = {"count": {"wrong": 1}}
    documents = [study("A"), study("B", meshes=[], conditions=[]), study("C", phases=[]), odd, {"no": "id"}, "[1]", "junk"]
    given = topic(spark, [(d, 0, i) for i, d in enumerate(documents)])
    landed = landing.land_variants(given)
    assert dict(landed.dtypes)["doc"] == "variant"
    landed.write.parquet(f"{tmp_path}/v")
    back = spark.read.parquet(f"{tmp_path}/v")
    assert rows(back, "nct_id") == [("A",), ("B",), ("C",), ("D",)]
    assert rows(back, "nct_id", "payload_hash") == rows(landing.land_raw(given), "nct_id", "payload_hash")
    got, want = silver.clean_landed(back), silver.clean_studies(given)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want)


def test_documents_are_not_parsed_in_one_task(spark):
    parsed = silver.flatten_studies(silver.decode_json(shapes.study_topic(spark, SF), silver.schemas.STUDY))
    per_task = [r["count"] for r in parsed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 8 and max(per_task) < 0.3 * sum(per_task)


def test_topic_in_one_file_is_spread(spark, tmp_path):
    delivered(spark).coalesce(1).write.json(f"{tmp_path}/t")
    assert spread(spark.range(10).coalesce(1), ["id"], 3).rdd.getNumPartitions() == 3
    assert spread(spark.range(10).repartition(5), ["id"], 3).rdd.getNumPartitions() == 5
    assert read_topic(spark, "t", files=f"{tmp_path}/t").rdd.getNumPartitions() == 1
    assert read_topic(spark, "t", files=f"{tmp_path}/t", partitions=6).rdd.getNumPartitions() == 6


# --- ranges, members, states ---


def test_key_ranges_of_skewed_and_missing_keys(spark):
    dice = random.Random(3)
    keys = [dice.randint(0, 1000) for _ in range(600)] + [500] * 300 + [None] * 40
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    predicates = range_predicates(df, "k", 9)
    sizes = [df.where(p).count() for p in predicates]
    assert sum(sizes) == len(keys) and sizes[-1] == 40
    hot = next(i for i, p in enumerate(predicates) if df.where(p).where("k = 500").count())
    assert all(abs(n - 100) <= 5 for i, n in enumerate(sizes[:-1]) if i not in (hot - 1, hot, hot + 1))
    assert 300 <= sizes[hot] < 420
    numbers = df.groupBy(range_number("k", range_bounds(df, "k", 9)).alias("part")).count()
    assert rows(numbers.where("part IS NOT NULL"), "count") == sorted([(n,) for n in sizes[:-1] if n], key=repr)
    assert range_predicates(df.limit(0), "k", 4) == ["k IS NOT NULL", "k IS NULL"]


@pytest.mark.parametrize("limit", [members.MAX_BROADCAST, 0])
def test_members_are_exact(spark, monkeypatch, limit):
    monkeypatch.setattr(members, "MAX_BROADCAST", limit)
    dice = random.Random(4)
    inside = {dice.choice([0, 1, 7, 8, 32767, 32768, 32769, -1, -32768, 10**12]) + dice.randint(-40, 40) for _ in range(300)}
    asked = sorted(inside | {x + d for x in inside for d in (-1, 1, 9, 32768)})
    bitmaps = members.member_bitmaps(spark.createDataFrame([(k,) for k in inside] + [(None,)], "k long"), F.col("k"))
    children = spark.createDataFrame([(k, "x") for k in asked] + [(None, "y")], "k long, block string")
    got = members.unknown_keys(children, F.col("k"), bitmaps)
    assert rows(got, "k") == sorted([(k,) for k in asked if k not in inside] + [(None,)], key=repr)


def test_known_children_do_not_reach_the_shuffle(spark):
    parents = spark.createDataFrame([(f"NCT{i:08d}",) for i in range(500)] + [("other",)], "id string")
    children = spark.createDataFrame(
        [(f"NCT{i % 510:08d}",) for i in range(2000)] + [("other",), ("odd",), (None,), ("ABC00000001",)], "child string"
    )
    bitmaps = members.member_bitmaps(parents, members.study_number(F.col("id")))
    found = members.fk_violations_by_bitmap(
        children, parents, "child", "id", bitmaps, members.study_number
    )
    want = [(f"NCT{i:08d}", sum(1 for x in range(2000) if x % 510 == i)) for i in range(500, 510)]
    assert rows(found) == sorted([*want, ("odd", 1), ("ABC00000001", 1)], key=repr)
    left = members.unknown_keys(children, members.study_number(F.col("child")), bitmaps)
    assert left.count() < 40


def test_states_of_two_loads_equal_the_whole(spark, tmp_path):
    lines = shapes.table(spark, SF, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_returnflag", (F.col("l_tax") > 0.04).alias("taxed"),
        F.when(F.col("l_discount") > 0, F.col("l_linestatus")).alias("status"),
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("nan"),
    )
    even = F.pmod(F.xxhash64("l_extendedprice"), F.lit(2)) == 0
    for load, part in ((1, lines.where(even)), (2, lines.where(~even)), (2, lines.where(~even))):
        profile_states.write_states(part, f"{tmp_path}/parts", load)
    profile_states.write_states(lines, f"{tmp_path}/whole", 1)
    found = []
    for name in ("parts", "whole"):
        columns, values = profile_states.read_states(spark, f"{tmp_path}/{name}")
        profile = profile_states.combined_columns(columns)
        exact = profile.withColumn("mean", F.round("mean", 6)).drop(*profile_states.ABOUT)
        counts = profile_states.combined_values(values)
        found.append((rows(exact), rows(counts, "column", "value", "n", "place")))
        about = {r["column"]: r for r in profile.collect()}
        n = lines.count()
        for q, name in ((0.25, "about_p25"), (0.5, "about_median"), (0.75, "about_p75")):
            rank = lines.where(F.col("l_extendedprice") <= about["l_extendedprice"][name]).count() / n
            assert abs(rank - q) < 0.03
        assert about["taxed"]["about_p25"] is None and about["nan"]["n"] < n
    assert found[0] == found[1]
    columns, _ = profile_states.read_states(spark, f"{tmp_path}/parts", loads=[1])
    assert profile_states.combined_columns(columns).first()["row_count"] == lines.where(even).count()


def test_deleting_a_missing_folder_is_harmless(spark, tmp_path):
    delete(spark, f"{tmp_path}/nothing")
    assert names(spark, f"{tmp_path}/nothing") == []


def test_lines_are_dealt_out_before_they_are_widened(spark):
    """Study documents have one exchange by number, below the joins, and as many tasks as were asked for."""
    made = shapes.study_topic(spark, SF)
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = [i for i, step in enumerate(plan) if "RepartitionByExpression" in step]
    joins = [i for i, step in enumerate(plan) if "Join LeftOuter" in step]
    assert len(dealt) == 1 and len(joins) == 5 and dealt[0] > max(joins)
    wanted = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert made.rdd.getNumPartitions() >= wanted
