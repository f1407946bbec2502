import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accrual.operators import areas, dims, joins, merge, order_stats, profiles, values
from accrual.operators.latest import latest_per_key

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

STATE = "k string, at int, seq int, v string"


def state(spark, data):
    return spark.createDataFrame(data, STATE)


def newest(*batches):
    best = {}
    for k, at, seq, v in [r for b in batches for r in b]:
        if k is not None and (k not in best or (at, seq) >= best[k][1:3]):
            best[k] = (k, at, seq, v)
    return sorted(best.values(), key=repr)


records = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 5)), max_size=12
)


@FEW
@given(records, records)
def test_upsert(spark, first, second):
    numbered = [(k, at, i, f"v{i}") for i, (k, at) in enumerate(first + second)]
    one, two = numbered[: len(first)], numbered[len(first) :]
    target = latest_per_key(
        state(spark, one).dropna(subset=["k"]), ["k"], [F.col("at").desc(), F.col("seq").desc()]
    )
    merged = merge.merge_upsert(target, state(spark, two), ["k"], ["at", "seq"])
    assert rows(merged) == newest(one, two)
    again = merge.merge_upsert(merged, state(spark, two), ["k"], ["at", "seq"])
    assert rows(again) == rows(merged)


def test_older_record_does_not_win(spark):
    target = state(spark, [("a", 5, 1, "new")])
    merged = merge.merge_upsert(target, state(spark, [("a", 4, 2, "old")]), ["k"], ["at", "seq"])
    assert rows(merged, "v") == [("new",)]


def test_upsert_may_write_null(spark):
    target = state(spark, [("a", 1, 1, "set")])
    merged = merge.merge_upsert(target, state(spark, [("a", 2, 1, None)]), ["k"], ["at", "seq"])
    assert rows(merged, "v") == [(None,)]


def test_insert_absent(spark):
    target = state(spark, [("a", 1, 1, "kept")])
    batch = state(
        spark, [("a", 0, 0, "no"), ("b", 2, 2, "later"), ("b", 1, 3, "first"), (None, 0, 0, "x")]
    )
    assert rows(merge.insert_absent(target, batch, ["k"], ["at", "seq"]), "k", "v") == [
        ("a", "kept"),
        ("b", "first"),
    ]


CHILD = "p string, ver int, n int, v string"


def apply_children(spark, target, parents, children):
    merged = merge.replace_children(
        target,
        spark.createDataFrame(parents, "p string, ver int"),
        spark.createDataFrame(children, CHILD),
        ["p"],
        "ver",
        "n",
    )
    return spark.createDataFrame(merged.collect(), CHILD)


def test_children_split_over_batches(spark):
    old = [("a", 1, 0, "x"), ("a", 1, 1, "y"), ("b", 1, 0, "z")]
    first = ([("a", 2)], [("a", 2, 0, "new"), ("a", 2, 1, "new")])
    second = ([("a", 2)], [("a", 2, 2, "new")])
    expected = [("a", 2, 0, "new"), ("a", 2, 1, "new"), ("a", 2, 2, "new"), ("b", 1, 0, "z")]
    for order in ((first, second), (second, first), (first, second, first)):
        current = spark.createDataFrame(old, CHILD)
        for parents, children in order:
            current = apply_children(spark, current, parents, children)
        assert rows(current) == expected


def test_children_without_parent_rows_and_late_versions(spark):
    current = spark.createDataFrame([("a", 2, 0, "x")], CHILD)
    current = apply_children(spark, current, [("a", 1)], [("a", 1, 0, "late")])
    assert rows(current) == [("a", 2, 0, "x")]
    current = apply_children(spark, current, [], [("a", 3, 0, "newer")])
    assert rows(current) == [("a", 3, 0, "newer")]
    current = apply_children(spark, current, [("a", 4)], [])
    assert rows(current) == []


def test_raw_upsert_keeps_first_arrival(spark):
    schema = (
        "nct_id string, payload_hash string, received_at int, updated_at int, payload string, "
        "timestamp int, partition int, offset int"
    )
    target = spark.createDataFrame([("N", "h1", 1, 1, "p1", 1, 0, 1)], schema)
    landed = spark.createDataFrame(
        [("N", "h2", 9, 9, "p2", 2, 0, 2), ("M", "h3", 9, 9, "p3", 2, 0, 3)], schema
    )
    merged = merge.upsert_raw(target, landed)
    assert rows(merged, "nct_id", "payload_hash", "received_at", "updated_at") == [
        ("M", "h3", 9, 9),
        ("N", "h2", 1, 9),
    ]
    assert rows(merge.changed_payloads(target, landed), "nct_id") == [("M",), ("N",)]
    assert merge.changed_payloads(merged, landed).count() == 0


def test_fk_violations(spark):
    children = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parents = spark.createDataFrame([("a",)], "id string")
    assert rows(joins.fk_violations(children, parents, ["k"], ["id"])) == [("b", 2)]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_salted_lookup_equals_join(spark, how, broadcast):
    rng = random.Random(7)
    # One key holds a third of the rows, a tenth has no key.
    keys = [rng.choice(["hot"] * 5 + list("abcdefgh") + [None, None]) for _ in range(600)]
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    lookup = spark.createDataFrame(
        [("hot", 1), ("a", 2), ("b", 3), ("c", 4), ("z", 5)], "k string, v int"
    )
    counts = fact.dropna().groupBy("k").agg(F.count("*").alias("n"))
    hot = joins.hot_keys_of_counts(counts, ["k"], "n", pieces=4)
    hottest = fact.filter("k = 'hot'").select(F.xxhash64("k")).distinct()
    assert rows(hot.drop("_salts")) == rows(hottest)
    assert hot.first()["_salts"] in (2, 3)
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = joins.salted_lookup(fact, lookup, ["k"], hot, ["i"], how)
        assert rows(got, "k", "i", "v") == rows(fact.join(lookup, "k", how), "k", "i", "v")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


def test_hot_keys_are_bounded(spark):
    counts = spark.range(50).select(F.col("id").alias("k"), (F.col("id") + 10).alias("n"))
    assert joins.hot_keys_of_counts(counts, ["k"], "n", pieces=30).count() < 30
    assert joins.hot_keys_of_counts(counts, ["k"], "n", pieces=2).count() == 0
    assert joins.hot_keys_of_counts(counts.limit(0), ["k"], "n").count() == 0


groups = st.lists(
    st.tuples(st.sampled_from(["x", "y", None]), st.integers(-5, 5)), min_size=1, max_size=40
)


@FEW
@given(groups)
def test_distributed_rank(spark, data):
    numbered = [(g, v, i) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(numbered, "g string, v int, i int")
    got = order_stats.distributed_rank(df, ["g"], [F.col("v").desc(), F.col("i")])
    expected = []
    for g in {g for g, _, _ in numbered}:
        own = sorted((r for r in numbered if r[0] == g), key=lambda r: (-r[1], r[2]))
        expected += [(*r, place) for place, r in enumerate(own, 1)]
    assert rows(got) == sorted(expected, key=repr)


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=1, max_size=60))
def test_quantiles(spark, data):
    df = spark.createDataFrame([(v, 1.5) for v in data], "v int, w double")
    known = sorted(v for v in data if v is not None)
    nearest = {
        r["column"]: r for r in order_stats.nearest_rank_quantiles(
            df, ["v", "w"], {"p50": 0.5, "p90": 0.9, "top": 1.0}
        ).collect()
    }
    smooth = {
        r["column"]: r
        for r in order_stats.interpolated_quantiles(df, ["v", "w"], {"p50": 0.5, "p99": 0.99}).collect()
    }
    assert nearest["w"]["p50"] == 1.5 and smooth["w"]["p99"] == 1.5
    if not known:
        assert "v" not in nearest and "v" not in smooth
        return
    n = len(known)
    assert nearest["v"]["p50"] == known[n // 2]
    assert nearest["v"]["p90"] == known[int(n * 0.90)]
    assert nearest["v"]["top"] == known[-1]
    expected = df.agg(F.percentile("v", [0.5, 0.99])).first()[0]
    assert [smooth["v"]["p50"], smooth["v"]["p99"]] == pytest.approx(expected)


odd_numbers = st.one_of(
    st.floats(allow_nan=False), st.sampled_from([0.0, 1e-310, 1.0, 1.5, -3.0, 1e308, -1e308]), st.none()
)


@FEW
@given(st.lists(odd_numbers, min_size=1, max_size=50))
def test_values_at_places_of_any_doubles(spark, data):
    df = spark.createDataFrame([(v,) for v in data] + [(float("nan"),)], "v double")
    known = sorted(v for v in data if v is not None)
    places = sorted({0, len(known) // 3, len(known) // 2, len(known) - 1})
    if known:
        got = order_stats.values_at(df, {"v": places})
        assert [got["v", p] for p in places] == [known[p] for p in places]


def test_quantiles_take_few_rounds_and_no_sort(spark, monkeypatch):
    df = spark.range(200_000).select((F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 9)).alias("v"))
    rounds, plain = [], order_stats._refined
    monkeypatch.setattr(order_stats, "_refined", lambda *a: rounds.append(len(a[1])) or plain(*a))
    quantiles = {f"p{i}": i / 20 for i in range(21)}
    got = order_stats.nearest_rank_quantiles(df, ["v"], quantiles).first()
    ordered = sorted(r[0] for r in df.collect())
    assert [got[q] for q in quantiles] == [ordered[min(200_000 * i // 20, 199_999)] for i in range(21)]
    assert len(rounds) <= 5 and max(rounds) <= 21


@FEW
@given(st.lists(st.sampled_from("abcdefgh") | st.none(), max_size=60), st.integers(1, 9), st.sampled_from([1, 3, 64]))
def test_top_values_for_any_cells(spark, data, n, cells):
    from unittest.mock import patch

    df = spark.createDataFrame([(v,) for v in data], "v string")
    counts = sorted(((-data.count(v), v is not None, v) for v in set(data)), key=lambda x: (x[0], x[1], x[2] or ""))
    with patch.object(values, "CELLS", cells):
        got = values.top_values(df, "v", n, plain_bytes=0).collect()
    assert [tuple(r) for r in got] == [(v, -c) for c, _, v in counts[:n]]
    assert values.top_values(df, "v", n).collect() == got


def test_top_values_of_many_rare_ones(spark):
    """The fullest cells do not settle it at first: rare values fill cells beside the frequent ones."""
    rare = spark.range(300_000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("v"))
    some = spark.range(40).select(F.explode(F.array_repeat(F.concat(F.lit("f"), "id"), 3)).alias("v"))
    got = values.top_values(rare.unionByName(some), "v", 41, plain_bytes=0).collect()
    assert sorted(r["v"] for r in got if r["n"] == 3) == sorted(f"f{i}" for i in range(40))
    assert got[-1]["n"] == 1 and got[-1]["v"] == "r0"


def test_top_dimension_values_pass_over_unknown_ids(spark):
    ids = [["a"]] * 9 + [["b", "x"]] * 5 + [["c"]] * 3 + [["y"]] * 2
    df = spark.createDataFrame([(i,) for i in ids], "ids array<string>")
    dim = spark.createDataFrame([("x", "X"), ("y", "Y"), ("c", "C"), ("c", "D")], "id string, name string")
    for plain_bytes in (0, values.PLAIN_BYTES):
        got = values.top_dimension_values(df, "ids", dim, "id", "name", 3, plain_bytes).collect()
        assert [tuple(r) for r in got] == [("x", "X", 5), ("c", "C", 3), ("c", "D", 3)]
        assert values.top_dimension_values(df, "ids", dim.limit(0), "id", "name", 3, plain_bytes).count() == 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    profile = profiles.numeric_profile(df).first()
    assert (profile["n"], profile["null_count"], profile["max"]) == (1, 2, 1.0)
    assert profile["flags"] == "CONSTANT"


def test_profile_flags(spark):
    numbers = spark.createDataFrame(
        [(float(i % 10), None, 5) for i in range(1000)] + [(5000.0, None, 5)],
        "spread double, nothing double, same int",
    )
    flags = {r["column"]: r["flags"] for r in profiles.numeric_profile(numbers).collect()}
    assert flags == {
        "spread": "SURPRISING DISTRIBUTION",
        "nothing": "ENTIRELY NULL",
        "same": "CONSTANT",
    }
    quick = profiles.numeric_profile(numbers, exact=False).filter("column = 'spread'").first()
    assert 3.0 <= quick["median"] <= 6.0
    texts = spark.createDataFrame(
        [("a" if i < 98 else "b", f"v{i}", None, [str(i % 2)]) for i in range(100)],
        "mostly string, many string, none string, items array<string>",
    )
    found = profiles.categorical_profile(texts)
    by_column = {r["column"]: r for r in found.filter("place = 1 or place is null").collect()}
    assert by_column["mostly"]["flags"] == "DOMINANT VALUE"
    assert by_column["many"]["flags"] == "HIGH CARDINALITY"
    assert by_column["many"]["n_distinct"] == 100
    assert by_column["none"]["flags"] == "ENTIRELY NULL"
    assert found.filter("column = 'many'").count() == 20
    assert by_column["items"]["n_distinct"] == 2


def test_table_profile_covers_every_column(spark):
    df = spark.createDataFrame(
        [(1, True, "a", [1]), (2, None, "b", None)], "n int, b boolean, s string, l array<int>"
    )
    tidy = profiles.table_profile(df, "t").collect()
    kinds = {r["column"]: r["kind"] for r in tidy}
    assert kinds == {"n": "numeric", "b": "boolean", "s": "categorical", "l": "categorical"}
    assert {r["value"] for r in tidy if r["column"] == "n" and r["metric"] == "mean"} == {"1.5"}


def test_case_variants(spark):
    df = spark.createDataFrame([("HIV",), ("hiv",), ("Hiv",), ("flu",), ("Flu",), ("x",)], "v string")
    got = values.case_variants(df, "v", n=1)
    assert rows(got) == [("hiv", 3, ["HIV", "Hiv", "hiv"])]
    assert rows(values.case_variants(df, "v", n=1, shown=2)) == [("hiv", 3, ["HIV", "Hiv"])]


def test_distinct_list_values(spark):
    df = spark.createDataFrame([(["a", "b", None],), (["a"],), (None,)], "items array<string>")
    assert values.distinct_list_values(df, "items").first()[0] == 2
    assert values.distinct_list_values(df, "items", approximate=True).first()[0] == 2
    assert values.exploded(df, "items", outer=True).count() == 5


AREA_PAIRS = [("heart", "D1"), ("heart", "D2"), ("skin", "D2"), ("skin", "D3")]


def test_areas(spark):
    """Keys may repeat or be NULL, ids in list and map may be NULL."""
    df = spark.createDataFrame(
        [
            ("A", ["D1"]), ("B", ["D2", "D9"]), ("C", []), ("D", None), ("E", ["D9"]),
            ("A", ["D3"]), (None, ["D1"]), ("F", ["D1", None, "D1"]),
        ],
        "nct_id string, ids array<string>",
    )
    mapping = spark.createDataFrame([*AREA_PAIRS, ("heart", None)], "area string, mesh_id string")
    got = areas.area_multihot(df, mapping, "ids", ["heart", "skin", "none"])
    assert rows(got.drop("ids").filter("nct_id is null or nct_id = 'F'")) == [
        ("F", 1, 0, 0, 1),
        (None, 1, 0, 0, 0),
    ]
    assert rows(got.drop("ids").filter("nct_id is not null and nct_id <> 'F'")) == [
        ("A", 0, 1, 0, 0),
        ("A", 1, 0, 0, 0),
        ("B", 1, 1, 0, 1),
        ("C", 0, 0, 0, 0),
        ("D", 0, 0, 0, 0),
        ("E", 0, 0, 0, 1),
    ]


def test_smallest_id_of_a_name(spark):
    names = spark.createDataFrame([("a",), ("z",)], "n string")
    dim = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "d string, id int")
    for order in ("id", "-id"):
        got = dims.name_to_id(names, dim.orderBy(F.expr(order)), "n", "d", "id")
        assert rows(got) == [("a", 1), ("z", None)]


def test_empty_area_map(spark):
    df = spark.createDataFrame([("A", ["D1"])], "nct_id string, ids array<string>")
    mapping = spark.createDataFrame([], "area string, mesh_id string")
    got = areas.area_multihot(df, mapping, "ids", ["heart"])
    assert rows(got.drop("ids")) == [("A", 0, 1)]


def test_place_filters(spark):
    sites = spark.createDataFrame([("IT", "Rome"), ("FR", "Paris")], "country string, city string")
    assert dims.within_places(sites, countries=["IT"]).count() == 1
    assert dims.within_places(sites, cities=["Paris", "Rome"]).count() == 2
    assert dims.within_places(sites, countries=["IT"], cities=["Paris"]).count() == 2
    chosen = spark.createDataFrame([("Rome",)], "city string")
    assert rows(dims.within_places(sites, chosen=chosen), "country") == [("IT",)]
    both = spark.createDataFrame([("IT", None), ("FR", "Nice")], "country string, city string")
    assert rows(dims.within_places(sites, chosen=both), "country") == [("IT",)]
    with pytest.raises(ValueError):
        dims.within_places(sites)


def test_latest_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    newest = latest_per_key(df, ["k"], [F.col("id").desc()])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit") < shuffle < plan.rindex("WindowGroupLimit")
    assert rows(newest) == [(0, 999), (1, 997), (2, 998)]


def test_hot_rows_are_spread(spark):
    """A key with a third of the rows, and the rows without a key, reach many tasks."""
    fact = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        "id",
    )
    lookup = fact.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    hot = joins.hot_keys_of_counts(lookup, ["k"], "n", pieces=16)
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = joins.salted_lookup(fact, lookup, ["k"], hot, ["id"])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
        largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
        assert total == 9000 and largest < 1500
        assert rows(joined.filter("k = 'hot'").select("n").distinct()) == [(3000,)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
