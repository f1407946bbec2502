import datetime

import pytest
from conftest import TESTDATA, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from accrual import schemas
from accrual.plans import gold
from accrual.queries import shapes

SF = str(TESTDATA / "sf0.001")

TRIAL = "nct_id string, trial_velocity double, start_date date, primary_completion_date date"


def trials(spark, *data):
    return spark.createDataFrame(
        [(i, v, datetime.date(s, 1, 1), datetime.date(e, 1, 1)) for i, v, s, e in data], TRIAL
    )


def sites(spark, *data):
    """(nct_id, facility, country, city, zip, ids)"""
    return spark.createDataFrame(
        [(n, f, c, "ST", z, co, 1.0, 2.0, ids) for n, f, co, c, z, ids in data],
        schemas.SILVER_SITES,
    )


@pytest.fixture
def world(spark):
    t = trials(spark, ("A", 2.0, 2010, 2011), ("B", 6.0, 2015, 2016), ("X", 150.0, 2020, 2021))
    s = sites(
        spark,
        ("A", "One", "IT", "Rome", "1", ["D1", "D2"]),
        ("A", "One", "IT", "Rome", "1", ["D1"]),
        ("B", "Uno", "IT", "Rome", "1", None),
        ("B", "Two", "IT", "Pisa", "2", []),
        ("B", "Three", "IT", "Pisa", None, ["D1"]),
        ("Z", "Two", "IT", "Pisa", "2", ["D2"]),
        ("A", "  ", "IT", "Bari", "3", ["D1"]),
        ("A", "unknown facility ", "IT", "Bari", "3", ["D1"]),
    )
    return t, gold.usable_sites(s)


def test_site_history(world):
    t, s = world
    history = gold.site_history(s, t)
    columns = ["city", "zip", "facility_name", "n_trials", "avg_velocity", "last_year"]
    assert rows(history, *columns) == [
        ("Pisa", "2", "Two", 2, 3.0, 2015),
        ("Rome", "1", "One", 3, pytest.approx(10 / 3), 2015),
    ]


def test_site_history_options(world):
    t, s = world
    dropped = gold.site_history(s, t, orphans="drop")
    assert rows(dropped, "city", "n_trials", "avg_velocity") == [("Pisa", 1, 6.0), ("Rome", 3, pytest.approx(10 / 3))]
    once = gold.site_history(s, t, distinct_trials=True)
    assert rows(once, "city", "n_trials", "avg_velocity") == [("Pisa", 2, 3.0), ("Rome", 2, 4.0)]
    with pytest.raises(ValueError):
        gold.site_history(s, t, orphans="other")


def test_orphan_only_place_has_no_year(spark):
    t = trials(spark, ("A", 2.0, 2010, 2011))
    s = sites(spark, ("Z", "One", "IT", "Rome", "1", None))
    assert rows(gold.site_history(s, t), "n_trials", "avg_velocity", "last_year") == [(1, 0.0, None)]


def test_condition_history(world):
    _, s = world
    assert rows(gold.site_condition_history(s)) == [
        ("IT", "Pisa", "2", "D2", 1),
        ("IT", "Rome", "1", "D1", 2),
        ("IT", "Rome", "1", "D2", 1),
    ]


def test_stats(world):
    t, s = world
    history = gold.site_history(s, t)
    plain = gold.trial_site_stats(s, history)
    got = {r["nct_id"]: (r["n_sites"], r["avg_site_exp"]) for r in plain.collect()}
    # B's site without a postal code counts as a site and has no history.
    assert got == {"A": (2, 3.0), "B": (3, 2.5), "Z": (1, 2.0)}


def test_leave_one_out(world):
    t, s = world
    got = {r["nct_id"]: (r["avg_site_exp"], r["avg_site_vel"]) for r in
           gold.leave_one_out_stats(s, t).collect()}
    # Rome without A is B's row; without B it is A's two. Pisa without B is the orphan's row.
    assert got["A"] == (1.0, 6.0)
    assert got["B"] == (1.5, 1.0)
    assert got["Z"] == (1.0, 6.0)


def test_as_of(world):
    t, s = world
    got = rows(gold.as_of_stats(s, t))
    # A was complete in 2011, so B sees A's two rows in Rome and nothing in Pisa.
    assert got == [("B", 2.0, 2.0)]


trial_sets = st.dictionaries(
    st.sampled_from("ABCDEF"),
    st.tuples(st.integers(1, 149), st.integers(2000, 2009), st.integers(1, 6)),
    min_size=1,
)
site_lists = st.lists(
    st.tuples(st.sampled_from("ABCDEFZ"), st.sampled_from(["1", "2", "3"])), min_size=1, max_size=25
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(trial_sets, site_lists)
def test_histories_match_brute_force(spark, chosen, listed):
    facts = {i: (float(v), s, s + d) for i, (v, s, d) in chosen.items()}
    t = trials(spark, *[(i, *f) for i, f in facts.items()])
    s = sites(spark, *[(n, "F", "IT", "Rome", z, None) for n, z in listed])

    got = {r["zip"]: (r["n_trials"], r["avg_velocity"]) for r in gold.site_history(s, t).collect()}
    for z in {z for _, z in listed}:
        speeds = [facts.get(n, (0.0,))[0] for n, place in listed if place == z]
        assert got[z] == (len(speeds), pytest.approx(sum(speeds) / len(speeds)))

    as_of = {r["nct_id"]: (r["avg_site_exp"], r["avg_site_vel"]) for r in gold.as_of_stats(s, t).collect()}
    for n in facts:
        seen = []
        for place in [z for who, z in listed if who == n]:
            past = [facts[o][0] for o, z in listed
                    if z == place and o in facts and facts[o][2] < facts[n][1]]
            if past:
                seen.append((len(past), sum(past) / len(past)))
        if not seen:
            assert n not in as_of
        else:
            assert as_of[n] == (
                pytest.approx(sum(e for e, _ in seen) / len(seen)),
                pytest.approx(sum(v for _, v in seen) / len(seen)),
            )


def test_write_gold(spark, tmp_path):
    from test_silver import study, topic

    from accrual.plans import silver

    folder = str(tmp_path)
    silver.write_silver(topic(spark, [(study("A"), 0, 1), (study("B", count=50), 0, 2)]), folder)
    gold.write_gold(
        spark.read.parquet(f"{folder}/trials"), spark.read.parquet(f"{folder}/trial_sites"), folder
    )
    features = spark.read.parquet(f"{folder}/trial_features")
    assert rows(features, "nct_id", "n_sites", "avg_site_exp") == [("A", 1, 2.0), ("B", 1, 2.0)]
    assert features.columns == [f.split()[0] for f in schemas.GOLD_TRIAL_FEATURES.split(",")]
    history = spark.read.parquet(f"{folder}/site_history")
    assert history.columns == [f.split()[0] for f in schemas.GOLD_SITE_HISTORY.split(",")]


def test_tasks_follow_the_input(spark):
    """Sites are dealt out by trial in as many tasks as the inputs fill; inputs of unknown size are left alone."""
    t, s = shapes.trials(spark, SF), shapes.sites(spark, SF)
    counts = [gold.by_trial(s, t, task_bytes).rdd.getNumPartitions() for task_bytes in (20_000, 10_000)]
    assert 4 < counts[0] < counts[1] <= 2 * counts[0] + 1
    assert gold.by_trial(s, t) is s
    assert rows(gold.by_trial(s, t, 20_000)) == rows(s)


def test_lines_stay_while_places_are_small(spark):
    assert "Exchange hashpartitioning" not in shapes.sites(spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_as_of_joins_sites_with_trials_once(world, monkeypatch):
    t, s = world
    plans, totals = [], gold.running_totals

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return totals(df, *args)

    monkeypatch.setattr(gold, "running_totals", seen)
    gold.as_of_stats(s, t)
    assert plans[0].count("Join Inner") == 1
