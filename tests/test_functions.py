import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from accrual.functions import (
    age_years,
    any_term,
    clean_name,
    count_where,
    distinct_count,
    duration_months,
    first_element,
    flag_int,
    has_date,
    is_usable_facility,
    list_size,
    log_target,
    nan_to_null,
    partial_date,
    percent,
    pipe_joined,
    real_units,
    recruitment_velocity,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2020", datetime.date(2020, 1, 1)),
        ("2020-05", datetime.date(2020, 5, 1)),
        ("2020-05-17", datetime.date(2020, 5, 17)),
        ("2020-13", None),
        ("abcd", None),
        (None, None),
        ("", None),
    ],
)
def test_partial_date(spark, text, expected):
    assert one(spark, partial_date(F.lit(text).cast("string"))) == expected
    assert one(spark, partial_date(F.lit(text).cast("string"), strict=True)) == expected


def test_strict_date_trims_and_rejects_other_shapes(spark):
    assert one(spark, partial_date(F.lit(" 2020-05 "), strict=True)) == datetime.date(2020, 5, 1)
    assert one(spark, partial_date(F.lit("2020-5-7"), strict=True)) is None


def test_placeholder_date(spark):
    placeholder = partial_date(F.lit("1970"))
    assert one(spark, has_date(placeholder)) is False
    assert one(spark, has_date(placeholder, sentinel_compat=False)) is True
    assert one(spark, has_date(F.lit(None).cast("date"))) is False


@pytest.mark.parametrize(
    "text, expected",
    [
        ("18 Years", 18.0),
        ("6 Months", 0.5),
        ("2 Weeks", 2 / 52.17),
        ("30 Days", 30 / 365.25),
        ("N/A", None),
        ("12 Hours", 12.0),
        ("x years", None),
        (None, None),
    ],
)
def test_age_years(spark, text, expected):
    got = one(spark, age_years(F.lit(text).cast("string")))
    assert got == (None if expected is None else pytest.approx(expected))


def test_age_variants(spark):
    assert one(spark, age_years(F.lit("12 Hours"), unknown_unit="null")) is None
    assert one(spark, age_years(F.lit("6 months"), mode="strict")) == 0.5
    assert one(spark, age_years(F.lit("2 Weeks"), mode="strict")) == round(14 / 365, 4)
    assert one(spark, age_years(F.lit("about 6 months"), mode="strict")) is None
    with pytest.raises(ValueError):
        age_years(F.lit("1 year"), mode="other")
    with pytest.raises(ValueError):
        age_years(F.lit("1 year"), unknown_unit="other")


@pytest.mark.parametrize(
    "texts, anywhere, as_word",
    [
        (["Imaging"], True, False),
        (["healthy volunteer"], True, True),
        (["Asthma", "PREGNANCY"], True, True),
        (["Asthma"], False, False),
        ([None], False, False),
        ([], False, False),
        (None, False, False),
    ],
)
def test_any_term(spark, texts, anywhere, as_word):
    df = spark.createDataFrame([(texts,)], "c array<string>")
    assert df.select(any_term("c")).first()[0] is anywhere
    assert df.select(any_term("c", whole_word=True)).first()[0] is as_word


def test_terms_are_literal_text(spark):
    df = spark.createDataFrame([(["a.b"],), (["axb"],)], "c array<string>")
    assert rows(df.select(any_term("c", ["A.B"]))) == [(False,), (True,)]


@pytest.mark.parametrize(
    "name, usable",
    [("Clinic", True), ("  ", False), ("unknown facility ", False), (None, False)],
)
def test_usable_facility(spark, name, usable):
    df = spark.createDataFrame([(name,)], "n string")
    assert bool(df.select(is_usable_facility("n")).first()[0]) is usable


def test_clean_name(spark):
    names = [("Rome",), ("Rome 2",), ("'s-Hertogenbosch",), ("Rome (IT)",), ("Rome?",), (None,)]
    df = spark.createDataFrame(names, "n string").filter(clean_name("n"))
    assert rows(df) == [("Rome",)]


def test_velocity(spark):
    start, end = F.lit("2020-01-01").cast("date"), F.lit("2020-03-01").cast("date")
    assert one(spark, duration_months(start, end)) == 1.97
    assert one(spark, recruitment_velocity(F.lit(10), F.lit(1.97))) == 5.0761
    assert one(spark, recruitment_velocity(F.lit(10), F.lit(0.0))) is None


def test_lists(spark):
    df = spark.createDataFrame(
        [(["a", "", "a", None],), ([],), (None,)], "c array<string>"
    )
    assert rows(df.select(list_size("c"))) == [(0,), (0,), (4,)]
    assert rows(df.select(distinct_count("c"))) == [(0,), (0,), (1,)]
    assert rows(df.select(count_where("c", lambda x: x == "a"))) == [(0,), (0,), (2,)]
    assert rows(df.select(first_element("c"))) == sorted([("a",), (None,), (None,)], key=repr)
    assert rows(df.select(pipe_joined("c"))) == [("",), ("",), ("a||a",)]


def test_numbers(spark):
    assert one(spark, flag_int(F.lit(None).cast("boolean"))) == 0
    assert one(spark, flag_int(F.lit(True))) == 1
    assert one(spark, nan_to_null(F.lit(float("nan")))) is None
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, real_units(log_target(F.lit(7.5)))) == pytest.approx(7.5)
