"""Dimension tables and the lists a dashboard offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrual.functions.text import clean_name


def dimension_from_lists(df: DataFrame, structs: str, id_field: str, name_field: str) -> DataFrame:
    """Distinct (mesh_condition_id, mesh_condition_name) pairs found in a list of structs."""
    return (
        df.select(F.explode(structs).alias("item"))
        .select(
            F.col(f"item.{id_field}").alias("mesh_condition_id"),
            F.col(f"item.{name_field}").alias("mesh_condition_name"),
        )
        .distinct()
    )


def one_name_per_id(pairs: DataFrame) -> DataFrame:
    """One row per id: the smallest name. Pairs without an id or a name drop out."""
    return (
        pairs.dropna(subset=["mesh_condition_id", "mesh_condition_name"])
        .groupBy("mesh_condition_id")
        .agg(F.min("mesh_condition_name").alias("mesh_condition_name"))
    )


def condition_totals(site_conditions: DataFrame, dim: DataFrame) -> DataFrame:
    """Trials per condition over all sites, most frequent first.

    Sums per id first, so one row per id meets the dimension.
    """
    totals = site_conditions.groupBy("mesh_condition_id").agg(
        F.sum("n_trials_for_condition").alias("count")
    )
    return (
        totals.join(dim, "mesh_condition_id")
        .select(
            F.col("mesh_condition_id").alias("condition_id"),
            F.col("mesh_condition_name").alias("condition_name"),
            "count",
        )
        .orderBy(F.col("count").desc(), "condition_id", "condition_name")
    )


def condition_list(totals: DataFrame) -> DataFrame:
    """(condition_id, condition_name) pairs in name order."""
    return (
        totals.select("condition_id", "condition_name")
        .distinct()
        .orderBy("condition_name", "condition_id")
    )


def parameter_lists(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): the sorted distinct non-NULL values of each column.

    Distinct combinations first, so the unpivot works on the few that exist.
    """
    combos = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).distinct()
    return (
        combos.unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("column", "value")
    )


def places(site_history: DataFrame) -> DataFrame:
    """Distinct (country, city) pairs without NULLs."""
    return site_history.select("country", "city").dropna().distinct()


def country_list(pairs: DataFrame) -> DataFrame:
    return pairs.select("country").distinct().orderBy("country")


def city_list(pairs: DataFrame) -> DataFrame:
    """City names that look like place names, sorted."""
    return pairs.select("city").filter(clean_name("city")).distinct().orderBy("city")


def name_to_id(names: DataFrame, dim: DataFrame, name: str, dim_name: str, dim_id: str):
    """``names`` with the smallest id of each name; NULL where the dimension lacks it."""
    wanted = dim.groupBy(F.col(dim_name).alias(name)).agg(F.min(dim_id).alias(dim_id))
    return names.join(wanted, name, "left")


def within_places(
    sites: DataFrame,
    countries: list[str] | None = None,
    cities: list[str] | None = None,
    chosen: DataFrame | None = None,
) -> DataFrame:
    """Sites in any of the chosen countries or cities.

    A choice made by hand is an IN list, which reaches the scan as a filter; a longer one comes
    as ``chosen`` and is a semi join. Its rows name a ``country`` or a ``city``, or both where it
    has both columns: a site is in such a place if it is in both, and a NULL part does not matter.
    """
    if chosen is not None:
        keys = [c for c in ("country", "city") if c in chosen.columns]
        if not keys:
            raise ValueError("chosen needs a column country or city")
        if len(keys) == 1:
            return sites.join(chosen.select(*keys), keys, "left_semi")
        # One equi-join for each combination of named parts; a site is kept by any of them.
        country, city = F.col("country").isNotNull(), F.col("city").isNotNull()
        parts = [(country & city, keys), (country & ~city, ["country"]), (~country & city, ["city"])]
        marked = sites
        for i, (shape, on) in enumerate(parts):
            wanted = chosen.filter(shape).select(*on).distinct().withColumn(f"_in{i}", F.lit(True))
            marked = marked.join(wanted, on, "left")
        found = F.coalesce(*[F.col(f"_in{i}") for i in range(len(parts))])
        return marked.filter(found).select(*sites.columns)
    tests = [F.col(c).isin(v) for c, v in (("country", countries), ("city", cities)) if v is not None]
    if not tests:
        raise ValueError("name countries, cities or a frame of them")
    return sites.filter(tests[0] | tests[1] if len(tests) == 2 else tests[0])
