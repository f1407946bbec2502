"""Exports and reports over the gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrual.functions import non_empty
from accrual.operators import dims, values
from accrual.operators.profiles import coverage, list_length_stats, numeric_profile, table_profile
from accrual.sources.tables import export_csv

# File and column of each parameter list, and the report's list lengths.
PARAMETER_FILES = {
    "study_types": "study_type",
    "purposes": "primary_purpose",
    "sponsors": "lead_sponsor_class",
    "sexes": "sex",
    "phases": "phase",
}
TOP_VALUES = 40
SAMPLE_ROWS = 20
TARGET = "target_velocity"


def write_dashboard(
    features: DataFrame,
    history: DataFrame,
    site_conditions: DataFrame,
    dim: DataFrame,
    folder: str,
) -> None:
    """The CSV lists a dashboard offers: conditions, parameters, places and sites."""
    totals = dims.condition_totals(site_conditions, dim)
    export_csv(totals, f"{folder}/cond_count")
    export_csv(dims.condition_list(totals), f"{folder}/conditions")
    lists = dims.parameter_lists(features, list(PARAMETER_FILES.values())).persist()
    for name, column in PARAMETER_FILES.items():
        chosen = lists.filter(F.col("column") == column).select(F.col("value").alias(column))
        export_csv(chosen, f"{folder}/{name}", order_by=[column])
    lists.unpersist()
    pairs = dims.places(history)
    export_csv(dims.country_list(pairs), f"{folder}/countries")
    export_csv(dims.city_list(pairs), f"{folder}/cities")
    sites = history.select(
        "country",
        "city",
        "state",
        "zip",
        F.col("facility_name").alias("site"),
        "n_trials",
        "avg_velocity",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )
    export_csv(sites, f"{folder}/site_history")


def conditions_report(
    documents: DataFrame, features: DataFrame, dim: DataFrame
) -> dict[str, DataFrame]:
    """How conditions are written and coded, as named tables.

    ``documents`` holds one row per study: ``nct_id``, ``conditions`` (texts) and ``meshes``
    (coded conditions).
    """
    checks = coverage(documents, {"coded": (non_empty("meshes"), None)}).unionByName(
        coverage(features, {"coded features": (non_empty("mesh_conditions_ids"), None)})
    )
    spelled = documents.select(F.explode("conditions").alias("value"))
    feature_lists = features.select(
        F.when(F.size("mesh_conditions_ids") > 0, F.col("mesh_conditions_ids")).alias(
            "mesh_conditions_ids"
        )
    )
    return {
        "coverage": checks,
        "distinct_conditions": values.distinct_list_values(documents, "conditions"),
        "list_lengths": list_length_stats(documents, ["conditions", "meshes"]),
        "feature_list_lengths": list_length_stats(feature_lists, ["mesh_conditions_ids"]),
        "top_conditions": values.top_list_values(documents, "conditions", TOP_VALUES),
        "top_uncoded": values.top_list_values(
            documents, "conditions", TOP_VALUES, lacking="meshes"
        ),
        "top_coded": values.top_dimension_values(
            features,
            "mesh_conditions_ids",
            dim,
            "mesh_condition_id",
            "mesh_condition_name",
            TOP_VALUES,
        ),
        "dimension_size": dim.agg(F.count("*").alias("n")),
        "case_variants": values.case_variants(spelled, "value"),
        "condition_sample": values.sample_rows(documents, "conditions", SAMPLE_ROWS, ["nct_id"]),
        "coded_sample": values.sample_rows(documents, "meshes", SAMPLE_ROWS, ["nct_id"]),
    }


def gold_report(features: DataFrame, history: DataFrame) -> dict[str, DataFrame]:
    """Profiles of both gold tables, the target's summary, row counts and all flags raised."""
    profile = table_profile(features, "trial_features").unionByName(
        table_profile(history, "site_history")
    )
    counts = features.agg(F.count("*").alias("n")).select(
        F.lit("trial_features").alias("table"), "n"
    )
    return {
        "profile": profile,
        "row_counts": counts.unionByName(
            history.agg(F.count("*").alias("n")).select(F.lit("site_history").alias("table"), "n")
        ),
        "target": numeric_profile(features, [TARGET]),
        "flags": profile.filter((F.col("metric") == "flags") & (F.col("value") != "")).select(
            "table", "column", F.col("value").alias("flags")
        ),
    }
