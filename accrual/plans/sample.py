"""Per-document metrics and the report over a set of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrual.functions import count_where, distinct_count, field_list, list_size, non_empty
from accrual.operators.order_stats import nearest_rank_quantiles
from accrual.operators.profiles import coverage, missing_rates, outlier_share, sum_ratios
from accrual.operators.values import value_shares

# Statuses of studies that ended early, and what the report looks at.
STOPPED = ["TERMINATED", "WITHDRAWN", "SUSPENDED"]
MISSING_FIELDS = [
    "overall_status",
    "status_verified_date",
    "why_stopped",
    "start_date",
    "primary_completion_date",
    "completion_date",
    "lead_sponsor_name",
    "lead_sponsor_class",
    "study_type",
    "allocation",
    "intervention_model",
    "masking",
    "enrollment_count",
    "enrollment_type",
    "criteria_length",
    "minimum_age",
    "maximum_age",
    "sex",
    "healthy_volunteers",
    "has_dmc",
    "is_fda_regulated_drug",
    "is_fda_regulated_device",
]
ENROLLMENT_QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99, "max": 1.0}
LARGE_ENROLLMENT = 10_000
SHARE_FIELDS = [
    "overall_status",
    "lead_sponsor_class",
    "study_type",
    "sex",
    "start_date_type",
    "enrollment_type",
]


def study_metrics(decoded: DataFrame) -> DataFrame:
    """One flat row per document decoded with ``schemas.STUDY_PROFILE``: its fields and the sizes
    of its lists."""
    study = F.col("data.protocolSection")
    ident, status = study["identificationModule"], study["statusModule"]
    sponsor, design = study["sponsorCollaboratorsModule"], study["designModule"]
    conditions, eligibility = study["conditionsModule"], study["eligibilityModule"]
    oversight = study["oversightModule"]
    interventions = study["armsInterventionsModule"]["interventions"]
    locations = study["contactsLocationsModule"]["locations"]
    meshes = F.col("data.derivedSection.conditionBrowseModule.meshes")
    types = F.filter(field_list(interventions, "type"), lambda t: F.coalesce(t != "", F.lit(False)))
    return decoded.select(
        ident["nctId"].alias("nct_id"),
        ident["briefTitle"].alias("brief_title"),
        ident["officialTitle"].alias("official_title"),
        status["overallStatus"].alias("overall_status"),
        status["statusVerifiedDate"].alias("status_verified_date"),
        status["whyStopped"].alias("why_stopped"),
        status["startDateStruct"]["date"].alias("start_date"),
        status["startDateStruct"]["type"].alias("start_date_type"),
        status["primaryCompletionDateStruct"]["date"].alias("primary_completion_date"),
        status["primaryCompletionDateStruct"]["type"].alias("primary_completion_date_type"),
        status["completionDateStruct"]["date"].alias("completion_date"),
        status["completionDateStruct"]["type"].alias("completion_date_type"),
        status["studyFirstPostDateStruct"]["date"].alias("first_post_date"),
        status["lastUpdatePostDateStruct"]["date"].alias("last_update_date"),
        sponsor["leadSponsor"]["name"].alias("lead_sponsor_name"),
        sponsor["leadSponsor"]["class"].alias("lead_sponsor_class"),
        list_size(sponsor["collaborators"]).alias("n_collaborators"),
        list_size(conditions["conditions"]).alias("n_conditions"),
        list_size(conditions["keywords"]).alias("n_keywords"),
        list_size(meshes).alias("n_mesh_terms"),
        non_empty(meshes).alias("has_mesh"),
        design["studyType"].alias("study_type"),
        design["phases"].alias("phases"),
        design["designInfo"]["allocation"].alias("allocation"),
        design["designInfo"]["interventionModel"].alias("intervention_model"),
        design["designInfo"]["maskingInfo"]["masking"].alias("masking"),
        design["enrollmentInfo"]["count"].alias("enrollment_count"),
        design["enrollmentInfo"]["type"].alias("enrollment_type"),
        F.coalesce(F.length(eligibility["eligibilityCriteria"]), F.lit(0)).alias(
            "criteria_length"
        ),
        eligibility["minimumAge"].alias("minimum_age"),
        eligibility["maximumAge"].alias("maximum_age"),
        eligibility["sex"].alias("sex"),
        eligibility["healthyVolunteers"].alias("healthy_volunteers"),
        eligibility["stdAges"].alias("std_ages"),
        list_size(interventions).alias("n_interventions"),
        types.alias("intervention_types"),
        oversight["oversightHasDmc"].alias("has_dmc"),
        oversight["isFdaRegulatedDrug"].alias("is_fda_regulated_drug"),
        oversight["isFdaRegulatedDevice"].alias("is_fda_regulated_device"),
        list_size(locations).alias("n_sites"),
        distinct_count(field_list(locations, "country")).alias("n_countries"),
        count_where(locations, lambda site: site["status"] != "").alias("sites_with_status"),
        count_where(locations, lambda site: site["geoPoint"]["lat"].isNotNull()).alias(
            "sites_with_geo"
        ),
    )


def coverage_report(metrics: DataFrame) -> DataFrame:
    """(check, part, whole, pct): documents with condition ids, stopped ones with a reason, sites
    with a status, sites with coordinates."""
    documents = coverage(
        metrics,
        {
            "mesh terms": (F.col("has_mesh"), None),
            "stop reason": (F.col("why_stopped") != "", F.col("overall_status").isin(STOPPED)),
        },
    )
    sites = sum_ratios(
        metrics,
        {
            "site status": ("sites_with_status", "n_sites"),
            "site geo point": ("sites_with_geo", "n_sites"),
        },
    ).withColumnRenamed("ratio", "check")
    return documents.unionByName(sites.drop("mean_part"))


def missing_report(metrics: DataFrame) -> DataFrame:
    """(column, row_count, missing, missing_pct) of the checked fields."""
    return missing_rates(metrics, MISSING_FIELDS)


def share_report(metrics: DataFrame) -> DataFrame:
    """(column, value, n, pct) of the distributed fields, most frequent first."""
    return value_shares(metrics, SHARE_FIELDS).orderBy("column", F.col("n").desc(), "value")


def enrollment_report(metrics: DataFrame) -> DataFrame:
    """(name, amount): nearest-rank quantiles of the enrolment and the mean number of sites."""
    quantiles = nearest_rank_quantiles(metrics, ["enrollment_count"], ENROLLMENT_QUANTILES)
    rows = quantiles.unpivot(["column"], list(ENROLLMENT_QUANTILES), "name", "amount")
    sites = metrics.agg(F.avg("n_sites").alias("amount"))
    return rows.select("name", "amount").unionByName(
        sites.select(F.lit("sites per trial").alias("name"), "amount")
    )


def sample_report(metrics: DataFrame) -> DataFrame:
    """Everything the report over a set of documents says, as one table.

    ``report`` is ``coverage``, ``missing``, ``share`` or ``enrollment``; ``name`` the check or field and
    ``value`` the field's value for shares. ``part`` of ``whole`` rows with their ``pct``, or an
    ``amount``. ``metrics`` is read several times, so it should be stored.
    """
    total = metrics.agg(F.count("*")).first()[0]
    outliers = outlier_share(metrics, "enrollment_count", LARGE_ENROLLMENT)
    parts = {
        "coverage": coverage_report(metrics).select(F.col("check").alias("name"), "part", "whole", "pct"),
        "missing": missing_report(metrics).select(
            F.col("column").alias("name"),
            F.col("missing").alias("part"),
            F.col("row_count").alias("whole"),
            F.col("missing_pct").alias("pct"),
        ),
        "share": value_shares(metrics, SHARE_FIELDS).select(
            F.col("column").alias("name"),
            "value",
            F.col("n").alias("part"),
            F.lit(total).cast("bigint").alias("whole"),
            "pct",
        ),
        "enrollment": enrollment_report(metrics).unionByName(
            outliers.select(
                F.lit("large").alias("name"),
                F.col("outliers").alias("part"),
                F.col("n").alias("whole"),
                F.col("outlier_pct").alias("pct"),
            ),
            allowMissingColumns=True,
        ),
    }
    found = None
    for report, rows in parts.items():
        rows = rows.withColumn("report", F.lit(report))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found.select("report", "name", "value", "part", "whole", "pct", "amount")
