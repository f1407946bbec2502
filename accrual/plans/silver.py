"""Raw study documents to trial, site and condition tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual import schemas
from accrual.functions import (
    NON_DIAGNOSTIC_TERMS,
    age_years,
    any_term,
    duration_months,
    field_list,
    first_element,
    has_date,
    partial_date,
    recruitment_velocity,
)
from accrual.operators.dims import dimension_from_lists, one_name_per_id
from accrual.operators.latest import latest_per_key
from accrual.sources.tables import refresh_table, stamped
from accrual.sources.topics import CORRUPT, decode_json

# Fill-ins for missing text and the velocity above which a trial is an outlier.
SITE_DEFAULTS = {
    "facility_name": "UNKNOWN FACILITY",
    "city": "UNKNOWN CITY",
    "state": "N/A",
    "zip": "N/A",
    "country": "UNKNOWN",
    "latitude": 0.0,
    "longitude": 0.0,
}
VELOCITY_CAP = 150.0

TRIAL_COLUMNS = [
    "nct_id",
    "brief_title",
    "brief_summary",
    "study_type",
    "primary_purpose",
    "overall_status",
    "lead_sponsor_class",
    "phase",
    "enrollment_count",
    "start_date",
    "primary_completion_date",
    "sex",
    "minimum_age_years",
    "maximum_age_years",
    "enrollment_duration_months",
    "trial_velocity",
    "mesh_conditions_ids",
    "has_non_diagnostic_condition",
]

NEWEST_FIRST = ["timestamp", "partition", "offset", "payload_hash"]


def flatten_studies(decoded: DataFrame) -> DataFrame:
    """Decoded documents (``data`` plus topic columns) as flat columns; no id, no row."""
    study = F.col("data.protocolSection")
    design, status = study["designModule"], study["statusModule"]
    eligibility = study["eligibilityModule"]
    return decoded.select(
        study["identificationModule"]["nctId"].alias("nct_id"),
        study["identificationModule"]["briefTitle"].alias("brief_title"),
        study["descriptionModule"]["briefSummary"].alias("brief_summary"),
        design["studyType"].alias("study_type"),
        design["designInfo"]["primaryPurpose"].alias("primary_purpose"),
        status["overallStatus"].alias("overall_status"),
        study["sponsorCollaboratorsModule"]["leadSponsor"]["class"].alias("lead_sponsor_class"),
        first_element(design["phases"]).alias("phase"),
        design["enrollmentInfo"]["count"].alias("enrollment_count"),
        status["startDateStruct"]["date"].alias("start_text"),
        status["primaryCompletionDateStruct"]["date"].alias("completion_text"),
        eligibility["sex"].alias("sex"),
        eligibility["minimumAge"].alias("minimum_age_text"),
        eligibility["maximumAge"].alias("maximum_age_text"),
        study["conditionsModule"]["conditions"].alias("conditions"),
        study["contactsLocationsModule"]["locations"].alias("locations"),
        F.col("data.derivedSection.conditionBrowseModule.meshes").alias("meshes"),
        *[c for c in ("timestamp", "partition", "offset") if c in decoded.columns],
        F.sha2("value", 256).alias("payload_hash"),
    ).filter(F.col("nct_id").isNotNull())


# Where the flat columns stand in a document.
PATHS = {
    "brief_title": ("$.protocolSection.identificationModule.briefTitle", "string"),
    "brief_summary": ("$.protocolSection.descriptionModule.briefSummary", "string"),
    "study_type": ("$.protocolSection.designModule.studyType", "string"),
    "primary_purpose": ("$.protocolSection.designModule.designInfo.primaryPurpose", "string"),
    "overall_status": ("$.protocolSection.statusModule.overallStatus", "string"),
    "lead_sponsor_class": ("$.protocolSection.sponsorCollaboratorsModule.leadSponsor.class", "string"),
    "phase": ("$.protocolSection.designModule.phases[0]", "string"),
    "enrollment_count": ("$.protocolSection.designModule.enrollmentInfo.count", "int"),
    "start_text": ("$.protocolSection.statusModule.startDateStruct.date", "string"),
    "completion_text": ("$.protocolSection.statusModule.primaryCompletionDateStruct.date", "string"),
    "sex": ("$.protocolSection.eligibilityModule.sex", "string"),
    "minimum_age_text": ("$.protocolSection.eligibilityModule.minimumAge", "string"),
    "maximum_age_text": ("$.protocolSection.eligibilityModule.maximumAge", "string"),
    "conditions": ("$.protocolSection.conditionsModule.conditions", "array<string>"),
    "locations": (
        "$.protocolSection.contactsLocationsModule.locations",
        "array<struct<facility: string, city: string, state: string, zip: string, country: string, "
        "geoPoint: struct<lat: double, lon: double>>>",
    ),
    "meshes": (
        "$.derivedSection.conditionBrowseModule.meshes",
        "array<struct<id: string, term: string>>",
    ),
}


def flatten_landed(landed: DataFrame) -> DataFrame:
    """The columns of ``flatten_studies`` from documents landed as VARIANT (``land_variants``).

    Fields are read by path from the parsed form. One of a type that cannot be converted is NULL.
    """
    fields = [F.try_variant_get("doc", path, kind).alias(name) for name, (path, kind) in PATHS.items()]
    return landed.select("nct_id", *fields, "timestamp", "partition", "offset", "payload_hash")


def derive_trials(
    flat: DataFrame,
    terms: list[str] = NON_DIAGNOSTIC_TERMS,
    whole_word: bool = False,
    age_mode: str = "lenient",
    unknown_unit: str = "digits",
) -> DataFrame:
    """Dates, ages, duration, velocity, condition flag and ids for every flat document."""
    return (
        flat.withColumn("start_date", partial_date("start_text"))
        .withColumn("primary_completion_date", partial_date("completion_text"))
        .withColumn(
            "enrollment_duration_months", duration_months("start_date", "primary_completion_date")
        )
        .withColumn(
            "trial_velocity",
            recruitment_velocity("enrollment_count", "enrollment_duration_months"),
        )
        .withColumn("minimum_age_years", age_years("minimum_age_text", age_mode, unknown_unit))
        .withColumn("maximum_age_years", age_years("maximum_age_text", age_mode, unknown_unit))
        .withColumn("has_non_diagnostic_condition", any_term("conditions", terms, whole_word))
        .withColumn("mesh_conditions_ids", field_list("meshes", "id"))
    )


def is_eligible(sentinel_compat: bool = True, velocity_cap: float = VELOCITY_CAP) -> Column:
    """Whether a derived trial enters the silver layer.

    Both dates known and in order, somebody enrolled, the type known, a phase unless the study
    is observational, and the velocity under the cap. Never NULL.
    """
    phase_ok = (F.col("study_type") == "OBSERVATIONAL") | (
        F.coalesce("phase", F.lit("UNKNOWN")) != "UNKNOWN"
    )
    test = (
        has_date("start_date", sentinel_compat)
        & has_date("primary_completion_date", sentinel_compat)
        & (F.datediff("primary_completion_date", "start_date") > 0)
        & (F.col("enrollment_count") > 0)
        & F.col("study_type").isNotNull()
        & phase_ok
        & (F.col("trial_velocity") < velocity_cap)
    )
    return F.coalesce(test, F.lit(False))


def clean_studies(
    topic: DataFrame, sentinel_compat: bool = True, keep_version: bool = False, **derive
) -> DataFrame:
    """Topic rows to the newest eligible version of each study, with sites and ids still nested.

    ``keep_version`` adds the arrival time of that version as ``version``.
    """
    flat = flatten_studies(decode_json(topic, schemas.STUDY))
    return newest_eligible(flat, sentinel_compat, keep_version, **derive)


def clean_landed(
    landed: DataFrame, sentinel_compat: bool = True, keep_version: bool = False, **derive
) -> DataFrame:
    """``clean_studies`` of documents that were landed as VARIANT, without parsing them again."""
    return newest_eligible(flatten_landed(landed), sentinel_compat, keep_version, **derive)


def newest_eligible(
    flat: DataFrame, sentinel_compat: bool = True, keep_version: bool = False, **derive
) -> DataFrame:
    """Flat documents to the newest eligible version of each study.

    Everything that depends on one document alone happens before the shuffle by id. A version
    that is not eligible only has to outrank older ones, so its wide columns are dropped first
    and the shuffle carries its key and order alone.
    """
    derived = derive_trials(flat, **derive)
    order = [c for c in NEWEST_FIRST if c in derived.columns]
    kept = [c for c in [*TRIAL_COLUMNS[1:], "locations", "meshes"]]
    flagged = derived.withColumn("_eligible", is_eligible(sentinel_compat)).select(
        "nct_id",
        *[F.when(F.col("_eligible"), F.col(c)).alias(c) for c in kept],
        "_eligible",
        *order,
    )
    newest = latest_per_key(flagged, ["nct_id"], [F.col(c).desc() for c in order])
    return (
        newest.filter("_eligible")
        .withColumn("phase", F.coalesce("phase", F.lit("UNKNOWN")))
        .withColumn("sex", F.coalesce("sex", F.lit("ALL")))
        .select(
            *TRIAL_COLUMNS,
            "locations",
            "meshes",
            *([F.col("timestamp").alias("version")] if keep_version else []),
        )
    )


def doubtful_studies(topic: DataFrame) -> DataFrame:
    """Topic rows that ``clean_studies`` cannot use, or uses without a field of the wrong type."""
    decoded = decode_json(topic, schemas.STUDY)
    study = F.col("data.protocolSection.identificationModule.nctId")
    reason = (
        F.when(F.col("data").isNull(), "undecodable")
        .when(study.isNull(), "missing id")
        .when(F.col(CORRUPT).isNotNull(), "field of the wrong type")
    )
    kept = decoded.select(*topic.columns, reason.alias("reason"))
    return kept.filter(F.col("reason").isNotNull())


def trials_table(studies: DataFrame) -> DataFrame:
    """One row per trial."""
    return studies.select(*TRIAL_COLUMNS)


def sites_table(studies: DataFrame, keep_ordinal: bool = False) -> DataFrame:
    """One row per listed location, missing parts filled in; no locations, no rows.

    ``keep_ordinal`` adds the location's place in its list and the study's version, if kept: the
    child key of replacement loads.
    """
    extra = [c for c in ("version",) if keep_ordinal and c in studies.columns]
    placed = studies.select(
        "nct_id",
        "mesh_conditions_ids",
        *extra,
        F.posexplode("locations").alias("site_ordinal", "loc"),
    )
    raw = {
        "facility_name": F.col("loc.facility"),
        "city": F.col("loc.city"),
        "state": F.col("loc.state"),
        "zip": F.col("loc.zip"),
        "country": F.col("loc.country"),
        "latitude": F.col("loc.geoPoint.lat"),
        "longitude": F.col("loc.geoPoint.lon"),
    }
    return placed.select(
        "nct_id",
        *[F.coalesce(value, F.lit(SITE_DEFAULTS[name])).alias(name) for name, value in raw.items()],
        "mesh_conditions_ids",
        *(["site_ordinal", *extra] if keep_ordinal else []),
    )


def conditions_table(studies: DataFrame) -> DataFrame:
    """One name per condition id."""
    return one_name_per_id(dimension_from_lists(studies, "meshes", "id", "term"))


def write_silver(topic: DataFrame, folder: str, **options) -> None:
    """Write the silver layer below ``folder``.

    Documents that cannot be decoded or have no id go to ``quarantine``; those that only lost a field
    of the wrong type are used, and noted there as well.

    The cleaned documents are written once and the three tables read them back, so nothing is
    decoded twice and a lost executor costs only its own tasks.
    """
    spark = topic.sparkSession
    refresh_table(doubtful_studies(topic), f"{folder}/quarantine")
    refresh_table(clean_studies(topic, **options), f"{folder}/studies")
    studies = spark.read.parquet(f"{folder}/studies")
    refresh_table(stamped(trials_table(studies)), f"{folder}/trials")
    refresh_table(stamped(sites_table(studies)), f"{folder}/trial_sites")
    refresh_table(conditions_table(studies), f"{folder}/dim_mesh_conditions")
