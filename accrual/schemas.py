"""Declared shapes of the registry documents and of the layers built from them."""

from __future__ import annotations

# One study document, as far as the trial and site tables need it.
STUDY = """
protocolSection struct<
  identificationModule: struct<nctId: string, briefTitle: string>,
  descriptionModule: struct<briefSummary: string>,
  designModule: struct<
    studyType: string,
    phases: array<string>,
    designInfo: struct<primaryPurpose: string>,
    enrollmentInfo: struct<count: int>>,
  statusModule: struct<
    overallStatus: string,
    startDateStruct: struct<date: string>,
    primaryCompletionDateStruct: struct<date: string, type: string>,
    lastUpdatePostDateStruct: struct<date: string>>,
  sponsorCollaboratorsModule: struct<leadSponsor: struct<name: string, class: string>>,
  eligibilityModule: struct<sex: string, minimumAge: string, maximumAge: string>,
  conditionsModule: struct<conditions: array<string>>,
  contactsLocationsModule: struct<locations: array<struct<
    facility: string, city: string, state: string, zip: string, country: string,
    geoPoint: struct<lat: double, lon: double>>>>>,
derivedSection struct<
  conditionBrowseModule: struct<meshes: array<struct<id: string, term: string>>>>
"""

# The wider document read by the sample profile.
STUDY_PROFILE = """
protocolSection struct<
  identificationModule: struct<nctId: string, briefTitle: string, officialTitle: string>,
  statusModule: struct<
    overallStatus: string,
    statusVerifiedDate: string,
    whyStopped: string,
    startDateStruct: struct<date: string, type: string>,
    primaryCompletionDateStruct: struct<date: string, type: string>,
    completionDateStruct: struct<date: string, type: string>,
    studyFirstPostDateStruct: struct<date: string>,
    lastUpdatePostDateStruct: struct<date: string>>,
  sponsorCollaboratorsModule: struct<
    leadSponsor: struct<name: string, class: string>,
    collaborators: array<struct<name: string>>>,
  conditionsModule: struct<conditions: array<string>, keywords: array<string>>,
  designModule: struct<
    studyType: string,
    phases: array<string>,
    designInfo: struct<
      allocation: string, interventionModel: string, maskingInfo: struct<masking: string>>,
    enrollmentInfo: struct<count: int, type: string>>,
  eligibilityModule: struct<
    eligibilityCriteria: string, minimumAge: string, maximumAge: string, sex: string,
    healthyVolunteers: boolean, stdAges: array<string>>,
  armsInterventionsModule: struct<interventions: array<struct<type: string>>>,
  oversightModule: struct<
    oversightHasDmc: boolean, isFdaRegulatedDrug: boolean, isFdaRegulatedDevice: boolean>,
  contactsLocationsModule: struct<locations: array<struct<
    facility: string, status: string, country: string,
    geoPoint: struct<lat: double, lon: double>>>>>,
derivedSection struct<
  conditionBrowseModule: struct<meshes: array<struct<id: string, term: string>>>>
"""

# Column contract of a keyed topic read, from Kafka or from files.
TOPIC = "key string, value string, timestamp timestamp, partition int, offset bigint"

BRONZE_RAW = (
    "nct_id string, payload_hash string, received_at timestamp, updated_at timestamp, payload string"
)

SILVER_TRIALS = """
nct_id string, brief_title string, brief_summary string, study_type string,
primary_purpose string, overall_status string, lead_sponsor_class string, phase string,
enrollment_count int, start_date date, primary_completion_date date, sex string,
minimum_age_years double, maximum_age_years double, enrollment_duration_months double,
trial_velocity double, mesh_conditions_ids array<string>, has_non_diagnostic_condition boolean
"""

SILVER_SITES = """
nct_id string, facility_name string, city string, state string, zip string, country string,
latitude double, longitude double, mesh_conditions_ids array<string>
"""

GOLD_DIM_CONDITIONS = "mesh_condition_id string, mesh_condition_name string"

GOLD_SITE_HISTORY = """
country string, city string, zip string, facility_name string, state string,
latitude double, longitude double, n_trials bigint, avg_velocity double, last_year int
"""

GOLD_TRIAL_FEATURES = """
nct_id string, study_type string, primary_purpose string, lead_sponsor_class string, sex string,
phase string, enrollment_count int, n_sites int, duration_months double,
mesh_conditions_ids array<string>, has_non_diagnostic_condition boolean,
avg_site_exp double, avg_site_vel double, target_velocity double
"""

GOLD_SITE_CONDITIONS = (
    "country string, city string, zip string, mesh_condition_id string, n_trials_for_condition bigint"
)

AREA_MAP = "area string, mesh_id string"

PLANS = """
plan_id string, study_type string, primary_purpose string, phase string, enrollment_count int,
lead_sponsor_class string, sex string, n_sites int, areas array<string>,
conditions array<string>, has_non_diagnostic_condition boolean
"""
