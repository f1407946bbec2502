import datetime
import json

import pytest
from conftest import rows

from accrual import schemas
from accrual.plans import silver
from accrual.sources.topics import CORRUPT, decode_json, split_bad_records


def study(nct_id="N1", **changes):
    """A study document; ``changes`` replace single facts."""
    facts = {
        "study_type": "INTERVENTIONAL",
        "phases": ["PHASE2"],
        "count": 100,
        "start": "2020-01-01",
        "end": "2020-12-31",
        "sex": "FEMALE",
        "min_age": "18 Years",
        "max_age": None,
        "conditions": ["Asthma"],
        "meshes": [{"id": "D1", "term": "Asthma"}],
        "locations": [
            {
                "facility": "Clinic",
                "city": "Rome",
                "state": "RM",
                "zip": "00100",
                "country": "Italy",
                "geoPoint": {"lat": 41.9, "lon": 12.5},
            }
        ],
    } | changes
    return {
        "protocolSection": {
            "identificationModule": {"nctId": nct_id, "briefTitle": "T"},
            "designModule": {
                "studyType": facts["study_type"],
                "phases": facts["phases"],
                "enrollmentInfo": {"count": facts["count"]},
            },
            "statusModule": {
                "overallStatus": "COMPLETED",
                "startDateStruct": {"date": facts["start"]},
                "primaryCompletionDateStruct": {"date": facts["end"]},
            },
            "sponsorCollaboratorsModule": {"leadSponsor": {"name": "S", "class": "INDUSTRY"}},
            "eligibilityModule": {
                "sex": facts["sex"],
                "minimumAge": facts["min_age"],
                "maximumAge": facts["max_age"],
            },
            "conditionsModule": {"conditions": facts["conditions"]},
            "contactsLocationsModule": {"locations": facts["locations"]},
        },
        "derivedSection": {"conditionBrowseModule": {"meshes": facts["meshes"]}},
    }


def topic(spark, documents):
    """Topic rows from (document or text, minute, offset)."""
    data = []
    for doc, minute, offset in documents:
        text = doc if isinstance(doc, str) else json.dumps(doc)
        data.append(("k", text, datetime.datetime(2024, 1, 1, 0, minute), 0, offset))
    return spark.createDataFrame(data, schemas.TOPIC)


def trials_of(spark, *documents):
    rows_in = [(doc, 0, i) for i, doc in enumerate(documents)]
    return silver.trials_table(silver.clean_studies(topic(spark, rows_in)))


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({"start": "2020"}, True),
        ({"start": None}, False),
        ({"start": "1970"}, False),
        ({"start": "1970-01"}, False),
        ({"start": "2020-13"}, False),
        ({"start": "abcd"}, False),
        ({"end": "2020-01-01"}, False),
        ({"end": "2019-06"}, False),
        ({"count": 0}, False),
        ({"count": None}, False),
        ({"study_type": None}, False),
        ({"phases": []}, False),
        ({"phases": None}, False),
        ({"phases": ["NA"]}, True),
        ({"phases": ["UNKNOWN"]}, False),
        ({"phases": None, "study_type": "OBSERVATIONAL"}, True),
    ],
)
def test_eligibility(spark, changes, kept):
    assert trials_of(spark, study(**changes)).count() == int(kept)


def test_velocity_cap(spark):
    # 31 days are 1.02 months: 152 participants give 149.0196, 153 exactly 150.
    under = study("U", start="2020-01-01", end="2020-02-01", count=152)
    at_cap = study("C", start="2020-01-01", end="2020-02-01", count=153)
    assert rows(trials_of(spark, under, at_cap), "nct_id", "trial_velocity") == [("U", 149.0196)]


def test_derived_columns(spark):
    doc = study(phases=None, study_type="OBSERVATIONAL", sex=None, max_age="6 Months", meshes=None)
    row = trials_of(spark, doc).first()
    assert row["phase"] == "UNKNOWN" and row["sex"] == "ALL"
    assert row["minimum_age_years"] == 18.0 and row["maximum_age_years"] == 0.5
    assert row["enrollment_duration_months"] == 11.99 and row["trial_velocity"] == 8.3403
    assert row["mesh_conditions_ids"] is None
    assert row["has_non_diagnostic_condition"] is False


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_newest_version_wins_in_any_input_order(spark, order):
    deliveries = [
        (study(count=10), 1, 1),
        (study(count=30), 2, 5),
        (study(count=20), 2, 4),
    ]
    frame = topic(spark, [deliveries[i] for i in order])
    assert rows(silver.clean_studies(frame), "enrollment_count") == [(30,)]


def test_ineligible_newest_version_removes_the_study(spark):
    frame = topic(spark, [(study(count=10), 1, 1), (study(count=0), 2, 2)])
    assert silver.clean_studies(frame).count() == 0


def test_documents_without_id_or_json_drop_out(spark):
    broken = [("{not json", 0, 1), (json.dumps({"protocolSection": {}}), 0, 2), (study(), 0, 3)]
    frame = topic(spark, broken)
    assert rows(silver.clean_studies(frame), "nct_id") == [("N1",)]
    decoded = decode_json(frame, schemas.STUDY)
    good, bad = split_bad_records(decoded, ["protocolSection.identificationModule.nctId"])
    assert good.count() == 1
    assert rows(bad, "offset", "reason") == [
        (1, "undecodable"),
        (2, "missing protocolSection.identificationModule.nctId"),
    ]
    assert bad.filter("offset = 1").first()[CORRUPT] == "{not json"


def test_a_field_of_the_wrong_type_keeps_its_document(spark):
    odd = study("N2")
    odd["protocolSection"]["contactsLocationsModule"] = {
        "locations": [{"facility": "F", "city": "Rome", "country": "IT", "geoPoint": {"lat": "x", "lon": 2.0}}]
    }
    frame = topic(spark, [(study(), 0, 1), (json.dumps(odd), 0, 2), ('{"a": 1} tail', 0, 3)])
    studies = silver.clean_studies(frame)
    assert rows(studies, "nct_id") == [("N1",), ("N2",)]
    site = silver.sites_table(studies).filter("nct_id = 'N2'").first()
    assert (site["latitude"], site["longitude"], site["facility_name"]) == (0.0, 2.0, "F")
    doubtful = silver.doubtful_studies(frame)
    assert rows(doubtful, "offset", "reason") == [(2, "field of the wrong type"), (3, "missing id")]


def test_failfast_raises(spark):
    frame = topic(spark, [("{not json", 0, 1)])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode_json(frame, schemas.STUDY, mode="FAILFAST").select("data").collect()


def test_sites(spark):
    nothing = dict.fromkeys(["facility", "city", "state", "zip", "country", "geoPoint"])
    docs = [
        study("A", locations=[nothing, nothing]),
        study("B", locations=None),
        study("C", locations=[]),
        study("D"),
    ]
    studies = silver.clean_studies(topic(spark, [(d, 0, i) for i, d in enumerate(docs)]))
    sites = silver.sites_table(studies, keep_ordinal=True)
    place = ["nct_id", "facility_name", "city", "state", "zip", "country", "latitude"]
    assert rows(sites, *place, "site_ordinal") == [
        ("A", "UNKNOWN FACILITY", "UNKNOWN CITY", "N/A", "N/A", "UNKNOWN", 0.0, 0),
        ("A", "UNKNOWN FACILITY", "UNKNOWN CITY", "N/A", "N/A", "UNKNOWN", 0.0, 1),
        ("D", "Clinic", "Rome", "RM", "00100", "Italy", 41.9, 0),
    ]


def test_conditions_have_one_name(spark):
    docs = [
        study("A", meshes=[{"id": "D1", "term": "Zeta"}, {"id": "D2", "term": None}]),
        study("B", meshes=[{"id": "D1", "term": "Alpha"}, {"id": None, "term": "x"}]),
    ]
    studies = silver.clean_studies(topic(spark, [(d, 0, i) for i, d in enumerate(docs)]))
    assert rows(silver.conditions_table(studies)) == [("D1", "Alpha")]


def test_write_silver(spark, tmp_path):
    silver.write_silver(topic(spark, [(study("A"), 0, 1), (study("B"), 0, 2)]), str(tmp_path))
    trials = spark.read.parquet(f"{tmp_path}/trials")
    sites = spark.read.parquet(f"{tmp_path}/trial_sites")
    conditions = spark.read.parquet(f"{tmp_path}/dim_mesh_conditions")
    assert trials.columns == [*silver.TRIAL_COLUMNS, "transformed_at"]
    assert (trials.count(), sites.count(), conditions.count()) == (2, 2, 1)


def test_documents_are_parsed_once(spark):
    frame = silver.clean_studies(topic(spark, [(study(), 0, 1)]))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
