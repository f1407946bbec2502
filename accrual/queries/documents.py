"""Document decoding, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from accrual import schemas
from accrual.functions import age_years, any_term, partial_date, pipe_joined
from accrual.operators.dims import dimension_from_lists
from accrual.operators.latest import latest_per_key
from accrual.plans import sample, silver
from accrual.queries import shapes
from accrual.queries.registry import query, settled
from accrual.queries.shapes import DOCS_SQL, table
from accrual.session import durable
from accrual.sources.landing import payload_hash, select_incremental
from accrual.sources.topics import CORRUPT, decode_json, keyed_json, split_bad_records, unwrap_envelope


SILVER_TRIALS_SQL = f"""WITH {DOCS_SQL}
SELECT nct_id, p_name AS brief_title, p_type AS brief_summary, study_type, p_brand AS primary_purpose,
       CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'RECRUITING' END AS overall_status,
       CASE WHEN l_linestatus = 'F' THEN 'INDUSTRY' ELSE 'OTHER' END AS lead_sponsor_class,
       phase, enrolled AS enrollment_count, started AS start_date, done AS primary_completion_date,
       CASE l_returnflag WHEN 'N' THEN 'FEMALE' WHEN 'R' THEN 'MALE' ELSE 'ALL' END AS sex,
       CASE WHEN p_size = 50 THEN NULL
            WHEN l_returnflag = 'A' THEN CAST(p_size AS DOUBLE)
            WHEN l_returnflag = 'N' THEN round(p_size / CAST(12 AS DOUBLE), 6)
            ELSE round(p_size / CAST(52.17 AS DOUBLE), 6) END AS minimum_age_years,
       CASE WHEN l_linestatus = 'F' THEN round(p_size / CAST(365.25 AS DOUBLE), 6)
            ELSE CAST(p_size AS DOUBLE) END AS maximum_age_years,
       months AS enrollment_duration_months, velocity AS trial_velocity,
       'P' || p_partkey || '|' || p_brand AS mesh_conditions_ids,
       p_type IN ('PROMO', 'SMALL') AS has_non_diagnostic_condition
FROM studies"""


def rounded_trials(trials):
    return (
        trials.withColumn("mesh_conditions_ids", pipe_joined("mesh_conditions_ids"))
        .withColumn("minimum_age_years", F.round("minimum_age_years", 6))
        .withColumn("maximum_age_years", F.round("maximum_age_years", 6))
    )


@query("silver_trials", SILVER_TRIALS_SQL)
def silver_trials(spark, sf_dir):
    trials = silver.trials_table(silver.clean_studies(shapes.study_topic(spark, sf_dir)))
    return rounded_trials(trials)


@query(
    "explode_sites",
    f"""WITH {DOCS_SQL}
SELECT nct_id, s_name AS facility_name, n_name AS city, 'N/A' AS state, 'Z' || l_suppkey AS zip,
       r_name AS country, s_acctbal AS latitude, CAST(0 AS DOUBLE) AS longitude,
       'P' || p_partkey || '|' || p_brand AS mesh_conditions_ids
FROM studies WHERE l_linenumber <> 6
UNION ALL
SELECT nct_id, 'UNKNOWN FACILITY', 'UNKNOWN CITY', 'second', 'N/A', r_name, CAST(0 AS DOUBLE),
       CAST(0 AS DOUBLE), 'P' || p_partkey || '|' || p_brand
FROM studies WHERE l_linenumber <> 6""",
)
def explode_sites(spark, sf_dir):
    sites = silver.sites_table(silver.clean_studies(shapes.study_topic(spark, sf_dir)))
    return sites.withColumn("mesh_conditions_ids", pipe_joined("mesh_conditions_ids"))


@query(
    "dim_conditions",
    f"""WITH {DOCS_SQL}
SELECT mesh_condition_id, min(mesh_condition_name) AS mesh_condition_name FROM (
  SELECT 'P' || p_partkey AS mesh_condition_id, p_name AS mesh_condition_name FROM studies
  UNION ALL SELECT p_brand, p_type FROM studies) GROUP BY 1""",
)
def dim_conditions(spark, sf_dir):
    return silver.conditions_table(silver.clean_studies(shapes.study_topic(spark, sf_dir)))


@query(
    "dim_distinct",
    """SELECT DISTINCT p_brand AS mesh_condition_id, p_type AS mesh_condition_name FROM part
UNION SELECT DISTINCT p_type, p_name FROM part""",
)
def dim_distinct(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.array(
            F.struct(F.col("p_brand").alias("id"), F.col("p_type").alias("term")),
            F.struct(F.col("p_type").alias("id"), F.col("p_name").alias("term")),
        ).alias("meshes")
    )
    return dimension_from_lists(parts, "meshes", "id", "term")


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS newness
  FROM events) WHERE newness = 1""",
)
def latest_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value", "ts"
    )
    newest = latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.drop("ts")


def _event_topic(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        "event_type",
        F.col("ts").alias("timestamp"),
    )


@query(
    "json_decode",
    """SELECT CAST(event_id AS VARCHAR) AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events WHERE json_extract(props, '$.k') IS NOT NULL""",
)
def json_decode(spark, sf_dir):
    decoded = decode_json(_event_topic(spark, sf_dir), "k int")
    return decoded.filter(F.col("data.k").isNotNull()).select("key", F.col("data.k").alias("k"))


@query(
    "json_roundtrip",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey, o_custkey, o_orderstatus,
       round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""",
)
def json_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate date, o_orderpriority string"
    )
    back = decode_json(keyed_json(orders, "o_orderkey"), schema)
    return back.select("key", "data.*").drop(CORRUPT).withColumn(
        "o_totalprice", F.round("o_totalprice", 2)
    )


@query(
    "quarantine",
    """SELECT event_type,
       CASE event_type WHEN 'error' THEN 'undecodable' WHEN 'view' THEN 'missing k' ELSE 'good' END AS outcome,
       count(*) AS n_records,
       CAST(coalesce(sum(CASE WHEN event_type NOT IN ('error', 'view')
                         THEN CAST(json_extract(props, '$.k') AS INTEGER) END), 0) AS BIGINT) AS sum_k
FROM events GROUP BY 1, 2""",
)
def quarantine(spark, sf_dir):
    # Errors lose their closing brace on the way, views send another field.
    value = (
        F.when(F.col("event_type") == "error", F.expr("left(value, length(value) - 1)"))
        .when(F.col("event_type") == "view", F.replace("value", F.lit('"k"'), F.lit('"j"')))
        .otherwise(F.col("value"))
    )
    topic = _event_topic(spark, sf_dir).withColumn("value", value)
    good, bad = split_bad_records(decode_json(topic, "k int"), ["k"])
    outcomes = good.select(
        "event_type", F.lit("good").alias("outcome"), F.col("data.k").alias("k")
    ).unionByName(
        bad.select("event_type", F.col("reason").alias("outcome"), F.lit(None).cast("int").alias("k"))
    )
    return outcomes.groupBy("event_type", "outcome").agg(
        F.count("*").alias("n_records"), F.coalesce(F.sum("k"), F.lit(0)).alias("sum_k")
    )


@query(
    "envelope_unwrap",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def envelope_unwrap(spark, sf_dir):
    # Purchases come in an envelope as JSON text, clicks as an embedded object, others bare.
    quoted = F.to_json(F.struct(F.col("props").alias("value")))
    embedded = F.concat(F.lit('{"value": '), F.col("props"), F.lit("}"))
    wrapped = (
        F.when(F.col("event_type") == "purchase", quoted)
        .when(F.col("event_type") == "click", embedded)
        .otherwise(F.col("props"))
    )
    events = table(spark, sf_dir, "events").select("event_id", wrapped.alias("value"))
    return events.select(
        "event_id", F.from_json(unwrap_envelope("value"), "k int")["k"].alias("k")
    )


@query(
    "payload_hash",
    """SELECT event_id, sha256('{"event_id":' || event_id || ',"event_type":"' || event_type ||
       '","props":' || replace(props, ' ', '') || ',"user_id":' || user_id || '}') AS payload_hash
FROM events""",
)
def payload_hashes(spark, sf_dir):
    # Keys in another order and with blanks: the hash is of the sorted spelling.
    spelled = F.format_string(
        '{"user_id": %d, "props": %s, "event_type": "%s", "event_id": %d}',
        "user_id", "props", "event_type", "event_id",
    )
    return table(spark, sf_dir, "events").select(
        "event_id", payload_hash(spelled).alias("payload_hash")
    )


@query(
    "incremental_filter",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS last_update FROM orders
WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) >= DATE '2001-06-30'""",
)
def incremental_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "last_update", F.col("o_orderdate").cast("date")
    )
    chosen = select_incremental(
        orders, "2001-07-01", daily=True, status="F", status_col="o_orderstatus"
    )
    return chosen.select("o_orderkey", "o_custkey", "last_update")


@query(
    "ingest_cap",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_orderdate, o_orderkey LIMIT 2000""",
)
def ingest_cap(spark, sf_dir):
    chosen = select_incremental(
        table(spark, sf_dir, "orders"),
        "2001-07-01",
        daily=False,
        max_rows=2000,
        status="F",
        status_col="o_orderstatus",
        order_by=["o_orderdate", "o_orderkey"],
    )
    return chosen.select("o_orderkey", "o_orderstatus")


@query(
    "date_normalise",
    """SELECT o_orderkey,
       CASE o_orderpriority
         WHEN '1-URGENT' THEN CAST(date_trunc('year', o_orderdate) AS DATE)
         WHEN '2-HIGH' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
         WHEN '3-MEDIUM' THEN CAST(o_orderdate AS DATE) END AS normalised,
       CASE o_orderpriority
         WHEN '1-URGENT' THEN CAST(date_trunc('year', o_orderdate) AS DATE)
         WHEN '2-HIGH' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
         WHEN '3-MEDIUM' THEN CAST(o_orderdate AS DATE) END AS normalised_strict
FROM orders""",
)
def date_normalise(spark, sf_dir):
    ordered, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_format(ordered, "yyyy"))
        .when(priority == "2-HIGH", F.date_format(ordered, "yyyy-MM"))
        .when(priority == "3-MEDIUM", F.date_format(ordered, "yyyy-MM-dd"))
        .when(priority == "5-LOW", F.concat(F.date_format(ordered, "yyyy"), F.lit("-99")))
        .otherwise(F.col("o_orderstatus"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        partial_date(text).alias("normalised"),
        partial_date(text, strict=True).alias("normalised_strict"),
    )


@query(
    "unit_normalise",
    """SELECT p_partkey,
       CASE p_type WHEN 'STANDARD' THEN CAST(p_size AS DOUBLE)
                   WHEN 'ECONOMY' THEN round(p_size / CAST(12 AS DOUBLE), 6)
                   WHEN 'MEDIUM' THEN round(p_size / CAST(52.17 AS DOUBLE), 6)
                   WHEN 'PROMO' THEN round(p_size / CAST(365.25 AS DOUBLE), 6)
                   WHEN 'LARGE' THEN CAST(p_size AS DOUBLE) END AS years,
       CASE p_type WHEN 'STANDARD' THEN CAST(p_size AS DOUBLE)
                   WHEN 'ECONOMY' THEN round(p_size * (CAST(1 AS DOUBLE) / 12), 4)
                   WHEN 'MEDIUM' THEN round(p_size * (CAST(7 AS DOUBLE) / 365), 4)
                   WHEN 'PROMO' THEN round(p_size * (CAST(1 AS DOUBLE) / 365), 4) END AS years_strict
FROM part""",
)
def unit_normalise(spark, sf_dir):
    size = F.col("p_size").cast("string")
    kind = F.col("p_type")
    text = (
        F.when(kind == "STANDARD", F.concat(size, F.lit(" Years")))
        .when(kind == "ECONOMY", F.concat(size, F.lit(" Months")))
        .when(kind == "MEDIUM", F.concat(size, F.lit(" WEEKS")))
        .when(kind == "PROMO", F.concat(size, F.lit(" day")))
        .when(kind == "LARGE", F.concat(size, F.lit(" Hours")))
        .otherwise("N/A")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(age_years(text), 6).alias("years"),
        age_years(text, mode="strict").alias("years_strict"),
    )


@query(
    "term_flag",
    """SELECT doc_id, regexp_matches(text, '(?i)(nicht|eaux|healthy|reation)') AS flagged FROM documents""",
)
def term_flag(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        any_term(F.split("text", "\n"), ["nicht", "EAUX", "Healthy", "Reation"]).alias("flagged"),
    )


def _profile_documents(spark, sf_dir):
    """One wide study document per order, decoded with the profile schema."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    urgent = priority == "1-URGENT"
    place = F.struct(
        F.when(status == "O", "ACTIVE").alias("status"),
        F.col("c_mktsegment").alias("country"),
        F.struct(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("lat")).alias("geoPoint"),
    )
    elsewhere = F.struct(
        F.lit("DONE").alias("status"),
        F.when(status == "F", "MACHINERY").otherwise("").alias("country"),
        F.struct(F.lit(1.5).alias("lat")).alias("geoPoint"),
    )
    document = F.struct(
        F.struct(
            F.struct(F.col("o_orderkey").cast("string").alias("nctId")).alias(
                "identificationModule"
            ),
            F.struct(
                F.when(status == "F", "TERMINATED").when(status == "P", "COMPLETED").alias(
                    "overallStatus"
                ),
                F.when(urgent, "no funds").when(priority == "2-HIGH", "").alias("whyStopped"),
            ).alias("statusModule"),
            F.struct(
                F.when(urgent, F.array(F.struct(F.col("c_name").alias("name")))).alias(
                    "collaborators"
                )
            ).alias("sponsorCollaboratorsModule"),
            F.struct(
                F.split(priority, "-").alias("conditions"),
                F.when(status != "P", F.split("c_name", "#")).alias("keywords"),
            ).alias("conditionsModule"),
            F.struct(
                F.struct(F.col("o_custkey").cast("int").alias("count")).alias("enrollmentInfo")
            ).alias("designModule"),
            F.struct(F.when(status != "O", F.col("c_name")).alias("eligibilityCriteria")).alias(
                "eligibilityModule"
            ),
            F.struct(
                F.array(
                    F.struct(F.when(urgent, "DRUG").alias("type")),
                    F.struct(F.lit("DEVICE").alias("type")),
                ).alias("interventions")
            ).alias("armsInterventionsModule"),
            F.struct(
                F.when(urgent, F.array(place))
                .when(priority != "5-LOW", F.array(place, elsewhere, place))
                .alias("locations")
            ).alias("contactsLocationsModule"),
        ).alias("protocolSection"),
        F.struct(
            F.struct(
                F.when(status == "O", F.array(F.struct(status.alias("id")))).alias("meshes")
            ).alias("conditionBrowseModule")
        ).alias("derivedSection"),
    )
    topic = orders.select(F.to_json(document).alias("value"))
    return decode_json(topic, schemas.STUDY_PROFILE)


@query(
    "list_metrics",
    """WITH d AS (
  SELECT *, o_orderpriority = '1-URGENT' AS urgent, o_orderpriority = '5-LOW' AS low
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT CAST(o_orderkey AS VARCHAR) AS nct_id,
  CASE WHEN urgent THEN 1 WHEN low THEN 0 ELSE 3 END AS n_sites,
  CASE WHEN low THEN 0 WHEN urgent THEN 1
       WHEN o_orderstatus = 'F' AND c_mktsegment <> 'MACHINERY' THEN 2 ELSE 1 END AS n_countries,
  CASE WHEN low THEN 0 WHEN urgent THEN CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END
       ELSE CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 1 END END AS sites_with_status,
  CASE WHEN low THEN 0 WHEN urgent THEN CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END
       ELSE CASE WHEN c_acctbal > 0 THEN 3 ELSE 1 END END AS sites_with_geo,
  CASE WHEN urgent THEN 1 ELSE 0 END AS n_collaborators,
  len(string_split(o_orderpriority, '-')) AS n_conditions,
  CASE WHEN o_orderstatus <> 'P' THEN 2 ELSE 0 END AS n_keywords,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS n_mesh_terms,
  2 AS n_interventions,
  CASE WHEN urgent THEN 'DRUG|DEVICE' ELSE 'DEVICE' END AS intervention_types,
  CASE WHEN o_orderstatus <> 'O' THEN length(c_name) ELSE 0 END AS criteria_length
FROM d""",
)
def list_metrics(spark, sf_dir):
    metrics = sample.study_metrics(_profile_documents(spark, sf_dir))
    return metrics.select(
        "nct_id", "n_sites", "n_countries", "sites_with_status", "sites_with_geo",
        "n_collaborators", "n_conditions", "n_keywords", "n_mesh_terms", "n_interventions",
        pipe_joined("intervention_types").alias("intervention_types"), "criteria_length",
    )


ALWAYS_MISSING = [
    "status_verified_date", "start_date", "primary_completion_date", "completion_date", "lead_sponsor_name",
    "lead_sponsor_class", "study_type", "allocation", "intervention_model", "masking", "enrollment_type",
    "minimum_age", "maximum_age", "sex", "healthy_volunteers", "has_dmc", "is_fda_regulated_drug",
    "is_fda_regulated_device",
]
MISSING_SQL = {
    "overall_status": "o_orderstatus NOT IN ('F', 'P')",
    "why_stopped": "NOT urgent",
    "enrollment_count": "FALSE",
    "criteria_length": "FALSE",
    **{name: "TRUE" for name in ALWAYS_MISSING},
}
SHARE_SQL = {
    "overall_status": "CASE o_orderstatus WHEN 'F' THEN 'TERMINATED' WHEN 'P' THEN 'COMPLETED' END",
    **{
        name: "CAST(NULL AS VARCHAR)"
        for name in ("lead_sponsor_class", "study_type", "sex", "start_date_type", "enrollment_type")
    },
}
ENROLLMENT_SQL = {
    "p50": "floor(n * CAST(0.5 AS DOUBLE))", "p90": "floor(n * CAST(0.9 AS DOUBLE))",
    "p99": "floor(n * CAST(0.99 AS DOUBLE))", "max": "n - 1",
}


@query(
    "sample_report",
    """WITH d AS (
  SELECT *, o_orderpriority = '1-URGENT' AS urgent, o_orderpriority = '5-LOW' AS low
  FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (
  SELECT *, CASE WHEN urgent THEN 1 WHEN low THEN 0 ELSE 3 END AS n_sites,
    CASE WHEN low THEN 0 WHEN urgent THEN CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END
         ELSE CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 1 END END AS sites_with_status,
    CASE WHEN low THEN 0 WHEN urgent THEN CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END
         ELSE CASE WHEN c_acctbal > 0 THEN 3 ELSE 1 END END AS sites_with_geo
  FROM d),
c AS (
  SELECT 'coverage' AS report, 'mesh terms' AS name, CAST(NULL AS VARCHAR) AS value,
         count(*) FILTER (o_orderstatus = 'O') AS part, count(*) AS whole FROM m
  UNION ALL SELECT 'coverage', 'stop reason', NULL, count(*) FILTER (o_orderstatus = 'F' AND urgent),
       count(*) FILTER (o_orderstatus = 'F') FROM m
  UNION ALL SELECT 'coverage', 'site status', NULL, CAST(sum(sites_with_status) AS BIGINT), CAST(sum(n_sites) AS BIGINT) FROM m
  UNION ALL SELECT 'coverage', 'site geo point', NULL, CAST(sum(sites_with_geo) AS BIGINT), CAST(sum(n_sites) AS BIGINT) FROM m
  UNION ALL SELECT 'enrollment', 'large', NULL, count(*) FILTER (o_custkey > 10000), count(o_custkey) FROM m
"""
    + "".join(
        f"  UNION ALL SELECT 'missing', '{name}', NULL, count(*) FILTER ({test}), count(*) FROM m\n"
        for name, test in MISSING_SQL.items()
    )
    + "".join(
        f"  UNION ALL SELECT 'share', '{name}', {value}, count(*), (SELECT count(*) FROM m) FROM m GROUP BY 3\n"
        for name, value in SHARE_SQL.items()
    )
    + """),
e AS (SELECT o_custkey AS v, row_number() OVER (ORDER BY o_custkey) - 1 AS place, count(*) OVER () AS n FROM m)
SELECT report, name, value, part, whole, round(100.0::DOUBLE * part / whole, 1) AS pct, CAST(NULL AS DOUBLE) AS amount FROM c
UNION ALL SELECT 'enrollment', 'sites per trial', NULL, NULL, NULL, NULL, round(avg(n_sites) + 1e-9, 6) FROM m
"""
    + "".join(
        f"UNION ALL SELECT 'enrollment', '{name}', NULL, NULL, NULL, NULL, CAST(max(v) AS DOUBLE) FROM e WHERE place = {at}\n"
        for name, at in ENROLLMENT_SQL.items()
    ),
)
def sample_report(spark, sf_dir):
    """All parts of the report: coverage, missing fields, shares of values, enrolment."""
    metrics = durable(sample.study_metrics(_profile_documents(spark, sf_dir)))
    return sample.sample_report(metrics).withColumn("amount", settled("amount"))


@query(
    "array_join",
    """SELECT doc_id, coalesce(array_to_string(string_split(source, 'c'), '|'), '') AS parts FROM documents""",
)
def array_join(spark, sf_dir):
    from accrual.sources.tables import flatten_lists

    return flatten_lists(
        table(spark, sf_dir, "documents").select("doc_id", F.split("source", "c").alias("parts"))
    )
