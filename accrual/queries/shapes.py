"""The given tables in the shapes of trials, sites and study documents.

A trial is an order with its lines, a site row is a line with its supplier's place, and a study
document is a line with its order, part and supplier. All of it is joins and aggregates over
whole tables. The SQL fragments below state the same shapes for the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual.functions import duration_months, recruitment_velocity
from accrual.plans.silver import is_eligible


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(suppkey, s_name, s_acctbal, city, country) of every supplier."""
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(
            F.col("s_suppkey").alias("l_suppkey"),
            "s_name",
            "s_acctbal",
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )


def raw_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with lines, in the shape of derived (not yet filtered) trials."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").cast("int").alias("enrollment_count"),
            F.max("l_shipdate").cast("date").alias("primary_completion_date"),
            F.min("l_partkey").alias("_low"),
            F.max("l_partkey").alias("_high"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    priority = F.col("o_orderpriority")
    return (
        orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"])
        .join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        .select(
            F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("nct_id"),
            F.when(F.col("o_orderstatus") == "O", "OBSERVATIONAL")
            .otherwise("INTERVENTIONAL")
            .alias("study_type"),
            F.when(F.col("o_totalprice") < 250_000, "TREATMENT")
            .otherwise("PREVENTION")
            .alias("primary_purpose"),
            F.col("c_mktsegment").alias("lead_sponsor_class"),
            F.when(F.col("o_orderstatus") == "F", "FEMALE").otherwise("ALL").alias("sex"),
            F.when(priority == "4-NOT SPECIFIED", "UNKNOWN").otherwise(priority).alias("phase"),
            "enrollment_count",
            F.col("o_orderdate").cast("date").alias("start_date"),
            "primary_completion_date",
            F.array_distinct(
                F.array(
                    F.concat(F.lit("P"), F.col("_low").cast("string")),
                    F.concat(F.lit("P"), F.col("_high").cast("string")),
                )
            ).alias("mesh_conditions_ids"),
            (priority == "5-LOW").alias("has_non_diagnostic_condition"),
        )
        .withColumn(
            "enrollment_duration_months", duration_months("start_date", "primary_completion_date")
        )
        .withColumn(
            "trial_velocity", recruitment_velocity("enrollment_count", "enrollment_duration_months")
        )
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible trials."""
    return raw_trials(spark, sf_dir).filter(is_eligible())


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site row per line. Some facilities are blank and some postal codes unknown."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus",
        "l_tax",
    )
    # Tables are joined one by one, nation and region first: both are small as files, so suppliers are
    # marked by broadcast and lines stay where they lie while the supplier file is small as well.
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    nations = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country")
    )
    placed = lines.join(supplier, lines["l_suppkey"] == supplier["s_suppkey"], "left").join(
        nations, supplier["s_nationkey"] == nations["n_nationkey"], "left"
    )
    # A supplier of no known nation has no place.
    known = F.col("n_nationkey").isNotNull()
    return placed.select(
        F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("nct_id"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "  ")
        .when((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0.0), " Unknown facility ")
        .otherwise(F.when(known, F.col("s_name")))
        .alias("facility_name"),
        "city",
        F.concat(F.lit("S"), F.col("l_linenumber").cast("string")).alias("state"),
        F.when(F.col("l_tax") < 0.08, F.concat(F.lit("Z"), F.col("l_suppkey").cast("string")))
        .alias("zip"),
        "country",
        F.when(known, F.col("s_acctbal")).alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.array(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
            F.concat(F.lit("L"), F.col("l_linenumber").cast("string")),
        ).alias("mesh_conditions_ids"),
    )


def condition_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition ids with names: the parts."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("mesh_condition_id"),
        F.col("p_name").alias("mesh_condition_name"),
    )


def study_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of study documents, one delivery per line; repeated keys are later versions."""
    # Documents are made and parsed where the rows lie, and the joins of a small file end in one task. Lines
    # are dealt out by the key of the first join, before they are widened; a second exchange of whole
    # rows would be as large as all of that joins move.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = table(spark, sf_dir, "lineitem").repartition(tasks, "l_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    )
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    # Every line has its order, part and supplier. Left joins keep the lines on the streamed side
    # of each join, however small their file is. Places are joined table by table, as the size of
    # their own join is not known when the plan is made and lines would be exchanged for it.
    rows = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left")
        .join(part, lines["l_partkey"] == part["p_partkey"], "left")
        .join(supplier, lines["l_suppkey"] == supplier["s_suppkey"], "left")
        .join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left")
        .join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
        .withColumnsRenamed({"n_name": "city", "r_name": "country"})
    )
    text = F.array().cast("array<string>")
    line, priority, status = F.col("l_linenumber"), F.col("o_orderpriority"), F.col("o_orderstatus")
    ordered, size = F.col("o_orderdate"), F.col("p_size").cast("string")
    key = F.concat_ws(
        "-", F.concat(F.lit("N"), F.col("l_orderkey").cast("string")), line.cast("string")
    )
    unit = (
        F.when(F.col("l_returnflag") == "A", " Years")
        .when(F.col("l_returnflag") == "N", " Months")
        .otherwise(" Weeks")
    )
    start = (
        F.when(line <= 2, F.date_format(ordered, "yyyy-MM-dd"))
        .when(line <= 4, F.date_format(ordered, "yyyy-MM"))
        .when(line <= 6, F.date_format(ordered, "yyyy"))
        .otherwise(F.concat(F.date_format(ordered, "yyyy"), F.lit("-13")))
    )
    protocol = F.struct(
        F.struct(key.alias("nctId"), F.col("p_name").alias("briefTitle")).alias(
            "identificationModule"
        ),
        F.struct(F.col("p_type").alias("briefSummary")).alias("descriptionModule"),
        F.struct(
            F.when(status == "O", "OBSERVATIONAL")
            .when(~((status == "P") & (priority == "5-LOW")), "INTERVENTIONAL")
            .alias("studyType"),
            F.when(priority == "1-URGENT", F.array(F.lit("PHASE1"), F.lit("PHASE2")))
            .when(priority == "2-HIGH", F.array(F.lit("NA")))
            .when(priority == "3-MEDIUM", F.array(F.lit("UNKNOWN")))
            .when(priority == "4-NOT SPECIFIED", text)
            .alias("phases"),
            F.struct(F.col("p_brand").alias("primaryPurpose")).alias("designInfo"),
            F.struct(
                F.when(F.col("l_discount") == 0.05, 0)
                .otherwise(F.col("l_quantity").cast("int"))
                .alias("count")
            ).alias("enrollmentInfo"),
        ).alias("designModule"),
        F.struct(
            F.when(F.col("l_linestatus") == "F", "COMPLETED")
            .otherwise("RECRUITING")
            .alias("overallStatus"),
            F.struct(start.alias("date")).alias("startDateStruct"),
            F.struct(
                F.when(F.col("l_tax") < 0.08, F.date_format("l_shipdate", "yyyy-MM-dd")).alias(
                    "date"
                )
            ).alias("primaryCompletionDateStruct"),
        ).alias("statusModule"),
        F.struct(
            F.struct(
                F.when(F.col("l_linestatus") == "F", "INDUSTRY").otherwise("OTHER").alias("class")
            ).alias("leadSponsor")
        ).alias("sponsorCollaboratorsModule"),
        F.struct(
            F.when(F.col("l_returnflag") == "N", "FEMALE")
            .when(F.col("l_returnflag") == "R", "MALE")
            .alias("sex"),
            F.when(F.col("p_size") == 50, "N/A").otherwise(F.concat(size, unit)).alias(
                "minimumAge"
            ),
            F.concat(
                size, F.when(F.col("l_linestatus") == "F", " Days").otherwise(" Hours")
            ).alias("maximumAge"),
        ).alias("eligibilityModule"),
        F.struct(
            F.array(
                F.col("p_name"),
                F.when(F.col("p_type") == "PROMO", "healthy volunteers")
                .when(F.col("p_type") == "SMALL", "Imaging")
                .otherwise("Diabetes"),
            ).alias("conditions")
        ).alias("conditionsModule"),
        F.struct(
            F.when(
                line != 6,
                F.array(
                    F.struct(
                        F.col("s_name").alias("facility"),
                        F.col("city"),
                        F.lit(None).cast("string").alias("state"),
                        F.concat(F.lit("Z"), F.col("l_suppkey").cast("string")).alias("zip"),
                        F.col("country"),
                        F.struct(
                            F.col("s_acctbal").alias("lat"), F.lit(None).cast("double").alias("lon")
                        ).alias("geoPoint"),
                    ),
                    F.struct(
                        F.lit(None).cast("string").alias("facility"),
                        F.lit(None).cast("string").alias("city"),
                        F.lit("second").alias("state"),
                        F.lit(None).cast("string").alias("zip"),
                        F.col("country"),
                        F.struct(
                            F.lit(None).cast("double").alias("lat"),
                            F.lit(None).cast("double").alias("lon"),
                        ).alias("geoPoint"),
                    ),
                ),
            ).alias("locations")
        ).alias("contactsLocationsModule"),
    )
    derived = F.struct(
        F.struct(
            F.array(
                F.struct(
                    F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"),
                    F.col("p_name").alias("term"),
                ),
                F.struct(F.col("p_brand").alias("id"), F.col("p_type").alias("term")),
            ).alias("meshes")
        ).alias("conditionBrowseModule")
    )
    return rows.select(
        key.alias("key"),
        F.to_json(
            F.struct(protocol.alias("protocolSection"), derived.alias("derivedSection"))
        ).alias("value"),
        F.col("l_shipdate").alias("timestamp"),
        line.alias("partition"),
        (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("offset"),
    )


# --- the same shapes in SQL ---------------------------------------------------------------

RAW_TRIALS_SQL = """
lines AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS INTEGER) AS enrolled,
         CAST(max(l_shipdate) AS DATE) AS done, min(l_partkey) AS low, max(l_partkey) AS high
  FROM lineitem GROUP BY l_orderkey),
raw_trials AS (
  SELECT 'T' || o_orderkey AS nct_id,
         CASE WHEN o_orderstatus = 'O' THEN 'OBSERVATIONAL' ELSE 'INTERVENTIONAL' END AS study_type,
         CASE WHEN o_totalprice < 250000 THEN 'TREATMENT' ELSE 'PREVENTION' END AS primary_purpose,
         c_mktsegment AS lead_sponsor_class,
         CASE WHEN o_orderstatus = 'F' THEN 'FEMALE' ELSE 'ALL' END AS sex,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'UNKNOWN' ELSE o_orderpriority END AS phase,
         enrolled, CAST(o_orderdate AS DATE) AS started, done,
         CASE WHEN low = high THEN ['P' || low] ELSE ['P' || low, 'P' || high] END AS ids,
         o_orderpriority = '5-LOW' AS non_diagnostic,
         round(date_diff('day', CAST(o_orderdate AS DATE), done) / CAST(30.44 AS DOUBLE), 2) AS months
  FROM orders JOIN lines ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey)
"""

TRIALS_SQL = (
    RAW_TRIALS_SQL
    + """,
trials AS (
  SELECT *, round(CAST(enrolled AS DOUBLE) / months, 4) AS velocity
  FROM raw_trials
  WHERE months > 0 AND enrolled > 0 AND done > started
    AND (study_type = 'OBSERVATIONAL' OR phase <> 'UNKNOWN')
    AND round(CAST(enrolled AS DOUBLE) / months, 4) < 150)
"""
)

SITES_SQL = """
all_sites AS (
  SELECT 'T' || l_orderkey AS nct_id,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '  '
              WHEN l_returnflag = 'R' AND l_tax = 0 THEN ' Unknown facility ' ELSE s_name END AS facility,
         n_name AS city, 'S' || l_linenumber AS state,
         CASE WHEN l_tax < 0.08 THEN 'Z' || l_suppkey END AS zip, r_name AS country,
         s_acctbal AS lat, l_tax AS lon, ['P' || l_partkey, 'L' || l_linenumber] AS ids
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
usable AS (
  SELECT * FROM all_sites
  WHERE trim(facility) <> '' AND upper(trim(facility)) <> 'UNKNOWN FACILITY'),
keyed AS (SELECT * FROM usable WHERE zip IS NOT NULL)
"""

HISTORY_SQL = """
history AS (
  SELECT country, city, zip, min(facility) AS facility_name, min(state) AS state,
         min(lat) AS latitude, min(lon) AS longitude, count(*) AS n_trials,
         avg(coalesce(velocity, 0)) AS avg_velocity, max(year(started)) AS last_year
  FROM keyed LEFT JOIN trials USING (nct_id) GROUP BY country, city, zip)
"""

DOCS_SQL = """
versions AS (
  SELECT 'N' || l_orderkey || '-' || l_linenumber AS nct_id, *,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS newness
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
docs AS (
  SELECT *,
         CASE WHEN o_orderstatus = 'O' THEN 'OBSERVATIONAL'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
              ELSE 'INTERVENTIONAL' END AS study_type,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'PHASE1' WHEN '2-HIGH' THEN 'NA' ELSE 'UNKNOWN' END AS phase,
         CASE WHEN l_discount = 0.05 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS enrolled,
         CASE WHEN l_linenumber <= 2 THEN CAST(o_orderdate AS DATE)
              WHEN l_linenumber <= 4 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
              WHEN l_linenumber <= 6 THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS started,
         CASE WHEN l_tax < 0.08 THEN CAST(l_shipdate AS DATE) END AS done
  FROM versions WHERE newness = 1),
timed AS (
  SELECT *, round(date_diff('day', started, done) / CAST(30.44 AS DOUBLE), 2) AS months
  FROM docs WHERE done > started AND enrolled > 0 AND study_type IS NOT NULL
    AND (study_type = 'OBSERVATIONAL' OR phase <> 'UNKNOWN')),
studies AS (
  SELECT *, round(CAST(enrolled AS DOUBLE) / months, 4) AS velocity
  FROM timed WHERE round(CAST(enrolled AS DOUBLE) / months, 4) < 150)
"""
