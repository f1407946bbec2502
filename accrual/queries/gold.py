"""Trial, site, history and dimension queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from accrual.functions import pipe_joined
from accrual.operators.areas import area_multihot
from accrual.operators import dims
from accrual.operators.order_stats import distributed_rank
from accrual.operators.values import top_dimension_values
from accrual.plans import gold
from accrual.queries import shapes
from accrual.queries.registry import query, settled
from accrual.session import durable, release
from accrual.queries.shapes import HISTORY_SQL, RAW_TRIALS_SQL, SITES_SQL, TRIALS_SQL, table


def _usable(spark, sf_dir):
    return gold.usable_sites(shapes.sites(spark, sf_dir))


def _history(spark, sf_dir):
    return gold.site_history(_usable(spark, sf_dir), shapes.trials(spark, sf_dir))


def _stored_history(spark, sf_dir):
    """The history as a written table, as the layer plan has it: computed once, read twice."""
    history = durable(_history(spark, sf_dir))
    release(spark)
    return history


@query(
    "trial_velocity",
    f"""WITH {TRIALS_SQL}
SELECT nct_id, study_type, phase, enrolled AS enrollment_count, months AS enrollment_duration_months,
       velocity AS trial_velocity FROM trials""",
)
def trial_velocity(spark, sf_dir):
    return shapes.trials(spark, sf_dir).select(
        "nct_id", "study_type", "phase", "enrollment_count", "enrollment_duration_months",
        "trial_velocity",
    )


@query(
    "site_history",
    f"""WITH {TRIALS_SQL}, {SITES_SQL}, {HISTORY_SQL}
SELECT country, city, zip, facility_name, state, latitude, longitude, n_trials,
       round(avg_velocity + 1e-9, 6) AS avg_velocity, CAST(last_year AS INTEGER) AS last_year FROM history""",
)
def site_history(spark, sf_dir):
    return _history(spark, sf_dir).withColumn("avg_velocity", settled("avg_velocity"))


@query(
    "site_history_distinct",
    f"""WITH {TRIALS_SQL}, {SITES_SQL},
once AS (SELECT nct_id, country, city, zip, min(facility) AS facility, min(state) AS low_state,
                min(lat) AS lat, min(lon) AS lon FROM keyed GROUP BY nct_id, country, city, zip)
SELECT country, city, zip, min(facility) AS facility_name, min(low_state) AS state,
       min(lat) AS latitude, min(lon) AS longitude, count(*) AS n_trials,
       round(avg(velocity) + 1e-9, 6) AS avg_velocity,
       CAST(max(year(started)) AS INTEGER) AS last_year
FROM once JOIN trials USING (nct_id) GROUP BY country, city, zip""",
)
def site_history_distinct(spark, sf_dir):
    history = gold.site_history(
        _usable(spark, sf_dir), shapes.trials(spark, sf_dir), distinct_trials=True, orphans="drop"
    )
    return history.withColumn("avg_velocity", settled("avg_velocity"))


@query(
    "site_condition_history",
    f"""WITH {SITES_SQL}
SELECT country, city, zip, mesh_condition_id, count(*) AS n_trials_for_condition
FROM (SELECT country, city, zip, unnest(ids) AS mesh_condition_id FROM keyed) GROUP BY ALL""",
)
def site_condition_history(spark, sf_dir):
    return gold.site_condition_history(_usable(spark, sf_dir))


@query(
    "trial_site_stats",
    f"""WITH {TRIALS_SQL}, {SITES_SQL}, {HISTORY_SQL}
SELECT nct_id, count(*) AS n_sites, round(avg(n_trials) + 1e-9, 6) AS avg_site_exp,
       round(avg(avg_velocity) + 1e-9, 6) AS avg_site_vel
FROM usable LEFT JOIN history USING (country, city, zip) GROUP BY nct_id""",
)
def trial_site_stats(spark, sf_dir):
    stats = gold.trial_site_stats(_usable(spark, sf_dir), _stored_history(spark, sf_dir))
    return stats.select(
        "nct_id",
        "n_sites",
        settled("avg_site_exp"),
        settled("avg_site_vel"),
    )


def _features(spark, sf_dir):
    stats = gold.trial_site_stats(_usable(spark, sf_dir), _stored_history(spark, sf_dir))
    return gold.trial_features(shapes.trials(spark, sf_dir), stats)


FEATURES_SQL = f"""{TRIALS_SQL}, {SITES_SQL}, {HISTORY_SQL},
stats AS (
  SELECT nct_id, count(*) AS n_sites, avg(n_trials) AS site_exp, avg(avg_velocity) AS site_vel
  FROM usable LEFT JOIN history USING (country, city, zip) GROUP BY nct_id),
features AS (
  SELECT * FROM trials JOIN stats USING (nct_id) WHERE site_exp IS NOT NULL AND site_vel IS NOT NULL)
"""


TRIAL_FEATURES_SQL = f"""WITH {FEATURES_SQL}
SELECT nct_id, study_type, primary_purpose, lead_sponsor_class, sex, phase,
       enrolled AS enrollment_count, CAST(n_sites AS INTEGER) AS n_sites, months AS duration_months,
       array_to_string(ids, '|') AS mesh_conditions_ids, non_diagnostic AS has_non_diagnostic_condition,
       round(site_exp + 1e-9, 6) AS avg_site_exp, round(site_vel + 1e-9, 6) AS avg_site_vel,
       velocity AS target_velocity FROM features"""


@query("trial_features", TRIAL_FEATURES_SQL)
def trial_features(spark, sf_dir):
    return (
        _features(spark, sf_dir)
        .withColumn("mesh_conditions_ids", pipe_joined("mesh_conditions_ids"))
        .withColumn("avg_site_exp", settled("avg_site_exp"))
        .withColumn("avg_site_vel", settled("avg_site_vel"))
    )


@query(
    "loo_history",
    f"""WITH {TRIALS_SQL}, {SITES_SQL},
own AS (
  SELECT nct_id, country, city, zip, count(*) AS n, sum(coalesce(velocity, 0)) AS v
  FROM keyed LEFT JOIN trials USING (nct_id) GROUP BY ALL),
place AS (SELECT country, city, zip, sum(n) AS all_n, sum(v) AS all_v FROM own GROUP BY ALL),
others AS (
  SELECT nct_id, n, all_n - n AS others, (all_v - v) / nullif(all_n - n, 0) AS vel
  FROM own JOIN place USING (country, city, zip))
SELECT nct_id,
  round(CAST(sum(CASE WHEN others > 0 THEN others * n END) AS DOUBLE)
        / CAST(sum(CASE WHEN others > 0 THEN n END) AS DOUBLE) + 1e-9, 6) AS avg_site_exp,
  round(sum(CASE WHEN others > 0 THEN vel * n END)
        / CAST(sum(CASE WHEN others > 0 THEN n END) AS DOUBLE) + 1e-9, 6) AS avg_site_vel
FROM others GROUP BY nct_id""",
)
def loo_history(spark, sf_dir):
    stats = gold.leave_one_out_stats(_usable(spark, sf_dir), shapes.trials(spark, sf_dir))
    return stats.select(
        "nct_id",
        settled("avg_site_exp"),
        settled("avg_site_vel"),
    )


@query(
    "asof_history",
    f"""WITH {TRIALS_SQL}, {SITES_SQL},
r AS (SELECT nct_id, country, city, zip, started, done, velocity FROM keyed JOIN trials USING (nct_id)),
days AS (
  SELECT country, city, zip, done, count(*) AS n, sum(velocity) AS v FROM r GROUP BY ALL),
cumulative AS (
  SELECT country, city, zip, done, sum(n) OVER w AS n, sum(v) OVER w AS v FROM days
  WINDOW w AS (PARTITION BY country, city, zip ORDER BY done)),
asked AS (
  SELECT r.nct_id, c.n, c.v / c.n AS vel FROM r ASOF JOIN cumulative c
  ON r.country = c.country AND r.city = c.city AND r.zip = c.zip AND r.started > c.done)
SELECT nct_id, round(avg(n) + 1e-9, 6) AS avg_site_exp, round(avg(vel) + 1e-9, 6) AS avg_site_vel
FROM asked GROUP BY nct_id""",
)
def asof_history(spark, sf_dir):
    stats = gold.as_of_stats(_usable(spark, sf_dir), shapes.trials(spark, sf_dir))
    return stats.select(
        "nct_id",
        settled("avg_site_exp"),
        settled("avg_site_vel"),
    )


@query(
    "condition_totals",
    f"""WITH {SITES_SQL},
h AS (SELECT country, city, zip, id, count(*) AS n FROM
      (SELECT country, city, zip, unnest(ids) AS id FROM keyed) GROUP BY ALL)
SELECT id AS condition_id, p_name AS condition_name, CAST(sum(n) AS BIGINT) AS count
FROM h JOIN part ON id = 'P' || p_partkey GROUP BY ALL""",
)
def condition_totals(spark, sf_dir):
    history = gold.site_condition_history(_usable(spark, sf_dir))
    return dims.condition_totals(history, shapes.condition_dim(spark, sf_dir))


@query(
    "condition_list",
    f"""WITH {SITES_SQL}
SELECT DISTINCT 'P' || p_partkey AS condition_id, p_name AS condition_name
FROM part JOIN (SELECT unnest(ids) AS id FROM keyed) ON id = 'P' || p_partkey""",
)
def condition_list(spark, sf_dir):
    history = gold.site_condition_history(_usable(spark, sf_dir))
    return dims.condition_list(
        dims.condition_totals(history, shapes.condition_dim(spark, sf_dir))
    )


CONDITION_TOPN_SQL = f"""WITH {RAW_TRIALS_SQL}
SELECT mesh_id AS mesh_condition_id, p_name AS mesh_condition_name, count(*) AS n_trials
FROM (SELECT unnest(ids) AS mesh_id FROM raw_trials) JOIN part ON mesh_id = 'P' || p_partkey
GROUP BY ALL ORDER BY n_trials DESC, mesh_condition_id, mesh_condition_name LIMIT 40"""


def _top_conditions(spark, sf_dir, **options):
    return top_dimension_values(
        shapes.raw_trials(spark, sf_dir),
        "mesh_conditions_ids",
        shapes.condition_dim(spark, sf_dir),
        "mesh_condition_id",
        "mesh_condition_name",
        40,
        **options,
    )


@query("condition_topn", CONDITION_TOPN_SQL)
def condition_topn(spark, sf_dir):
    return _top_conditions(spark, sf_dir)


@query("condition_topn_by_cells", CONDITION_TOPN_SQL)
def condition_topn_by_cells(spark, sf_dir):
    """The same by hash cells, as large inputs have it."""
    return _top_conditions(spark, sf_dir, plain_bytes=0)


PARAMETERS = ["study_type", "primary_purpose", "lead_sponsor_class", "sex", "phase"]


@query(
    "param_combinations",
    f"""WITH {RAW_TRIALS_SQL}
SELECT DISTINCT study_type, primary_purpose, lead_sponsor_class, sex, phase FROM raw_trials""",
)
def param_combinations(spark, sf_dir):
    return shapes.raw_trials(spark, sf_dir).select(*PARAMETERS).distinct()


@query(
    "param_lists",
    f"WITH {RAW_TRIALS_SQL} "
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM raw_trials WHERE {c} IS NOT NULL"
        for c in PARAMETERS
    ),
)
def param_lists(spark, sf_dir):
    return dims.parameter_lists(shapes.raw_trials(spark, sf_dir), PARAMETERS)


@query(
    "geo_lists",
    """SELECT 'country' AS kind, r_name AS name FROM region
WHERE r_regionkey IN (SELECT n_regionkey FROM nation JOIN supplier ON s_nationkey = n_nationkey)
UNION ALL
SELECT DISTINCT 'city', p_name FROM part
WHERE NOT regexp_matches(p_name, '[0-9]|^''s-|\\(|\\?')""",
)
def geo_lists(spark, sf_dir):
    pairs = dims.places(shapes.places(spark, sf_dir))
    countries = dims.country_list(pairs).select(
        F.lit("country").alias("kind"), F.col("country").alias("name")
    )
    cities = dims.city_list(
        table(spark, sf_dir, "part").select(F.col("p_name").alias("city"))
    ).select(F.lit("city").alias("kind"), F.col("city").alias("name"))
    return countries.unionByName(cities)


@query(
    "regex_exclude",
    r"""SELECT DISTINCT city FROM (
  SELECT regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS city FROM pages
  UNION ALL SELECT p_name FROM part UNION ALL SELECT n_name FROM nation)
WHERE NOT regexp_matches(city, '[0-9]|^''s-|\(|\?')""",
)
def regex_exclude(spark, sf_dir):
    names = (
        table(spark, sf_dir, "pages")
        .select(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1).alias("city"))
        .unionByName(table(spark, sf_dir, "part").select(F.col("p_name").alias("city")))
        .unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("city")))
    )
    return dims.city_list(names)


@query(
    "geo_filter",
    f"""WITH {SITES_SQL}
SELECT country, city, count(*) AS n_rows FROM keyed WHERE country IN ('ASIA', 'EUROPE') GROUP BY ALL""",
)
def geo_filter(spark, sf_dir):
    chosen = dims.within_places(
        gold.with_geo_key(_usable(spark, sf_dir)), countries=["ASIA", "EUROPE"]
    )
    return chosen.groupBy("country", "city").agg(F.count("*").alias("n_rows"))


@query(
    "geo_semi_filter",
    f"""WITH {SITES_SQL}
SELECT country, city, count(*) AS n_rows FROM keyed
WHERE city IN (SELECT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey
               GROUP BY n_name HAVING avg(c_acctbal) > 4500) GROUP BY ALL""",
)
def geo_semi_filter(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rich = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("city"))
        .agg(F.avg("c_acctbal").alias("balance"))
        .filter(F.col("balance") > 4500)
    )
    chosen = dims.within_places(gold.with_geo_key(_usable(spark, sf_dir)), chosen=rich)
    return chosen.groupBy("country", "city").agg(F.count("*").alias("n_rows"))


@query(
    "name_lookup",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, min(s.s_name) AS s_name, min(s2.s_suppkey) AS found_id
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem) l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s2
  ON right(s2.s_name, 1) = right(s.s_name, 1) GROUP BY 1, 2, 3""",
)
def name_lookup(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey"
    ).distinct()
    named = rows.join(
        supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey", "left"
    )
    # Names cut to their last character repeat; the smallest id of each counts.
    last = F.substring("s_name", -1, 1)
    known = supplier.filter(F.col("s_acctbal") > 0).select(
        last.alias("short"), F.col("s_suppkey").alias("found_id")
    )
    named = named.withColumn("short", last)
    return dims.name_to_id(named, known, "short", "short", "found_id").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name", "found_id"
    )


AREA_KEYS = ["standard", "economy", "medium", "promo", "brand1"]


def _area_map(spark, sf_dir):
    """Parts by type, and those of one brand in an area of their own; two types stay unmapped."""
    part = table(spark, sf_dir, "part").withColumn(
        "mesh_id", F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    )
    by_type = part.filter(F.col("p_type").isin("STANDARD", "ECONOMY", "MEDIUM", "PROMO")).select(
        F.lower("p_type").alias("area"), "mesh_id"
    )
    by_brand = part.filter(F.col("p_brand") == "Brand#1").select(
        F.lit("brand1").alias("area"), "mesh_id"
    )
    return by_type.unionByName(by_brand)


AREA_SQL = f"""WITH {RAW_TRIALS_SQL},
m AS (
  SELECT lower(p_type) AS area, 'P' || p_partkey AS mesh_id FROM part
  WHERE p_type IN ('STANDARD', 'ECONOMY', 'MEDIUM', 'PROMO')
  UNION ALL SELECT 'brand1', 'P' || p_partkey FROM part WHERE p_brand = 'Brand#1')
SELECT nct_id, {", ".join(f"max(CASE WHEN area = '{a}' THEN 1 ELSE 0 END) AS area_{a}" for a in AREA_KEYS)},
       max(CASE WHEN area IS NULL THEN 1 ELSE 0 END) AS area_other
FROM (SELECT nct_id, unnest(ids) AS mesh_id FROM raw_trials) LEFT JOIN m USING (mesh_id) GROUP BY nct_id"""


@query("area_multihot", AREA_SQL)
def area_multihot_default(spark, sf_dir):
    trials = shapes.raw_trials(spark, sf_dir).select("nct_id", "mesh_conditions_ids")
    marked = area_multihot(trials, _area_map(spark, sf_dir), "mesh_conditions_ids", AREA_KEYS)
    return marked.drop("mesh_conditions_ids")


@query(
    "area_multihot_repeated",
    f"""WITH flags AS ({AREA_SQL})
SELECT CASE WHEN nct_id LIKE '%0' THEN NULL ELSE left(nct_id, 4) END AS nct_id, flags.* EXCLUDE (nct_id)
FROM flags""",
)
def area_multihot_repeated(spark, sf_dir):
    """Rows with repeated and NULL keys: every row has the flags of its own list."""
    short = F.when(~F.col("nct_id").endswith("0"), F.substring("nct_id", 1, 4))
    trials = shapes.raw_trials(spark, sf_dir).select(short.alias("nct_id"), "mesh_conditions_ids")
    known = _area_map(spark, sf_dir).unionByName(
        _area_map(spark, sf_dir).select("area", F.lit(None).cast("string").alias("mesh_id"))
    )
    marked = area_multihot(trials, known, "mesh_conditions_ids", AREA_KEYS)
    return marked.drop("mesh_conditions_ids")


@query(
    "rank_sites_by_history",
    f"""WITH {TRIALS_SQL}, {SITES_SQL}, {HISTORY_SQL}
SELECT country, city, zip, n_trials,
       row_number() OVER (PARTITION BY country ORDER BY n_trials DESC, city, zip) AS rank FROM history""",
)
def rank_sites_by_history(spark, sf_dir):
    history = _history(spark, sf_dir).select("country", "city", "zip", "n_trials")
    order = [F.col("n_trials").desc(), F.col("city"), F.col("zip")]
    return distributed_rank(history, ["country"], order)


@query(
    "cold_start",
    f"""WITH {TRIALS_SQL}, {SITES_SQL},
recent AS (SELECT * FROM trials WHERE study_type = 'OBSERVATIONAL' AND phase = '1-URGENT'),
h AS (SELECT zip, count(*) AS n FROM keyed JOIN recent USING (nct_id) GROUP BY zip)
SELECT s_name, CASE WHEN n IS NULL THEN 'cold' ELSE 'known' END AS state, n AS n_trials
FROM supplier LEFT JOIN h ON zip = 'Z' || s_suppkey""",
)
def cold_start(spark, sf_dir):
    from accrual.ml.ranking import split_cold_sites

    recent = shapes.trials(spark, sf_dir).filter(
        (F.col("study_type") == "OBSERVATIONAL") & (F.col("phase") == "1-URGENT")
    )
    history = gold.site_history(_usable(spark, sf_dir), recent, orphans="drop").select(
        "zip", "n_trials", "avg_velocity"
    )
    candidates = table(spark, sf_dir, "supplier").select(
        "s_name", F.concat(F.lit("Z"), F.col("s_suppkey").cast("string")).alias("zip")
    ).join(history, "zip", "left")
    known, cold = split_cold_sites(candidates)
    return known.select("s_name", F.lit("known").alias("state"), "n_trials").unionByName(
        cold.select("s_name", F.lit("cold").alias("state"), "n_trials")
    )
