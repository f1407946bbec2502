"""Frequency, quantile and column-profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from accrual.operators import profiles, values
from accrual.operators.order_stats import nearest_rank_quantiles
from accrual.queries.registry import NUDGE, query, settled
from accrual.queries.shapes import table
from accrual.sources.topics import spread

WORDS_SQL = """
words AS (
  SELECT * FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+')) AS value FROM documents)
  WHERE value <> '')
"""


def _words(spark, sf_dir):
    split = F.split("text", r"[ \t\n\x0B\f\r]+")
    # A small file is one row group, and its texts would be split in one task.
    return spread(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "lang", "source", F.filter(split, lambda w: w != "").alias("words")
    )


TOPN_SQL = f"""WITH {WORDS_SQL}
SELECT value, count(*) AS n FROM words GROUP BY value ORDER BY n DESC, value LIMIT 40"""


@query("topn_values", TOPN_SQL)
def topn_values(spark, sf_dir):
    return values.top_list_values(_words(spark, sf_dir), "words", 40)


@query("topn_by_cells", TOPN_SQL)
def topn_by_cells(spark, sf_dir):
    """The same by hash cells and an exact count of what they leave, as large inputs have it."""
    return values.top_list_values(_words(spark, sf_dir), "words", 40, plain_bytes=0)


@query(
    "topn_missing",
    f"""WITH {WORDS_SQL}
SELECT value, count(*) AS n FROM words WHERE doc_id NOT IN (SELECT doc_id FROM labels)
GROUP BY value ORDER BY n DESC, value LIMIT 40""",
)
def topn_missing(spark, sf_dir):
    tags = table(spark, sf_dir, "labels").select("doc_id", F.array("quality").alias("tags"))
    tagged = _words(spark, sf_dir).join(tags, "doc_id", "left")
    return values.top_list_values(tagged, "words", 40, lacking="tags")


@query(
    "distinct_values",
    f"WITH {WORDS_SQL} SELECT count(DISTINCT value) AS n_distinct FROM words",
)
def distinct_values(spark, sf_dir):
    return values.distinct_list_values(_words(spark, sf_dir), "words")


@query(
    "case_variants",
    f"""WITH {WORDS_SQL}
SELECT lower(value) AS normalized, count(DISTINCT value) AS variant_count,
       array_to_string(list_sort(list(DISTINCT value)), '|') AS variants
FROM words GROUP BY 1 HAVING count(DISTINCT value) > 1
ORDER BY variant_count DESC, normalized LIMIT 15""",
)
def case_variants(spark, sf_dir):
    words = _words(spark, sf_dir).select(F.explode("words").alias("value"))
    return values.case_variants(words, "value").withColumn(
        "variants", F.array_join("variants", "|")
    )


@query(
    "sample_rows",
    """SELECT doc_id, source, n_chars FROM documents WHERE length(text) > 0 ORDER BY source, doc_id LIMIT 20""",
)
def sample_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "n_chars", F.split("text", "\n").alias("lines")
    )
    return values.sample_rows(documents, "lines", 20, ["source", "doc_id"]).drop("lines")


@query(
    "array_len_stats",
    f"""WITH {WORDS_SQL},
sizes AS (SELECT documents.doc_id, count(value) AS n FROM documents LEFT JOIN words USING (doc_id) GROUP BY 1)
SELECT 'words' AS "column", count(*) AS n_lists, min(n) AS min, max(n) AS max,
       quantile_cont(n, 0.5) AS median, round(quantile_cont(n, 0.99) + 1e-9, 6) AS p99 FROM sizes""",
)
def array_len_stats(spark, sf_dir):
    stats = profiles.list_length_stats(_words(spark, sf_dir), ["words"])
    return stats.withColumn("p99", settled("p99"))


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


def _numeric_sql(column, source):
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", count(*) AS row_count, count({column}) AS n,
  count(*) - count({column}) AS null_count,
  round(100.0::DOUBLE * (count(*) - count({column})) / count(*), 1) AS null_pct,
  round(avg({v}) + 1e-9, 6) AS mean, min({v}) AS min, max({v}) AS max,
  round(quantile_cont({v}, 0.25) + 1e-9, 6) AS p25, round(quantile_cont({v}, 0.5) + 1e-9, 6) AS median,
  round(quantile_cont({v}, 0.75) + 1e-9, 6) AS p75, round(quantile_cont({v}, 0.99) + 1e-9, 6) AS p99,
  concat_ws(',', CASE WHEN count({column}) = 0 THEN 'ENTIRELY NULL' END,
    CASE WHEN min({column}) = max({column}) THEN 'CONSTANT' END,
    CASE WHEN quantile_cont({v}, 0.99) > 0 AND max({column}) > 10 * quantile_cont({v}, 0.99)
         THEN 'SURPRISING DISTRIBUTION' END) AS flags FROM {source}"""


def _rounded(profile):
    rounded = ["mean", "p25", "median", "p75", "p99"]
    return profile.select(
        *[settled(c) if c in rounded else F.col(c) for c in profile.columns]
    )


@query("numeric_profile", " UNION ALL ".join(_numeric_sql(c, "lineitem") for c in NUMERIC))
def numeric_profile(spark, sf_dir):
    return _rounded(profiles.numeric_profile(table(spark, sf_dir, "lineitem"), NUMERIC))


@query(
    "numeric_profile_flags",
    "WITH d AS (SELECT quality, toxic, n_chars, CASE WHEN lang = 'en' THEN 1 END AS one, "
    "CAST(NULL AS DOUBLE) AS nothing FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        _numeric_sql(c, "d") for c in ["quality", "toxic", "n_chars", "one", "nothing"]
    ),
)
def numeric_profile_flags(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    frame = documents.select(
        "quality",
        "toxic",
        "n_chars",
        F.when(F.col("lang") == "en", 1).alias("one"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return _rounded(profiles.numeric_profile(frame))


def _boolean_sql(name, expression):
    return f"""SELECT '{name}' AS "column", count(*) AS row_count,
  count(*) FILTER ({expression}) AS true_count, count(*) FILTER (NOT {expression}) AS false_count,
  count(*) FILTER (({expression}) IS NULL) AS null_count,
  round(100.0::DOUBLE * count(*) FILTER (({expression}) IS NULL) / count(*), 1) AS null_pct,
  CASE WHEN count({expression}) = 0 THEN 'ENTIRELY NULL'
       WHEN min(CAST({expression} AS INTEGER)) = max(CAST({expression} AS INTEGER)) THEN 'CONSTANT'
       ELSE '' END AS flags FROM documents LEFT JOIN labels USING (doc_id)"""


@query(
    "boolean_profile",
    " UNION ALL ".join(
        _boolean_sql(*pair)
        for pair in [("good", "(quality = 1)"), ("long", "(n_chars > 500)"), ("any", "(n_chars >= 0)")]
    ),
)
def boolean_profile(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return profiles.boolean_profile(
        documents.select(
            (F.col("quality") == 1).alias("good"),
            (F.col("n_chars") > 500).alias("long"),
            (F.col("n_chars") >= 0).alias("any"),
        )
    )


def _categorical_sql(column, expression, source):
    return f"""SELECT '{column}' AS "column", * FROM (
  WITH c AS (SELECT CAST({expression} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY 1),
  s AS (SELECT CAST(sum(n) AS BIGINT) AS row_count,
          CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS null_count,
          count(value) AS n_distinct, max(n) FILTER (value IS NOT NULL) AS top FROM c),
  p AS (SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS place FROM c WHERE value IS NOT NULL)
  SELECT row_count, null_count, round(100.0::DOUBLE * null_count / row_count, 1) AS null_pct, n_distinct,
    CAST(place AS INTEGER) AS place, value, n AS value_count,
    concat_ws(',', CASE WHEN n_distinct = 1 THEN 'CONSTANT' END,
      CASE WHEN n_distinct > 1 AND top >= CAST(0.95 AS DOUBLE) * (row_count - null_count) THEN 'DOMINANT VALUE' END,
      CASE WHEN n_distinct > 20 THEN 'HIGH CARDINALITY' END) AS flags
  FROM s, p WHERE place <= 20)"""


@query(
    "categorical_profile",
    " UNION ALL ".join(
        _categorical_sql(*spec)
        for spec in [
            ("l_returnflag", "l_returnflag", "lineitem"),
            ("l_linestatus", "l_linestatus", "lineitem"),
            ("ship_month", "strftime(l_shipdate, '%Y-%m')", "lineitem"),
            ("taxed", "CASE WHEN l_tax > 0 THEN 'yes' END", "lineitem"),
            ("usual", "CASE WHEN l_quantity < 50 THEN 'usual' ELSE 'large' END", "lineitem"),
        ]
    ),
)
def categorical_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
        F.when(F.col("l_tax") > 0, "yes").alias("taxed"),
        F.when(F.col("l_quantity") < 50, "usual").otherwise("large").alias("usual"),
    )
    return profiles.categorical_profile(lines)


# Every metric as a number where it is one and as text where it is not.
NUMERIC_METRICS = [
    "row_count", "n", "null_count", "null_pct", "mean", "min", "max", "p25", "median", "p75", "p99",
]


def _tidy_sql(column, kind, source, metrics, flags):
    parts = [
        f"SELECT \"column\", '{kind}' AS kind, '{m}' AS metric, CAST({m} AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS text FROM s"
        for m in metrics
    ]
    parts.append(f"SELECT \"column\", '{kind}', 'flags', NULL, {flags} FROM s")
    return f"(WITH s AS ({source}) {' UNION ALL '.join(parts)})"


def _profile_sql():
    parts = [
        _tidy_sql(c, "numeric", _numeric_sql(c, "o"), NUMERIC_METRICS, "flags")
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    ]
    true, counts = "o_orderpriority = '1-URGENT'", ["row_count", "true_count", "false_count", "null_count", "null_pct"]
    urgent = f"""SELECT 'urgent' AS "column", count(*) AS row_count, count(*) FILTER ({true}) AS true_count,
  count(*) FILTER (NOT ({true})) AS false_count, 0 AS null_count, 0 AS null_pct, '' AS flags FROM o"""
    parts.append(_tidy_sql("urgent", "boolean", urgent, counts, "flags"))
    for c in ("o_orderstatus", "o_orderpriority", "o_orderdate"):
        listed = _categorical_sql(c, c, "o")
        columns = ["row_count", "null_count", "null_pct", "n_distinct"]
        parts.append(_tidy_sql(c, "categorical", f"SELECT * FROM ({listed}) WHERE place = 1", columns, "flags"))
        parts.append(
            f"(SELECT \"column\", 'categorical', 'count of ' || value, CAST(value_count AS DOUBLE), NULL FROM ({listed}))"
        )
    return "WITH o AS (SELECT * FROM orders) SELECT 'orders' AS \"table\", * FROM (" + " UNION ALL ".join(parts) + ")"


@query("table_profile", _profile_sql())
def table_profile(spark, sf_dir):
    """Every metric of every column of the orders, and of one more that is true or false."""
    orders = table(spark, sf_dir, "orders").withColumn("urgent", F.col("o_orderpriority") == "1-URGENT")
    number = F.when(F.col("metric") != "flags", F.col("value")).cast("double")
    rounded = F.round(number + F.lit(NUDGE), 6)
    kept = F.col("metric").isin("mean", "p25", "median", "p75", "p99")
    return profiles.table_profile(orders, "orders").select(
        "table", "column", "kind", "metric",
        F.when(kept, rounded).otherwise(number).alias("number"),
        F.when(F.col("metric") == "flags", F.col("value")).alias("text"),
    )


@query(
    "missing_rate",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(*) AS row_count, count(*) FILTER ({test}) AS missing,
  round(100.0::DOUBLE * count(*) FILTER ({test}) / count(*), 1) AS missing_pct
  FROM documents LEFT JOIN labels USING (doc_id)"""
        for name, test in [
            ("quality", "quality IS NULL"),
            ("lang", "lang IS NULL"),
            ("short", "n_chars > 900 OR length(source) = 4"),
        ]
    ),
)
def missing_rate(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    short = F.when(F.col("n_chars") <= 900, F.when(F.length("source") == 4, "").otherwise("x"))
    return profiles.missing_rates(
        documents.select("quality", "lang", short.alias("short")), ["quality", "lang", "short"]
    )


@query(
    "value_share",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM documents), 1) AS pct
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY {c}"""
        for c in ["lang", "source", "quality"]
    ),
)
def value_share(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return values.value_shares(documents, ["lang", "source", "quality"])


def _nearest_sql(column, source):
    picks = ", ".join(
        f"max(v) FILTER (place = {at}) AS {name}"
        for name, at in [
            ("p50", "floor(total * CAST(0.5 AS DOUBLE))"),
            ("p90", "floor(total * CAST(0.9 AS DOUBLE))"),
            ("p99", "floor(total * CAST(0.99 AS DOUBLE))"),
            ("top", "total - 1"),
        ]
    )
    return f"""SELECT '{column}' AS "column", {picks} FROM (
  SELECT CAST({column} AS DOUBLE) AS v, row_number() OVER (ORDER BY {column}) - 1 AS place,
         count(*) OVER () AS total FROM {source})"""


@query(
    "nearest_rank",
    " UNION ALL ".join(
        [_nearest_sql("l_extendedprice", "lineitem"), _nearest_sql("l_quantity", "lineitem")]
    ),
)
def nearest_rank(spark, sf_dir):
    return nearest_rank_quantiles(
        table(spark, sf_dir, "lineitem"),
        ["l_extendedprice", "l_quantity"],
        {"p50": 0.5, "p90": 0.9, "p99": 0.99, "top": 1.0},
    )


@query(
    "outlier_share",
    """SELECT count(l_extendedprice) AS n, count(*) FILTER (l_extendedprice > 100000) AS outliers,
       round(100.0::DOUBLE * count(*) FILTER (l_extendedprice > 100000) / count(l_extendedprice), 1) AS outlier_pct,
       max(l_extendedprice) AS max FROM lineitem""",
)
def outlier_share(spark, sf_dir):
    return profiles.outlier_share(table(spark, sf_dir, "lineitem"), "l_extendedprice", 100_000)


@query(
    "coverage",
    """SELECT 'labelled' AS "check", count(quality) AS part, count(*) AS whole,
  round(100.0::DOUBLE * count(quality) / count(*), 1) AS pct FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'good among english', count(*) FILTER (lang = 'en' AND quality = 1),
  count(*) FILTER (lang = 'en'),
  round(100.0::DOUBLE * count(*) FILTER (lang = 'en' AND quality = 1) / count(*) FILTER (lang = 'en'), 1)
  FROM documents LEFT JOIN labels USING (doc_id)""",
)
def coverage(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return profiles.coverage(
        documents,
        {
            "labelled": (F.col("quality").isNotNull(), None),
            "good among english": (F.col("quality") == 1, F.col("lang") == "en"),
        },
    )


@query(
    "sum_ratio",
    """SELECT 'discounted' AS ratio, CAST(sum(CASE WHEN l_discount > 0 THEN l_quantity ELSE 0 END) AS BIGINT) AS part,
  CAST(sum(l_quantity) AS BIGINT) AS whole,
  round(avg(CASE WHEN l_discount > 0 THEN l_quantity ELSE 0 END) + 1e-9, 6) AS mean_part,
  round(100.0::DOUBLE * sum(CASE WHEN l_discount > 0 THEN l_quantity ELSE 0 END) / sum(l_quantity), 1) AS pct
FROM lineitem""",
)
def sum_ratio(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_discount") > 0, F.col("l_quantity")).otherwise(0.0).alias("discounted"),
        "l_quantity",
    )
    return profiles.sum_ratios(lines, {"discounted": ("discounted", "l_quantity")}).withColumn(
        "mean_part", settled("mean_part")
    )


@query(
    "mode",
    """WITH c AS (
  SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS n FROM orders GROUP BY ALL
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY ALL)
SELECT "column", value, n FROM c
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""",
)
def mode(spark, sf_dir):
    return values.most_frequent(
        table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"]
    )
