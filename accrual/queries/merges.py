"""Merge operators and referential checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from accrual.operators import merge
from accrual.operators.joins import fk_violations
from accrual.operators.latest import latest_per_key
from accrual.queries.registry import query
from accrual.queries.shapes import table
from accrual.sources.landing import payload_hash


@query(
    "upsert_latest",
    """WITH newest AS (
  SELECT user_id, max({'ts': ts, 'event_id': event_id, 'event_type': event_type, 'value': value}) AS r
  FROM events GROUP BY user_id)
SELECT user_id, r.event_id AS event_id, r.event_type AS event_type, r.value AS value FROM newest""",
)
def upsert_latest(spark, sf_dir):
    """State per user from browsing events, with all other events merged in as one batch that
    holds many records per user, older and newer ones."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", "value"
    )
    browsing = F.col("event_type").isin("view", "click")
    newest_first = [F.col("ts").desc(), F.col("event_id").desc()]
    state = latest_per_key(events.filter(browsing), ["user_id"], newest_first)
    merged = merge.merge_upsert(state, events.filter(~browsing), ["user_id"], ["ts", "event_id"])
    return merged.drop("ts")


@query(
    "insert_absent",
    """WITH old AS (
  SELECT l_partkey, l_suppkey, min(l_shipdate) AS first_ship, 'returned' AS origin
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT l_partkey, l_suppkey, first_ship, origin FROM old
UNION ALL
SELECT l_partkey, l_suppkey, min(l_shipdate), 'shipped' FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.l_partkey = lineitem.l_partkey
                  AND old.l_suppkey = lineitem.l_suppkey) GROUP BY 1, 2""",
)
def insert_absent(spark, sf_dir):
    """A dimension of part and supplier pairs known from returns, completed from all shipments."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_partkey", "l_suppkey"]
    known = (
        lines.filter(F.col("l_returnflag") == "R")
        .groupBy(*keys)
        .agg(F.min("l_shipdate").alias("first_ship"))
        .withColumn("origin", F.lit("returned"))
    )
    shipped = lines.select(
        *keys, F.col("l_shipdate").alias("first_ship"), F.lit("shipped").alias("origin")
    )
    return merge.insert_absent(known, shipped, keys, ["first_ship"])


@query(
    "replace_children",
    """SELECT o_custkey, o_orderkey, o_orderstatus,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS version
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment <> 'BUILDING' OR o_orderstatus <> 'F'""",
)
def replace_children(spark, sf_dir):
    """Orders of building customers delivered anew without the finished ones; a customer with
    only finished orders ends up with none. The delivery is in the batch twice."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    building = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_custkey").alias("o_custkey"), F.lit(2).alias("version"))
    )
    again = orders.filter(F.col("o_orderstatus") != "F").join(building, "o_custkey")
    return merge.replace_children(
        orders.withColumn("version", F.lit(1)),
        building,
        again.unionByName(again),
        ["o_custkey"],
        "version",
        "o_orderkey",
    )


@query(
    "fk_violations",
    """SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
)
def fk_check(spark, sf_dir):
    active = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    return fk_violations(table(spark, sf_dir, "orders"), active, ["o_custkey"], ["c_custkey"])


@query(
    "changed_payloads",
    """SELECT o_orderkey AS nct_id FROM orders WHERE o_orderpriority = '1-URGENT'
OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def changed_payloads(spark, sf_dir):
    """Orders whose document changed (urgent ones) or that are not stored yet (those without
    lines). The landed documents spell their keys in another order and with other white space."""
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    known = F.format_string('{"status":"%s","customer":%s}', status, key)
    older = F.format_string('{"status":"%s","customer":%s,"old":true}', status, key)
    stored_text = F.when(F.col("o_orderpriority") == "1-URGENT", older).otherwise(known)
    stored = (
        orders.join(
            table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")),
            "o_orderkey",
            "left_semi",
        )
        .select(F.col("o_orderkey").alias("nct_id"), payload_hash(stored_text).alias("payload_hash"))
    )
    again = F.format_string('{ "customer" : %s, "status" : "%s" }', key, status)
    landed = orders.select(F.col("o_orderkey").alias("nct_id"), payload_hash(again).alias("payload_hash"))
    return merge.changed_payloads(stored, landed).select("nct_id")
