"""Writing and reading back: layers, CSV, topics, continuous loads. The answers are the tables' own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from accrual.queries.registry import query
from accrual.queries.shapes import table
from accrual.session import checkpoint_dir
from accrual.sources.landing import land_raw, reject_raw
from accrual.sources.tables import append_table, export_csv, load_csv, refresh_table, stamped
from accrual.sources.topics import (
    decode_json,
    read_topic,
    split_bad_records,
    stream_topic,
    write_topic,
)
from accrual.streaming import loader


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


@query(
    "append_and_refresh",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, 2 AS deliveries, TRUE AS stamped FROM orders
WHERE o_orderstatus <> 'P'""",
)
def append_and_refresh(spark, sf_dir):
    """A layer that is replaced as a whole and then takes two appended deliveries of its rows."""
    folder = _folder(spark, "layer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    refresh_table(orders.withColumn("gone", F.lit(1)), folder)
    final = stamped(orders.filter("o_orderstatus <> 'P'"))
    refresh_table(final.limit(0), folder)
    for _ in range(2):
        append_table(final, folder)
    return (
        spark.read.parquet(folder)
        .groupBy("o_orderkey", "o_orderstatus", "o_totalprice")
        .agg(
            F.count("*").cast("int").alias("deliveries"),
            F.every(F.col("transformed_at").isNotNull()).alias("stamped"),
        )
    )


@query(
    "csv_roundtrip",
    """SELECT 'T' || o_orderkey AS nct_id, o_custkey, o_totalprice,
       o_orderstatus || '|' || o_orderpriority AS labels FROM orders""",
)
def csv_roundtrip(spark, sf_dir):
    """Orders exported with their labels as one text, and loaded with a declared schema."""
    folder = _folder(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("nct_id"),
        "o_custkey",
        "o_totalprice",
        F.array("o_orderstatus", "o_orderpriority").alias("labels"),
    )
    export_csv(orders, folder)
    return load_csv(spark, folder, "nct_id string, o_custkey long, o_totalprice double, labels string")


def _changes(spark, sf_dir):
    """Events as records: each user's row, stated anew with every event."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("nct_id"),
        F.col("event_id").alias("enrollment_count"),
        F.col("event_type").alias("brief_title"),
        F.col("ts").alias("at"),
    )


def _loaded(spark, sf_dir, name: str, first_wins: bool):
    """All events loaded as a stream of several batches, with a snapshot after the first ones."""
    folder = _folder(spark, name)
    source = _changes(spark, sf_dir)
    record = "nct_id string, enrollment_count bigint, brief_title string"
    apply = loader.record_changes(folder, record, ["nct_id"], envelope=False)
    for part in range(2):
        chosen = source.filter(F.pmod("enrollment_count", F.lit(2)) == part)
        records = chosen.select(
            F.col("nct_id").alias("key"),
            F.to_json(F.struct("nct_id", "enrollment_count", "brief_title")).alias("value"),
            F.col("at").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("partition"),
            F.col("enrollment_count").alias("offset"),
        )
        records.write.mode("append").json(f"{folder}/in")
        stream = stream_topic(spark, "events", files=f"{folder}/in", max_per_trigger=2)
        loader.stream_load(stream, apply, f"{folder}/checkpoint").awaitTermination()
        if part == 0:
            loader.compact(
                spark,
                folder,
                lambda upto: loader.current_rows(spark, folder, ["nct_id"], first_wins, upto),
                f"{folder}/checkpoint",
            )
            loader.prune(spark, folder)
    rows = loader.current_rows(spark, folder, ["nct_id"], first_wins)
    return rows.select("nct_id", "enrollment_count", "brief_title")


LOADED_SQL = """SELECT CAST(user_id AS VARCHAR) AS nct_id, event_id AS enrollment_count, event_type AS brief_title
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {0}, event_id {0}) AS place FROM events)
WHERE place = 1"""


@query("stream_newest", LOADED_SQL.format("DESC"))
def stream_newest(spark, sf_dir):
    """The newest record of each key from a continuous load equals the batch answer."""
    return _loaded(spark, sf_dir, "newest", first_wins=False)


@query("stream_first", LOADED_SQL.format("ASC"))
def stream_first(spark, sf_dir):
    """The first record of each key, whatever was in the snapshot when it arrived."""
    return _loaded(spark, sf_dir, "first", first_wins=True)


@query(
    "topic_publish",
    "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name, p_size FROM part",
)
def topic_publish(spark, sf_dir):
    """Parts published as keyed records and read again."""
    folder = _folder(spark, "topic")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    write_topic(parts, "p_partkey", "parts", files=folder)
    back = read_topic(spark, "parts", files=folder)
    data = F.from_json("value", "p_name string, p_size int")
    return back.select("key", data["p_name"].alias("p_name"), data["p_size"].alias("p_size"))


@query(
    "raw_landing",
    """SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'landed' WHEN 'O' THEN
         CASE WHEN o_orderkey % 2 = 0 THEN 'not a JSON object' ELSE 'repeated key' END
       ELSE 'missing id' END AS outcome FROM orders""",
)
def raw_landing(spark, sf_dir):
    """Orders as documents: good ones, ones with trailing text, with a repeated key, without an id."""
    number = F.col("o_orderkey").cast("string")
    study = F.format_string('{"protocolSection":{"identificationModule":{"nctId":"%s"}}}', number)
    status, even = F.col("o_orderstatus"), F.col("o_orderkey") % 2 == 0
    value = (
        F.when(status == "F", study)
        .when((status == "O") & even, F.concat(study, F.lit(" tail")))
        .when(status == "O", F.regexp_replace(study, r"^\{", '{"a":1,"a":2,'))
        .otherwise(F.lit('{"protocolSection":{}}'))
    )
    topic = table(spark, sf_dir, "orders").select(
        number.alias("key"),
        value.alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
    )
    landed = land_raw(topic).select(F.col("offset").alias("o_orderkey"), F.lit("landed").alias("outcome"))
    rejected = reject_raw(topic).select(F.col("offset").alias("o_orderkey"), F.col("reason").alias("outcome"))
    return landed.unionByName(rejected)


@query(
    "ill_typed_field",
    """SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
       CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events""",
)
def ill_typed_field(spark, sf_dir):
    """A third of the records has one field of the wrong type; all records and other fields stay."""
    wrong = F.when(F.col("event_id") % 3 == 0, F.lit('"x"')).otherwise(F.to_json(F.struct("value")))
    v = F.regexp_replace(wrong, r'^\{"value":|\}$', "")
    text = F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(',"v":'), v, F.lit("}"))
    topic = table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    good, bad = split_bad_records(decode_json(topic, "k int, v double"), ["k"])
    return good.select("event_id", "data.k", "data.v").unionByName(
        bad.select("event_id", F.lit(None).cast("int").alias("k"), F.lit(None).cast("double").alias("v"))
    )
