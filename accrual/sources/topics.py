"""Keyed JSON records: bounded topic reads, decoding, bad-record policy, topic writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual import schemas

CORRUPT = "_corrupt_record"


def spread(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` in at least ``partitions`` tasks (as many as there are cores, if not given).

    For costly work on input that lies in few large files or partitions. What is already cut finely
    stays where it is; ``keys`` say how the rest is dealt out.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    # An explicit number, which adaptive execution does not fold together again.
    return df.repartition(wanted, *keys)


def read_topic(
    spark: SparkSession,
    topic: str,
    bootstrap_servers: str | None = None,
    files: str | None = None,
    file_format: str = "json",
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Everything a topic holds now, as ``key, value, timestamp, partition, offset``.

    Reads Kafka from the earliest to the latest offset, or the same columns from ``files``. A topic that
    lies in fewer than ``partitions`` is dealt out by arrival, so that its documents are not parsed in a
    few tasks.
    """
    if files is not None:
        frame = spark.read.schema(schemas.TOPIC).format(file_format).options(**options).load(files)
    else:
        frame = (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .options(**options)
            .load()
        )
    rows = topic_columns(frame)
    return spread(rows, ["timestamp", "partition", "offset"], partitions) if partitions else rows


def stream_topic(
    spark: SparkSession,
    topic: str,
    bootstrap_servers: str | None = None,
    files: str | None = None,
    file_format: str = "json",
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """The streaming twin of :func:`read_topic`; ``max_per_trigger`` caps offsets or files."""
    if files is not None:
        reader = spark.readStream.schema(schemas.TOPIC).format(file_format).options(**options)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return topic_columns(reader.load(files))
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return topic_columns(reader.load())


def topic_columns(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
        "partition",
        "offset",
    )


def unwrap_envelope(value: Column | str) -> Column:
    """The record inside a ``{"value": ...}`` envelope, or the text itself when there is none.

    ``get_json_object`` yields the inner text for both spellings: an embedded object and an
    object spelled as a JSON string.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.get_json_object(value, "$.value"), value)


def decode_json(
    topic: DataFrame,
    schema: str,
    envelope: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Topic rows plus ``data`` (the decoded struct) and ``_corrupt_record``.

    Unknown fields are dropped and missing ones are NULL. A field of the wrong type is NULL too and
    the rest of its document stays; the text is then kept in ``_corrupt_record`` as a warning. Only
    text that is not one JSON object leaves ``data`` NULL. ``mode="FAILFAST"`` raises instead.
    """
    value = unwrap_envelope("value") if envelope else F.col("value")
    if mode == "FAILFAST":
        parsed = F.from_json(value, schema, {"mode": "FAILFAST"})
        return computed_once(topic, {"data": parsed}).withColumn(
            CORRUPT, F.lit(None).cast("string")
        )
    parsed = F.from_json(
        value, f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}
    )
    # The second look at the text is only taken where the first one found fault.
    faulty = F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull()
    readable = F.when(faulty, is_json_object(value)).otherwise(True)
    return computed_once(topic, {"_parsed": parsed}).select(
        *topic.columns,
        F.when(readable, F.col("_parsed")).alias("data"),
        F.when(faulty & F.col("value").isNotNull(), F.col("value")).alias(CORRUPT),
    )


def is_json_object(text: Column) -> Column:
    """Whether ``text`` is exactly one JSON object, with nothing after it. Never NULL."""
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(alone & F.ltrim(text).startswith("{"), F.lit(False))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` plus columns that later filters read instead of computing again.

    A filter on a plain projected column is pushed below the projection, with the expression
    copied into it at every mention; for JSON that means parsing each document several times.
    Filters on generated columns stay above the generator.
    """
    once = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(once)))


def split_bad_records(decoded: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): bad rows are undecodable or lack a required field of ``data``.

    Rows that lost only a field of the wrong type are good. Quarantined rows carry a ``reason``. Both frames are lazy filters over the same decode;
    persist ``decoded`` when both are going to be written.
    """
    reason = F.when(F.col("data").isNull(), F.lit("undecodable"))
    for field in required:
        reason = F.coalesce(
            reason, F.when(F.col(f"data.{field}").isNull(), F.lit(f"missing {field}"))
        )
    tagged = decoded.withColumn("reason", reason)
    return (
        tagged.filter(F.col("reason").isNull()).drop("reason", CORRUPT),
        tagged.filter(F.col("reason").isNotNull()),
    )


def keyed_json(df: DataFrame, key: str, ignore_nulls: bool = False) -> DataFrame:
    """``key`` and ``value`` columns, the value being the whole row as JSON, NULL fields kept."""
    options = {"ignoreNullFields": str(ignore_nulls).lower()}
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*"), options).alias("value")
    )


def write_topic(
    df: DataFrame,
    key: str,
    topic: str,
    bootstrap_servers: str | None = None,
    files: str | None = None,
    file_format: str = "json",
    mode: str = "append",
    **options: str,
) -> None:
    """Write every row as a keyed JSON record, to Kafka or to files.

    ``options`` go to the sink, among them any ``kafka.`` producer setting.
    """
    records = keyed_json(df, key)
    if files is not None:
        records.write.mode(mode).format(file_format).options(**options).save(files)
        return
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
