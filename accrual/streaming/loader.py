"""Topic-to-table loading with Structured Streaming.

A load appends each micro-batch to a change table, one folder per batch: its cost follows the
batch, not the table. The table's current rows are the newest change per key, and ``compact``
folds changes into a snapshot so that reads stay short. A batch that is replayed after a failure
overwrites its own folder, which makes at-least-once delivery harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accrual.operators.latest import latest_per_key
from accrual.operators.merge import merge_first, merge_upsert, replace_children, upsert_raw
from accrual.sources.files import delete, names
from accrual.sources.landing import land_raw, reject_raw
from accrual.sources.topics import CORRUPT, decode_json, split_bad_records

ARRIVAL = ["timestamp", "partition", "offset"]
FILES_PER_BATCH = 4


def newest_first() -> list[Column]:
    return [F.col(c).desc() for c in ARRIVAL]


def oldest_first() -> list[Column]:
    return [F.col(c).asc() for c in ARRIVAL]


def stream_load(
    records: DataFrame,
    apply_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    drain: bool = True,
    interval: str = "3 seconds",
) -> StreamingQuery:
    """Start feeding micro-batches of ``records`` to ``apply_batch(batch, batch_id)``.

    ``drain`` processes what is there now and stops; wait for it with ``awaitTermination``.
    Otherwise the query keeps running, one batch per ``interval``.
    """
    writer = records.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def record_changes(
    folder: str, schema: str, required: list[str], envelope: bool = True, mode: str = "PERMISSIVE"
) -> Callable[[DataFrame, int], None]:
    """A batch writer: decoded records to ``folder/changes``, bad ones to ``folder/quarantine``.

    ``mode="FAILFAST"`` stops the query at the first undecodable record instead.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_json(batch, schema, envelope, mode).persist()
        good, bad = split_bad_records(decoded, required)
        _write_batch(good.select("data.*", *ARRIVAL), f"{folder}/changes", batch_id, [CORRUPT])
        _write_batch(
            bad.select("key", "value", "reason", *ARRIVAL), f"{folder}/quarantine", batch_id
        )
        decoded.unpersist()

    return apply


def record_raw(folder: str) -> Callable[[DataFrame, int], None]:
    """A batch writer: whole documents with id and content hash to ``folder/changes``, the others to
    ``folder/quarantine``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        _write_batch(land_raw(batch), f"{folder}/changes", batch_id)
        _write_batch(reject_raw(batch), f"{folder}/quarantine", batch_id)
        batch.unpersist()

    return apply


def _write_batch(rows: DataFrame, path: str, batch_id: int, drop: list[str] | None = None) -> None:
    """Write a batch as one folder of at most ``FILES_PER_BATCH`` files."""
    rows.drop(*(drop or [])).coalesce(FILES_PER_BATCH).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _read(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame | None:
    try:
        return spark.read.format(file_format).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def batches(spark: SparkSession, folder: str) -> list[int]:
    """Batches whose folders are there, in order; ``prune`` keeps them few."""
    there = names(spark, f"{folder}/changes")
    return sorted(int(n.split("=")[1]) for n in there if n.startswith("batch_id="))


def committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that the load with this checkpoint has finished."""
    done = [int(n) for n in names(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(done, default=None)


def changes(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """Changes not yet in a snapshot (and of batches to ``upto`` at most), with their ``batch_id``.

    Only the folders of those batches are named to Spark; older ones are neither listed nor read.
    """
    through = _snapshot_through(spark, folder)
    there = batches(spark, folder)
    if not there:
        raise FileNotFoundError(f"nothing was loaded into {folder}")
    wanted = [
        b for b in there if (through is None or b > through) and (upto is None or b <= upto)
    ]
    reader = spark.read.option("basePath", f"{folder}/changes")
    if not wanted:
        return reader.parquet(f"{folder}/changes/batch_id={there[-1]}").limit(0)
    return reader.parquet(*[f"{folder}/changes/batch_id={b}" for b in wanted])


def _snapshot_through(spark: SparkSession, folder: str) -> int | None:
    log = _read(spark, f"{folder}/snapshots_done", "json")
    return None if log is None else log.agg(F.max("through")).first()[0]


def _snapshot(spark: SparkSession, folder: str) -> DataFrame | None:
    through = _snapshot_through(spark, folder)
    return None if through is None else spark.read.parquet(f"{folder}/snapshots/{through}")


def current_rows(
    spark: SparkSession,
    folder: str,
    keys: list[str],
    first_wins: bool = False,
    upto: int | None = None,
) -> DataFrame:
    """The table as of now: the newest record per key.

    ``first_wins`` keeps the oldest record of a key instead. See ``merge_upsert`` and
    ``merge_first`` for how the changes meet the snapshot; when snapshots were made does not matter.
    """
    fresh = changes(spark, folder, upto).drop("batch_id")
    base = _snapshot(spark, folder)
    if base is None:
        order = oldest_first() if first_wins else newest_first()
        return latest_per_key(fresh.dropna(subset=keys), keys, order)
    if first_wins:
        return merge_first(base, fresh, keys, ARRIVAL)
    return merge_upsert(base, fresh, keys, ARRIVAL)


def current_raw(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """Raw documents as of now: newest payload per id, with the time the id was first received."""
    rows = changes(spark, folder, upto).drop("batch_id")
    first = rows.groupBy("nct_id").agg(F.min("received_at").alias("received_at"))
    newest = latest_per_key(rows, ["nct_id"], [*newest_first(), F.col("payload_hash").desc()])
    fresh = newest.drop("received_at").join(first, "nct_id").select(*rows.columns)
    base = _snapshot(spark, folder)
    return fresh if base is None else upsert_raw(base, fresh)


def current_children(
    spark: SparkSession,
    folder: str,
    parents: DataFrame,
    key: list[str],
    version: str,
    ordinal: str,
    upto: int | None = None,
) -> DataFrame:
    """Child rows of each parent's newest version; ``parents`` lists (key, version) of all parent
    records, so a version that has no children clears the older ones."""
    fresh = changes(spark, folder, upto).drop("batch_id", *ARRIVAL)
    base = _snapshot(spark, folder)
    target = fresh.limit(0) if base is None else base
    return replace_children(target, parents, fresh, key, version, ordinal)


def compact(
    spark: SparkSession,
    folder: str,
    current: Callable[[int], DataFrame],
    checkpoint: str | None = None,
) -> int:
    """Write ``current(through)`` as the new snapshot; returns the batch it reaches through.

    ``current`` calls ``current_rows``, ``current_children`` or ``current_raw`` with ``upto``. With the
    ``checkpoint`` of a load only batches that the load has committed are taken, so it may be writing
    its next one meanwhile; without one no load may be running. The snapshot is a new folder, and it
    counts from the moment its number is appended to the list of finished ones, so a reader or a crash
    in between still finds the previous state. With no new batch there is nothing to do.
    """
    through = max(batches(spark, folder), default=None)
    if checkpoint is not None:
        done = committed(spark, checkpoint)
        through = done if through is None or done is None else min(through, done)
    before = _snapshot_through(spark, folder)
    if through is None or (before is not None and through <= before):
        return before
    current(through).write.mode("overwrite").parquet(f"{folder}/snapshots/{through}")
    done = spark.range(1).select(F.lit(through).cast("bigint").alias("through"))
    done.coalesce(1).write.mode("append").json(f"{folder}/snapshots_done")
    return through


def prune(spark: SparkSession, folder: str, keep_snapshots: int = 2) -> None:
    """Delete batches that the oldest kept snapshot holds, and snapshots before it.

    Run it when no reader is on a snapshot older than the last ``keep_snapshots``.
    """
    there = names(spark, f"{folder}/snapshots")
    through = _snapshot_through(spark, folder)
    if through is None:
        return
    kept = sorted(int(n) for n in there if n.isdigit() and int(n) <= through)[-keep_snapshots:]
    for name in there:
        if name.isdigit() and int(name) < kept[0]:
            delete(spark, f"{folder}/snapshots/{name}")
    # The newest batch stays: with nothing newer, its folder gives the table's columns.
    for batch in batches(spark, folder)[:-1]:
        if batch <= kept[0]:
            delete(spark, f"{folder}/changes/batch_id={batch}")


def streaming_latest(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest record per key as a streaming aggregate, for update-mode sinks.

    Its state holds one record per key for as long as the query lives. Where keys keep coming, use
    ``accrual.streaming.quiet``, whose state ends, or record changes and read ``current_rows``.
    """
    rest = [c for c in records.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return records.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
