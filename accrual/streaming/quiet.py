"""Newest record per key from a stream whose keys come and go, with state that ends.

A key is held while it is active: from its first record until it has been quiet for a given time.
Then its newest record goes to the sink and its state is dropped, so the state follows the keys that
are active now, not all keys ever seen. A key that comes back is held anew, and its next result
follows the earlier one; ``newest_of`` reads the table that the results make.

Time is event time. Records older than the watermark (the newest event time seen in earlier batches
less ``late``) are late: they are left out and counted by ``dropped_late``. Everything else has its say,
in whatever order and batches it arrives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accrual.operators.latest import latest_per_key

QUIET_SINCE, RECORDS = "quiet_since", "n_records"


def latest_when_quiet(
    records: DataFrame, keys: list[str], order: list[str], event_time: str, quiet: str, late: str
) -> DataFrame:
    """One row per key and active spell: its newest record by ``order``, ``quiet_since`` and ``n_records``.

    ``quiet`` is the gap that ends a spell, ``late`` how far records may lag behind. For append-mode
    sinks: a row comes when the watermark has passed the end of its spell. Records without a key or an
    event time are left out. State is one record per active key; the grouping is Spark's own session
    window, so spells that a late-coming record connects become one.
    """
    rest = [c for c in records.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    spell = F.session_window(event_time, quiet).alias("_spell")
    return (
        records.dropna(subset=[*keys, event_time])
        .withWatermark(event_time, late)
        .groupBy(*keys, spell)
        .agg(newest, F.count("*").alias(RECORDS))
        .select(*keys, "_newest.*", F.col("_spell.end").alias(QUIET_SINCE), RECORDS)
    )


def append_when_quiet(
    records: DataFrame,
    folder: str,
    keys: list[str],
    order: list[str],
    event_time: str,
    quiet: str,
    late: str,
    drain: bool = True,
    interval: str = "3 seconds",
) -> StreamingQuery:
    """Start appending the results of ``latest_when_quiet`` to ``folder/rows``, each exactly once.

    ``drain`` processes what is there now and stops. Keys that are still active then stay in the
    checkpoint and go on when the load is started again.
    """
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return (
        latest_when_quiet(records, keys, order, event_time, quiet, late)
        .writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def newest_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest record per key among the appended rows; equal to the batch answer over all records
    of ended spells that were not late."""
    order = [F.col(c).desc() for c in order]
    return latest_per_key(rows.drop(QUIET_SINCE, RECORDS), keys, order)


def held_keys(query: StreamingQuery) -> int:
    """Rows of state after the query's last batch."""
    return sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])


def dropped_late(query: StreamingQuery) -> int:
    """Late records left out in the batches that the query still reports."""
    return sum(
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
    )
