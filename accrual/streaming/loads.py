"""The continuous loads of the five record topics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from accrual import schemas
from accrual.sources.topics import stream_topic
from accrual.streaming import loader


@dataclass(frozen=True)
class Load:
    """What one topic carries and how its table treats a repeated key."""

    schema: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    first_wins: bool = False


LOADS = {
    "trials": Load(f"{schemas.SILVER_TRIALS}, version timestamp", ("nct_id",), ("nct_id",)),
    "sites": Load(
        f"{schemas.SILVER_SITES}, site_ordinal int, version timestamp", ("nct_id",), ("nct_id",)
    ),
    "features": Load(schemas.GOLD_TRIAL_FEATURES, ("nct_id",), ("nct_id",)),
    "conditions": Load(
        schemas.GOLD_DIM_CONDITIONS,
        ("mesh_condition_id",),
        ("mesh_condition_id", "mesh_condition_name"),
        first_wins=True,
    ),
}


def start(
    spark: SparkSession, name: str, folder: str, drain: bool = True, **source
) -> StreamingQuery:
    """Start one load into ``folder``: ``raw`` or a name in ``LOADS``.

    ``source`` goes to ``stream_topic``: Kafka servers or a folder of files. Each load has its own
    checkpoint, so each is awaited and restarted by itself.
    """
    stream = stream_topic(spark, source.pop("topic", name), **source)
    if name == "raw":
        apply = loader.record_raw(folder)
    else:
        load = LOADS[name]
        apply = loader.record_changes(folder, load.schema, list(load.required))
    return loader.stream_load(stream, apply, f"{folder}/checkpoint", drain=drain)


def current(
    spark: SparkSession,
    name: str,
    folder: str,
    parents: DataFrame | None = None,
    upto: int | None = None,
) -> DataFrame:
    """The loaded table as of now. Sites also take (nct_id, version) of all trial deliveries, which
    are the ``version`` and key of the trials load."""
    if name == "raw":
        return loader.current_raw(spark, folder, upto)
    load = LOADS[name]
    if name == "sites":
        if parents is None:
            parents = loader.changes(spark, folder, upto).select("nct_id", "version")
        return loader.current_children(
            spark, folder, parents, ["nct_id"], "version", "site_ordinal", upto
        )
    return loader.current_rows(spark, folder, list(load.keys), load.first_wins, upto)


def compact(
    spark: SparkSession, name: str, folder: str, parents: DataFrame | None = None
) -> int | None:
    """Fold the load's committed batches into a snapshot and delete what no snapshot needs."""
    through = loader.compact(
        spark,
        folder,
        lambda upto: current(spark, name, folder, parents, upto),
        f"{folder}/checkpoint",
    )
    loader.prune(spark, folder)
    return through
