"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Spark 4.1.2 plans keyed operators on the partitioning it infers for a union of joins, and
    # adaptive execution may then join inputs with different partition counts.
    "spark.sql.unionOutputPartitioning": "false",
}


def build_session(app_name: str = "accrual", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI and adaptive execution.

    Shuffle parallelism is left to the cluster's own setting plus AQE; pass
    ``**{"spark.sql.shuffle.partitions": "8"}`` for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Turn off inferred union partitioning (see ``SESSION_CONF``) on a session built elsewhere."""
    name = "spark.sql.unionOutputPartitioning"
    if spark.conf.get(name, None) != "false":
        spark.conf.set(name, "false")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` where it names one.

    Only a local master may fall back to a temporary folder; anywhere else a machine-local
    path would be lost with its machine, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="accrual-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage, so that later stages see one fixed result.

    Used where a frame is read twice and both reads must agree on row placement
    (partition numbers after a sampled range partitioning).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_folders: set[str] = set()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again: lineage ends here.

    For wide frames that are read several times: the files are a fraction of a checkpoint, and a reader
    takes the columns it needs. They lie below one folder per application, removed when the driver ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the gateway may already be closed
        pass


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files, cached blocks and checkpoints that nothing refers to any more.

    It learns of them when the driver's heap is collected, and a driver with little to do can fill the
    executors' disks before that.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
