"""What the corpus operators share: tables, stored intermediates, words as Spark columns."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual.session import checkpoint_dir

ROOT = str(Path(__file__).resolve().parents[2])
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything in ASCII that is neither a digit nor a lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_folders: set[str] = set()
_scratch: list[list[str]] = []

# Rows travel to Python workers in batches of at most this size; a larger row is a batch of its own.
BATCH_BYTES = 8 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package under the path it has on the driver, and bound their batches
    by bytes: the default bounds rows, and 10 000 whole texts can be any size."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    if spark.conf.get(BATCH_CONF) != f"{BATCH_BYTES}b":
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")
    return spark


def release_memory() -> None:
    """Give memory that this worker's libraries have freed back to the machine.

    A worker is used again by later stages, and the C library keeps what it once had.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning_memory(run: Callable) -> Callable:
    """``run`` over the batches of a task, and ``release_memory`` after the last one."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder; removed when the driver ends."""
    folder = f"{checkpoint_dir(spark)}/accrual-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    try:
        delete(spark, folder)
    except Exception:  # the gateway may already be closed
        pass


def delete(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through the file system that Spark uses for it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends here."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    if _scratch:
        _scratch[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside is deleted at the end; a result has to be stored outside."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            delete(spark, path)


@contextmanager
def lasting() -> Iterator[None]:
    """What ``stored`` writes inside stays, also within ``scratch``."""
    held = _scratch[:]
    _scratch.clear()
    try:
        yield
    finally:
        _scratch[:] = held


# Rows of some numbers that may be broadcast: some 100 MB.
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame) -> DataFrame:
    """A stored frame of few narrow columns, marked for a broadcast if it has at most ``BROADCAST_ROWS``
    rows; beyond that it is joined by a shuffle, with the same result."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def plain_words(text: Column) -> Column:
    """Words of digits, a-z and non-ASCII characters, after lower-casing A-Z; none for NULL."""
    spaced = F.regexp_replace(ascii_lower(text), SEPARATORS, " ")
    return F.coalesce(F.array_remove(F.split(spaced, " "), ""), F.array().cast("array<string>"))


PIECES = 256


def hot_counts(counts: DataFrame, key: str, rows: str) -> DataFrame:
    """Keys with more than one in ``PIECES`` of all rows, and how many pieces (``_k``) to cut each into.

    ``counts`` has one row per key and its number of rows. There cannot be more than ``PIECES`` such
    keys, whatever the data, so the result may be broadcast.
    """
    total = counts.agg(F.sum(rows)).first()[0] or 0
    share = max(1, total // PIECES)
    return counts.where(F.col(rows) > share).select(
        F.col(key), F.ceil(F.col(rows) / share).cast("int").alias("_k")
    )


def salted_join(left: DataFrame, right: DataFrame, key: str, rows: str, spread: Column) -> DataFrame:
    """Inner join with ``right``, which has one row per key and the number of left rows in ``rows``.

    Keys with many rows are cut into pieces by a hash of ``spread``; their right rows are repeated once
    per piece. The columns of ``right`` but ``rows`` are added to those of ``left``.
    """
    hot = F.broadcast(hot_counts(right, key, rows))
    pieces = F.coalesce(F.col("_k"), F.lit(1))
    cut = left.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), pieces))
    repeated = (
        right.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), (pieces - 1).cast("long"))))
        .drop("_k", rows)
    )
    return cut.drop("_k").join(repeated, [key, "_salt"]).drop("_salt")
