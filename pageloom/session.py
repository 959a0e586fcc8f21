"""Session builder with the settings the engine is tuned for, and what plans ask of a session: batches, memory, tables in between."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of one Arrow batch between the JVM and a worker, however long the texts.
BATCH_BYTES = 8 << 20


def build_session(app: str = "pageloom", master: str | None = None, **conf: str) -> SparkSession:
    """A local session by default; on a cluster, spark-submit's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.sql.shuffle.partitions", str(max(8, os.cpu_count() or 8)))
        builder = builder.config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def bounded_batches(spark: SparkSession) -> None:
    """Batches by bytes: whole texts in the default's 10,000 rows or 64 MB a batch would need that several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Gives freed memory back to the system: a worker lives on after its task, next to those of other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, whose worker gives back its memory at the end of a task."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return wrapped


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of our own only in local sessions (tests), where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not _is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="pageloom-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table into the shared checkpoint folder and returns it reread from there.

    Unlike checkpoint(), a table is columnar and compressed, which is a third of the disk.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/pageloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a table that later steps read, where there is a folder for it; without one every step computes ``df`` again."""
    spark = df.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None) or not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()
    return cut_lineage(df) if named or _is_local(spark) else df
