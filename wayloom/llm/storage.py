"""Where intermediate results are written, and how Python workers keep small."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

FILE_ROWS = 1 << 21
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Kept:
    """Checkpoints of narrow tables, in files of some FILE_ROWS rows.

    Writing a file costs the executor a process of its own (for its permissions), so a
    table is dealt into few files rather than one for each of its tasks.
    """

    def __init__(self, rows: int) -> None:
        """rows: about how many the largest table has."""
        self.files = max(1, -(-rows // FILE_ROWS))

    def __call__(self, df: DataFrame) -> DataFrame:
        return checkpoint(df.repartition(self.files))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the cluster's checkpoint folder and read it back, cutting its lineage.

    The folder is the session's spark.checkpoint.dir. Only where none is set and Spark
    runs on one machine, as in tests, a temporary one is made; a cluster without one is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint"))
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Let the driver collect its garbage: it then has the shuffle files removed of what has been written down since, and gives memory back."""
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of texts hold BATCH_ROWS rows at most; a session that asks for fewer keeps its number.

    A batch is held by the JVM and by Python at once; Spark's default of 10,000 texts
    costs each core some 200 MB.
    """
    now = int(spark.conf.get(_BATCH))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def release() -> None:
    """Give memory that is free inside this process back to the machine: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """An Arrow function over batches that releases memory after its last one."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return over
