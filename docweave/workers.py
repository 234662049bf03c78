"""What Python workers and folders need before operators run."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: Rows and bytes of an Arrow batch, where the application names none: texts are long, and a worker holds a batch whole.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def reachable(spark: SparkSession) -> SparkSession:
    """Adds the package's folder to the workers' path, and keeps Arrow batches small. On a cluster, ship the package
    with ``--py-files``."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)
    named = spark.sparkContext.getConf()
    for key, value in BATCH.items():
        if not named.contains(key):
            spark.conf.set(key, value)
    return spark


#: For workers that run one operator after another: large arrays are mapped by themselves and go back to the system when
#: they are freed, instead of staying in the worker's heap for the next operator to sit beside.
FRUGAL = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(2 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20)}


def frugal(spark: SparkSession) -> SparkSession:
    """:func:`reachable`, with workers that keep no freed memory."""
    spark.sparkContext.environment.update(FRUGAL)
    return reachable(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and every executor see: the one of ``spark.checkpoint.dir``.

    Where it is unset, a folder of this machine is taken if all runs on it; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if (base := sc._jsc.sc().getCheckpointDir()).isDefined():
        return base.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut, safe when executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
