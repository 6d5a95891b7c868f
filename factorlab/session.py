"""Session helpers: a local session for tests and the lineage-cut checkpoint.

Library functions never create a session; they take DataFrames. The helpers here are for
tests, the bench and the driver entry points.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. AQE re-plans joins at run time (broadcast only when the
# measured size is under the threshold, split skewed partitions of sort-merge joins) and
# coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # one BLAS thread per Python worker: task slots already use every core
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
}


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "factorlab",
                  driver_memory: str = "16g") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the session. Only a local-mode
    session without that setting (tests) gets a fresh folder under /tmp.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder") from None
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    folder = tempfile.mkdtemp(prefix="factorlab-ckpt-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and return the re-read plan.

    The result survives executor loss (it is read back from shared storage, not from
    executor memory) and its partitioning and in-partition order are fixed. An eager
    checkpoint runs one job to compute the data and a second one to write it; the data
    is persisted for the duration so the second job reads it instead of recomputing the
    last stage (which may be a Python stage), then released.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if df.is_cached:                # the caller's own cache: use it and leave it alone
        return df.checkpoint(eager=True)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet into the shared folder; the re-read table and its path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more (any Hadoop file system)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
