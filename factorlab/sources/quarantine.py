"""Rejected input rows: kept beside the accepted ones and counted in the same pass."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from factorlab.session import ensure_checkpoint_dir


@dataclass
class Checked:
    """Accepted rows, rejected rows with their ``reason``, and how many there are of each."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    """The session's setting ``key`` for one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def split_rejects(rows: DataFrame, reason: str = "reason", path: str | None = None) -> Checked:
    """Write ``rows`` once, partitioned by whether column ``reason`` is set, and read both parts back.

    The counts are metrics observed by that one write (``Observation``), so no second pass over the source is needed. The rows
    go to ``path`` or to a new folder in the session's shared folder; they are the quarantine table.
    """
    spark = rows.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/staged/checked-{uuid.uuid4().hex}"
    marked = rows.withColumn("is_rejected", F.col(reason).isNotNull())
    seen = Observation()
    observed = marked.observe(seen, F.count_if(~F.col("is_rejected")).alias("accepted"), F.count_if("is_rejected").alias("rejected"))
    # a task keeps a file open for each of the two parts: rows are not sorted by part first
    with _set(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        observed.write.partitionBy("is_rejected").parquet(path)
    counts = seen.get
    back = spark.read.schema(marked.schema).parquet(path)      # the partition column prunes files
    return Checked(back.where("NOT is_rejected").drop(reason, "is_rejected"), back.where("is_rejected").drop("is_rejected"),
                   counts["accepted"], counts["rejected"])
