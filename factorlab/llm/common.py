"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factorlab.session import cut_lineage, ensure_checkpoint_dir

#: Texts per Python step inside an Arrow batch: bounds the Python objects alive at once.
SLICE_ROWS = 256
#: Bytes of one Arrow batch between Spark and Python.
BATCH_BYTES = 16 << 20
#: Fixed value: characters of scripts without spaces between words, as ranges of a character class.
UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1050-\u108f\u1780-\u17d3"
            "\u3005-\u3007\u3041-\u3096\u309d-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff")


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share (``spark.checkpoint.dir``)."""
    return ensure_checkpoint_dir(spark)


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python in Arrow batches of at most ``BATCH_BYTES`` (if the session allows more)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: what follows starts from files that outlive any executor.
    """
    bounded_batches(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use, one for each of ``names``."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def release_unused() -> None:
    """Give freed Arrow memory back: workers live through many tasks."""
    pa.default_memory_pool().release_unused()


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        release_unused()


def byte_slices(batches: Iterable[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches where the strings of ``column`` reach ``max_bytes`` (one row at least)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            reached = (ends[start - 1] if start else 0) + max_bytes
            stop = max(start + 1, int(np.searchsorted(ends, reached, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        release_unused()


def as_bytes(column: pa.Array) -> list:
    """UTF-8 bytes of a string column, nulls as None, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def sized_partitions(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partition count from the row count; the session's shuffle count is the floor."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one text after another, and the n + 1 offsets of the texts (nulls are empty)."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets.astype(np.int64) - offsets[0]


def globally_ranked(df: DataFrame, rank: str, *order: Column) -> DataFrame:
    """``df`` with ``rank`` 1, 2, 3... in ``order``, without one task that sees all rows.

    Rows are dealt by ranges of the order, sorted in their partitions and checkpointed; a partition's first rank comes
    from the row counts before it (one row per partition, broadcast with that bound).
    """
    part, place, count, before = spare(df, "_part", "_place", "_count", "_before")
    fixed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    local = fixed.withColumn(part, F.spark_partition_id()).withColumn(
        place, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    counts = local.groupBy(part).agg(F.count(F.lit(1)).alias(count))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(part, F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(before))
    numbered = local.join(F.broadcast(firsts), part)
    return numbered.select(*own_columns(df), (F.col(before) + F.col(place) + 1).cast("long").alias(rank))
