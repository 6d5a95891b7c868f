"""Block helpers for products of two id-indexed sides.

Ids are dense 1-based indexes, so ``block = (id - 1) div size`` cuts each side into
contiguous ranges. A row goes to the blocks of the other side that hold a partner for it, and
each ``(block, block)`` group is handled in one Arrow call whose memory is bounded by the block
sizes, not by the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_of(col: str | Column, size: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.floor((c - 1) / F.lit(size)).cast("int")


def block_count(largest: int | None, size: int) -> int:
    return max(1, -(-(largest or 0) // size))


def max_id(df: DataFrame, col: str) -> int:
    value = df.agg(F.max(col)).first()[0]
    return int(value or 0)


def broadcast_if_bounded(df: DataFrame, rows: int | None, row_bytes: int,
                         limit_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast ``df`` only when a proven row bound times the row size is under the limit;
    otherwise leave the join strategy to AQE's measured sizes."""
    if rows is not None and rows * row_bytes <= limit_bytes:
        return F.broadcast(df)
    return df


def factor_row_bytes(k: int) -> int:
    return 8 * k + 32


def running_before(df: DataFrame, key: str, place: str, value: Column, name: str, largest: int,
                   span: int = 65_536) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same ``key`` with a smaller ``place``.

    Places are integers from 1 to ``largest``, each at most once in a key. A key is cut into bands
    of ``span`` places, so no window group has more than ``span`` rows, however many rows a key has; what lies in earlier
    bands is added from one row per key and band.
    """
    banded = df.withColumn("_band", block_of(place, span))
    inside = Window.partitionBy(key, "_band").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(df.select(value.alias("v")).schema[0].dataType)
    here = banded.withColumn(name, F.coalesce(F.sum(value).over(inside), zero))
    if largest <= span:
        return here.drop("_band")
    earlier = Window.partitionBy(key).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    bands = banded.groupBy(key, "_band").agg(F.sum(value).alias("_sum")).select(
        key, "_band", F.coalesce(F.sum("_sum").over(earlier), zero).alias("_in_earlier_bands"))
    return (here.join(bands, [key, "_band"]).withColumn(name, F.col(name) + F.col("_in_earlier_bands"))
            .drop("_band", "_in_earlier_bands"))
