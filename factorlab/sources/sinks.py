"""Sinks: factor tables, prediction CSVs, JSON debug output, exported examples.

Writers are distributed (one file per partition); nothing is coalesced to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_factors(factors: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """``(id, features)`` as parquet, or as text lines ``(id, [f1, …])`` with ``fmt="text"``."""
    if fmt == "text":
        id_col = factors.columns[0]
        line = F.concat(F.lit("("), F.col(id_col).cast("string"), F.lit(", "), F.to_json("features"), F.lit(")"))
        factors.select(line.alias("value")).write.mode(mode).text(path)
    else:
        factors.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line (array columns rendered as JSON text)."""
    cols = [F.to_json(F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode(mode).option("header", True).csv(path)


def write_sorted_csv(df: DataFrame, path: str, *order: str, mode: str = "overwrite") -> None:
    """CSV in ``order`` over all files (range partitions, sorted within; no one-task sort)."""
    write_csv(df.repartitionByRange(*order).sortWithinPartitions(*order), path, mode)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def register_views(tables: dict) -> None:
    """Expose results under SQL names (``createOrReplaceTempView``) so they can be queried
    with ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
