"""Parser for exported training lines ``([x1, …, xk], [y1, …, yk], r)``.

Brackets, parentheses and spaces are stripped, the rest is split on commas and each piece
is cast with ``try_cast`` (NULL when not a number). The last value is the label, the rest
are the features. Lines whose pieces are not all finite numbers, or whose width differs
from the expected one, are rejected. Runs as native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_values(line: Column) -> Column:
    stripped = F.regexp_replace(line, r"[()\[\]\s]", "")
    return F.transform(F.split(stripped, ","), lambda s: s.try_cast("double"))


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def parse_examples(lines: DataFrame, width: int | None = None, column: str = "value") -> DataFrame:
    """``(features array<double>, label double, accepted boolean, n_values int)``.

    ``width`` is the expected number of features (2k). If not given, the most frequent
    width among lines that parsed as numbers is used (one small aggregate).
    """
    # one generated row per line: filters stay above it, so a line is parsed once and not again in every condition
    vals = lines.select(F.explode(F.array(parse_values(F.col(column)))).alias("_v"))
    vals = vals.select(
        "_v",
        F.size("_v").alias("n_values"),
        F.forall("_v", _finite).alias("_numeric"),
    )
    if width is None:
        top = (vals.where("_numeric AND n_values > 1").groupBy("n_values").count()
               .orderBy(F.desc("count"), F.asc("n_values")).limit(1).collect())
        width = (top[0]["n_values"] - 1) if top else 0
    accepted = F.col("_numeric") & (F.col("n_values") == width + 1)
    return vals.select(
        F.slice("_v", 1, F.greatest(F.col("n_values") - 1, F.lit(1))).alias("features"),
        F.element_at("_v", -1).alias("label"),
        accepted.alias("accepted"),
        "n_values",
    )


def reject_reason(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``reason``: null for accepted lines, ``width`` for numbers of another count, else ``not numeric``."""
    numeric = F.forall("features", _finite) & F.coalesce(_finite(F.col("label")), F.lit(False))
    return parsed.withColumn("reason", F.when(~F.col("accepted"), F.when(numeric, "width").otherwise("not numeric")))


def accepted_examples(parsed: DataFrame, k: int | None = None) -> DataFrame:
    """Accepted rows split into the two halves: ``(user_vec, item_vec, label)``."""
    ok = parsed.where("accepted")
    half = F.floor(F.size("features") / 2).cast("int")
    return ok.select(
        F.slice("features", F.lit(1), half).alias("user_vec"),
        F.slice("features", half + 1, half).alias("item_vec"),
        "label",
    )
