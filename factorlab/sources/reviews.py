"""Review scans.

``read_reviews_json`` reads JSON-lines reviews with a fixed three-column schema, so no
inference pass runs and the scan only materialises the columns used.
``ratings_from_orders`` derives the same review view from the order tables in the test
data (customer = reviewer, part = product, quantity bucket = star rating).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorlab.schemas import ITEM_ID, RATING, REVIEWS, USER_ID


def read_reviews_json(spark: SparkSession, path: str, drop_malformed: bool = False) -> DataFrame:
    reader = spark.read.schema(REVIEWS)
    if drop_malformed:
        reader = reader.option("mode", "DROPMALFORMED")
    return reader.json(path)


def scan_reviews_json(spark: SparkSession, path: str) -> DataFrame:
    """``(reviewerID, asin, overall, line, reason)``: every line of the source, none dropped.

    ``reason`` is null for a usable review, ``malformed`` for a line that is no JSON record or does not fit the schema, and
    ``missing`` for a review without user, item or rating; ``line`` keeps what a rejected row said.
    ``quarantine.split_rejects`` parts the rows and counts them while it reads.
    """
    schema = T.StructType([*REVIEWS.fields, T.StructField("_line", T.StringType())])
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").json(path)
    holes = F.col(USER_ID).isNull() | F.col(ITEM_ID).isNull() | F.col(RATING).isNull()
    reason = F.when(F.col("_line").isNotNull(), "malformed").when(holes, "missing")
    line = F.when(F.col("_line").isNotNull(), F.col("_line")).when(holes, F.to_json(F.struct(USER_ID, ITEM_ID, RATING)))
    return rows.select(USER_ID, ITEM_ID, RATING, line.alias("line"), reason.alias("reason"))


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Drop reviews with a NULL user, item or rating before any index is assigned."""
    return reviews.select(USER_ID, ITEM_ID, RATING).na.drop(subset=[USER_ID, ITEM_ID, RATING])


def ratings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review view over ``lineitem`` joined to ``orders`` (one review per line item)."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.concat(F.lit("U"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias(USER_ID),
        F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias(ITEM_ID),
        (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias(RATING),
    )
