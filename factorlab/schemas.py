"""Fixed schemas and column names shared by the operators."""

from pyspark.sql import types as T

USER_ID = "reviewerID"
ITEM_ID = "asin"
RATING = "overall"
USER_IDX = "reviewer_index"
ITEM_IDX = "asin_index"

# Review records: only these three fields are read; other JSON fields are ignored.
REVIEWS = T.StructType([
    T.StructField(USER_ID, T.StringType()),
    T.StructField(ITEM_ID, T.StringType()),
    T.StructField(RATING, T.DoubleType()),
])

