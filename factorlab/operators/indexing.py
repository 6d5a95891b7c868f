"""Dense 1-based indexes for users and items, and the indexed rating table.

The index of an id is its rank in ascending id order (same numbers as a global
``row_number() OVER (ORDER BY id)``), computed without funnelling every id through one
task:

1. distinct ids (partial aggregation, so a hot id costs one row per map task);
2. range-partition the ids and sort inside each partition, then cut lineage with a
   reliable checkpoint so partition numbers and in-partition order are fixed;
3. in each partition the position of a row is given by ``monotonically_increasing_id``
   (partition id in the upper bits, row number in the lower 33 bits);
4. per-partition row counts (one row per partition) are turned into running offsets by a
   window over that tiny table, broadcast back (size bound: the partition count).

``dense_indexes`` does this for users and items together in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorlab.schemas import ITEM_ID, ITEM_IDX, RATING, USER_ID, USER_IDX
from factorlab.session import cut_lineage


def distinct_ids(reviews: DataFrame, column: str) -> DataFrame:
    return reviews.select(column).where(F.col(column).isNotNull()).distinct()


def dense_index(reviews: DataFrame, column: str, index_column: str,
                num_partitions: int | None = None) -> DataFrame:
    """``(column, index_column int)``: ids ranked 1..n in ascending order."""
    ids = distinct_ids(reviews, column)
    ranged = (ids.repartitionByRange(num_partitions, column) if num_partitions
              else ids.repartitionByRange(column))
    ranged = cut_lineage(ranged.sortWithinPartitions(column))
    local = ranged.select(
        column,
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    ).withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(column, (F.col("_offset") + F.col("_pos") + 1).cast("int").alias(index_column)))


def dense_indexes(reviews: DataFrame, specs: list[tuple[str, str]],
                  num_partitions: int | None = None) -> list[DataFrame]:
    """Several dense indexes in one pass: ``specs`` = [(id column, index column), …].

    The ids of all columns are tagged with their spec number and ranked together (one
    range partitioning, one checkpoint, one count table). The tiny count table, one row per
    (partition, tag), gives each tag's running offset across partitions and the number of
    rows of lower tags inside a partition (rows are sorted by tag, then id).
    """
    entries = [F.struct(F.lit(tag).alias("_tag"), F.col(column).cast("string").alias("_id")) for tag, (column, _) in enumerate(specs)]
    tagged = reviews.select(F.explode(F.array(*entries)).alias("_e")).select("_e._tag", "_e._id")      # reviews are read once
    ids = tagged.where(F.col("_id").isNotNull()).distinct()
    ranged = (ids.repartitionByRange(num_partitions, "_tag", "_id") if num_partitions
              else ids.repartitionByRange("_tag", "_id"))
    ranged = cut_lineage(ranged.sortWithinPartitions("_tag", "_id"))
    local = ranged.select(
        "_tag", "_id",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    ).withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = local.groupBy("_pid", "_tag").agg(F.count(F.lit(1)).alias("_n"))
    earlier_parts = Window.partitionBy("_tag").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    lower_tags = Window.partitionBy("_pid").orderBy("_tag").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", "_tag",
        (F.coalesce(F.sum("_n").over(earlier_parts), F.lit(0))
         - F.coalesce(F.sum("_n").over(lower_tags), F.lit(0))).alias("_shift"))
    ranked = local.join(F.broadcast(offsets), ["_pid", "_tag"]).select(
        "_tag", "_id", (F.col("_shift") + F.col("_pos") + 1).cast("int").alias("_idx"))
    return [ranked.where(F.col("_tag") == tag).select(F.col("_id").alias(column), F.col("_idx").alias(index))
            for tag, (column, index) in enumerate(specs)]


def ranked(df: DataFrame, rank: str, *order: Column) -> DataFrame:
    """``df`` with ``rank`` 1, 2, 3, ... in ``order``, by the same range partitions and offsets as above.

    Rows that are equal in ``order`` meet in one partition: end it with a column that tells rows apart.
    """
    fixed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    local = fixed.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return local.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_offset") + F.col("_pos") + 1).cast("long").alias(rank))


def item_index(reviews: DataFrame, num_partitions: int | None = None) -> DataFrame:
    return dense_index(reviews, ITEM_ID, ITEM_IDX, num_partitions)


def user_index(reviews: DataFrame, num_partitions: int | None = None) -> DataFrame:
    return dense_index(reviews, USER_ID, USER_IDX, num_partitions)


def entity_counts(items: DataFrame, users: DataFrame) -> DataFrame:
    """One row: number of distinct items and users (exact, from the index tables).

    One partial+final aggregate over the tagged union of both tables; no join.
    """
    tagged = (items.select(F.lit(1).alias("_t"), F.col(ITEM_ID).alias("_id"))
              .unionByName(users.select(F.lit(2).alias("_t"), F.col(USER_ID).alias("_id"))))
    return tagged.agg(
        F.count(F.when(F.col("_t") == 1, F.col("_id"))).alias("num_distinct_asins"),
        F.count(F.when(F.col("_t") == 2, F.col("_id"))).alias("num_distinct_reviewerIDs"))


def id_sketches(reviews: DataFrame, *by: str, lg_k: int = 14) -> DataFrame:
    """``(by..., items, users)``: one mergeable HyperLogLog sketch of the item ids and one of the user ids per group.

    A sketch has at most 2^``lg_k`` small registers whatever the rows behind it, so it can be stored per file, day or shop and
    merged later without reading the reviews again. Without ``by``, one sketch of all rows.
    """
    sketches = [F.hll_sketch_agg(ITEM_ID, F.lit(lg_k)).alias("items"), F.hll_sketch_agg(USER_ID, F.lit(lg_k)).alias("users")]
    return reviews.groupBy(*by).agg(*sketches)


def merged_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of larger groups (of everything without ``by``) from stored ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("items").alias("items"), F.hll_union_agg("users").alias("users"))


def approximate_counts(sketches: DataFrame) -> DataFrame:
    """The counts of ``entity_counts``, estimated (relative error about 1.04 / 2^(lg_k / 2): 0.8 % by default)."""
    kept = [c for c in sketches.columns if c not in ("items", "users")]
    return sketches.select(*kept, F.hll_sketch_estimate("items").alias("num_distinct_asins"),
                           F.hll_sketch_estimate("users").alias("num_distinct_reviewerIDs"))


def attach_indexes(reviews: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Indexed ratings ``(reviewerID, reviewer_index, asin, asin_index, overall)``.

    Two inner equi-joins; AQE broadcasts an index table only when its measured size is
    under the threshold and splits skewed partitions of hot ids otherwise.
    """
    return (reviews.join(items, ITEM_ID).join(users, USER_ID)
            .select(USER_ID, USER_IDX, ITEM_ID, ITEM_IDX, RATING))


def index_reviews(reviews: DataFrame, num_partitions: int | None = None):
    """Clean reviews → (item index, user index, indexed ratings); both indexes in one pass."""
    items, users = dense_indexes(reviews, [(ITEM_ID, ITEM_IDX), (USER_ID, USER_IDX)], num_partitions)
    return items, users, attach_indexes(reviews, items, users)
