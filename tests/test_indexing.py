from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from factorlab.operators import indexing
from factorlab.sources.reviews import clean_reviews, ratings_from_orders
from tests.conftest import SF


def test_tiny_indexes_drop_nulls(tiny):
    clean = clean_reviews(tiny)
    items, users, indexed = indexing.index_reviews(clean)
    assert sorted(map(tuple, users.collect())) == [("U1", 1), ("U2", 2), ("U3", 3)]
    assert sorted(map(tuple, items.collect())) == [("A", 1), ("B", 2), ("C", 3)]
    assert indexed.count() == 6
    assert indexed.columns == ["reviewerID", "reviewer_index", "asin", "asin_index", "overall"]


def test_dense_index_equals_global_row_number(spark):
    reviews = clean_reviews(ratings_from_orders(spark, SF))
    for parts in (1, 3, 7):
        idx = indexing.dense_index(reviews, "asin", "asin_index", num_partitions=parts)
        ref = reviews.select("asin").distinct().withColumn(
            "ref", F.row_number().over(Window.orderBy("asin")))
        joined = idx.join(ref, "asin")
        assert joined.count() == ref.count() == idx.count()
        assert joined.where("ref != asin_index").count() == 0


def test_entity_counts(spark, tiny):
    items, users, _ = indexing.index_reviews(clean_reviews(tiny))
    row = indexing.entity_counts(items, users).first()
    assert (row["num_distinct_asins"], row["num_distinct_reviewerIDs"]) == (3, 3)


def test_combined_indexes_equal_separate_ones(spark):
    reviews = clean_reviews(ratings_from_orders(spark, SF))
    for parts in (None, 1, 5):
        items, users = indexing.dense_indexes(reviews, [("asin", "asin_index"), ("reviewerID", "reviewer_index")], parts)
        for got, col, idx in ((items, "asin", "asin_index"), (users, "reviewerID", "reviewer_index")):
            ref = reviews.select(col).distinct().withColumn("ref", F.row_number().over(Window.orderBy(col)))
            joined = got.join(ref, col)
            assert got.count() == ref.count() == joined.count()
            assert joined.where(f"ref != {idx}").count() == 0


def test_indexes_read_the_reviews_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rb in batches:
            seen.add(rb.num_rows)
            yield rb

    rows = spark.range(100).selectExpr("concat('U', id % 7) AS reviewerID", "concat('P', id % 11) AS asin", "1.0D AS overall")
    reviews = rows.mapInArrow(counted, rows.schema)
    items, users = indexing.dense_indexes(reviews, [("asin", "asin_index"), ("reviewerID", "reviewer_index")])
    assert (items.count(), users.count()) == (11, 7) and seen.value == 100


def test_index_queries_leave_the_ratings_alone(spark, tmp_path):
    for name in ("orders", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    assert entry.queries()["user_index"](spark, str(tmp_path)).count() == 150
    made = entry._base(spark, str(tmp_path))
    assert "indexed" not in made and "pairs" not in made
