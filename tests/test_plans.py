"""Physical-plan properties the scale design depends on."""

import re

from pyspark.sql import functions as F

from factorlab.operators.blocks import block_of
from factorlab.operators import indexing, predict, ratings, recommend, similarity
from factorlab.sources.reviews import clean_reviews, ratings_from_orders
from factorlab.functions.vectors import arithmetic_vector
from factorlab.session import cut_lineage
from tests.conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _setup(spark):
    reviews = clean_reviews(ratings_from_orders(spark, SF))
    items, users, indexed = indexing.index_reviews(reviews)
    return reviews, items, users, indexed


def test_scan_reads_only_used_columns(spark):
    plan = clean_reviews(ratings_from_orders(spark, SF))._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas


def test_dense_index_has_no_global_window_over_ids(spark):
    reviews, items, _, _ = _setup(spark)
    plan = _plan(items)
    # the only unpartitioned window runs over the per-partition counts
    assert "Window [sum(_n" in plan
    assert "row_number" not in plan


def test_recommend_and_grid_have_no_cartesian_product(spark):
    _, items, users, indexed = _setup(spark)
    X = users.select("reviewer_index", arithmetic_vector("reviewer_index", 2).alias("features"))
    Y = items.select("asin_index", arithmetic_vector("asin_index", 2).alias("features"))
    rec = recommend.recommend_unseen(X, Y, ratings.rating_pairs(indexed), n=5)
    grid = predict.predict_grid(X, Y, items, 3, 4)
    for plan in (_plan(rec), _plan(grid)):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in _plan(rec)   # partial top-N before the shuffle


def test_cosine_rows_go_only_to_blocks_with_a_partner(spark):
    _, _, _, indexed = _setup(spark)
    pairs = cut_lineage(ratings.rating_pairs(indexed))
    size = 10
    rows = pairs.select("asin_index", block_of("reviewer_index", size).alias("blk"))
    blocks = rows.select("asin_index", F.col("blk").alias("o")).distinct()
    sent = similarity._meeting(rows, "asin_index", blocks).count()
    per_item = {r[0]: (r["n"], r["b"]) for r in rows.groupBy("asin_index").agg(
        F.count("*").alias("n"), F.countDistinct("blk").alias("b")).collect()}
    assert sent == sum(n * b for n, b in per_item.values())
    assert sent <= sum(n * n for n, _ in per_item.values())    # never more than the raters of the item


def test_no_registered_query_plans_a_cross_join(spark):
    import __spark_entry__ as entry
    slow = {"als_fit_k20", "recommend_unseen_als", "mlp_predictions", "mlp_mae", "builtin_als_mse",
            "builtin_user_factors", "builtin_recommend"}     # the last asks Spark ML, which pairs its own factor blocks
    for name, fn in entry.queries().items():
        if name in slow or name in entry._LLM_QUERIES:
            continue
        plan = _plan(fn(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
