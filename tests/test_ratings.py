import contextlib
import io

import numpy as np
from pyspark.sql import functions as F

from factorlab.functions.vectors import scatter_dense, scatter_joined
from factorlab.operators import indexing, ratings, similarity
from factorlab.sources.reviews import clean_reviews


def _pairs(tiny):
    _, _, indexed = indexing.index_reviews(clean_reviews(tiny))
    return ratings.rating_pairs(indexed)


def test_pairs_duplicates_and_truncation(tiny):
    got = {(r[0], r[1]): r[2] for r in _pairs(tiny).collect()}
    assert got == {(1, 1): 5, (1, 2): 3, (2, 1): 4, (2, 3): 1, (3, 3): 4}


def test_dense_matrices(tiny):
    pairs = _pairs(tiny)
    um = {r[0]: list(r[1]) for r in ratings.user_item_matrix(pairs, 3).collect()}
    assert um == {1: [5, 3, 0], 2: [4, 0, 1], 3: [0, 0, 4]}
    im = {r[0]: list(r[1]) for r in ratings.item_user_matrix(pairs, 3).collect()}
    assert im == {1: [5, 4, 0], 2: [3, 0, 0], 3: [0, 1, 4]}


def test_lists_sorted(tiny):
    lists = {r[0]: [(e["pos"], e["val"]) for e in r[1]] for r in ratings.ratings_by_user(_pairs(tiny)).collect()}
    assert lists[1] == [(1, 5), (2, 3)]


def test_norms(tiny):
    norms = {r[0]: r[1] for r in similarity.user_norms(_pairs(tiny)).collect()}
    assert norms == {1: 34.0, 2: 17.0, 3: 16.0}


def test_joined_matrix_rows(spark, tiny):
    pairs = _pairs(tiny)
    for make in (ratings.user_item_matrix, ratings.item_user_matrix):
        dense = make(pairs, 7)
        key = dense.columns[0]
        want = {r[0]: r[1] for r in dense.select(key, F.array_join("ratings", ",")).collect()}
        assert {r[0]: r[1] for r in make(pairs, 7, joined=",").collect()} == want
    assert {r[0]: r[1] for r in ratings.user_item_matrix(pairs, 3, joined=",").collect()} == {1: "5,3,0", 2: "4,0,1", 3: "0,0,4"}
    odd = spark.createDataFrame([(2, [(1, None), (4, 2)]), (3, [(2, 3), (6, None)]), (4, [(6, 1)]), (5, None)],
                                "k int, e array<struct<pos:int,val:int>>")
    for r in odd.select(scatter_joined("e", 6, ";").alias("a"), F.array_join(scatter_dense("e", 6), ";").alias("b")).collect():
        assert r.a == r.b
    none = spark.createDataFrame([(1, [])], "k int, e array<struct<pos:int,val:int>>")
    assert none.select(scatter_joined("e", 3, ";"), scatter_joined("e", 0, ";")).first()[:] == ("0;0;0", "")


def test_long_matrix_row_without_its_array(spark):
    width = 300_000_000                  # as an array of boxed numbers this row does not fit the driver
    pairs = spark.createDataFrame([(1, 2, 5), (1, width, 3)], "reviewer_index int, asin_index int, rating int")
    row = ratings.user_item_matrix(pairs, width, joined=",").select(
        F.octet_length("ratings").alias("n"), F.expr("left(ratings, 7)").alias("a"), F.expr("right(ratings, 5)").alias("z")).first()
    assert (row.n, row.a, row.z) == (2 * width - 1, "0,5,0,0", "0,0,3")


def test_many_small_matrix_blocks(spark):
    at = np.random.default_rng(3).integers(1, 50_000, (30_000, 2))
    rows = {(int(u), int(i)): int((u + i) % 5 + 1) for u, i in at}
    pairs = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "reviewer_index int, asin_index int, rating int")
    blocks = ratings.matrix_blocks(pairs, block_rows=64, block_cols=256)
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        blocks.explain()
    assert "FlatMapGroupsInArrow" not in plan.getvalue()          # no Python call per block
    found = [(r.row_block, r.col_block) for r in blocks.select("row_block", "col_block").collect()]
    assert len(found) == len(set(found)) > 25_000
    assert {(r.reviewer_index, r.asin_index): r.rating for r in ratings.matrix_cells(blocks).collect()} == rows


def test_matrix_block_over_many_batches(spark):
    pairs = spark.range(60_000).selectExpr("cast(id % 300 + 1 as int) reviewer_index", "cast(id div 300 + 1 as int) asin_index",
                                           "cast(id % 5 + 1 as int) rating")
    blocks = ratings.matrix_blocks(pairs, block_rows=256, block_cols=1024)
    sizes = {(b.row_block, b.col_block): (len(b.indptr), b.indptr[-1], len(b["values"])) for b in blocks.collect()}
    assert sizes == {(0, 0): (257, 51_200, 51_200), (1, 0): (257, 8_800, 8_800)}
    assert ratings.matrix_cells(blocks).exceptAll(pairs).count() == 0 and ratings.matrix_cells(blocks).count() == 60_000
