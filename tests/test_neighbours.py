"""Cosine floor, best n per user and the paged and blocked forms against brute force, with hot users and items."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorlab.operators import neighbours, ratings, similarity
from factorlab.operators.blocks import running_before
from factorlab.operators.indexing import ranked
from factorlab.session import cut_lineage


def table(spark, rows):
    return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "reviewer_index int, asin_index int, rating int")


def structured(seed=1, n=90, m=60):
    """Users in groups that rate alike, one user and one item that meet all others, users of one item only."""
    rng = np.random.default_rng(seed)
    rows = {}
    for u in range(1, n + 1):
        taste = np.random.default_rng(u // 6)
        for i in taste.permutation(m)[:10]:
            if rng.random() < 0.9:
                rows[u, int(i) + 1] = int(rng.integers(2, 6))
    rows |= {(5, i): 3 for i in range(1, m + 1)} | {(u, 7): 4 for u in range(1, n + 1)} | {(u, 7): 1 for u in range(n + 1, n + 9)}
    rows[n + 20, 3] = 0           # a user whose only rating is worth nothing
    return rows


def cosines(rows):
    users, items = max(u for u, _ in rows), max(i for _, i in rows)
    R = np.zeros((users + 1, items + 1))
    for (u, i), r in rows.items():
        R[u, i] = r
    norm = np.sqrt((R * R).sum(1))
    dots = R @ R.T
    return {(u, v): dots[u, v] / (norm[u] * norm[v]) for u in range(1, users + 1) for v in range(1, users + 1) if dots[u, v] > 0}


@pytest.mark.parametrize("min_cos", [0.05, 0.4, 0.9, 1.0])
@pytest.mark.parametrize("kind", [{}, {"span": 7, "block_entries": 5}])
def test_cosine_floor_equals_brute_force(spark, min_cos, kind):
    rows = structured()
    got = {(r.u, r.v): r.cos for r in neighbours.cosine_at_least(table(spark, rows), min_cos, **kind).collect()}
    # the diagonal is always there; its cosine can miss 1 by rounding
    want = {p: c for p, c in cosines(rows).items() if p[0] <= p[1] and (c >= min_cos or p[0] == p[1])}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[p], want[p], rel_tol=1e-12) for p in want)


def test_floor_is_the_filtered_full_result(spark):
    pairs = table(spark, structured(4))
    full = similarity.user_cosine(pairs).where("cos >= 0.5").collect()
    assert sorted(map(tuple, full)) == sorted(map(tuple, similarity.user_cosine(pairs, min_cos=0.5).collect()))
    with pytest.raises(ValueError):
        similarity.user_cosine(pairs, min_cos=0)


def test_index_leaves_out_popular_items_and_moves_fewer_rows(spark):
    """Groups that rate alike plus 20 items that everyone rates: the block plan ships every rating to every block."""
    rng = np.random.default_rng(0)
    rows = {(u, i): int(rng.integers(3, 6)) for u in range(1, 1201) for i in range(1, 21)}
    for u in range(1, 1201):
        rows |= {(u, 20 + 40 * (u // 8) + int(j)): 5 for j in np.random.default_rng(u // 8).permutation(40)[:35]}
    pairs = cut_lineage(table(spark, rows))
    entries, index = neighbours.cosine_index(pairs, 0.8)
    popular = index.where("f <= 20").count()      # ranks 1 to 20: the items of everyone
    assert popular == 0 and entries.where("f <= 20").count() == 24_000
    found = neighbours.candidates(index, 0.8).count()
    blocks = pairs.select("asin_index", F.floor((F.col("reviewer_index") - 1) / 150).alias("b"))
    sent = blocks.join(blocks.select("asin_index", F.col("b").alias("o")).distinct(), "asin_index").count()
    # rows that move: index entries to both sides of the join, candidates once, two vectors per candidate
    assert 2 * index.count() + 3 * found < sent
    assert neighbours.cosine_at_least(pairs, 0.8).where("u < v").count() >= 1200 * 7 / 2 * 0.9


@pytest.mark.parametrize("n", [1, 4, 200])
@pytest.mark.parametrize("kind", [{}, {"block_users": 16}, {"block_users": 16, "block_rows": 40, "hot_rows": 30}])
def test_best_neighbours_equal_the_full_table(spark, n, kind):
    pairs = table(spark, structured(2))
    want = similarity.similar_users_all(similarity.user_cosine(pairs), n).collect()
    got = neighbours.top_neighbours(pairs, n, **kind).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_best_neighbours_write_no_table_of_all_pairs(spark):
    rows = {(u, i): 3 for u in range(1, 301) for i in range(1, 4)}     # 300 users that all meet: 44,850 pairs
    pairs = table(spark, rows)
    assert neighbours.top_neighbours(pairs, 3, block_users=50).count() == 900
    sizes = {}
    real = neighbours.cut_lineage

    def watched(df):
        out = real(df)
        sizes[tuple(df.columns)] = out.count()
        return out
    neighbours.cut_lineage = watched
    try:
        neighbours.top_neighbours(pairs, 3, block_users=50)
    finally:
        neighbours.cut_lineage = real
    assert max(sizes.values()) == 900
    groups = pairs.withColumn("norm", F.lit(math.sqrt(27.0))).select(
        F.col("reviewer_index").alias("u"), F.col("asin_index").alias("i"), F.col("rating").cast("double").alias("r"), "norm",
        F.lit(0).alias("blk"), F.lit(0).alias("ga"), F.lit(0).alias("gb"))
    assert groups.groupBy("ga", "gb").applyInArrow(neighbours._best_fn(3), neighbours._BEST).count() == 900


def test_scores_of_the_nearest(spark):
    rows = structured(3)
    pairs, cos = table(spark, rows), cosines(rows)
    got = {(r.reviewer_index, r.asin_index): r.score for r in similarity.neighbour_scores(pairs, top_n=4).collect()}
    want = {}
    for u in {u for u, _ in cos}:
        near = sorted((v for a, v in cos if a == u and v != u), key=lambda v: (-cos[u, v], v))[:4] + [u]
        mass = sum(cos[u, v] for v in near)
        for i in {i for (v, i) in rows if v in near}:
            want[u, i] = sum(cos[u, v] * rows.get((v, i), 0) for v in near) / mass
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    one = similarity.neighbour_scores(pairs, top_n=4, users=spark.createDataFrame([(8,)], "reviewer_index int"))
    assert {r.reviewer_index for r in one.collect()} == {8}


@pytest.mark.parametrize("kind", [{}, {"block_users": 16, "block_items": 8, "max_group_rows": 60}])
def test_scores_through_items_and_for_chosen_users(spark, kind):
    rows = structured(7)
    pairs, cos = table(spark, rows), cosines(rows)
    full = {(r.reviewer_index, r.asin_index): r.score for r in similarity.neighbour_scores(pairs, similarity.user_cosine(pairs)).collect()}
    items = {(r.reviewer_index, r.asin_index): r.score for r in similarity.neighbour_scores(pairs, **kind).collect()}
    assert items.keys() == full.keys() and all(abs(items[k] - full[k]) < 1e-12 for k in full)
    chosen = spark.createDataFrame([(5,), (8,), (95,)], "reviewer_index int")
    some = {(r.reviewer_index, r.asin_index): r.score for r in similarity.neighbour_scores(pairs, users=chosen).collect()}
    assert some.keys() == {k for k in full if k[0] in (5, 8, 95)} and all(abs(some[k] - full[k]) < 1e-12 for k in some)
    mass = {r.reviewer_index: r.mass for r in similarity.similarity_mass_direct(pairs).collect()}
    want = {}
    for (u, _), c in cos.items():
        want[u] = want.get(u, 0) + c
    assert mass.keys() == want.keys() and all(math.isclose(mass[u], want[u], rel_tol=1e-12) for u in want)


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "reviewer_index int, asin_index int, rating int")
    assert neighbours.cosine_at_least(nothing, 0.5).count() == 0
    assert neighbours.top_neighbours(nothing).count() == 0
    assert ratings.rating_pages(nothing).count() == 0 and ratings.matrix_blocks(nothing).count() == 0


def test_running_sums_and_ranks(spark):
    rng = np.random.default_rng(0)
    rows = [(k, int(p), float(rng.integers(1, 9))) for k in range(4) for p in rng.permutation(200)[:60 * k + 1] + 1]
    df = spark.createDataFrame(rows, "k int, p int, x double")
    for span in (13, 1000):
        for r in running_before(df, "k", "p", F.col("x"), "before", 200, span).collect():
            assert r.before == sum(x for k, p, x in rows if k == r.k and p < r.p)
    order = [(r.k, r.p) for r in ranked(df, "rank", F.desc("k"), F.asc("p")).orderBy("rank").collect()]
    assert order == sorted(((k, p) for k, p, _ in rows), key=lambda e: (-e[0], e[1]))


def test_running_sums_under_any_name(spark):
    rows = [(1, p, 2.0) for p in range(1, 41)]
    df = spark.createDataFrame(rows, "k int, p int, x double")
    got = running_before(df, "k", "p", F.col("x"), "_before", 40, 7).collect()
    assert len(got) == 40 and all(r["_before"] == 2.0 * (r.p - 1) for r in got)


def test_user_blocks_beyond_one_band(spark):
    degrees = spark.range(1, 70_001).select(F.col("id").cast("int").alias("u"), F.lit(3).cast("long").alias("n"))
    blocks = neighbours.user_blocks(degrees, 1024, 1500)
    assert blocks.count() == 70_000
    held = blocks.groupBy("blk").agg(F.count("*").alias("c"), F.sum("n").alias("s")).agg(F.max("c"), F.max("s")).first()
    assert held[0] <= 1024 and held[1] <= 1500 + 3


def test_pages_of_an_item_that_everyone_rates(spark):
    rows = {(u, 1): u % 5 + 1 for u in range(1, 1001)} | {(3, 2): 4}
    pages = ratings.rating_pages(table(spark, rows), page_size=64, span=100).collect()
    mine = sorted((p for p in pages if p.asin_index == 1), key=lambda p: p.page)
    assert [p.page for p in mine] == list(range(math.ceil(1000 / 64))) and max(len(p.entries) for p in pages) == 64
    assert [(e.pos, e.val) for p in mine for e in p.entries] == [(u, rows[u, 1]) for u in range(1, 1001)]
    other = ratings.rating_pages(table(spark, rows), "reviewer_index", "asin_index", page_size=1).where("reviewer_index = 3").collect()
    assert sorted((p.page, p.entries[0].pos) for p in other) == [(0, 1), (1, 2)]


def test_matrix_blocks_rebuild_the_cells(spark):
    rows = structured(5)
    pairs = table(spark, rows)
    blocks = ratings.matrix_blocks(pairs, block_rows=8, block_cols=16)
    back = {(r.reviewer_index, r.asin_index): r.rating for r in ratings.matrix_cells(blocks).collect()}
    assert back == rows
    for b in blocks.collect():
        assert len(b.indptr) == 9 and b.indptr[-1] == len(b.indices) == len(b["values"]) <= 8 * 16
        assert b.first_row == 8 * b.row_block + 1 and b.first_col == 16 * b.col_block + 1


def test_pieces_of_the_dense_vectors(spark):
    pairs = table(spark, structured(6))
    cos = similarity.user_cosine(pairs)
    n = max(r.u for r in cos.collect())
    whole = {r.reviewer_index: r.Similarity for r in similarity.similarity_vectors(cos, n).collect()}
    for r in similarity.similarity_pieces(cos, n, width=32).collect():
        part = whole[r.reviewer_index][r.piece * 32:(r.piece + 1) * 32]
        assert r.Similarity == part and any(part)


def test_vectors_from_lists_without_a_pair_table(spark):
    pairs = table(spark, structured(6))
    cos = similarity.user_cosine(pairs)
    want = {(r.u, r.v): r.cos for r in similarity.symmetric(cos).collect()}
    n = max(u for u, _ in want)
    vectors = {r.reviewer_index: r.Similarity for r in similarity.similarity_vectors(cos, n).collect()}
    for sizes in ({}, {"max_products": 500, "max_group_rows": 50}):
        lists = similarity.user_cosine(pairs, by_user=True, **sizes)
        got = [(r.reviewer_index, e.pos, e.val) for r in lists.collect() for e in r.entries]
        assert len(got) == len(want) and {(u, v): c for u, v, c in got} == want
        assert {r.reviewer_index: r.Similarity for r in similarity.similarity_vectors(lists, n).collect()} == vectors
    assert similarity.user_cosine(pairs.where("reviewer_index < 0"), by_user=True).count() == 0


def test_similarity_vector_stages_no_cosines(spark, monkeypatch):
    import __spark_entry__ as entry

    labels, kept = [], entry.staged
    monkeypatch.setattr(entry, "staged", lambda df, label: labels.append(label) or kept(df, label))
    monkeypatch.setattr(entry, "_MEMO", {})
    rows = entry.queries()["similarity_vector"](spark, "/root/testdata/sf0.001")
    users = entry.queries()["user_index"](spark, "/root/testdata/sf0.001").count()
    assert rows.count() == users * users and "cos" not in labels
