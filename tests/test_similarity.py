import math

import numpy as np
from pyspark.sql import functions as F

from factorlab.operators import indexing, ratings, similarity
from factorlab.sources.reviews import clean_reviews


def _pairs(tiny):
    _, _, indexed = indexing.index_reviews(clean_reviews(tiny))
    return ratings.rating_pairs(indexed)


def test_tiny_cosine(tiny):
    cos = {(r[0], r[1]): r[2] for r in similarity.user_cosine(_pairs(tiny)).collect()}
    assert math.isclose(cos[(1, 2)], 20 / math.sqrt(578), rel_tol=1e-15)
    assert math.isclose(cos[(2, 3)], 4 / math.sqrt(272), rel_tol=1e-15)
    assert (1, 3) not in cos
    assert all(abs(cos[(u, u)] - 1) < 1e-15 for u in (1, 2, 3))


def test_tiny_scores(tiny):
    pairs = _pairs(tiny)
    cos = similarity.user_cosine(pairs)
    sc = {(r[0], r[1]): r[2] for r in similarity.neighbour_scores(pairs, cos).collect()}
    c12 = 20 / math.sqrt(578)
    assert math.isclose(sc[(1, 1)], (5 + c12 * 4) / (1 + c12), rel_tol=1e-12)
    assert abs(sc[(1, 1)] - 4.545884) < 1e-6


def _brute(pairs_np, n, m):
    R = np.zeros((n + 1, m + 1))
    for u, i, r in pairs_np:
        R[u, i] = r
    dots = R @ R.T
    norms = np.sqrt((R * R).sum(1))
    return R, dots, norms


def test_blocks_and_item_splits_match_brute_force(spark):
    rng = np.random.default_rng(3)
    n, m = 70, 40
    rows = {(int(rng.integers(1, n + 1)), int(rng.integers(1, m + 1))): int(rng.integers(1, 6)) for _ in range(600)}
    for i in range(1, m + 1):
        rows[(5, i)] = 3  # a hot user rating every item
    data = [(u, i, r) for (u, i), r in rows.items()]
    pairs = spark.createDataFrame(data, "reviewer_index int, asin_index int, rating int")
    R, dots, norms = _brute(data, n, m)
    for block, max_rows in ((16, 2_000_000), (16, 50), (1000, 100)):
        got = similarity.user_cosine(pairs, block_users=block, max_group_rows=max_rows).collect()
        ref = {(u, v): dots[u, v] / (norms[u] * norms[v])
               for u in range(1, n + 1) for v in range(u, n + 1) if dots[u, v] > 0}
        assert len(got) == len(ref)
        for u, v, c in got:
            assert abs(c - ref[(u, v)]) < 1e-12
    cos = similarity.user_cosine(pairs, block_users=16)
    S = np.zeros((n + 1, n + 1))
    for u, v, c in cos.collect():
        S[u, v] = S[v, u] = c
    num = S @ R
    mass = S.sum(1)
    nz = {(u, i) for u in range(1, n + 1) for i in range(1, m + 1) if num[u, i] > 0}
    for kw in ({"block_users": 16, "block_items": 8}, {"block_users": 16, "block_items": 8, "max_group_rows": 30}):
        got = similarity.neighbour_scores(pairs, cos, **kw).collect()
        assert len(got) == len(nz)
        for u, i, s in got:
            assert abs(s - num[u, i] / mass[u]) < 1e-12


def test_similar_users_excludes_self_and_orders(spark, tiny):
    pairs = _pairs(tiny)
    top = similarity.similar_users(pairs, user=2, n=10).collect()
    assert [r["similar_index"] for r in top] == [1, 3]
    assert [r["sim_rank"] for r in top] == [1, 2]
    allv = similarity.similar_users_all(similarity.user_cosine(pairs), n=1).collect()
    assert {r[0]: r[2] for r in allv} == {1: 2, 2: 1, 3: 2}


def test_dense_similarity_vector(tiny):
    pairs = _pairs(tiny)
    vec = {r[0]: list(r[1]) for r in similarity.similarity_vectors(similarity.user_cosine(pairs), 3).collect()}
    assert vec[1][2] == 0.0 and abs(vec[1][0] - 1) < 1e-15 and vec[1][1] == vec[2][0]
    assert F is not None


def test_cosine_joins_no_table_of_pairs(spark):
    rows = [(u, i, (u * i) % 5 + 1) for u in range(1, 30) for i in range(1, 20) if (u + i) % 3]
    pairs = spark.createDataFrame(rows, "reviewer_index int, asin_index int, rating int")
    plain = {(r.u, r.v): r.cos for r in similarity.user_cosine(pairs, block_users=7).collect()}
    split = similarity.user_cosine(pairs, block_users=7, max_group_rows=40)
    assert {(r.u, r.v): r.cos for r in split.collect()} == plain
    plan = similarity.user_cosine(pairs)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("FlatMapGroupsInArrow")]
    assert "Join" not in above


def test_packed_table_pieces_and_best_equal_the_block_products(spark):
    rng = np.random.default_rng(11)
    rows = {(int(u), int(i)): int(r) for u, i, r in zip(rng.integers(1, 90, 900), rng.integers(1, 60, 900), rng.integers(0, 6, 900))}
    rows |= {(7, i): 5 for i in range(1, 60)} | {(90 + k, 61 + k): 2 for k in range(3)}
    pairs = spark.createDataFrame([(*k, r) for k, r in rows.items()], "reviewer_index int, asin_index int, rating int")
    blocks = similarity.user_cosine(pairs, block_users=16).collect()
    want = {(r.u, r.v): r.cos for r in blocks}
    some = dict(max_group_rows=200, max_products=700)
    packed = similarity.user_cosine(pairs, **some)
    got = [tuple(r) for r in packed.collect()]
    assert len(got) == len(want) and {(u, v): c for u, v, c in got} == want
    table = spark.createDataFrame([(*k, c) for k, c in want.items()], "u int, v int, cos double")
    both = sorted(map(tuple, similarity.symmetric(table).collect()))
    assert both == sorted([(u, v, c) for (u, v), c in want.items()] + [(v, u, c) for (u, v), c in want.items() if u != v])
    for n in (1, 4):
        assert sorted(map(tuple, similarity.similar_users_all(None, n, pairs, **some).collect())) == sorted(
            map(tuple, similarity.similar_users_all(table, n).collect()))
    for length, width in ((92, 8), (95, 64), (200, 7)):
        direct = similarity.similarity_pieces(None, length, width, pairs, **some).collect()
        assert sorted(map(tuple, direct)) == sorted(map(tuple, similarity.similarity_pieces(table, length, width).collect()))


def test_cosines_read_once_are_not_staged(spark, monkeypatch):
    """A user with far more products than a group should hold takes the blocks that also split items; no other pair is shuffled."""
    pairs = spark.createDataFrame([(u, i, (u + i) % 5 + 1) for u in range(1, 30) for i in range(1, 9)],
                                  "reviewer_index int, asin_index int, rating int")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    plain = similarity.user_cosine(pairs)
    assert "ga#" in plan(plain) and "gb#" not in plan(plain)
    assert plan(similarity.similarity_mass(plain)).count("FlatMapGroupsInArrow") == plan(plain).count("FlatMapGroupsInArrow")
    want = sorted(map(tuple, plain.collect()))
    empty = spark.createDataFrame([(1, 1, 2), (2, 1, None)], pairs.schema)
    assert "gb#" in plan(similarity.user_cosine(empty))
    monkeypatch.setattr(similarity, "_HOT_PRODUCTS", 100)
    assert "gb#" in plan(similarity.user_cosine(pairs)) and sorted(map(tuple, similarity.user_cosine(pairs).collect())) == want


def test_score_product_in_parts_of_the_left_side(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = {(int(u), int(i)): int(r) for u, i, r in zip(rng.integers(1, 60, 500), rng.integers(1, 50, 500), rng.integers(1, 6, 500))}
    pairs = spark.createDataFrame([(*k, r) for k, r in rows.items()], "reviewer_index int, asin_index int, rating int")
    cos = similarity.user_cosine(pairs, block_users=16)
    want = {(r[0], r[1]): r[2] for r in similarity.neighbour_scores(pairs, cos).collect()}
    seen, real = [], similarity._product_sums
    monkeypatch.setattr(similarity, "_product_sums", lambda parts: seen.append(parts) or real(parts))
    monkeypatch.setattr(similarity, "_PART_ROWS", 150)
    got = similarity.neighbour_scores(pairs, cos, block_users=16, block_items=20)
    rows = got.collect()
    assert seen[0] > 2 and len(rows) == len(want)
    assert all(abs(s - want[(u, i)]) < 1e-12 for u, i, s in rows)


def test_score_vectors_from_dense_pieces(spark):
    rows = [(u, i, u + i / 64) for u in (1, 2, 9) for i in range(1, 41) if (u + i // 6) % 3] + [(4, 40, 0.5), (5, 1, 0.25)]
    scores = spark.createDataFrame(rows, "reviewer_index int, asin_index int, score double")
    for n, width in ((40, 7), (41, 8), (100, 4096), (64, 8)):
        vec = similarity.score_vectors(scores, n, width)
        assert vec._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        want = {u: [0.0] * n for u, _, _ in rows}
        for u, i, s in rows:
            want[u][i - 1] = s
        assert {r[0]: list(r[1]) for r in vec.collect()} == want
