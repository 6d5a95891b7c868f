import numpy as np
import pandas as pd
import pytest

from factorlab.session import cut_lineage
from factorlab.operators import als, indexing, ratings
from factorlab.sources.reviews import clean_reviews


def numpy_als(u, i, r, k, lam, epochs, init):
    users, items = sorted(set(u)), sorted(set(i))
    Y = {it: init(it) for it in items}
    for _ in range(epochs):
        X = {}
        for uu in users:
            idx = np.flatnonzero(u == uu)
            V = np.array([Y[i[j]] for j in idx])
            X[uu] = np.linalg.solve(V.T @ V + lam * np.eye(k), V.T @ r[idx])
        Y = {}
        for it in items:
            idx = np.flatnonzero(i == it)
            V = np.array([X[u[j]] for j in idx])
            Y[it] = np.linalg.solve(V.T @ V + lam * np.eye(k), V.T @ r[idx])
    return X, Y


def arith(k):
    return lambda id_: np.array([((id_ * 7919 + f * 104729) % 1000 + 1) / 1001 for f in range(1, k + 1)])


def check(spark, u, i, r, k, epochs=2, **kw):
    pdf = pd.DataFrame({"reviewer_index": u.astype("int32"), "asin_index": i.astype("int32"), "overall": r})
    model = als.fit(spark.createDataFrame(pdf), k=k, lam=1.0, epochs=epochs, init="arithmetic", **kw)
    Xr, Yr = numpy_als(u, i, r, k, 1.0, epochs, arith(k))
    xs, ys = model.user_factors.collect(), model.item_factors.collect()
    assert len(xs) == len({a for a, _ in xs}) and len(ys) == len({a for a, _ in ys})  # one row per id
    X = {a: np.array(b) for a, b in xs}
    Y = {a: np.array(b) for a, b in ys}
    assert set(X) == set(Xr) and set(Y) == set(Yr)
    assert max(np.abs(X[a] - Xr[a]).max() for a in X) < 1e-8
    assert max(np.abs(Y[a] - Yr[a]).max() for a in Y) < 1e-8
    return model


def _tiny_triples(tiny):
    _, _, indexed = indexing.index_reviews(clean_reviews(tiny))
    t = ratings.rating_triples(indexed).toPandas()
    return t.reviewer_index.to_numpy(), t.asin_index.to_numpy(), t.overall.to_numpy(float)


@pytest.mark.parametrize("k", [1, 2, 20])
def test_tiny_and_transpose(spark, tiny, k):
    u, i, r = _tiny_triples(tiny)
    check(spark, u, i, r, k)
    check(spark, i, u, r, k)


def test_more_users_than_items(spark, tiny):
    u, i, r = _tiny_triples(tiny)
    check(spark, np.r_[u, 4], np.r_[i, 1], np.r_[r, 3.0], 2)


def test_hot_keys_and_tiny_batches(spark):
    rng = np.random.default_rng(0)
    u = rng.integers(1, 30, 400)
    i = rng.integers(1, 25, 400)
    u[:150] = 7
    r = rng.integers(1, 6, 400).astype(float)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, u, i, r, 3, epochs=3, max_rows_per_group=40)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_objective_never_increases(spark):
    rng = np.random.default_rng(1)
    u, i = rng.integers(1, 40, 500), rng.integers(1, 30, 500)
    r = rng.integers(1, 6, 500).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"reviewer_index": u.astype("int32"),
                                             "asin_index": i.astype("int32"), "overall": r}))
    prev = None
    for epochs in (1, 2, 3):
        model = als.fit(df, k=4, lam=1.0, epochs=epochs, init="random")
        obj = als.objective(df, model).first()["objective"]
        if prev is not None:
            assert obj <= prev + 1e-9
        prev = obj


def test_large_factor_path(spark):
    """Factor tables over the broadcast bound are shipped to the rating slices."""
    rng = np.random.default_rng(2)
    u, i = rng.integers(1, 25, 300), rng.integers(1, 20, 300)
    u[:100] = 3
    r = rng.integers(1, 6, 300).astype(float)
    model = check(spark, u, i, r, 2, epochs=2, broadcast_bytes=0, max_rows_per_group=30)
    assert model.max_users == 24 or model.max_users == int(u.max())


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_half_step_moves_no_rating(spark, broadcast_bytes):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(pd.DataFrame({"reviewer_index": rng.integers(1, 20, 100).astype("int32"),
                                             "asin_index": rng.integers(1, 15, 100).astype("int32"),
                                             "overall": rng.integers(1, 6, 100).astype(float)}))
    keyed = als.prepare_keyed(df, "reviewer_index", "asin_index", max_rows_per_group=200)
    Y = cut_lineage(als.initial_factors(df, "asin_index", 3))
    keyed.links()
    plan = als.half_step(keyed, Y, 3, 1.0, broadcast_bytes, keep=lambda df: df)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "InMemoryTableScan" in line and "_nsalt" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    level = depth(lines[scan])
    for line in reversed(lines[:scan]):          # the nodes above the ratings, up to the root
        if depth(line) < level:
            level = depth(line)
            assert "Exchange" not in line and not line.lstrip(" :+-*()0123456789").startswith("Sort "), plan


def test_hot_limit_does_not_grow_with_the_table(spark):
    pdf = pd.DataFrame({"u": np.repeat([1, 2, 3], [5000, 300, 7]).astype("int32"), "overall": 1.0})
    pdf["i"] = np.arange(len(pdf), dtype="int32") + 1
    df = spark.createDataFrame(pdf)
    keyed = als.prepare_keyed(df, "u", "i", max_rows_per_group=200, stats=(10 ** 12, 3, len(pdf)), num_partitions=4)
    groups = {(r["u"], r["_salt"]): r["count"] for r in keyed.df.groupBy("u", "_salt").count().collect()}
    assert max(groups.values()) <= 2 * 200 and len([g for g in groups if g[0] == 1]) == 25


def test_fit_keeps_a_constant_number_of_tables(spark):
    from pathlib import Path

    from factorlab.session import ensure_checkpoint_dir
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 3.0), (2, 2, 4.0)], "reviewer_index int, asin_index int, overall double")
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "staged"
    counts = []
    for epochs in (1, 4):
        before = set(folder.glob("*")) if folder.exists() else set()
        als.fit(df, k=2, epochs=epochs)
        counts.append(len(set(folder.glob("*")) - before))
    assert counts == [2, 2]


def test_rating_without_factor_is_dropped(spark):
    """A rating whose item has no factor drops out of the join; a user whose only rating is
    on that item gets no factor."""
    pdf = pd.DataFrame({"reviewer_index": np.array([1, 1, 2, 3], dtype="int32"),
                        "asin_index": np.array([1, 2, 1, 3], dtype="int32"),
                        "overall": [5.0, 3.0, 4.0, 2.0]})
    df = spark.createDataFrame(pdf)
    keyed = als.prepare_keyed(df, "reviewer_index", "asin_index")
    Y = spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.0, 0.5])], "id int, features array<double>")
    X = {r[0]: np.array(r[1]) for r in als.half_step(keyed, Y, 2, 1.0).collect()}
    assert set(X) == {1, 2}
    V = np.array([[0.5, 0.25], [1.0, 0.5]])
    want = np.linalg.solve(V.T @ V + np.eye(2), V.T @ np.array([5.0, 3.0]))
    assert np.abs(X[1] - want).max() < 1e-12


def test_id_stats_bounds(spark):
    dense = spark.createDataFrame([(1, 3, 1.0), (2, 3, 1.0), (2, 1, 1.0)], "u int, i int, r double")
    assert als.id_stats(dense, "u", "i") == (3, 2, 3)
    odd = spark.createDataFrame([(-5, 0, 1.0), (-3, 0, 1.0), (-3, 7, 1.0)], "u int, i int, r double")
    assert als.id_stats(odd, "u", "i") == (3, 2, 2)   # exact distinct counts below 1


def test_factors_are_shipped_in_packed_pieces(spark, monkeypatch):
    """A rating slice gets a few binary pieces, not one row per factor, and every factor it needs once."""
    monkeypatch.setattr(als, "_PIECE", 4)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"u": rng.integers(1, 40, 400).astype("int32"), "i": rng.integers(1, 60, 400).astype("int32"),
                        "overall": rng.integers(1, 6, 400).astype(float)})
    keyed = als.prepare_keyed(spark.createDataFrame(pdf), "u", "i", num_partitions=3, max_rows_per_group=10)
    links = keyed.links().collect()
    assert len(links) <= 3 * 3 and len({(r["_q"], r["_pid"]) for r in links}) == len(links)
    needed = {(i, r["_pid"]) for r in links for i in r["ids"]}
    assert sum(len(r["ids"]) for r in links) == len(needed)
    assert needed == {(r["i"], r["_pid"]) for r in keyed.df.select("i", "_pid").distinct().collect()}
    Y = als.initial_factors(spark.createDataFrame(pdf).where("i <> 7"), "i", 3)     # one item without a factor
    packed = {r["id"]: r["features"] for r in als.half_step(keyed, Y, 3, 1.0, 0).collect()}
    joined = {r["id"]: r["features"] for r in als.half_step(keyed, Y, 3, 1.0).collect()}
    assert packed.keys() == joined.keys() and all(np.allclose(packed[u], joined[u], atol=1e-12) for u in packed)


def test_ratings_are_laid_out_once(spark, monkeypatch):
    """Preparing the ratings writes no copy of them beside the persisted layout."""
    written = []
    real = als.cut_lineage
    monkeypatch.setattr(als, "cut_lineage", lambda df: written.append(df.columns) or real(df))
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 3.0), (2, 2, 4.0)], "u int, i int, overall double")
    als.prepare_keyed(df, "u", "i")
    assert not any("r" in columns for columns in written)
