"""Headline timings on the driver's tables.

Runs each headline operator over the review view of ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and writes every result to the ``noop``
sink, so the full plan executes without collecting. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from factorlab.operators import (als, als_builtin, indexing, metrics, mlp, mlp_sync, neighbours, predict, ratings,  # noqa: E402
                                 recommend, similarity)
from factorlab.session import cut_lineage, local_session  # noqa: E402
from factorlab.sources.reviews import clean_reviews, ratings_from_orders  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="factorlab-bench")
    times, errors = {}, {}

    def timed(name, fn):
        """Time one step; a failing step is recorded (null time + error) and re-raised so
        the steps depending on it are skipped."""
        t0 = time.time()
        try:
            out = fn()
        except Exception as exc:  # noqa: BLE001 - reported in the JSON line
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {exc}"[:300]
            raise
        times[name] = round(time.time() - t0, 3)
        return out

    try:
        _steps(spark, sf_dir, timed)
    except Exception:  # noqa: BLE001 - already recorded by timed()
        pass
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    line = {"metric": "total_sec", "value": round(sum(v for v in times.values() if v), 3), "unit": "sec",
            "queries": times, "sf": sf}
    if errors:
        line["errors"] = errors
    print(json.dumps(line))


def _steps(spark, sf_dir, timed):
    """The headline steps, in order; later steps reuse earlier results."""
    # 0. first query of a fresh JVM (class loading, code generation): reported on its own
    timed("jvm_warmup", lambda: run(spark.range(100_000).selectExpr("id % 7 AS k").groupBy("k").count()))

    # 1. ingest + dense indexes + indexed ratings (materialised for the later steps)
    def index_step():
        reviews = clean_reviews(ratings_from_orders(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
        items, users, indexed = indexing.index_reviews(reviews)
        indexed = cut_lineage(indexed)
        reviews.unpersist()
        return items, users, indexed
    items, users, indexed = timed("index", index_step)
    triples = ratings.rating_triples(indexed)

    # 2. ALS preparation (hot-key salting, (key, salt) layout, checkpoint), then one
    #    half-step (users from items), k = 20, λ = 1
    def prepare():
        by_user = als.prepare_keyed(triples, "reviewer_index", "asin_index")
        by_user.df.count()      # lays the ratings out
        Y = cut_lineage(als.initial_factors(indexed, "asin_index", 20))
        return by_user, Y
    by_user, Y = timed("als_prepare", prepare)
    # the first call also starts the Python workers; the repeat shows the steady state
    timed("als_half_step", lambda: als.half_step(by_user, Y, 20, 1.0))
    timed("als_half_step_warm", lambda: als.half_step(by_user, Y, 20, 1.0))

    # the path for factor tables too large to broadcast; the first call builds the link table
    by_user.links()
    timed("als_half_step_large", lambda: als.half_step(by_user, Y, 20, 1.0, broadcast_bytes=0))

    # 3. full plain-λ ALS: k = 20, λ = 1, 5 epochs (the benchmark settings)
    model = timed("als_fit_5_epochs", lambda: als.fit(triples, k=20, lam=1.0, epochs=5))

    # 4. predict every rating + MAE/MSE/RMSE
    timed("predict_mae", lambda: run(metrics.error_metrics(
        predict.predict_model(indexed, model))))

    # 5. top-10 unseen items for every user
    pairs = timed("pairs", lambda: cut_lineage(ratings.rating_pairs(indexed)))
    timed("recommend_unseen", lambda: run(recommend.recommend_unseen(
        model.user_factors, model.item_factors, pairs, n=10)))

    # 6. all-pairs user cosine
    timed("user_cosine", lambda: run(similarity.user_cosine(pairs)))

    # the same questions without the table of all pairs
    timed("cosine_floor_0.8", lambda: run(similarity.user_cosine(pairs, min_cos=0.8)))
    timed("top_neighbours_10", lambda: run(neighbours.top_neighbours(pairs, 10)))
    timed("neighbour_scores_top20", lambda: run(similarity.neighbour_scores(pairs, top_n=20)))
    timed("similarity_mass_direct", lambda: run(similarity.similarity_mass_direct(pairs)))

    # weighted scores and dense similarity rows of 200 users
    some = users.filter("reviewer_index <= 200").select("reviewer_index")
    timed("neighbour_scores_200_users", lambda: run(similarity.neighbour_scores(pairs, users=some)))
    cos = cut_lineage(similarity.user_cosine(pairs))
    near = similarity.symmetric(cos).join(some.withColumnRenamed("reviewer_index", "u"), "u", "left_semi")
    timed("similarity_vectors_200_users", lambda: run(similarity.similarity_vectors(
        near.filter("u <= v"), users.count())))

    # 7. Spark ML ALS: rank 20, 15 iterations, fit + predict + MSE
    def builtin():
        m = als_builtin.fit_builtin(triples, 20, 15, 0.01, 42)
        run(metrics.error_metrics(als_builtin.predict_builtin(m, triples)))
        return m
    built = timed("builtin_als", builtin)
    timed("builtin_recommend", lambda: run(als_builtin.recommend_builtin(built, pairs, n=10)))

    # 8. MLP regressor on the learnt factors, 2 epochs
    examples = cut_lineage(predict.with_factors(indexed, model.user_factors, model.item_factors).select(
        F.concat("reviewer_latent_vector", "asin_latent_vector").alias("features"), F.col("overall").alias("label")))
    timed("mlp_fit_2_epochs", lambda: mlp.fit_mlp(examples, epochs=2))
    timed("mlp_adam_1_epoch", lambda: mlp_sync.fit_adam(examples, epochs=1))


if __name__ == "__main__":
    main()
