"""

Every query reads the driver's order tables through the review view (customer = reviewer,
part = product, quantity bucket = star rating) and runs over the whole tables. Oracles are
DuckDB SQL over the same parquet files; column names match the Spark results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorlab.functions.vectors import arithmetic_vector
from factorlab.functions.parsing import accepted_examples, parse_examples, reject_reason
from factorlab.functions.vectors import dot, vector_sum
from factorlab.operators import (als, als_builtin, indexing, metrics, mlp, mlp_sync, neighbours, predict, ratings, recommend,
                                 similarity)
from factorlab.session import cut_lineage, ensure_checkpoint_dir, staged
from factorlab.sources import sinks
from factorlab.sources.examples import example_line, read_examples_text, write_lines
from factorlab.sources.quarantine import split_rejects
from factorlab.sources.reviews import clean_reviews, ratings_from_orders, read_reviews_json, scan_reviews_json

# The training-data subpackage and the pipeline are optional; this is their only guard.
_LLM = find_spec("factorlab.llm") is not None and find_spec("factorlab.llm.queries") is not None
if _LLM:
    from factorlab.llm.queries import ORACLE_SQL as _LLM_ORACLES
    from factorlab.llm.queries import QUERIES as _LLM_QUERIES
else:
    _LLM_ORACLES, _LLM_QUERIES = {}, {}
if _LLM and find_spec("corpus_pipeline") is not None:
    import corpus_pipeline

    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLES = {**_LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}

SMOKE_DIR = "/root/testdata/sf0.001"

_MEMO: dict = {}


def _base(spark: SparkSession, sf_dir: str) -> dict:
    """Clean reviews and both indexes of ``sf_dir`` (memoised)."""
    try:
        session_key = spark.sparkContext.applicationId   # unique per running context
    except Exception:  # Spark Connect
        session_key = id(spark)
    key = (session_key, sf_dir)
    if key not in _MEMO:
        for old in [k for k in _MEMO if k[0] != session_key]:     # tables of ended sessions
            del _MEMO[old]
        reviews = clean_reviews(ratings_from_orders(spark, sf_dir))
        items, users, indexed = indexing.index_reviews(reviews)
        _MEMO[key] = {"reviews": reviews, "items": items, "users": users, "_indexed": indexed}
    return _MEMO[key]


def _indexed(spark, sf_dir):
    """``_base`` with the indexed ratings (written once, when a query needs them) and the largest indexes."""
    b = _base(spark, sf_dir)
    if "indexed" not in b:
        b["indexed"] = staged(b["_indexed"], "indexed")[0]
        b["n_items"] = ratings.max_index(b["items"], "asin_index")
        b["n_users"] = ratings.max_index(b["users"], "reviewer_index")
    return b


# ---------------------------------------------------------------- step 1: ingest + index

def q_ratings_view(spark, sf_dir):
    return _base(spark, sf_dir)["reviews"]


def q_distinct_items(spark, sf_dir):
    return indexing.distinct_ids(_base(spark, sf_dir)["reviews"], "asin")


def q_distinct_users(spark, sf_dir):
    return indexing.distinct_ids(_base(spark, sf_dir)["reviews"], "reviewerID")


def q_entity_counts(spark, sf_dir):
    b = _base(spark, sf_dir)
    return indexing.entity_counts(b["items"], b["users"])


def q_approx_entity_counts(spark, sf_dir):
    """Item and user counts from sketches stored per rating value and merged: exact counts, and whether the estimates are
    within 5 %."""
    b = _base(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/staged/sketches-{uuid.uuid4().hex}"
    indexing.id_sketches(b["reviews"], "overall").write.parquet(path)
    near = indexing.approximate_counts(indexing.merged_sketches(spark.read.parquet(path)))
    exact = indexing.entity_counts(b["items"], b["users"])
    both = exact.select(F.lit(1).alias("exact"), "*").unionByName(near.select(F.lit(0).alias("exact"), "*"))
    top = lambda c, e: F.max(F.when(F.col("exact") == e, F.col(c)))
    fine = lambda c: (F.abs(top(c, 0) - top(c, 1)) < 0.05 * top(c, 1)).alias(f"{c}_near")
    names = ["num_distinct_asins", "num_distinct_reviewerIDs"]
    return both.agg(*[top(c, 1).alias(c) for c in names], *[fine(c) for c in names])


def q_item_index(spark, sf_dir):
    return _base(spark, sf_dir)["items"]


def q_user_index(spark, sf_dir):
    return _base(spark, sf_dir)["users"]


def q_indexed_ratings(spark, sf_dir):
    return _indexed(spark, sf_dir)["indexed"]


# ---------------------------------------------------------------- step 2: grouping

def _pairs(spark, sf_dir):
    b = _indexed(spark, sf_dir)
    if "pairs" not in b:
        b["pairs"] = staged(ratings.rating_pairs(b["indexed"]), "pairs")[0]
    return b


def _render_entries(df, key):
    return df.select(key, F.array_join(F.transform(
        "entries", lambda e: F.concat(e["pos"].cast("string"), F.lit(":"), e["val"].cast("string"))),
        ",").alias("ratings"))


def q_rating_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)["pairs"]


def q_ratings_by_user(spark, sf_dir):
    return _render_entries(ratings.ratings_by_user(_pairs(spark, sf_dir)["pairs"]), "reviewer_index")


def q_ratings_by_item(spark, sf_dir):
    return _render_entries(ratings.ratings_by_item(_pairs(spark, sf_dir)["pairs"]), "asin_index")


def q_user_matrix(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    return ratings.user_item_matrix(b["pairs"], b["n_items"], joined=",")


def q_item_matrix(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    return ratings.item_user_matrix(b["pairs"], b["n_users"], joined=",")


def q_ratings_by_item_pages(spark, sf_dir):
    """Item lists in pages of 16, from running counts in bands of 500 users."""
    pages = ratings.rating_pages(_pairs(spark, sf_dir)["pairs"], page_size=16, span=500)
    return _render_entries(pages.withColumn("key", F.struct("asin_index", "page")), "key").select(
        "key.asin_index", "key.page", "ratings")


def q_user_matrix_blocks(spark, sf_dir):
    """The user-item matrix in compressed-row blocks, rebuilt to its dense rows."""
    b = _pairs(spark, sf_dir)
    cells = ratings.matrix_cells(ratings.matrix_blocks(b["pairs"], block_rows=64, block_cols=256))
    return ratings.user_item_matrix(cells, b["n_items"], joined=",")


# ---------------------------------------------------------------- step 3: prediction + metrics
# Factors in these queries are the arithmetic start vectors (reproducible in SQL) over the
# index tables, so prediction and metrics are checked on their own.

PRED_K = 20


def _arith_factors(spark, sf_dir, k):
    b = _indexed(spark, sf_dir)
    memo = f"arith{k}"
    if memo not in b:
        b[memo] = (
            b["users"].select("reviewer_index", arithmetic_vector("reviewer_index", k).alias("features")),
            b["items"].select("asin_index", arithmetic_vector("asin_index", k).alias("features")))
    return b[memo]


def q_predict_ratings(spark, sf_dir):
    X, Y = _arith_factors(spark, sf_dir, PRED_K)
    b = _indexed(spark, sf_dir)
    return predict.predict_ratings(b["indexed"], X, Y, b["n_users"], b["n_items"], PRED_K)


def q_predict_grid(spark, sf_dir):
    X, Y = _arith_factors(spark, sf_dir, PRED_K)
    return predict.predict_grid(X, Y, _base(spark, sf_dir)["items"], n_users=10, n_items=100)


def q_train_mae(spark, sf_dir):
    return metrics.mae(q_predict_ratings(spark, sf_dir)).select(F.round("mae", 9).alias("mae"))


def q_train_mse(spark, sf_dir):
    return metrics.mse(q_predict_ratings(spark, sf_dir)).select(F.round("mse", 9).alias("mse"))


# ---------------------------------------------------------------- step 4: own ALS (λ = 1)

def _keyed(spark, sf_dir):
    b = _indexed(spark, sf_dir)
    if "by_user" not in b:
        triples = ratings.rating_triples(b["indexed"])
        b["by_user"] = als.prepare_keyed(triples, "reviewer_index", "asin_index")
        b["by_item"] = als.prepare_keyed(triples, "asin_index", "reviewer_index")
    return b


def _fit(spark, sf_dir, k, epochs, init="arithmetic"):
    b = _indexed(spark, sf_dir)
    memo = ("fit", k, epochs, init)
    if memo not in b:
        b[memo] = als.fit(ratings.rating_triples(b["indexed"]), k=k, lam=1.0, epochs=epochs, init=init)
    return b[memo]


def _sides(model, rank, digits):
    cols = [F.round(F.element_at("features", f), digits).alias(f"f{f}") for f in range(1, rank + 1)]
    users = model.user_factors.select(F.lit("user").alias("side"), F.col("reviewer_index").alias("id"), *cols)
    items = model.item_factors.select(F.lit("item").alias("side"), F.col("asin_index").alias("id"), *cols)
    return users.unionByName(items)


def q_als_normal_eq(spark, sf_dir):
    b = _keyed(spark, sf_dir)
    Y = als.initial_factors(b["indexed"], "asin_index", 2, "arithmetic")
    ne = als.normal_equations(b["by_user"], Y, 2)
    g, r = F.col("gram"), F.col("rhs")
    return ne.select(F.col("id").alias("reviewer_index"),
                     *[F.round(g[j], 6).alias(name) for j, name in ((0, "g11"), (1, "g12"), (3, "g22"))],
                     F.round(r[0], 6).alias("b1"), F.round(r[1], 6).alias("b2"), "n")


def q_als_normal_eq_k20(spark, sf_dir):
    """All 210 + 20 sums per user, k = 20, as two exact-order-free digests and the corner terms."""
    b = _keyed(spark, sf_dir)
    ne = als.normal_equations(b["by_user"], als.initial_factors(b["indexed"], "asin_index", PRED_K, "arithmetic"), PRED_K)
    return ne.select(F.col("id").alias("reviewer_index"), F.round(vector_sum("gram"), 5).alias("gram_sum"),
                     F.round(vector_sum("rhs"), 5).alias("rhs_sum"), F.round(F.col("gram")[19], 6).alias("g1_20"),
                     F.round(F.col("gram")[399], 6).alias("g20_20"), "n")


def _first_half_step(spark, sf_dir, keyed, broadcast_bytes=64 << 20):
    Y = als.initial_factors(_indexed(spark, sf_dir)["indexed"], "asin_index", 2, "arithmetic")
    X = als.half_step(keyed, Y, 2, 1.0, broadcast_bytes)
    return X.select(F.col("id").alias("reviewer_index"),
                    *[F.round(F.element_at("features", f), 6).alias(f"f{f}") for f in (1, 2)])


def q_als_half_step_users(spark, sf_dir):
    return _first_half_step(spark, sf_dir, _keyed(spark, sf_dir)["by_user"])


def q_als_half_step_users_large(spark, sf_dir):
    """The same step as it runs when factors are too many to broadcast and keys are split."""
    triples = ratings.rating_triples(_indexed(spark, sf_dir)["indexed"])
    keyed = als.prepare_keyed(triples, "reviewer_index", "asin_index", max_rows_per_group=16)
    return _first_half_step(spark, sf_dir, keyed, broadcast_bytes=0)


def q_als_fit_rank1(spark, sf_dir):
    return _sides(_fit(spark, sf_dir, 1, 2), 1, 4)


def q_als_fit_rank2(spark, sf_dir):
    return _sides(_fit(spark, sf_dir, 2, 2), 2, 4)


def q_als_objective(spark, sf_dir):
    obj = als.objective(ratings.rating_triples(_indexed(spark, sf_dir)["indexed"]), _fit(spark, sf_dir, 2, 2))
    return obj.select(*[F.round(c, 3).alias(c) for c in ("sse", "x_sq", "y_sq", "objective")])


def q_als_objective_tracked(spark, sf_dir):
    """The objective that the fit records after its second epoch, from the sums of the half-steps."""
    model = als.fit(ratings.rating_triples(_indexed(spark, sf_dir)["indexed"]), k=2, lam=1.0, epochs=2, init="arithmetic", track=True)
    return spark.createDataFrame([(len(model.history), model.history[-1])], "epochs long, objective double").select(
        "epochs", F.round("objective", 3).alias("objective"))


def q_als_fit_resumed(spark, sf_dir):
    """A run that ends after one epoch, and a second call that goes on from its log."""
    triples, run = ratings.rating_triples(_indexed(spark, sf_dir)["indexed"]), f"query-{uuid.uuid4().hex}"
    settings = dict(k=2, lam=1.0, init="arithmetic", resume=run)
    als.fit(triples, epochs=1, **settings)
    return _sides(als.fit(triples, epochs=2, **settings), 2, 4)


def _residuals(ratings_df, own, key, others, other, penalty):
    """``(key, n, residual)``: rows and the largest |Σ (x·y − r) y + penalty · x| per row of ``own``."""
    # the join by key comes last: its layout serves the sums, which are not shuffled again
    rows = (ratings_df.join(others.withColumnRenamed("features", "y"), other).join(own.withColumnRenamed("features", "x"), key)
            .withColumn("e", dot("x", "y") - F.col("overall")))
    per = rows.select(key, "e", F.posexplode("y").alias("f", "yf")).groupBy(key, "f").agg(
        F.sum(F.col("e") * F.col("yf")).alias("g"), F.count("*").alias("n"))
    terms = per.join(own, key).withColumn("t", F.abs(F.col("g") + penalty(F.col("n")) * F.col("features")[F.col("f")]))
    return terms.groupBy(key).agg(F.max("n").alias("n"), F.max("t").alias("residual"))


def q_als_fit_k20(spark, sf_dir):
    """15 random-start epochs: every item factor (updated last) solves its normal equations, and
    every user has a finite factor of length 20."""
    model, triples = _fit(spark, sf_dir, 20, 15, init="random"), ratings.rating_triples(_indexed(spark, sf_dir)["indexed"])
    items = _residuals(triples, model.item_factors, "asin_index", model.user_factors, "reviewer_index", lambda n: F.lit(1.0))
    users = triples.groupBy("reviewer_index").agg(F.count("*").alias("n")).join(model.user_factors, "reviewer_index", "left")
    fine = F.coalesce((F.size("features") == 20) & F.forall("features", lambda x: ~F.isnan(x)), F.lit(False))
    return (items.select(F.lit("item").alias("side"), F.col("asin_index").alias("id"), "n", (F.col("residual") < 1e-6).alias("ok"))
            .unionByName(users.select(F.lit("user").alias("side"), F.col("reviewer_index").alias("id"), "n", fine.alias("ok"))))


# ---------------------------------------------------------------- step 5: recommend

def q_recommend_unseen(spark, sf_dir):
    X, Y = _arith_factors(spark, sf_dir, 1)
    return recommend.recommend_unseen(X, Y, _pairs(spark, sf_dir)["pairs"], n=10)


def q_recommend_unseen_rank2(spark, sf_dir):
    """Top-10 from rank-2 ALS factors (2 epochs) in many blocks; factors are rounded to whole
    1/10,000 so that every score is an exact integer."""
    model = _fit(spark, sf_dir, 2, 2)
    whole = lambda t: t.withColumn("features", F.transform("features", lambda x: F.round(x, 4)))
    scaled = lambda t: whole(t).withColumn("features", F.transform("features", lambda x: F.round(x * 10000)))
    return recommend.recommend_unseen(scaled(model.user_factors), scaled(model.item_factors), _pairs(spark, sf_dir)["pairs"],
                                      n=10, block_users=300, block_items=400)


def q_recommend_unseen_als(spark, sf_dir):
    """Top-10 unseen items per user from the learnt k = 20 factors (15 plain-λ epochs): number of
    items, and whether all are unrated, ranked 1 to n and in score order."""
    model, pairs = _fit(spark, sf_dir, 20, 15, init="random"), _pairs(spark, sf_dir)["pairs"]
    top = recommend.recommend_unseen(model.user_factors, model.item_factors, pairs, n=10)
    seen = top.join(pairs.select("reviewer_index", "asin_index", F.lit(1).alias("rated")), ["reviewer_index", "asin_index"], "left")
    by_user = seen.groupBy("reviewer_index").agg(
        F.count("*").alias("n"), F.count("rated").alias("rated"), F.max("rec_rank").alias("last"),
        F.array_sort(F.collect_list(F.struct("rec_rank", "score"))).alias("s"))
    falling = F.forall(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.element_at("s", i)["score"] >= F.element_at("s", i + 1)["score"])
    return by_user.select("reviewer_index", "n", ((F.col("rated") == 0) & (F.col("last") == F.col("n"))
                                                  & ((F.size("s") < 2) | falling)).alias("ok"))


def q_grid_preview(spark, sf_dir):
    """The first 20 rows of the prediction grid in a total order, by SQL over registered views."""
    sinks.register_views({"grid_rows": q_predict_grid(spark, sf_dir), "item_rows": _base(spark, sf_dir)["items"]})
    return spark.sql("""SELECT g.reviewer_index, g.asin_index, i.asin, g.predicted_overall FROM grid_rows g
        JOIN item_rows i ON i.asin_index = g.asin_index ORDER BY g.predicted_overall DESC, g.reviewer_index, g.asin_index LIMIT 20""")


def q_factors_roundtrip(spark, sf_dir):
    """Item factors written as text lines and read back."""
    _, Y = _arith_factors(spark, sf_dir, 2)
    path = f"{ensure_checkpoint_dir(spark)}/staged/factors-{uuid.uuid4().hex}"
    sinks.write_factors(Y, path, fmt="text")
    parts = F.regexp_extract_all("value", F.lit("[0-9.Ee+-]+"), F.lit(0))
    return spark.read.text(path).select(parts.alias("p")).select(
        F.col("p")[0].cast("int").alias("asin_index"), F.col("p")[1].cast("double").alias("f1"), F.col("p")[2].cast("double").alias("f2"))


def q_predictions_csv_roundtrip(spark, sf_dir):
    """Predictions written as CSV files in index order, with a header, and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/staged/csv-{uuid.uuid4().hex}"
    rows = q_predict_ratings(spark, sf_dir)
    sinks.write_sorted_csv(rows, path, "reviewer_index", "asin_index")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def q_user_lists_json_roundtrip(spark, sf_dir):
    """The users' rating lists written as JSON lines and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/staged/json-{uuid.uuid4().hex}"
    rows = ratings.ratings_by_user(_pairs(spark, sf_dir)["pairs"])
    sinks.write_json(rows, path)
    return _render_entries(spark.read.schema(rows.schema).json(path), "reviewer_index")


# ---------------------------------------------------------------- step 7: similarity

def _cos(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    if "cos" not in b:
        b["cos"] = staged(similarity.user_cosine(b["pairs"]), "cos")[0]
    return b


def q_user_norms(spark, sf_dir):
    return similarity.user_norms(_pairs(spark, sf_dir)["pairs"])


def _cos_once(spark, sf_dir):
    """The cosine table for a query that reads it once: not written, unless another query has."""
    b = _pairs(spark, sf_dir)
    return b["cos"] if "cos" in b else similarity.user_cosine(b["pairs"])


def q_user_cosine(spark, sf_dir):
    return _cos_once(spark, sf_dir)


def q_similar_users_top10(spark, sf_dir):
    return similarity.similar_users(_pairs(spark, sf_dir)["pairs"], user=None, n=10)


def q_similar_users_top10_all(spark, sf_dir):
    return similarity.similar_users_all(None, n=10, pairs=_pairs(spark, sf_dir)["pairs"])


def _cos_floor(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    if "cos_floor" not in b:
        b["cos_floor"] = staged(similarity.user_cosine(b["pairs"], min_cos=0.1), "cos-floor")[0]
    return b["cos_floor"]


def q_user_cosine_floor(spark, sf_dir):
    """Pairs with a cosine of 0.1 or more, from the prefix-filtered inverted index."""
    return _cos_floor(spark, sf_dir)


def q_similar_users_floor(spark, sf_dir):
    """The five most similar users of each user among those with a cosine of 0.1 or more."""
    return similarity.similar_users_all(_cos_floor(spark, sf_dir), n=5)


def q_similar_users_best10(spark, sf_dir):
    """Top 10 per user without the table of all pairs: blocks of 300 users, users over 70 ratings joined."""
    return neighbours.top_neighbours(_pairs(spark, sf_dir)["pairs"], n=10, block_users=300, block_rows=8_000, hot_rows=70)


def q_neighbour_scores_top20(spark, sf_dir):
    """Weighted scores from each user and its 20 most similar users."""
    return similarity.neighbour_scores(_pairs(spark, sf_dir)["pairs"], top_n=20).select(
        "reviewer_index", "asin_index", F.round("score", 6).alias("score"))


def q_similarity_mass(spark, sf_dir):
    return similarity.similarity_mass(_cos_once(spark, sf_dir)).select(
        "reviewer_index", F.round("mass", 9).alias("mass"))


def _scores(spark, sf_dir):
    b = _cos(spark, sf_dir)
    if "scores" not in b:
        b["scores"] = similarity.neighbour_scores(b["pairs"], b["cos"])
    return b["scores"]


def q_neighbour_scores(spark, sf_dir):
    return _scores(spark, sf_dir).select("reviewer_index", "asin_index", F.round("score", 6).alias("score"))


def q_similarity_vector(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    vec = similarity.similarity_vectors(similarity.user_cosine(b["pairs"], by_user=True), b["n_users"])
    return vec.select("reviewer_index", F.posexplode("Similarity").alias("pos", "cos")) \
        .select("reviewer_index", (F.col("pos") + 1).alias("other_index"), "cos")


def q_score_vector(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    vec = similarity.score_vectors(_scores(spark, sf_dir), b["n_items"])
    return vec.select("reviewer_index", F.posexplode("g_score_vector").alias("pos", "score")) \
        .select("reviewer_index", (F.col("pos") + 1).alias("asin_index"), F.round("score", 6).alias("score"))


def q_similarity_mass_direct(spark, sf_dir):
    """The users' similarity masses from sums per item, without any pair of users."""
    return similarity.similarity_mass_direct(_pairs(spark, sf_dir)["pairs"]).select("reviewer_index", F.round("mass", 9).alias("mass"))


def q_neighbour_scores_items(spark, sf_dir):
    """All weighted scores through the table of item pairs."""
    return similarity.neighbour_scores(_pairs(spark, sf_dir)["pairs"]).select(
        "reviewer_index", "asin_index", F.round("score", 6).alias("score"))


def q_neighbour_scores_users(spark, sf_dir):
    """Weighted scores of every 50th user from their own cosine rows."""
    b = _pairs(spark, sf_dir)
    some = b["users"].where("reviewer_index % 50 = 0")
    return similarity.neighbour_scores(b["pairs"], users=some).select(
        "reviewer_index", "asin_index", F.round("score", 6).alias("score"))


def _unfold(pieces, vector, other, value, width):
    return pieces.select("reviewer_index", "piece", F.posexplode(vector).alias("pos", value)).select(
        "reviewer_index", (F.col("piece") * width + F.col("pos") + 1).alias(other), F.round(value, 6).alias(value))


def q_similarity_pieces(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    return _unfold(similarity.similarity_pieces(None, b["n_users"], width=64, pairs=b["pairs"]), "Similarity", "other_index", "cos", 64)


def q_score_pieces(spark, sf_dir):
    b = _pairs(spark, sf_dir)
    return _unfold(similarity.score_pieces(_scores(spark, sf_dir), b["n_items"], width=64), "g_score_vector", "asin_index", "score", 64)


# ---------------------------------------------------------------- step 6: Spark ML ALS

def _builtin(spark, sf_dir):
    b = _indexed(spark, sf_dir)
    if "builtin" not in b:
        b["builtin"] = als_builtin.fit_builtin(ratings.rating_triples(b["indexed"]), rank=20, max_iter=15,
                                               reg=0.01, seed=42)
    return b


def q_builtin_als_mse(spark, sf_dir):
    """Spark ML's fit predicts every rating, with a mean squared error well below the variance."""
    b = _builtin(spark, sf_dir)
    pred = als_builtin.predict_builtin(b["builtin"], ratings.rating_triples(b["indexed"]))
    return metrics.error_metrics(pred).select("n", (F.col("mse") < 0.25).alias("mse_below_quarter"))


def q_builtin_user_factors(spark, sf_dir):
    """Spark ML's user factors (updated last) solve their normal equations with λ times the count,
    up to its single precision."""
    b = _builtin(spark, sf_dir)
    users, items = als_builtin.builtin_factors(b["builtin"])
    left = _residuals(ratings.rating_triples(b["indexed"]), users, "reviewer_index", items, "asin_index", lambda n: 0.01 * n)
    return left.select("reviewer_index", "n", (F.col("residual") < 0.05).alias("ok"))


def q_builtin_recommend(spark, sf_dir):
    """Spark ML's ten best unseen items per user against exact scores of its factors, rank by rank (single precision)."""
    b = _pairs(spark, sf_dir)
    _builtin(spark, sf_dir)
    top = als_builtin.recommend_builtin(b["builtin"], b["pairs"], n=10)
    users, items = als_builtin.builtin_factors(b["builtin"])
    exact = recommend.recommend_unseen(users, items, b["pairs"], n=10).select(
        "reviewer_index", "rec_rank", F.col("score").alias("exact"), F.col("asin_index").alias("best_item"))
    pairs = b["pairs"].select("reviewer_index", "asin_index", F.lit(True).alias("rated"))
    both = top.join(exact, ["reviewer_index", "rec_rank"], "full").join(pairs, ["reviewer_index", "asin_index"], "left")
    fine = (F.abs(F.col("score") - F.col("exact")) < 1e-4) & F.col("rated").isNull()
    return both.groupBy("reviewer_index").agg(F.count("asin_index").alias("n"), F.count("best_item").alias("n_exact"),
                                              F.bool_and(F.coalesce(fine, F.lit(False))).alias("ok"))


# ---------------------------------------------------------------- step 8: exported examples + regression

def _example_lines(spark, sf_dir):
    """Training lines ``([x…], [y…], r)`` rendered from the arithmetic factors (k = 20)."""
    X, Y = _arith_factors(spark, sf_dir, PRED_K)
    b = _indexed(spark, sf_dir)
    rated = b["indexed"].select("reviewer_index", "asin_index", "overall")     # no line has the item's name
    both = predict.with_factors(rated, X, Y, b["n_users"], b["n_items"], PRED_K)
    return both.select(example_line("reviewer_latent_vector", "asin_latent_vector", "overall").alias("value"))


def _parsed(spark, sf_dir):
    return accepted_examples(parse_examples(_example_lines(spark, sf_dir), width=2 * PRED_K))


def q_parse_examples(spark, sf_dir):
    ex = _parsed(spark, sf_dir)
    return ex.select((F.size("user_vec") + F.size("item_vec")).alias("width"), "label",
                     F.round(dot("user_vec", "item_vec"), 9).alias("dot"))


def q_dot_baseline_mae(spark, sf_dir):
    ex = _parsed(spark, sf_dir).select("label", dot("user_vec", "item_vec").alias("predicted_overall"))
    return metrics.mae(ex, label="label").select(F.round("mae", 9).alias("mae"))


def q_examples_roundtrip(spark, sf_dir):
    """Training lines written as text with bad lines among them (width, text, NaN), read back:
    accepted and rejected counts and the label sum."""
    lines = _example_lines(spark, sf_dir)
    bad = spark.createDataFrame([("([1.0], [2.0], 3.0)",), ("not a line",), ("([NaN], [2.0], 3.0)",), ("",)], "value string")
    wide = _indexed(spark, sf_dir)["indexed"].groupBy().agg(F.concat(
        F.lit("(["), F.array_join(F.array_repeat(F.lit("0.5"), 2 * PRED_K), ", "), F.lit("], [], NaN)")).alias("value"))
    path = f"{ensure_checkpoint_dir(spark)}/staged/lines-{uuid.uuid4().hex}"
    write_lines(lines.unionByName(bad).unionByName(wide), path)
    parsed = read_examples_text(spark, path)
    return parsed.agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"),
                      F.sum(F.when(F.col("accepted"), F.col("label"))).alias("label_sum"))


def q_examples_rejects(spark, sf_dir):
    """Training lines with bad ones among them, kept aside in the pass that reads them: counts per reason, and the metrics
    observed on the way."""
    bad = spark.createDataFrame([("([1.0], [2.0], 3.0)",), ("not a line",), ("([NaN], [2.0], 3.0)",), ("",)], "value string")
    path = f"{ensure_checkpoint_dir(spark)}/staged/lines-{uuid.uuid4().hex}"
    write_lines(_example_lines(spark, sf_dir).unionByName(bad), path)
    checked = split_rejects(reject_reason(read_examples_text(spark, path, 2 * PRED_K)))
    rows = checked.accepted.select(F.lit("accepted").alias("reason")).unionByName(checked.rejected.select("reason"))
    return rows.groupBy("reason").agg(F.count("*").alias("n")).withColumns(
        {"observed_accepted": F.lit(checked.n_accepted), "observed_rejected": F.lit(checked.n_rejected)})


def q_reviews_json_rejects(spark, sf_dir):
    """The lines that a review scan can't use, with reason and text, beside the number of those it can."""
    reviews = _base(spark, sf_dir)["reviews"]
    holes = spark.createDataFrame([(None, "P1", 5.0), ("U1", None, 4.0), ("U1", "P1", None)], reviews.schema.names)
    bad = spark.createDataFrame([("{broken",), ('{"reviewerID":"U1","asin":"P1","overall":"five"}',)], "value string")
    path = f"{ensure_checkpoint_dir(spark)}/staged/reviews-{uuid.uuid4().hex}"
    reviews.unionByName(holes).select(F.to_json(F.struct("*")).alias("value")).unionByName(bad).write.text(path)
    checked = split_rejects(scan_reviews_json(spark, path))
    total = checked.accepted.agg(F.lit("accepted").alias("reason"), F.lit(None).cast("string").alias("line"), F.count("*").alias("n"))
    return total.unionByName(checked.rejected.select("reason", "line", F.lit(1).cast("long").alias("n")))


def q_reviews_json_roundtrip(spark, sf_dir):
    """Reviews written as JSON lines, with NULL ids and a malformed line, scanned with the fixed schema."""
    reviews = _base(spark, sf_dir)["reviews"]
    holes = spark.createDataFrame([(None, "P1", 5.0), ("U1", None, 4.0), ("U1", "P1", None)], reviews.schema.names)
    path = f"{ensure_checkpoint_dir(spark)}/staged/reviews-{uuid.uuid4().hex}"
    reviews.unionByName(holes).select(F.to_json(F.struct("*")).alias("value")).unionByName(
        spark.createDataFrame([("{broken",)], "value string")).write.text(path)
    return clean_reviews(read_reviews_json(spark, path, drop_malformed=True))


def _mlp(spark, sf_dir):
    """MLP on the learnt k = 20 factors (15 plain-λ ALS epochs), trained 30 epochs."""
    b = _indexed(spark, sf_dir)
    if "mlp" not in b:
        model = _fit(spark, sf_dir, 20, 15, init="random")
        ex = cut_lineage(predict.with_factors(ratings.rating_triples(b["indexed"]), model.user_factors, model.item_factors, model.max_users, model.max_items, model.k).select(
            F.concat("reviewer_latent_vector", "asin_latent_vector").alias("features"),
            F.col("overall").alias("label")))
        b["mlp"] = cut_lineage(mlp.predict_mlp(mlp.fit_mlp(ex, epochs=30), ex))
    return b["mlp"]


def q_mlp_predictions(spark, sf_dir):
    """Predictions per label: how many, and whether all are finite."""
    finite = F.coalesce(F.abs("prediction") < float("inf"), F.lit(False))
    return _mlp(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"), F.bool_and(finite).alias("finite"))


def q_mlp_mae(spark, sf_dir):
    """The network's mean absolute error beats always answering the median rating."""
    pred = _mlp(spark, sf_dir)
    median = pred.agg(F.percentile("label", 0.5)).first()[0]
    return pred.agg(F.count("*").alias("n"), (F.avg(F.abs(F.col("prediction") - F.col("label")))
                                              < F.avg(F.abs(F.lit(median) - F.col("label")))).alias("below_median_baseline"))


#: Steps, start and settings of ``mlp_adam_steps``, in Spark and in SQL.
ADAM = dict(epochs=5, lr=0.02, hidden=(2,), seed=7)


def q_mlp_adam_steps(spark, sf_dir):
    """Predictions of a small net (two inputs, two hidden units) after five full-batch Adam steps in barrier stages."""
    X, Y = _arith_factors(spark, sf_dir, 1)
    b = _indexed(spark, sf_dir)
    ex = predict.with_factors(b["indexed"], X, Y, b["n_users"], b["n_items"], 1).select(
        F.concat("reviewer_latent_vector", "asin_latent_vector").alias("features"), F.col("overall").alias("label"))
    net = mlp_sync.fit_adam(ex, batch=1 << 40, **ADAM)
    return mlp.predict_mlp(net, ex).select("label", F.round("prediction", 5).alias("prediction"))


# ---------------------------------------------------------------- SQL oracles

_RV = """rv AS (
  SELECT concat('U', lpad(CAST(o_custkey AS varchar), 9, '0')) AS reviewerID,
         concat('P', lpad(CAST(l_partkey AS varchar), 9, '0')) AS asin,
         CAST(1 + floor((l_quantity - 1) / 10) AS double) AS overall
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL AND l_quantity IS NOT NULL)"""
_ITEMS = """items AS (
  SELECT asin, CAST(row_number() OVER (ORDER BY asin) AS INTEGER) AS asin_index
  FROM (SELECT DISTINCT asin FROM rv))"""
_USERS = """users AS (
  SELECT reviewerID, CAST(row_number() OVER (ORDER BY reviewerID) AS INTEGER) AS reviewer_index
  FROM (SELECT DISTINCT reviewerID FROM rv))"""
_IR = """ir AS (
  SELECT rv.reviewerID, users.reviewer_index, rv.asin, items.asin_index, rv.overall
  FROM rv JOIN items ON rv.asin = items.asin JOIN users ON rv.reviewerID = users.reviewerID)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_PAIRS = """pairs AS (
  SELECT reviewer_index, asin_index, max(CAST(trunc(overall) AS INTEGER)) AS rating
  FROM ir GROUP BY reviewer_index, asin_index)"""

_BASE = _with(_RV, _ITEMS, _USERS, _IR)
_BASE_P = _with(_RV, _ITEMS, _USERS, _IR, _PAIRS)


def _arith_sql(col: str, f: int) -> str:
    return f"((CAST({col} AS BIGINT) * 7919 + {f} * 104729) % 1000 + 1) / CAST(1001 AS double)"


def _factor_ctes(k: int) -> str:
    xs = ", ".join(f"{_arith_sql('reviewer_index', f)} AS x{f}" for f in range(1, k + 1))
    ys = ", ".join(f"{_arith_sql('asin_index', f)} AS y{f}" for f in range(1, k + 1))
    return f"xf AS (SELECT reviewer_index, {xs} FROM users),\nyf AS (SELECT asin_index, {ys} FROM items)"


def _dot_sql(k: int, a: str = "x", b: str = "y") -> str:
    return "(CAST(0 AS double)" + "".join(f" + {a}{f} * {b}{f}" for f in range(1, k + 1)) + ")"


def _ysum() -> str:
    return " + ".join(f"y{f}" for f in range(1, PRED_K + 1))


_PRED = _with(_RV, _ITEMS, _USERS, _IR, _factor_ctes(PRED_K), f"""pred AS (
  SELECT ir.reviewer_index, ir.asin_index, ir.asin, ir.overall, {_dot_sql(PRED_K)} AS predicted_overall
  FROM ir JOIN xf ON ir.reviewer_index = xf.reviewer_index JOIN yf ON ir.asin_index = yf.asin_index)""")


def _als_ctes(rank: int, epochs: int) -> list[str]:
    """Unrolled ALS epochs in SQL: closed-form solve for rank 1 and rank 2, λ = 1."""
    lam = "CAST(1 AS double)"
    ys = ", ".join(f"{_arith_sql('asin_index', f)} AS f{f}" for f in range(1, rank + 1))
    ctes = [f"y0 AS (SELECT asin_index AS id, {ys} FROM items)"]

    def half(name, key, other, src):
        inner = (f"FROM ir JOIN {src} s ON ir.{other} = s.id GROUP BY ir.{key}")
        if rank == 1:
            return (f"{name} AS (SELECT ir.{key} AS id, sum(ir.overall * s.f1) / (sum(s.f1 * s.f1) + {lam}) AS f1 "
                    f"{inner})")
        det = f"((a + {lam}) * (c + {lam}) - g * g)"
        return (f"{name} AS (SELECT id, ((c + {lam}) * b1 - g * b2) / {det} AS f1, "
                f"((a + {lam}) * b2 - g * b1) / {det} AS f2 FROM (SELECT ir.{key} AS id, "
                f"sum(s.f1 * s.f1) AS a, sum(s.f1 * s.f2) AS g, sum(s.f2 * s.f2) AS c, "
                f"sum(ir.overall * s.f1) AS b1, sum(ir.overall * s.f2) AS b2 {inner}))")
    for e in range(1, epochs + 1):
        ctes.append(half(f"x{e}", "reviewer_index", "asin_index", f"y{e - 1}"))
        ctes.append(half(f"y{e}", "asin_index", "reviewer_index", f"x{e}"))
    return ctes


def _als_sides_sql(rank: int, epochs: int) -> str:
    cols = ", ".join(f"round(f{f}, 4) AS f{f}" for f in range(1, rank + 1))
    return (_with(_RV, _ITEMS, _USERS, _IR, *_als_ctes(rank, epochs))
            + f"SELECT 'user' AS side, id, {cols} FROM x{epochs} UNION ALL "
              f"SELECT 'item' AS side, id, {cols} FROM y{epochs}")


def _als_objective_sql() -> str:
    dot = "(CAST(0 AS double) + x.f1 * y.f1 + x.f2 * y.f2)"
    body = f"""SELECT round(sse, 3) AS sse, round(x_sq, 3) AS x_sq, round(y_sq, 3) AS y_sq,
        round(sse + CAST(1 AS double) * (x_sq + y_sq), 3) AS objective FROM
        (SELECT sum(pow(ir.overall - {dot}, 2)) AS sse FROM ir JOIN x2 x ON ir.reviewer_index = x.id
           JOIN y2 y ON ir.asin_index = y.id) e,
        (SELECT sum(CAST(0 AS double) + f1 * f1 + f2 * f2) AS x_sq FROM x2) nx,
        (SELECT sum(CAST(0 AS double) + f1 * f1 + f2 * f2) AS y_sq FROM y2) ny"""
    return _with(_RV, _ITEMS, _USERS, _IR, *_als_ctes(2, 2)) + body


_NORMS = """norms AS (
  SELECT reviewer_index, sum(CAST(rating AS double) * CAST(rating AS double)) AS norm_sq
  FROM pairs GROUP BY reviewer_index)"""
_COS = """dots AS (
  SELECT a.reviewer_index AS u, b.reviewer_index AS v, sum(CAST(a.rating AS double) * b.rating) AS dot
  FROM pairs a JOIN pairs b ON a.asin_index = b.asin_index AND a.reviewer_index <= b.reviewer_index
  GROUP BY 1, 2),
cos AS (
  SELECT u, v, dot / (sqrt(na.norm_sq) * sqrt(nb.norm_sq)) AS cos
  FROM dots JOIN norms na ON na.reviewer_index = u JOIN norms nb ON nb.reviewer_index = v),
sym AS (SELECT u, v, cos FROM cos UNION ALL SELECT v AS u, u AS v, cos FROM cos WHERE u <> v)"""
_SCORES = """mass AS (SELECT u, sum(cos) AS mass FROM sym GROUP BY u),
num AS (SELECT s.u, p.asin_index, sum(s.cos * p.rating) AS num
        FROM sym s JOIN pairs p ON p.reviewer_index = s.v GROUP BY 1, 2),
scores AS (SELECT num.u AS reviewer_index, asin_index, num / mass AS score FROM num JOIN mass ON mass.u = num.u)"""
_SIM = _with(_RV, _ITEMS, _USERS, _IR, _PAIRS, _NORMS, _COS)
_SIM_SCORES = _with(_RV, _ITEMS, _USERS, _IR, _PAIRS, _NORMS, _COS, _SCORES)


_BEST = """best AS (
  SELECT u, v, cos FROM (SELECT u, v, cos, row_number() OVER (PARTITION BY u ORDER BY cos DESC, v) AS rn FROM sym WHERE u <> v) WHERE rn <= 20
  UNION ALL SELECT u, v, cos FROM cos WHERE u = v)"""


def _mlp_adam_sql() -> str:
    """Five full-batch Adam steps of the 2-2-1 net, unrolled: parameters w1..w9 in the order of ``MLP.params``."""
    start = [float(x) for x in mlp.init_mlp(2, ADAM["hidden"], ADAM["seed"]).params]
    num = lambda x: f"CAST({x!r} AS DOUBLE)"
    ks = range(1, len(start) + 1)
    forward = """(SELECT e.*, {p}, greatest(x * w1 + y * w3 + w5, 0) AS a1, greatest(x * w2 + y * w4 + w6, 0) AS a2 FROM ex e, {state})""".replace(
        "{p}", ", ".join(f"w{k}" for k in ks))
    out = "(a1 * w7 + a2 * w8 + w9)"
    ctes = ["ex AS (SELECT overall AS r, x1 AS x, y1 AS y FROM ir JOIN xf ON ir.reviewer_index = xf.reviewer_index "
            "JOIN yf ON ir.asin_index = yf.asin_index)",
            "s0 AS (SELECT " + ", ".join(f"{num(w)} AS w{k}, {num(0.0)} AS m{k}, {num(0.0)} AS v{k}" for k, w in zip(ks, start)) + ")"]
    on = [f"(CASE WHEN a{j} > 0 THEN w{6 + j} ELSE 0 END)" for j in (1, 2)]
    terms = [f"d * x * {on[0]}", f"d * x * {on[1]}", f"d * y * {on[0]}", f"d * y * {on[1]}", f"d * {on[0]}", f"d * {on[1]}", "d * a1", "d * a2", "d"]
    for t in range(1, ADAM["epochs"] + 1):
        sums = ", ".join(f"sum({g}) / count(*) AS g{k}" for k, g in zip(ks, terms))
        ctes.append(f"g{t} AS (SELECT {sums} FROM (SELECT *, CAST(sign({out} - r) AS DOUBLE) AS d FROM {forward.replace('{state}', f's{t - 1}')}))")
        moments = ", ".join(f"0.9::DOUBLE * m{k} + (1 - 0.9::DOUBLE) * g{k} AS m{k}, 0.999::DOUBLE * v{k} + (1 - 0.999::DOUBLE) * g{k} * g{k} AS v{k}, w{k}"
                            for k in ks)
        steps = ", ".join(f"w{k} - {num(ADAM['lr'])} * (m{k} / (1 - pow(0.9::DOUBLE, {t}))) / (sqrt(v{k} / (1 - pow(0.999::DOUBLE, {t}))) + 1e-7::DOUBLE) "
                          f"AS w{k}, m{k}, v{k}" for k in ks)
        ctes.append(f"s{t} AS (SELECT {steps} FROM (SELECT {moments} FROM s{t - 1}, g{t}))")
    last = forward.replace("{state}", f"s{ADAM['epochs']}")
    return _with(_RV, _ITEMS, _USERS, _IR, _factor_ctes(1), *ctes) + f"SELECT r AS label, round({out}, 5) AS prediction FROM {last}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ratings_view": q_ratings_view,
        "distinct_items": q_distinct_items,
        "distinct_users": q_distinct_users,
        "entity_counts": q_entity_counts,
        "item_index": q_item_index,
        "user_index": q_user_index,
        "indexed_ratings": q_indexed_ratings,
        "rating_pairs": q_rating_pairs,
        "ratings_by_user": q_ratings_by_user,
        "ratings_by_item": q_ratings_by_item,
        "user_matrix": q_user_matrix,
        "item_matrix": q_item_matrix,
        "predict_ratings": q_predict_ratings,
        "predict_grid": q_predict_grid,
        "train_mae": q_train_mae,
        "train_mse": q_train_mse,
        "als_normal_eq": q_als_normal_eq,
        "als_normal_eq_k20": q_als_normal_eq_k20,
        "als_half_step_users": q_als_half_step_users,
        "als_half_step_users_large": q_als_half_step_users_large,
        "als_fit_rank1": q_als_fit_rank1,
        "als_fit_rank2": q_als_fit_rank2,
        "als_objective": q_als_objective,
        "als_fit_k20": q_als_fit_k20,
        "recommend_unseen": q_recommend_unseen,
        "recommend_unseen_rank2": q_recommend_unseen_rank2,
        "recommend_unseen_als": q_recommend_unseen_als,
        "user_norms": q_user_norms,
        "user_cosine": q_user_cosine,
        "similar_users_top10": q_similar_users_top10,
        "similar_users_top10_all": q_similar_users_top10_all,
        "similarity_mass": q_similarity_mass,
        "neighbour_scores": q_neighbour_scores,
        "similarity_vector": q_similarity_vector,
        "score_vector": q_score_vector,
        "builtin_als_mse": q_builtin_als_mse,
        "builtin_user_factors": q_builtin_user_factors,
        "parse_examples": q_parse_examples,
        "dot_baseline_mae": q_dot_baseline_mae,
        "examples_roundtrip": q_examples_roundtrip,
        "reviews_json_roundtrip": q_reviews_json_roundtrip,
        "approx_entity_counts": q_approx_entity_counts,
        "ratings_by_item_pages": q_ratings_by_item_pages,
        "user_matrix_blocks": q_user_matrix_blocks,
        "als_objective_tracked": q_als_objective_tracked,
        "als_fit_resumed": q_als_fit_resumed,
        "grid_preview": q_grid_preview,
        "factors_roundtrip": q_factors_roundtrip,
        "predictions_csv_roundtrip": q_predictions_csv_roundtrip,
        "user_lists_json_roundtrip": q_user_lists_json_roundtrip,
        "user_cosine_floor": q_user_cosine_floor,
        "similar_users_floor": q_similar_users_floor,
        "similar_users_best10": q_similar_users_best10,
        "neighbour_scores_top20": q_neighbour_scores_top20,
        "similarity_mass_direct": q_similarity_mass_direct,
        "neighbour_scores_items": q_neighbour_scores_items,
        "neighbour_scores_users": q_neighbour_scores_users,
        "similarity_pieces": q_similarity_pieces,
        "score_pieces": q_score_pieces,
        "builtin_recommend": q_builtin_recommend,
        "examples_rejects": q_examples_rejects,
        "reviews_json_rejects": q_reviews_json_rejects,
        "mlp_adam_steps": q_mlp_adam_steps,
        "mlp_predictions": q_mlp_predictions,
        "mlp_mae": q_mlp_mae,
        **_LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "ratings_view": _BASE + "SELECT * FROM rv",
        "distinct_items": _BASE + "SELECT DISTINCT asin FROM rv",
        "distinct_users": _BASE + "SELECT DISTINCT reviewerID FROM rv",
        "entity_counts": _BASE + """SELECT (SELECT count(asin) FROM items) AS num_distinct_asins,
            (SELECT count(reviewerID) FROM users) AS num_distinct_reviewerIDs""",
        "item_index": _BASE + "SELECT * FROM items",
        "user_index": _BASE + "SELECT * FROM users",
        "indexed_ratings": _BASE + "SELECT * FROM ir",
        "rating_pairs": _BASE_P + "SELECT * FROM pairs",
        "ratings_by_user": _BASE_P + """SELECT reviewer_index,
            string_agg(CAST(asin_index AS varchar) || ':' || CAST(rating AS varchar), ',' ORDER BY asin_index)
            AS ratings FROM pairs GROUP BY reviewer_index""",
        "ratings_by_item": _BASE_P + """SELECT asin_index,
            string_agg(CAST(reviewer_index AS varchar) || ':' || CAST(rating AS varchar), ',' ORDER BY reviewer_index)
            AS ratings FROM pairs GROUP BY asin_index""",
        "user_matrix": _BASE_P + """SELECT u.reviewer_index,
            string_agg(CAST(coalesce(p.rating, 0) AS varchar), ',' ORDER BY g.pos) AS ratings
            FROM users u CROSS JOIN (SELECT CAST(range AS INTEGER) AS pos FROM range(1, (SELECT count(*) FROM items) + 1)) g
            LEFT JOIN pairs p ON p.reviewer_index = u.reviewer_index AND p.asin_index = g.pos
            GROUP BY u.reviewer_index""",
        "item_matrix": _BASE_P + """SELECT i.asin_index,
            string_agg(CAST(coalesce(p.rating, 0) AS varchar), ',' ORDER BY g.pos) AS ratings
            FROM items i CROSS JOIN (SELECT CAST(range AS INTEGER) AS pos FROM range(1, (SELECT count(*) FROM users) + 1)) g
            LEFT JOIN pairs p ON p.asin_index = i.asin_index AND p.reviewer_index = g.pos
            GROUP BY i.asin_index""",
        "predict_ratings": _PRED + "SELECT * FROM pred",
        "predict_grid": _with(_RV, _ITEMS, _USERS, _IR, _factor_ctes(PRED_K)) + f"""
            SELECT x.reviewer_index, y.asin_index, items.asin, {_dot_sql(PRED_K)} AS predicted_overall
            FROM (SELECT * FROM xf ORDER BY reviewer_index DESC LIMIT 10) x
            CROSS JOIN (SELECT * FROM yf ORDER BY asin_index DESC LIMIT 100) y
            JOIN items ON items.asin_index = y.asin_index""",
        "train_mae": _PRED + "SELECT round(avg(abs(overall - predicted_overall)), 9) AS mae FROM pred",
        "train_mse": _PRED + "SELECT round(avg(pow(overall - predicted_overall, 2)), 9) AS mse FROM pred",
        "als_normal_eq": _with(_RV, _ITEMS, _USERS, _IR, *_als_ctes(2, 0)) + """
            SELECT ir.reviewer_index, round(sum(s.f1 * s.f1), 6) AS g11, round(sum(s.f1 * s.f2), 6) AS g12,
                   round(sum(s.f2 * s.f2), 6) AS g22, round(sum(ir.overall * s.f1), 6) AS b1,
                   round(sum(ir.overall * s.f2), 6) AS b2, count(*) AS n
            FROM ir JOIN y0 s ON ir.asin_index = s.id GROUP BY ir.reviewer_index""",
        "als_half_step_users": _with(_RV, _ITEMS, _USERS, _IR, *_als_ctes(2, 1)) + """
            SELECT id AS reviewer_index, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM x1""",
        "als_half_step_users_large": _with(_RV, _ITEMS, _USERS, _IR, *_als_ctes(2, 1)) + """
            SELECT id AS reviewer_index, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM x1""",
        "als_normal_eq_k20": _with(_RV, _ITEMS, _USERS, _IR, _factor_ctes(PRED_K)) + f"""
            SELECT ir.reviewer_index, round(sum(({_ysum()}) * ({_ysum()})), 5) AS gram_sum,
                   round(sum(ir.overall * ({_ysum()})), 5) AS rhs_sum, round(sum(y1 * y20), 6) AS g1_20,
                   round(sum(y20 * y20), 6) AS g20_20, count(*) AS n
            FROM ir JOIN yf ON ir.asin_index = yf.asin_index GROUP BY ir.reviewer_index""",
        "als_fit_k20": _BASE + """SELECT 'item' AS side, asin_index AS id, count(*) AS n, true AS ok FROM ir GROUP BY asin_index
            UNION ALL SELECT 'user', reviewer_index, count(*), true FROM ir GROUP BY reviewer_index""",
        "recommend_unseen_als": _BASE_P + """SELECT reviewer_index,
            least(10, (SELECT count(*) FROM items) - count(*)) AS n, true AS ok FROM pairs GROUP BY reviewer_index""",
        "recommend_unseen_rank2": _with(_RV, _ITEMS, _USERS, _IR, _PAIRS, *_als_ctes(2, 2)) + """,
            xi AS (SELECT id, round(round(f1, 4) * 10000) AS f1, round(round(f2, 4) * 10000) AS f2 FROM x2),
            yi AS (SELECT id, round(round(f1, 4) * 10000) AS f1, round(round(f2, 4) * 10000) AS f2 FROM y2),
            cand AS (SELECT xi.id AS reviewer_index, yi.id AS asin_index, xi.f1 * yi.f1 + xi.f2 * yi.f2 AS score FROM xi CROSS JOIN yi
                     WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.reviewer_index = xi.id AND p.asin_index = yi.id)),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY reviewer_index ORDER BY score DESC, asin_index) AS rn FROM cand)
            SELECT reviewer_index, CAST(rn AS INTEGER) AS rec_rank, asin_index, score FROM ranked WHERE rn <= 10""",
        "builtin_als_mse": _BASE + "SELECT count(*) AS n, true AS mse_below_quarter FROM ir",
        "builtin_user_factors": _BASE + "SELECT reviewer_index, count(*) AS n, true AS ok FROM ir GROUP BY reviewer_index",
        "mlp_predictions": _BASE + "SELECT overall AS label, count(*) AS n, true AS finite FROM ir GROUP BY overall",
        "mlp_mae": _BASE + "SELECT count(*) AS n, true AS below_median_baseline FROM ir",
        "examples_roundtrip": _BASE + "SELECT count(*) AS accepted, 5 AS rejected, sum(overall) AS label_sum FROM ir",
        "reviews_json_roundtrip": _BASE + "SELECT * FROM rv",
        "als_fit_rank1": _als_sides_sql(1, 2),
        "als_fit_rank2": _als_sides_sql(2, 2),
        "als_objective": _als_objective_sql(),
        "recommend_unseen": _with(_RV, _ITEMS, _USERS, _IR, _PAIRS, _factor_ctes(1)) + """,
            cand AS (SELECT xf.reviewer_index, yf.asin_index, xf.x1 * yf.y1 AS score FROM xf CROSS JOIN yf
                     WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.reviewer_index = xf.reviewer_index
                                       AND p.asin_index = yf.asin_index)),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY reviewer_index ORDER BY score DESC, asin_index)
                       AS rn FROM cand)
            SELECT reviewer_index, CAST(rn AS INTEGER) AS rec_rank, asin_index, score FROM ranked WHERE rn <= 10""",
        "user_norms": _with(_RV, _ITEMS, _USERS, _IR, _PAIRS, _NORMS)
            + "SELECT reviewer_index, norm_sq, sqrt(norm_sq) AS norm FROM norms",
        "user_cosine": _SIM + "SELECT u, v, cos FROM cos",
        "similar_users_top10": _SIM + """,
            tgt AS (SELECT max(reviewer_index) AS t FROM users),
            t AS (SELECT asin_index, rating AS r0 FROM pairs, tgt WHERE reviewer_index = tgt.t),
            n0 AS (SELECT sum(CAST(r0 AS double) * r0) AS n0 FROM t),
            d AS (SELECT p.reviewer_index AS v, sum(CAST(p.rating AS double) * t.r0) AS dot
                  FROM pairs p JOIN t ON p.asin_index = t.asin_index GROUP BY 1),
            c AS (SELECT v, dot / (sqrt(n0) * sqrt(norms.norm_sq)) AS cos
                  FROM d JOIN norms ON norms.reviewer_index = d.v, n0, tgt WHERE v <> tgt.t)
            SELECT (SELECT t FROM tgt) AS reviewer_index,
                   CAST(row_number() OVER (ORDER BY cos DESC, v) AS INTEGER) AS sim_rank, v AS similar_index, cos
            FROM c ORDER BY cos DESC, v LIMIT 10""",
        "similar_users_top10_all": _SIM + """,
            r AS (SELECT u, v, cos, row_number() OVER (PARTITION BY u ORDER BY cos DESC, v) AS rn
                  FROM sym WHERE u <> v)
            SELECT u AS reviewer_index, CAST(rn AS INTEGER) AS sim_rank, v AS similar_index, cos FROM r WHERE rn <= 10""",
        "similarity_mass": _SIM + "SELECT u AS reviewer_index, round(sum(cos), 9) AS mass FROM sym GROUP BY u",
        "neighbour_scores": _SIM_SCORES + "SELECT reviewer_index, asin_index, round(score, 6) AS score FROM scores",
        "similarity_vector": _SIM + """
            SELECT u.reviewer_index, g.pos AS other_index, coalesce(s.cos, CAST(0 AS double)) AS cos
            FROM (SELECT DISTINCT u AS reviewer_index FROM sym) u
            CROSS JOIN (SELECT CAST(range AS INTEGER) AS pos FROM range(1, (SELECT count(*) FROM users) + 1)) g
            LEFT JOIN sym s ON s.u = u.reviewer_index AND s.v = g.pos""",
        "score_vector": _SIM_SCORES + """
            SELECT u.reviewer_index, g.pos AS asin_index, round(coalesce(s.score, CAST(0 AS double)), 6) AS score
            FROM (SELECT DISTINCT reviewer_index FROM scores) u
            CROSS JOIN (SELECT CAST(range AS INTEGER) AS pos FROM range(1, (SELECT count(*) FROM items) + 1)) g
            LEFT JOIN scores s ON s.reviewer_index = u.reviewer_index AND s.asin_index = g.pos""",
        "approx_entity_counts": _BASE + """SELECT (SELECT count(*) FROM items) AS num_distinct_asins,
            (SELECT count(*) FROM users) AS num_distinct_reviewerIDs, true AS num_distinct_asins_near, true AS num_distinct_reviewerIDs_near""",
        "ratings_by_item_pages": _BASE_P + """SELECT asin_index, CAST(rn // 16 AS INTEGER) AS page,
            string_agg(CAST(reviewer_index AS varchar) || ':' || CAST(rating AS varchar), ',' ORDER BY reviewer_index) AS ratings
            FROM (SELECT *, row_number() OVER (PARTITION BY asin_index ORDER BY reviewer_index) - 1 AS rn FROM pairs) GROUP BY asin_index, rn // 16""",
        "user_matrix_blocks": _BASE_P + """SELECT u.reviewer_index,
            string_agg(CAST(coalesce(p.rating, 0) AS varchar), ',' ORDER BY g.pos) AS ratings
            FROM users u CROSS JOIN (SELECT CAST(range AS INTEGER) AS pos FROM range(1, (SELECT count(*) FROM items) + 1)) g
            LEFT JOIN pairs p ON p.reviewer_index = u.reviewer_index AND p.asin_index = g.pos
            GROUP BY u.reviewer_index""",
        "als_objective_tracked": "SELECT 2 AS epochs, objective FROM (" + _als_objective_sql() + ")",
        "als_fit_resumed": _als_sides_sql(2, 2),
        "grid_preview": _with(_RV, _ITEMS, _USERS, _IR, _factor_ctes(PRED_K)) + f"""
            SELECT x.reviewer_index, y.asin_index, items.asin, {_dot_sql(PRED_K)} AS predicted_overall
            FROM (SELECT * FROM xf ORDER BY reviewer_index DESC LIMIT 10) x
            CROSS JOIN (SELECT * FROM yf ORDER BY asin_index DESC LIMIT 100) y
            JOIN items ON items.asin_index = y.asin_index ORDER BY predicted_overall DESC, reviewer_index, y.asin_index LIMIT 20""",
        "factors_roundtrip": _with(_RV, _ITEMS, _USERS, _IR, _factor_ctes(2)) + "SELECT asin_index, y1 AS f1, y2 AS f2 FROM yf",
        "predictions_csv_roundtrip": _PRED + "SELECT * FROM pred",
        "user_lists_json_roundtrip": _BASE_P + """SELECT reviewer_index,
            string_agg(CAST(asin_index AS varchar) || ':' || CAST(rating AS varchar), ',' ORDER BY asin_index)
            AS ratings FROM pairs GROUP BY reviewer_index""",
        "user_cosine_floor": _SIM + "SELECT u, v, cos FROM cos WHERE cos >= 0.1::DOUBLE",
        "similar_users_floor": _SIM + """,
            r AS (SELECT u, v, cos, row_number() OVER (PARTITION BY u ORDER BY cos DESC, v) AS rn
                  FROM sym WHERE u <> v AND cos >= 0.1::DOUBLE)
            SELECT u AS reviewer_index, CAST(rn AS INTEGER) AS sim_rank, v AS similar_index, cos FROM r WHERE rn <= 5""",
        "similar_users_best10": _SIM + """,
            r AS (SELECT u, v, cos, row_number() OVER (PARTITION BY u ORDER BY cos DESC, v) AS rn
                  FROM sym WHERE u <> v)
            SELECT u AS reviewer_index, CAST(rn AS INTEGER) AS sim_rank, v AS similar_index, cos FROM r WHERE rn <= 10""",
        "neighbour_scores_top20": _with(_RV, _ITEMS, _USERS, _IR, _PAIRS, _NORMS, _COS, _BEST) + """
            SELECT num.u AS reviewer_index, asin_index, round(num / mass, 6) AS score
            FROM (SELECT b.u, p.asin_index, sum(b.cos * p.rating) AS num FROM best b JOIN pairs p ON p.reviewer_index = b.v GROUP BY 1, 2) num
            JOIN (SELECT u, sum(cos) AS mass FROM best GROUP BY u) m ON m.u = num.u""",
        "similarity_mass_direct": _SIM + "SELECT u AS reviewer_index, round(sum(cos), 9) AS mass FROM sym GROUP BY u",
        "neighbour_scores_items": _SIM_SCORES + "SELECT reviewer_index, asin_index, round(score, 6) AS score FROM scores",
        "neighbour_scores_users": _SIM_SCORES + """SELECT reviewer_index, asin_index, round(score, 6) AS score FROM scores
            WHERE reviewer_index % 50 = 0""",
        "similarity_pieces": _SIM + """
            SELECT p.u AS reviewer_index, CAST(g.pos AS INTEGER) AS other_index, round(coalesce(s.cos, CAST(0 AS double)), 6) AS cos
            FROM (SELECT DISTINCT u, (v - 1) // 64 AS piece FROM sym) p
            JOIN (SELECT range AS pos, (range - 1) // 64 AS piece FROM range(1, (SELECT count(*) FROM users) + 1)) g ON g.piece = p.piece
            LEFT JOIN sym s ON s.u = p.u AND s.v = g.pos""",
        "score_pieces": _SIM_SCORES + """
            SELECT p.u AS reviewer_index, CAST(g.pos AS INTEGER) AS asin_index, round(coalesce(s.score, CAST(0 AS double)), 6) AS score
            FROM (SELECT DISTINCT reviewer_index AS u, (asin_index - 1) // 64 AS piece FROM scores) p
            JOIN (SELECT range AS pos, (range - 1) // 64 AS piece FROM range(1, (SELECT count(*) FROM items) + 1)) g ON g.piece = p.piece
            LEFT JOIN scores s ON s.reviewer_index = p.u AND s.asin_index = g.pos""",
        "builtin_recommend": _BASE_P + """SELECT reviewer_index, least(10, (SELECT count(*) FROM items) - count(*)) AS n,
            least(10, (SELECT count(*) FROM items) - count(*)) AS n_exact, true AS ok FROM pairs GROUP BY reviewer_index""",
        "examples_rejects": _BASE + """SELECT reason, n, (SELECT count(*) FROM ir) AS observed_accepted, 4 AS observed_rejected FROM
            (SELECT 'accepted' AS reason, count(*) AS n FROM ir UNION ALL SELECT 'width', 1 UNION ALL SELECT 'not numeric', 3)""",
        "reviews_json_rejects": _BASE + """SELECT 'accepted' AS reason, NULL AS line, count(*) AS n FROM rv
            UNION ALL SELECT 'missing', '{"asin":"P1","overall":5.0}', 1
            UNION ALL SELECT 'missing', '{"reviewerID":"U1","overall":4.0}', 1
            UNION ALL SELECT 'missing', '{"reviewerID":"U1","asin":"P1"}', 1
            UNION ALL SELECT 'malformed', '{broken', 1
            UNION ALL SELECT 'malformed', '{"reviewerID":"U1","asin":"P1","overall":"five"}', 1""",
        "mlp_adam_steps": _mlp_adam_sql(),
        "parse_examples": _PRED + f"SELECT {2 * PRED_K} AS width, overall AS label, round(predicted_overall, 9) AS dot FROM pred",
        "dot_baseline_mae": _PRED + "SELECT round(avg(abs(predicted_overall - overall)), 9) AS mae FROM pred",
        **_LLM_ORACLES,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: top-10 unseen items per user from plain-λ ALS factors
    (k = 20, λ = 1, 5 epochs: the benchmark settings of the original scripts)."""
    b = _pairs(spark, SMOKE_DIR)
    model = _fit(spark, SMOKE_DIR, 20, 5, init="random")
    return recommend.recommend_unseen(model.user_factors, model.item_factors, b["pairs"], n=10)
