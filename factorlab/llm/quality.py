"""Quality classifier with hierarchical empirical Bayes (operator 10).

Two targets, good quality and toxicity, are handled alike:

1. Evidence: a logistic model on word presence and binned shape features of the whole text,
   fitted on a bounded sample of labelled rows (``max_train_docs``), gives every document a
   log-likelihood ratio (its log-odds less the log-odds of the training share).
2. Sites: rates per (host, path) and per host are grouped sums over all documents: a labelled
   document counts its label, another its predicted probability.
3. Shrinkage: a host's rate is a Beta posterior around the global rate and a path's one around
   its host, with strengths found by the method of moments from the spread between sites, so a
   sparse site stays near the level above and a well-filled one speaks for itself.
4. Decision: posterior log-odds = site log-odds + evidence. A document is kept if it is good
   with probability at least 1/2 and toxic with probability below 1/2.

Defined cases: null text is an empty text; a null host or path is a site of its own; repeated
label rows of a doc_id count once (worst label); null labels are ignored; without labels of both
kinds the evidence is zero (every document is kept). One row per input row.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorlab.llm.common import read_documents, slices, spare, written

WORD = re.compile(r"\w+")
SHAPES = ("upper", "symbols", "pipes", "digits", "distinct", "repeats", "word_length", "line_length", "words")
_SYMBOLS = np.array([b in b"!#$%&*+=@^_~|<>{}[]\\" for b in range(256)])
TARGETS = ("good", "toxic")
PREFIX = 5


@dataclass
class Model:
    """Fitted evidence model; small (bounded by the vocabulary and bin counts)."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    edges: list[np.ndarray] = field(default_factory=lambda: [np.array([])] * len(SHAPES))
    weights: dict[str, np.ndarray | None] = field(default_factory=lambda: dict.fromkeys(TARGETS))
    prior: dict[str, float] = field(default_factory=lambda: {"good": 0.5, "toxic": 0.0})

    def columns(self) -> int:
        return 1 + len(self.vocabulary) + sum(len(e) + 1 for e in self.edges)

    def active(self, words: set[str], shape: np.ndarray) -> np.ndarray:
        """Indexes of the set features of one document (column 0 is the constant)."""
        hits = [1 + self.vocabulary[w] for w in words & self.vocabulary.keys()]
        at = 1 + len(self.vocabulary)
        for edge, value in zip(self.edges, shape):
            hits.append(at + int(np.searchsorted(edge, value)))
            at += len(edge) + 1
        return np.array([0, *hits])


def terms(words: set[str]) -> set[str]:
    """Words up to 64 letters and, for inflected or compounded forms, their first letters."""
    return {w for w in words if len(w) <= 64} | {w[:PREFIX] + "*" for w in words if len(w) > PREFIX}


def describe(text: str) -> tuple[set[str], np.ndarray]:
    """Terms and shape features of one whole text."""
    words = WORD.findall(text.lower())
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256) if text else np.zeros(256, int)
    n, distinct = max(1, int(raw.sum())), set(words)
    count = max(1, len(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    return terms(distinct), np.array([
        raw[65:91].sum() / n, raw[_SYMBOLS].sum() / n, raw[124] / n, raw[48:58].sum() / n,
        len(distinct) / count, repeats / count, sum(map(len, words)) / count, n / (1 + raw[10]), math.log1p(len(words))])


# ------------------------------------------------------------------ fit

def _worst_labels(labels: DataFrame) -> DataFrame:
    return labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("good"), F.max("toxic").cast("int").alias("toxic"))


def _sampled(docs: DataFrame, labels: DataFrame, max_train_docs: int) -> DataFrame:
    """About ``max_train_docs`` labelled documents, chosen by a hash of the id (broadcast: bounded)."""
    total = labels.count()
    share = min(1.0, max_train_docs / max(1, total))
    chosen = labels.filter(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")


def _vocabulary(sample: DataFrame, size: int, least_docs: int) -> dict[str, int]:
    """Words whose presence differs most between the classes (two-sample z of the shares)."""
    def count(batches):
        for part in slices(batches):
            table = {}
            for text, good, toxic in zip(*(part.column(c).to_pylist() for c in ("text", "good", "toxic"))):
                for w in terms(set(WORD.findall((text or "").lower()))):
                    row = table.setdefault(w, [0, 0, 0])
                    row[0] += 1
                    row[1] += good == 0
                    row[2] += toxic == 1
            cols = list(zip(*table.values())) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(table), pa.string()), *(pa.array(c, pa.int64()) for c in cols)], ["word", "n", "bad", "tox"])

    totals = sample.agg(F.count("*"), F.sum(F.when(F.col("good") == 0, 1).otherwise(0)),
                        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    counts = (sample.mapInArrow(count, "word string, n long, bad long, tox long")
              .groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("tox").alias("tox"))
              .filter(F.col("n") >= least_docs))
    words: dict[str, int] = {}
    for column, inside in (("bad", totals[1]), ("tox", totals[2])):
        rest = (totals[0] or 0) - (inside or 0)
        if not inside or not rest:
            continue
        pooled = F.col("n") / totals[0]
        z = (F.col(column) / inside - (F.col("n") - F.col(column)) / rest) / F.sqrt(
            pooled * (1 - pooled) * (1 / inside + 1 / rest) + 1e-12)
        top = counts.select("word", F.abs(z).alias("z")).filter("z >= 6").orderBy(F.desc("z"), "word").limit(size)
        for row in top.collect():   # at most ``size`` words per target
            words.setdefault(row["word"], len(words))
    return words


def _described(sample: DataFrame, vocabulary: dict[str, int]) -> list:
    """Features of the training sample (bounded by ``max_train_docs``)."""
    def run(batches):
        for part in slices(batches):
            rows = [describe(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([[vocabulary[w] for w in r[0] & vocabulary.keys()] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].tolist() for r in rows], pa.list_(pa.float64())),
                 part.column("good"), part.column("toxic")], ["doc_id", "hits", "shape", "good", "toxic"])

    return (sample.mapInArrow(run, "doc_id long, hits array<int>, shape array<double>, good int, toxic int")
            .orderBy("doc_id").collect())


def _logistic(rows: list[np.ndarray], y: np.ndarray, columns: int, steps: int = 500, spread: float = 3.0) -> np.ndarray:
    """Logistic regression on sparse 0/1 rows, weights with a normal prior of deviation ``spread``.

    Accelerated gradient steps, scaled per column by a bound of its curvature so that rare
    words converge as fast as frequent ones.
    """
    index = np.concatenate(rows)
    sizes = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    ridge = np.where(np.arange(columns) > 0, 1 / spread ** 2, 1e-6)
    bound = np.bincount(index, 0.25 * sizes[owner], columns) + ridge
    weights = ahead = np.zeros(columns)
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.bincount(owner, ahead[index], len(rows))))
        following = ahead - (np.bincount(index, (p - y)[owner], columns) + ridge * ahead) / bound
        ahead, weights = following + t / (t + 3) * (following - weights), following
    return weights


def fit(docs: DataFrame, labels: DataFrame, max_train_docs: int = 20_000, vocabulary_size: int = 512,
        bins: int = 10, least_docs: int = 4) -> Model:
    """Fit the evidence model on at most about ``max_train_docs`` labelled documents."""
    sample = written(_sampled(docs, _worst_labels(labels), max_train_docs), "quality-sample")
    model = Model(vocabulary=_vocabulary(sample, vocabulary_size, least_docs))
    rows = _described(sample, model.vocabulary)
    if not rows:
        return model
    shapes = np.array([r["shape"] for r in rows])
    model.edges = [np.unique(np.quantile(shapes[:, j], np.arange(1, bins) / bins)) for j in range(len(SHAPES))]
    names = list(model.vocabulary)
    features = [model.active({names[i] for i in r["hits"]}, s) for r, s in zip(rows, shapes)]
    for target in TARGETS:
        known = [i for i, r in enumerate(rows) if r[target] is not None]
        y = np.array([float(rows[i][target] > 0) for i in known])
        if len(y) and 0 < y.mean() < 1:
            model.weights[target] = _logistic([features[i] for i in known], y, model.columns())
            model.prior[target] = float(y.mean())
    return model


# ------------------------------------------------------------------ evidence and sites

def evidence(docs: DataFrame, model: Model, host: Column, path: Column) -> DataFrame:
    """``(doc_id, host, path, llr_good, llr_toxic)``, one row per document."""
    shift = {t: math.log(model.prior[t] / (1 - model.prior[t])) if model.weights[t] is not None else 0.0 for t in TARGETS}

    def run(batches):
        for part in slices(batches):
            scores = {t: [] for t in TARGETS}
            for text in part.column("text").to_pylist():
                active = model.active(*describe(text or ""))
                for t in TARGETS:
                    w = model.weights[t]
                    scores[t].append(0.0 if w is None else float(w[active].sum()) - shift[t])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), part.column("path"),
                 *(pa.array(scores[t], pa.float64()) for t in TARGETS)], ["doc_id", "host", "path", "llr_good", "llr_toxic"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"),
                         path.cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, host string, path string, llr_good double, llr_toxic double")


def _strength(sites: DataFrame, mean: str) -> float:
    """Beta strength from the spread of the site rates around ``mean`` (method of moments)."""
    row = sites.agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(mean), 2)).alias("spread"),
        F.count("*").alias("sites")).first()
    if not row["n"] or row["sites"] < 2:
        return 1e6
    rate = min(max(row["s"] / row["n"], 1e-6), 1 - 1e-6)
    noise = rate * (1 - rate)
    between = (row["spread"] - row["sites"] * noise) / row["n"]
    return min(1e6, max(1.0, noise / between - 1)) if between > 0 else 1e6


def site_posteriors(counts: DataFrame) -> tuple[DataFrame, float]:
    """``(host, path, rate)`` and the global rate from ``counts(host, path, n, s)``."""
    n, s = counts.agg(F.sum("n"), F.sum("s")).first()
    overall = min(max((s + 0.5) / (n + 1), 1e-6), 1 - 1e-6) if n else 0.5
    hosts = counts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("above", F.lit(overall))
    strength = _strength(hosts, "above")
    hosts = hosts.select("host", ((F.col("s") + strength * F.col("above")) / (F.col("n") + strength)).alias("above"))
    paths = counts.join(hosts.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    strength = _strength(paths, "above")
    return paths.select("host", "path", ((F.col("s") + strength * F.col("above")) / (F.col("n") + strength)).alias("rate")), overall


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
             model: Model | None = None, **options) -> DataFrame:
    """``(doc_id, host, path, p_good, p_toxic, keep)``, one row per document."""
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", F.col("source"), F.col("lang")) if path is None else path
    model = model or fit(docs, labels, **options)
    scored = written(evidence(docs, model, host, path), "evidence")
    known = _worst_labels(labels).withColumnRenamed("doc_id", "_id")
    marked = scored.join(known, F.col("doc_id") == F.col("_id"), "left")
    probability = {}
    for t in TARGETS:
        if model.weights[t] is None:
            probability[t] = F.lit(model.prior[t])
            continue
        odds = math.log(model.prior[t] / (1 - model.prior[t]))
        p = 1 / (1 + F.exp(-(F.col(f"llr_{t}") + odds)))
        counts = marked.groupBy("host", "path").agg(
            F.count("*").alias("n"), F.sum(F.coalesce((F.col(t) > 0).cast("double"), p)).alias("s"))
        sites, overall = site_posteriors(written(counts, "sites"))
        sites = sites.select(F.col("host").alias("_h"), F.col("path").alias("_p"),
                             F.log(F.col("rate") / (1 - F.col("rate"))).alias(f"site_{t}"))
        scored = scored.join(written(sites, "site-odds"), F.col("host").eqNullSafe(F.col("_h"))
                             & F.col("path").eqNullSafe(F.col("_p")), "left").drop("_h", "_p")
        probability[t] = 1 / (1 + F.exp(-(F.col(f"site_{t}") + F.col(f"llr_{t}"))))
    return scored.select("doc_id", "host", "path", probability["good"].alias("p_good"),
                         probability["toxic"].alias("p_toxic")).withColumn(
                             "keep", (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept; all columns stay.

    Repeated rows of a doc_id go together (a doc_id goes if any of its rows is rejected); rows
    without doc_id can't be named by a decision and stay.
    """
    (key,) = spare(docs, "key")
    gone = classify(docs, labels, **options).filter("NOT keep AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(key), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return classify(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
