"""Approximate nearest neighbours with a hierarchical k-means tree (operator 6).

1. The tree is fitted on a bounded sample (``sample_rows`` vectors, ``sample_values`` numbers): spherical
   k-means with ``branching`` children per node until about one leaf per ``leaf_rows`` rows of the
   table, ``max_leaves`` at most. Its size is bounded by these, so it can go to every task.
2. Every vector descends to a leaf. Equal vectors share a leaf and scores, so of each class of them
   only the ``k + 1`` smallest ids can be among anybody's nearest; the rest are counted, not kept.
3. A query takes leaves best-bin-first: a priority queue over tree nodes ordered by the
   cosine to their centres. The number of leaves visited is widened step by step until the
   recall of ``calibration_rows`` calibration queries, compared with their exact neighbours over all rows, reaches
   ``target_recall``; a query goes on until its leaves hold more than ``k`` rows.
4. Leaves are cut into blocks of ``block_rows`` members; a (leaf, block) meets its queries in
   one group, and the best ``k`` per query are merged by a ranked window.

Defined cases: vectors that are null, empty, zero, hold null or non-finite numbers, or have another
length than most vectors take no part, nor do rows without id; of repeated rows of an id the smallest
vector counts. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorlab.llm.common import written

K = 5
LEAF_ROWS = 512
MAX_LEAVES = 4096
BRANCHING = 16
SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 4_000_000
CALIBRATION_ROWS = 200
TARGET_RECALL = 0.97
BLOCK_ROWS = 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)


# ------------------------------------------------------------------ tree

@dataclass
class Tree:
    """Inner nodes hold the unit centres of their children; ``leaf`` is the number of a leaf."""

    centres: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self) -> int:
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of every unit vector: the nearest child on every level."""
        out = np.empty(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = (vectors[rows] @ self.centres[node].T).argmax(axis=1)
            todo += [(c, rows[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return out

    def visit(self, vector: np.ndarray, leaves: int, sizes: np.ndarray | None = None, rows: int = 0) -> list[int]:
        """Best-bin-first: at least ``leaves`` leaves that hold at least ``rows`` rows, best first."""
        queue, found, held = [(-2.0, 0)], [], 0
        while queue and (len(found) < leaves or held < rows):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(self.leaf[node])
                held += int(sizes[self.leaf[node]]) if sizes is not None else 0
                continue
            for child, near in zip(self.children[node], self.centres[node] @ vector):
                heapq.heappush(queue, (-float(near), child))
        return found


def _kmeans(vectors: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    # einsum: plain loops; the driver's threaded BLAS stalls when other processes hold the cores
    nearest = lambda c: np.einsum("ij,kj->ik", vectors, c).argmax(axis=1)
    centres = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        near = nearest(centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        norms = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(norms[:, None] > 1e-12, sums / np.maximum(norms, 1e-12)[:, None], centres)
    return centres, nearest(centres)


def grow(sample: np.ndarray, leaves: int, branching: int = BRANCHING, seed: int = 7) -> Tree:
    """k-means tree over unit vectors with about ``leaves`` leaves; the largest node splits first."""
    tree, rng = Tree(), np.random.default_rng(seed)
    queue, open_leaves = [(-len(sample), tree.add(), np.arange(len(sample)))], 1
    while queue and open_leaves < leaves:
        size, node, rows = heapq.heappop(queue)
        k = min(branching, leaves - open_leaves + 1, -size // 2)
        if k < 2:
            continue
        centres, near = _kmeans(sample[rows], k, rng)
        used = [i for i in range(k) if (near == i).any()]
        if len(used) < 2:
            continue
        tree.centres[node] = centres[used]
        for i in used:
            child = tree.add()
            tree.children[node].append(child)
            heapq.heappush(queue, (-int((near == i).sum()), child, rows[near == i]))
        open_leaves += len(used) - 1
    for node, below in enumerate(tree.children):
        if not below:
            tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
    return tree


# ------------------------------------------------------------------ table

def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``(vec_id, vector)`` of the rows that take part, one per id, and their dimension."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter("vec_id IS NOT NULL AND size(vector) > 0").filter(finite & F.exists("vector", lambda x: x != 0))
    most = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dimension = most["d"] if most else 0
    same = rows.filter(F.size("vector") == dimension)
    return written(same.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors"), dimension


def _placed(vectors: DataFrame, tree: Tree, dimension: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.place(unit(matrix(batch.column(1), dimension)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "vector", "leaf"])

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id long, vector array<double>, leaf long")


def _best(ids: np.ndarray, members: np.ndarray, query: np.ndarray, own: int, shortlist: np.ndarray, k: int):
    """The ``k`` nearest of a shortlist by exact cosine, own row left out."""
    shortlist = shortlist[ids[shortlist] != own]
    near = members[shortlist]
    score = (near * query).sum(axis=1) / (np.sqrt((near * near).sum(axis=1)) * np.sqrt((query * query).sum()))
    order = np.lexsort((ids[shortlist], -score))[:k]
    return ids[shortlist[order]], score[order]


def _nearest(ids, members, query_ids, queries, k, step=256):
    """``(query, id, score)`` arrays of the ``k`` best members of each query: a matrix product
    picks a shortlist wide enough for ties of equal vectors, which exact cosines then order."""
    out, flat = [], unit(members)
    wide = min(len(ids), 4 * (k + 1))
    for at in range(0, len(query_ids), step):
        rough = unit(queries[at:at + step]) @ flat.T
        short = np.argpartition(-rough, wide - 1, axis=1)[:, :wide]
        for i, row in enumerate(short):
            found, score = _best(ids, members, queries[at + i], query_ids[at + i], row, k)
            out.append((np.full(len(found), query_ids[at + i]), found, score))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


_HITS = "query_id long, vec_id long, score double"


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_neighbours(members: DataFrame, query_ids: np.ndarray, queries: np.ndarray, dimension: int, k: int = K) -> DataFrame:
    """Exact nearest rows of a small stated query set over all rows, block by block."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = _nearest(batch.column(0).to_numpy(), matrix(batch.column(1), dimension), query_ids, queries, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    return _ranked(members.select("vec_id", "vector").mapInArrow(run, _HITS), k)


@dataclass
class Index:
    tree: Tree
    members: DataFrame
    dimension: int
    sizes: np.ndarray
    visits: int
    recall: float


def build(vectors: DataFrame, k: int = K, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES,
          branching: int = BRANCHING, sample_rows: int = SAMPLE_ROWS, calibration_rows: int = CALIBRATION_ROWS,
          target_recall: float = TARGET_RECALL) -> tuple[Index, DataFrame]:
    """Index over all usable rows, and the usable rows themselves."""
    rows, dimension = usable(vectors)
    # members that can matter: the k + 1 smallest ids of every distinct vector
    ids = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = written(rows.withColumn("n", ids).filter(F.col("n") <= k + 1).drop("n"), "distinct-vectors")
    total = distinct.count()
    if not total:
        return Index(Tree([None], [[]], [0], 1), distinct.withColumn("leaf", F.lit(0).cast("long")), dimension, np.zeros(1), 1, 1.0), rows
    wanted = min(sample_rows, SAMPLE_VALUES // dimension, total)
    share = int(min(1.0, 1.2 * wanted / total) * (1 << 20))
    drawn = (distinct.withColumn("draw", F.xxhash64(F.lit("sample"), "vec_id")).filter(F.pmod("draw", F.lit(1 << 20)) < share)
             .orderBy("draw").limit(wanted).select("vec_id", "vector").collect())   # bounded sample
    if not drawn:
        drawn = distinct.orderBy("vec_id").limit(wanted).collect()
    sample = np.array([r["vector"] for r in drawn])
    tree = grow(unit(sample), min(max_leaves, max(1, total // leaf_rows), max(1, len(sample) // 4)), branching)
    members = written(_placed(distinct, tree, dimension), "placed-vectors")
    sizes = np.zeros(tree.leaves)
    for r in members.groupBy("leaf").agg(F.count("*").alias("n")).collect():   # at most max_leaves rows
        sizes[r["leaf"]] = r["n"]
    # calibration: in which place of its own leaf order does a query meet its exact neighbours?
    probe_ids = np.array([r["vec_id"] for r in drawn[:calibration_rows]])
    probes = sample[:calibration_rows]
    found = (exact_neighbours(members, probe_ids, probes, dimension, k).join(members.select("vec_id", "leaf"), "vec_id")
             .select("query_id", "leaf").collect())
    place = {}
    for i, p in zip(probe_ids.tolist(), unit(probes)):
        place[i] = {leaf: at for at, leaf in enumerate(tree.visit(p, tree.leaves))}
    met = np.array([place[r["query_id"]][r["leaf"]] for r in found])
    visits, recall = 1, 1.0
    while len(met):
        recall = float((met < visits).mean())
        if recall >= target_recall or visits >= tree.leaves:
            break
        visits = min(tree.leaves, visits + max(1, visits // 3))
    return Index(tree, members, dimension, sizes, visits, recall), rows


def search(index: Index, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``queries(vec_id, vector)``."""
    tree, dimension, sizes, visits = index.tree, index.dimension, index.sizes, index.visits
    blocks = np.maximum(1, -(-sizes // block_rows)).astype(np.int64)

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, leaf, block = [], [], []
            for i, vector in enumerate(unit(matrix(batch.column(1), dimension))):
                for at in tree.visit(vector, visits, sizes, k + 1):
                    if sizes[at]:
                        n = int(blocks[at])
                        rows += [i] * n
                        leaf += [at] * n
                        block += range(n)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf, pa.int64()), pa.array(block, pa.int64())],
                                             ["vec_id", "vector", "leaf", "block"])

    routed = queries.select("vec_id", "vector").mapInArrow(route, "vec_id long, vector array<double>, leaf long, block long")
    count = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), (F.col("leaf") + 1).cast("int")) if blocks.max() > 1 else F.lit(1)
    members = index.members.withColumn("block", F.pmod(F.xxhash64("vec_id"), count).cast("long"))

    def meet(members, queries):
        if members.num_rows and queries.num_rows:
            found = _nearest(members.column("vec_id").to_numpy(), matrix(members.column("vector").combine_chunks(), dimension),
                             queries.column("vec_id").to_numpy(), matrix(queries.column("vector").combine_chunks(), dimension), k)
        else:
            found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    hits = members.groupBy("leaf", "block").cogroup(routed.groupBy("leaf", "block")).applyInArrow(meet, _HITS)
    return _ranked(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    index, rows = build(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return search(index, rows.filter(F.col("vec_id") % 50 == 0))
