"""SimHash near-duplicates by a binary-trie self-join (operator 4).

``fingerprints`` hashes every word shingle of whole texts and keeps the majority of each bit.
``components`` links fingerprints at Hamming distance ``max_bits`` or less and labels the
connected groups:

1. Equal fingerprints are one trie leaf (aggregated before the shuffle, so thousands of exact
   copies are one row).
2. Two fingerprints that differ in at most ``k`` bits agree on ``s - k`` of any ``s`` segments.
   For every choice of ``s - k`` segments a fingerprint goes to the subtrie whose root path
   is those bits; ``s`` is the smallest count for which the mean subtrie stays small.
3. A task walks its subtries with node pairs: a pair starts as (root, root), descends one bit
   at a time, adds one error when the two sides take different branches, and is pruned once the
   errors exceed the budget; small nodes are compared exactly. Linked leaves are merged in a
   union-find, so a task returns a spanning forest (fewer edges than leaves), never all pairs.
4. A subtrie with more leaves than ``max_leaves`` is cut into blocks, and each pair of blocks
   is a task of its own: memory per task stays bounded for any skew and no link is lost.
5. The forest edges of all subtries go through connected components.

Null or blank texts have fingerprint zero and link like any other. ``near_duplicates`` drops
no row: repeated rows and null doc_ids keep theirs (``component_id`` is null only if the whole
component has no doc_id). Columns other than the id and the text are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorlab.llm.common import as_bytes, own_columns, read_documents, sized_partitions, slices, spare, written
from factorlab.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Leaves compared directly instead of descending further.
LEAF = 6
#: Node pairs (or leaf pairs) handled in one numpy step.
STEP = 1 << 18


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one UTF-8 text (0 for no words)."""
    words = text.lower().split() if text else []   # bytes: A-Z only, the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words_per_shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in
                       zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        part = hashes[at:at + STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << j for j in np.flatnonzero(ones * 2 > len(hashes)).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``: one row per input row; ``fp`` holds the 64 bits as a signed long."""
    def run(batches):
        for part in slices(batches):
            values = [fingerprint(t, words_per_shingle) for t in as_bytes(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------ trie walk (one task)

def segments_for(leaves: int, max_bits: int, per_subtrie: int = 2000) -> int:
    """Smallest segment count whose subtries hold about ``per_subtrie`` leaves or fewer."""
    for s in range(max_bits + 1, 2 * max_bits + 2):
        if leaves / 2 ** (BITS * (s - max_bits) // s) <= per_subtrie:
            return s
    return 2 * max_bits + 1


def segment_choices(segments: int, max_bits: int) -> list[np.ndarray]:
    """For every choice of ``segments - max_bits`` segments: the bit order that puts them first."""
    cuts = np.linspace(0, BITS, segments + 1).round().astype(int)
    runs = [np.arange(a, b) for a, b in itertools.pairwise(cuts)]
    orders = []
    for chosen in itertools.combinations(range(segments), segments - max_bits):
        rest = [i for i in range(segments) if i not in chosen]
        orders.append((sum(len(runs[i]) for i in chosen), np.concatenate([runs[i] for i in (*chosen, *rest)])))
    return orders


def permute(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Move bit ``order[t]`` (counted from the top) of every value to place ``t``."""
    out = np.zeros_like(values)
    start = 0
    while start < BITS:   # whole runs of neighbouring bits at a time
        stop = start + 1
        while stop < BITS and order[stop] == order[stop - 1] + 1:
            stop += 1
        n = stop - start
        part = (values >> np.uint64(BITS - int(order[start]) - n)) & np.uint64((1 << n) - 1)
        out |= part << np.uint64(BITS - start - n)
        start = stop
    return out


class Forest:
    """Union-find over array positions, merged in batches."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def find(self, nodes: np.ndarray) -> np.ndarray:
        roots = self.parent[nodes]
        while True:
            up = self.parent[roots]
            if (up == roots).all():
                return roots
            roots = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.find(a), self.find(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
            self.parent = self.find(np.arange(len(self.parent)))


def trie_links(paths: np.ndarray, depth: int, max_bits: int) -> Forest:
    """Link sorted distinct ``paths`` that share their first ``depth`` bits and differ in
    ``max_bits`` bits or fewer. Nodes are intervals of the sorted array."""
    forest = Forest(len(paths))
    top = paths >> np.uint64(BITS - depth)
    first = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    last = np.r_[first[1:], len(paths)]
    keep = last - first > 1
    zero = np.zeros(keep.sum(), np.int64)
    stack = [(first[keep], last[keep], first[keep], last[keep], zero, depth)]
    while stack:
        alo, ahi, blo, bhi, err, level = stack.pop()
        if len(alo) > STEP:
            half = len(alo) // 2
            stack.append((alo[half:], ahi[half:], blo[half:], bhi[half:], err[half:], level))
            alo, ahi, blo, bhi, err = alo[:half], ahi[:half], blo[:half], bhi[:half], err[:half]
            stack.append((alo, ahi, blo, bhi, err, level))
            continue
        small = ((ahi - alo) <= LEAF) & ((bhi - blo) <= LEAF) | (level >= BITS)
        _compare(paths, forest, alo[small], ahi[small], blo[small], bhi[small], max_bits)
        big = ~small
        if not big.any():
            continue
        alo, ahi, blo, bhi, err = alo[big], ahi[big], blo[big], bhi[big], err[big]
        amid, bmid = _branch(paths, alo, ahi, level), _branch(paths, blo, bhi, level)
        same = alo == blo
        children = [(alo, amid, blo, bmid, err, np.ones(len(alo), bool)),
                    (amid, ahi, bmid, bhi, err, np.ones(len(alo), bool)),
                    (alo, amid, bmid, bhi, err + 1, np.ones(len(alo), bool)),
                    (amid, ahi, blo, bmid, err + 1, ~same)]
        parts = []
        for l1, h1, l2, h2, e, wanted in children:
            ok = wanted & (h1 > l1) & (h2 > l2) & (e <= max_bits) & ~((l1 == l2) & (h1 - l1 == 1))
            parts.append((l1[ok], h1[ok], l2[ok], h2[ok], e[ok]))
        merged = [np.concatenate(column) for column in zip(*parts)]
        if len(merged[0]):
            stack.append((*merged, level + 1))
    return forest


def _branch(paths: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """First position of each interval whose bit ``level`` is set (``hi`` if none)."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - level)
    prefix = paths[lo] & ~((bit << np.uint64(1)) - np.uint64(1)) if level else np.zeros(len(lo), np.uint64)
    return np.clip(np.searchsorted(paths, prefix | bit), lo, hi)


def _compare(paths, forest, alo, ahi, blo, bhi, max_bits) -> None:
    """Compare every leaf of node a with every leaf of node b, in steps."""
    rows = (ahi - alo) * (bhi - blo)
    bounds = np.searchsorted(np.cumsum(rows), np.arange(0, rows.sum() + STEP, STEP))
    for s, e in itertools.pairwise(np.unique(np.r_[bounds, len(rows)])):
        n = rows[s:e]
        if not n.sum():
            continue
        pair = np.repeat(np.arange(s, e), n)
        local = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = (bhi - blo)[pair]
        a, b = alo[pair] + local // wide, blo[pair] + local % wide
        near = (a < b) | (alo[pair] != blo[pair])
        a, b = a[near], b[near]
        near = np.bitwise_count(paths[a] ^ paths[b]) <= max_bits
        forest.link(a[near], b[near])


# ------------------------------------------------------------------ Spark plan

def forest_edges(leaves: DataFrame, count: int, max_bits: int = MAX_BITS, segments: int | None = None,
                 max_leaves: int = 20_000, rows_per_task: int = 200_000) -> DataFrame:
    """Edges ``(a, b)`` of a spanning forest per subtrie over ``leaves(fp)`` (distinct)."""
    spark = leaves.sparkSession
    segments = segments or segments_for(count, max_bits)
    choices = segment_choices(segments, max_bits)

    def spread(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for c, (depth, order) in enumerate(choices):
                root = (permute(fp, order) >> np.uint64(BITS - depth)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), c, np.int32)), pa.array(root), batch.column(0)],
                    ["choice", "root", "fp"])

    placed = leaves.select("fp").mapInArrow(spread, "choice int, root long, fp long")
    crowded = (placed.groupBy("choice", "root").agg(F.count("*").alias("n")).filter(F.col("n") > max_leaves)
               .select("choice", "root", F.ceil(F.col("n") / max_leaves).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda o: F.struct(F.least(o, block).alias("x"), F.greatest(o, block).alias("y"))))
    tasks = (placed.join(crowded, ["choice", "root"], "left")
             .select("choice", "root", "fp", F.inline(cells)))
    parts = sized_partitions(spark, count * len(choices), rows_per_task)

    def walk(batches):
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        choice, x, y, fp = (table.column(c).to_numpy() for c in ("choice", "x", "y", "fp"))
        groups, index = np.unique(np.stack([choice, x, y]), axis=1, return_inverse=True)
        for g in range(groups.shape[1]):
            depth, order = choices[groups[0, g]]
            mine = fp[index.ravel() == g].view(np.uint64)
            paths = permute(mine, order)
            rank = np.argsort(paths)
            mine, paths = mine[rank], paths[rank]
            forest = trie_links(paths, depth, max_bits)
            child = np.flatnonzero(forest.parent != np.arange(len(mine)))
            if len(child):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine[child].view(np.int64)), pa.array(mine[forest.parent[child]].view(np.int64))],
                    ["a", "b"])

    return tasks.repartition(parts, "choice", "root", "x", "y").mapInArrow(walk, "a long, b long")


def components(prints: DataFrame, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """``(fp, root, component_id)`` per distinct fingerprint of ``prints(doc_id, fp)``; ``root``
    names the component, ``component_id`` is its smallest doc_id."""
    leaves = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "leaves")
    roots = connected_components(forest_edges(leaves, leaves.count(), max_bits, **options))
    labelled = leaves.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(labelled.join(groups, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row."""
    prints = written(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return (prints.join(components(prints, max_bits, **options), "fp")
            .select("doc_id", hexed, "component_id"))


def keep_first(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               **options) -> DataFrame:
    """Rows of ``docs(doc_id, text, ...)`` that stand for their component; all columns kept.

    The row with the component's smallest doc_id stays. Repeated rows of that doc_id are one
    document: one row stays. In a component without any doc_id one row stays.
    """
    prints = written(fingerprints(docs, words_per_shingle=words_per_shingle), "fingerprints")
    groups = components(prints, max_bits, **options)
    key, rows, own = spare(docs, "key", "rows", "own")
    winners = (prints.join(groups, "fp").filter("doc_id = component_id")
               .groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias(rows)))
    chosen = docs.join(winners, F.col("doc_id").cast("long") == F.col(key))
    kept = chosen.filter(F.col(rows) == 1).select(*own_columns(docs)).unionByName(
        chosen.filter(F.col(rows) > 1).dropDuplicates([key]).select(*own_columns(docs)))

    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        values = [fingerprint(None if t is None else t.encode(), words_per_shingle) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    unnamed = docs.filter("doc_id IS NULL").withColumn(own, print_of(F.col("text").cast("string")))
    nobody = groups.filter("component_id IS NULL").select(F.col("fp").alias(key), F.col("root").alias(rows))
    unnamed = unnamed.join(nobody, F.col(own) == F.col(key)).dropDuplicates([rows])
    return kept.unionByName(unnamed.select(*own_columns(docs)))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir, "doc_id", "text"))
