"""Rating tables: triples, de-duplicated pairs, per-key lists and dense matrix rows.

The long form ``(reviewer_index, asin_index, rating)`` is the primary representation; the
list and dense-row forms exist because the original workflow builds them, and are derived from the
de-duplicated pairs so every row is bounded by the number of items (or users). Where that is too long
for a row, the paged lists (``rating_pages``) and the blocked sparse matrix (``matrix_blocks``) hold the same
entries in rows of a fixed largest size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorlab.functions.vectors import scatter_dense, scatter_joined
from factorlab.operators.blocks import block_of, max_id, running_before
from factorlab.schemas import ITEM_IDX, RATING, USER_IDX


def rating_triples(indexed: DataFrame) -> DataFrame:
    """``(reviewer_index, asin_index, overall)``: every rating row, duplicates kept."""
    return indexed.select(USER_IDX, ITEM_IDX, RATING)


def rating_pairs(indexed: DataFrame) -> DataFrame:
    """``(reviewer_index, asin_index, rating int)``: one row per pair.

    Ratings are truncated to int; a pair rated several times keeps the largest value, so
    the result does not depend on row order. Partial aggregation combines duplicates
    before the shuffle.
    """
    return (indexed.groupBy(USER_IDX, ITEM_IDX)
            .agg(F.max(F.col(RATING).cast("int")).alias("rating")))


def _lists(pairs: DataFrame, key: str, other: str) -> DataFrame:
    return pairs.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(other).alias("pos"), F.col("rating").alias("val"))))
        .alias("entries"))


def ratings_by_user(pairs: DataFrame) -> DataFrame:
    """``(reviewer_index, entries array<struct<pos=asin_index, val=rating>>)`` sorted by item."""
    return _lists(pairs, USER_IDX, ITEM_IDX)


def ratings_by_item(pairs: DataFrame) -> DataFrame:
    """``(asin_index, entries array<struct<pos=reviewer_index, val=rating>>)`` sorted by user."""
    return _lists(pairs, ITEM_IDX, USER_IDX)


def _dense_rows(lists: DataFrame, key: str, length: int, joined: str | None) -> DataFrame:
    row = scatter_dense("entries", length) if joined is None else scatter_joined("entries", length, joined)
    return lists.select(key, row.alias("ratings"))


def user_item_matrix(pairs: DataFrame, num_items: int, joined: str | None = None) -> DataFrame:
    """``(reviewer_index, ratings array<int>)`` of length ``num_items``; 0 = not rated. With ``joined`` a row's
    ``num_items`` values are one text with that separator, made without the array."""
    return _dense_rows(ratings_by_user(pairs), USER_IDX, num_items, joined)


def item_user_matrix(pairs: DataFrame, num_users: int, joined: str | None = None) -> DataFrame:
    """``(asin_index, ratings array<int>)`` of length ``num_users``; 0 = not rated. ``joined`` as in ``user_item_matrix``."""
    return _dense_rows(ratings_by_item(pairs), ITEM_IDX, num_users, joined)


def rating_pages(pairs: DataFrame, key: str = ITEM_IDX, other: str = USER_IDX, page_size: int = 10_000,
                 span: int = 65_536) -> DataFrame:
    """``(key, page, entries array<struct<pos, val>>)``: a key's list in pages of ``page_size`` entries, by ``pos``.

    Page numbers come from running counts inside bands of ``span`` ids: an item rated by
    every user is many pages made by many tasks, and no task or row holds its whole list.
    """
    placed = running_before(pairs, key, other, F.lit(1), "_at", max_id(pairs, other), span)
    return placed.groupBy(key, F.floor(F.col("_at") / page_size).cast("int").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(other).alias("pos"), F.col("rating").alias("val")))).alias("entries"))


_BLOCK = ("row_block int, col_block int, first_row int, first_col int, indptr array<int>, indices array<int>, "
          "values array<int>")
_BLOCK_ROWS = 1 << 20


def matrix_blocks(pairs: DataFrame, row: str = USER_IDX, col: str = ITEM_IDX, block_rows: int = 256,
                  block_cols: int = 1024) -> DataFrame:
    """The sparse matrix in compressed-row blocks:
    ``(row_block, col_block, first_row, first_col, indptr, indices, values)``.

    Entries of row ``first_row + j`` are ``indices[indptr[j]:indptr[j + 1]]`` (columns counted from ``first_col``). Blocks without
    an entry have no row; a block holds at most ``block_rows * block_cols`` entries of 8 bytes (2 MB by default).
    """
    names = ("row_block", "col_block", "r", "c", "v")

    def build(rb, cb, r, c, v):
        """The blocks of whole sorted blocks, at most about ``_BLOCK_ROWS`` matrix rows per batch."""
        starts = np.r_[0, np.flatnonzero((np.diff(rb) != 0) | (np.diff(cb) != 0)) + 1]
        ends, step = np.r_[starts[1:], len(rb)], max(1, _BLOCK_ROWS // block_rows)
        for k in range(0, len(starts), step):
            at, n = starts[k:k + step], ends[k:k + step] - starts[k:k + step]
            lo, hi = at[0], at[0] + n.sum()
            rows = np.repeat(np.arange(len(at)), n) * block_rows + r[lo:hi]
            indptr = np.zeros((len(at), block_rows + 1), np.int32)
            np.cumsum(np.bincount(rows, minlength=len(at) * block_rows).reshape(len(at), -1), axis=1, out=indptr[:, 1:])
            lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(a.astype(np.int32))) for offsets, a in (
                (np.arange(len(at) + 1) * (block_rows + 1), indptr.ravel()), (np.r_[0, np.cumsum(n)], c[lo:hi]), (np.r_[0, np.cumsum(n)], v[lo:hi]))]
            heads = [pa.array(x.astype(np.int32)) for x in (rb[at], cb[at], rb[at] * block_rows + 1, cb[at] * block_cols + 1)]
            yield pa.RecordBatch.from_arrays([*heads, *lists], names=["row_block", "col_block", "first_row", "first_col",
                                                                      "indptr", "indices", "values"])

    def compress(batches):
        held: list = []                                     # the parts of the last block, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
            held.append(part)
            if (held[0][0][0], held[0][1][0]) == (part[0][-1], part[1][-1]):
                continue
            whole = [np.concatenate(cols) for cols in zip(*held)]
            cut = int(np.flatnonzero((whole[0] != part[0][-1]) | (whole[1] != part[1][-1]))[-1]) + 1
            yield from build(*(x[:cut] for x in whole))
            held = [[x[cut:] for x in whole]]
        if held:
            yield from build(*(np.concatenate(cols) for cols in zip(*held)))

    rb, cb = block_of(row, block_rows), block_of(col, block_cols)
    cells = pairs.select(rb.alias("row_block"), cb.alias("col_block"), (F.col(row) - 1 - rb * block_rows).cast("int").alias("r"),
                         (F.col(col) - 1 - cb * block_cols).cast("int").alias("c"), F.col("rating").cast("int").alias("v"))
    # many blocks have few entries: blocks come one after the other in sorted partitions, not in a group each
    return cells.repartition("row_block", "col_block").sortWithinPartitions(*names[:4]).mapInArrow(compress, _BLOCK)


def matrix_cells(blocks: DataFrame, row: str = USER_IDX, col: str = ITEM_IDX) -> DataFrame:
    """The entries ``(row, col, rating)`` of a blocked matrix, row by row inside the JVM."""
    rows = F.transform(F.sequence(F.lit(0), F.size("indptr") - 2), lambda j: F.struct(
        (F.col("first_row") + j).alias("row"), F.get("indptr", j).alias("a"), (F.get("indptr", j + 1) - F.get("indptr", j)).alias("n")))
    cut = blocks.select("first_col", "indices", "values", F.explode(F.filter(rows, lambda at: at["n"] > 0)).alias("at"))
    part = lambda c: F.slice(c, F.col("at.a") + 1, F.col("at.n"))
    cells = cut.select(F.col("at.row").alias(row), "first_col", F.explode(F.arrays_zip(
        part("indices").alias("c"), part("values").alias("v"))).alias("e"))
    return cells.select(row, (F.col("first_col") + F.col("e.c")).alias(col), F.col("e.v").alias("rating"))


def max_index(index_table: DataFrame, column: str) -> int:
    """Largest dense index (= number of ids): a single scalar aggregate."""
    value = index_table.agg(F.max(column)).first()[0]
    return int(value or 0)
