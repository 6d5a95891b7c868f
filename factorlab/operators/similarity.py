"""User-user cosine similarity and similarity-weighted item scores.

    cos(u, v)   = Σ_i r_ui r_vi / (‖r_u‖ ‖r_v‖)          (ratings as int, 0 = unrated)
    score(u, i) = Σ_v cos(u, v) r_vi / Σ_v cos(u, v)     (all users v, u itself included)

Both are sparse matrix products (R Rᵀ and S R). The mass Σ_v cos(u, v) and, through item pairs, the scores need no
table of user pairs; floors and best-n lists are in ``neighbours``. Where all pairs are wanted, they are never made by a per-item self
join: a rating goes, packed, to the user blocks that hold a rater of its item, and a group makes the cosines of its users from what it
got, a few million products at a time (``_cosine_lists``); no pair is shuffled.

Where one user's products would fill a group, and for item pairs, contiguous index blocks meet in pairs: one Arrow call
(``applyInArrow``) per block group accumulates the products into a dense block-sized array with ``numpy.bincount``. When the rows of
a block pair exceed ``max_group_rows``, items are split into several groups as well and the partial dot
products are summed by a native aggregate (map-side combined) before the norms apply.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorlab.functions.vectors import scatter_dense
from factorlab.operators.blocks import block_of, max_id
from factorlab.operators.packed import Side, block_number, pack, pair_sums, segments, sums_with, unpack
from factorlab.schemas import ITEM_IDX, USER_IDX
from factorlab.session import cut_lineage, staged

_PAIR_CHUNK = 8_000_000


def user_norms(pairs: DataFrame) -> DataFrame:
    """``(reviewer_index, norm_sq double, norm double)`` over the de-duplicated int ratings."""
    sq = pairs.groupBy(USER_IDX).agg(
        F.sum(F.col("rating").cast("double") * F.col("rating").cast("double")).alias("norm_sq"))
    return sq.withColumn("norm", F.sqrt("norm_sq"))


def ragged_pairs(keys_a: np.ndarray, keys_b: np.ndarray, chunk: int = _PAIR_CHUNK):
    """Yield index arrays ``(ia, ib)`` of all row pairs with equal keys, in bounded chunks.

    ``keys_b`` must be sorted; ``keys_a`` may be in any order.
    """
    if len(keys_a) == 0 or len(keys_b) == 0:
        return
    ub, sb, cb = np.unique(keys_b, return_index=True, return_counts=True)
    pos = np.minimum(np.searchsorted(ub, keys_a), len(ub) - 1)
    match = ub[pos] == keys_a
    cnt = np.where(match, cb[pos], 0)
    start = np.where(match, sb[pos], 0)
    csum = np.cumsum(cnt)
    lo, n = 0, len(keys_a)
    while lo < n:
        base = csum[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(csum, base + chunk, side="right")), lo + 1)
        c = cnt[lo:hi]
        total = int(c.sum())
        if total:
            ia = np.repeat(np.arange(lo, hi), c)
            off = np.arange(total) - np.repeat(np.cumsum(c) - c, c)
            yield ia, np.repeat(start[lo:hi], c) + off
        lo = hi


def _block_size(n: int, target_blocks: int, lo: int, hi: int) -> int:
    return int(min(hi, max(lo, math.ceil(max(n, 1) / target_blocks))))


# ------------------------------------------------------------------ cosine

_DOTS = "u int, v int, dot double"
_DOTS_ARROW = pa.schema([("u", pa.int32()), ("v", pa.int32()), ("dot", pa.float64())])
_COS = _DOTS + ", nu double, nv double"
_COS_ARROW = pa.schema([*_DOTS_ARROW, ("nu", pa.float64()), ("nv", pa.float64())])


def _np(table: pa.Table, name: str, dtype=None) -> np.ndarray:
    arr = table.column(name).to_numpy()
    return arr.astype(dtype, copy=False) if dtype is not None else arr


def _dots(table: pa.Table) -> pa.Table:
    """``applyInArrow`` body for one (block, block, item split) group; norms ``n`` that come with the rows leave with the pairs."""
    with_norms = "n" in table.column_names
    schema = _COS_ARROW if with_norms else _DOTS_ARROW
    if table.num_rows == 0:
        return schema.empty_table()
    ga, gb = int(table.column("ga")[0].as_py()), int(table.column("gb")[0].as_py())
    blk, u, i = _np(table, "blk"), _np(table, "u"), _np(table, "i")
    r = _np(table, "r", np.float64)
    in_a = blk == ga
    in_b = in_a if ga == gb else blk == gb
    if not in_a.any() or not in_b.any():
        return schema.empty_table()
    ua_rows, ub_rows = u[in_a], u[in_b]
    order = np.argsort(i[in_b], kind="stable")
    ib_sorted, ub_rows, rb = i[in_b][order], ub_rows[order], r[in_b][order]
    ra = r[in_a]
    (ua, first_a), (ub, first_b) = np.unique(ua_rows, return_index=True), np.unique(ub_rows, return_index=True)
    la, lb = np.searchsorted(ua, ua_rows), np.searchsorted(ub, ub_rows)
    acc = np.zeros(len(ua) * len(ub))
    for ia, ib in ragged_pairs(i[in_a], ib_sorted):
        acc += np.bincount(la[ia] * len(ub) + lb[ib], weights=ra[ia] * rb[ib], minlength=acc.size)
    acc = acc.reshape(len(ua), len(ub))
    if ga == gb:
        acc = np.triu(acc)
    rr, cc = np.nonzero(acc)
    columns = [pa.array(ua[rr].astype(np.int32)), pa.array(ub[cc].astype(np.int32)), pa.array(acc[rr, cc])]
    if with_norms:
        n = _np(table, "n")
        columns += [pa.array(n[in_a][first_a][rr]), pa.array(n[in_b][order][first_b][cc])]
    return pa.Table.from_arrays(columns, schema=schema)


def user_cosine(pairs: DataFrame, block_users: int | None = None, max_group_rows: int = 2_000_000,
                min_cos: float | None = None, by_user: bool = False, max_products: int = 2_000_000) -> DataFrame:
    """``(u, v, cos)`` for every pair ``u <= v`` sharing at least one rated item
    (the diagonal is included; pairs without a shared item have cosine 0 and are omitted).

    With ``min_cos`` only pairs at that floor, from an inverted index instead of block products. With ``by_user`` the same
    cosines in both directions, one row per user (``_cosine_lists``): no pair is shuffled. The plain table is made the same way, from
    packed ratings; with ``block_users``, or where one user's products would fill a group, by block products that also split items.
    """
    if by_user:
        return _cosine_lists(pairs, max_group_rows, max_products)
    if min_cos is not None:
        from factorlab.operators.neighbours import cosine_at_least
        return cosine_at_least(pairs, min_cos)
    if block_users is None:
        packed = _cosine_lists(pairs, max_group_rows, max_products, upper=True)
        if packed is not None:
            return packed
    norms = user_norms(pairs).select(USER_IDX, F.col("norm").alias("n"))
    # the norms travel with the ratings: pairs, of which there are many more, are not joined
    rows = pairs.join(norms, USER_IDX).select(
        F.col(USER_IDX).alias("u"), F.col(ITEM_IDX).alias("i"), F.col("rating").cast("double").alias("r"), "n")
    dots = _block_dots(rows, block_users, max_group_rows)
    return dots.select("u", "v", (F.col("dot") / (F.col("nu") * F.col("nv"))).alias("cos"))


_MET = "ga int, rows binary"
_MET_ARROW = pa.schema([("ga", pa.int32()), ("rows", pa.binary())])
_COSINES = "u int, v int, cos double"
#: Products of one user with more of which the plain table is made by blocks that also split items.
_HOT_PRODUCTS = 16_000_000
_LISTS = f"{USER_IDX} int, entries array<struct<pos:int,val:double>>"


def _rater_packs(blocks: int, upper: bool = False):
    """``applyInArrow`` body for all ratings of some items: the ratings that meet a user block, packed for it. With ``upper``
    a block gets an item's raters from its own first one on, who are all that pairs ``u <= v`` need."""
    def run(table: pa.Table) -> pa.Table:
        u, i, r, q = (_np(table, c) for c in ("u", "i", "r", "q"))
        order = np.lexsort((i, u))                              # long runs of a user: small packs
        u, i, r, q = u[order], i[order], r[order], q[order]
        by_item = np.argsort(i, kind="stable")                  # rows of an item side by side, by user
        starts = np.r_[0, np.flatnonzero(np.diff(i[by_item])) + 1][:len(i)]
        ends = np.r_[starts[1:], len(i)][:len(starts)]
        at = np.repeat(np.arange(len(starts)), ends - starts)
        key = block_number(u[by_item], blocks) * len(starts) + at
        place = np.argsort(key, kind="stable")                  # the first row of every (block, item)
        heads = np.r_[0, np.flatnonzero(np.diff(key[place])) + 1][:len(key)]
        block, item = np.divmod(key[place[heads]], max(len(starts), 1))
        first, packs, met = place[heads] if upper else starts[item], [], np.zeros(len(u), bool)
        cuts = np.searchsorted(block, np.arange(blocks + 1))
        for b in np.unique(block).tolist():
            here = slice(cuts[b], cuts[b + 1])
            n = ends[item[here]] - first[here]
            rows = by_item[np.repeat(first[here] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            met[rows] = True
            x = np.flatnonzero(met)
            met[rows] = False
            packs.append((b, pack({"u": u[x], "i": i[x], "r": r[x], "q": q[x]})))
        return pa.Table.from_arrays([pa.array([p[k] for p in packs], t.type) for k, t in enumerate(_MET_ARROW)], schema=_MET_ARROW)
    return run


def _dense_pieces(x: np.ndarray, y: np.ndarray, cos: np.ndarray, length: int, width: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The pieces of ``width`` positions of the vectors ``x`` that have an entry, from entries in order of (x, y); about
    ``most`` numbers at a time."""
    piece, at = np.divmod(y.astype(np.int64) - 1, width)
    heads = np.r_[0, np.flatnonzero((np.diff(x) != 0) | (np.diff(piece) != 0)) + 1][:len(x)]
    ends, step = np.r_[heads[1:], len(x)], max(1, most // width)
    for k in range(0, len(heads), step):
        first, n = heads[k:k + step], ends[k:k + step] - heads[k:k + step]
        lo, hi = first[0], first[0] + n.sum()
        dense = np.zeros((len(first), width))
        dense[np.repeat(np.arange(len(first)), n), at[lo:hi]] = cos[lo:hi]
        size = np.minimum(width, length - piece[first] * width)
        values = pa.array(dense[np.arange(width) < size[:, None]])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), values)
        yield pa.RecordBatch.from_arrays([pa.array(x[first].astype(np.int32)), pa.array(piece[first].astype(np.int32)), lists],
                                         names=[USER_IDX, "piece", "Similarity"])


def _lists_of_block(blocks: int, upper: bool = False, pieces: tuple[int, int] | None = None, best: int | None = None):
    """``applyInArrow`` body for a user block: the cosines of its users, whole lists as they are made; with ``upper`` rows
    ``(u, v, cos)`` of ``u <= v`` instead, with ``pieces`` (length, width) the pieces of their vectors, with ``best`` that many
    rows ``(u, v, cos)`` of the highest cosine to another user."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        met = unpack(table.column("rows"))
        if met is None:
            return
        u, i, r = met["u"], met["i"], met["r"]
        mine = block_number(u, blocks) == table.column("ga")[0].as_py()
        users, first = np.unique(u, return_index=True)
        norm = np.sqrt(met["q"][first])
        for x, y, dot in pair_sums(i[mine], u[mine], r[mine], i, u, r):
            if upper:
                keep = x <= y
                x, y, dot = x[keep], y[keep], dot[keep]
                cos = dot / (norm[np.searchsorted(users, x)] * norm[np.searchsorted(users, y)])
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(cos)],
                                                 names=["u", "v", "cos"])
                continue
            if best is not None:
                other = x != y
                x, y, dot = x[other], y[other], dot[other]
                cos = dot / (norm[np.searchsorted(users, x)] * norm[np.searchsorted(users, y)])
                order = np.lexsort((y, -cos, x))
                x, y, cos = x[order], y[order], cos[order]
                heads = np.r_[0, np.flatnonzero(np.diff(x)) + 1][:len(x)]
                keep = np.arange(len(x)) - np.repeat(heads, np.diff(np.r_[heads, len(x)])) < best
                yield pa.RecordBatch.from_arrays([pa.array(x[keep].astype(np.int32)), pa.array(y[keep].astype(np.int32)), pa.array(cos[keep])],
                                                 names=["u", "v", "cos"])
                continue
            order = np.lexsort((y, x))
            x, y, dot = x[order], y[order], dot[order]
            cos = dot / (norm[np.searchsorted(users, x)] * norm[np.searchsorted(users, y)])
            if pieces:
                yield from _dense_pieces(x, y, cos, *pieces)
                continue
            heads = np.r_[0, np.flatnonzero(np.diff(x)) + 1][:len(x)]
            entries = pa.StructArray.from_arrays([pa.array(y.astype(np.int32)), pa.array(cos)], names=["pos", "val"])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(x)].astype(np.int32)), entries)
            yield pa.RecordBatch.from_arrays([pa.array(x[heads].astype(np.int32)), lists], names=[USER_IDX, "entries"])
    return run


def _cosine_lists(pairs: DataFrame, max_group_rows: int, max_products: int, upper: bool = False,
                  pieces: tuple[int, int] | None = None, best: int | None = None) -> DataFrame | None:
    """``(reviewer_index, entries array<struct<pos=user, val=cos>>)``: each user's cosines, itself included, by ``pos``. With
    ``upper`` the table ``(u, v, cos)`` of ``u <= v``, or None where one user has far more products than a group should
    or a rating is null; with
    ``pieces`` (length, width) the pieces of the users' vectors; with ``best`` the rows ``(u, v, cos)`` of each user's ``best``
    nearest other users.

    A group is a block of users with about ``max_products`` products of ratings. All ratings of an item meet once, in a bucket of
    items, and go from there, packed, to the blocks that have a rater of it (at most one copy per product); a user's list is made
    whole in its group and is not shuffled.
    """
    rated = pairs.where("rating is not null")
    rows = rated.join(user_norms(rated).where("norm_sq > 0").select(USER_IDX, F.col("norm_sq").alias("q")), USER_IDX).select(
        F.col(USER_IDX).alias("u"), F.col(ITEM_IDX).alias("i"), F.col("rating").cast("double").alias("r"), "q")
    size = rated.groupBy(ITEM_IDX).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n")).alias("products")).first()
    n, products = size["rows"] or 0, size["products"] or 0
    if upper and n:
        of_user = pairs.groupBy(USER_IDX).agg(F.count("rating").alias("n"), F.count_if(F.col("rating").isNull()).alias("none"))
        most, none = of_user.agg(F.max("n"), F.sum("none")).first()
        if none or most * products / n > _HOT_PRODUCTS:
            return None
    blocks = max(1, math.ceil(products / max_products))
    buckets = max(1, math.ceil(2 * n / max_group_rows))
    met = rows.groupBy(F.pmod(F.xxhash64("i"), F.lit(buckets)).cast("int").alias("bucket")).applyInArrow(_rater_packs(blocks, upper), _MET)
    # a number of its own: packs are small for the work in them
    schema = _COSINES if upper or best is not None else f"{USER_IDX} int, piece int, Similarity array<double>" if pieces else _LISTS
    return met.repartition(2 * blocks, "ga").groupBy("ga").applyInArrow(_lists_of_block(blocks, upper, pieces, best), schema)


def _block_dots(rows: DataFrame, block: int | None = None, max_group_rows: int = 2_000_000) -> DataFrame:
    """``(u, v, dot)``, ``u <= v``: dot products of the sparse rows ``u`` of ``(u, i, r)`` that share an ``i``; from
    ``(u, i, r, n)`` also ``nu`` and ``nv``, the numbers ``n`` of both rows."""
    extra = ["n"] if "n" in rows.columns else []
    bs = block or _block_size(max_id(rows, "u"), 8, 256, 2048)
    # The largest block bounds a group (a hot row makes its block large): split the i
    # so that two such blocks together stay under max_group_rows.
    biggest = (rows.groupBy(block_of("u", bs).alias("blk")).count()
               .agg(F.max("count")).first()[0]) or 0
    splits = max(1, math.ceil(2 * biggest / max_group_rows))
    rows = rows.select("u", "i", "r", *extra, block_of("u", bs).alias("blk"))
    rows = _meeting(rows, "i", rows.select("i", F.col("blk").alias("o")).distinct()).select(
        "u", "i", "r", *extra, "blk",
        F.least("blk", "o").alias("ga"), F.greatest("blk", "o").alias("gb"),
        (F.pmod(F.xxhash64("i"), F.lit(splits)).cast("int") if splits > 1 else F.lit(0)).alias("c"))
    dots = rows.groupBy("ga", "gb", "c").applyInArrow(_dots, _COS if extra else _DOTS)
    kept = [F.max(c).alias(c) for c in ("nu", "nv")] if extra else []
    return dots if splits == 1 else dots.groupBy("u", "v").agg(F.sum("dot").alias("dot"), *kept)


def _meeting(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """``rows`` once per block that holds a partner: ``blocks`` has the blocks of each ``key``."""
    return rows.join(blocks, key)


def symmetric(cos: DataFrame) -> DataFrame:
    """Both directions of a ``u <= v`` cosine table (the diagonal once), made row by row: the table is read, or computed, once."""
    u, v = F.col("u"), F.col("v")
    row = lambda a, b: F.struct(a.alias("u"), b.alias("v"), F.col("cos"))
    both = F.when(u != v, F.array(row(u, v), row(v, u))).otherwise(F.array(row(u, v)))
    return cos.select(F.explode(both).alias("c")).select("c.u", "c.v", "c.cos")


def similarity_mass(cos: DataFrame) -> DataFrame:
    """``(reviewer_index, mass)``: Σ_v cos(u, v) over all users v (u itself included), the
    denominator of the weighted score; a native partial+final aggregate."""
    return symmetric(cos).groupBy(F.col("u").alias(USER_IDX)).agg(F.sum("cos").alias("mass"))


def similarity_mass_direct(pairs: DataFrame) -> DataFrame:
    """``similarity_mass`` without any pair of users: with x = r / ‖r‖, Σ_v x_u · x_v = Σ_i x_ui (Σ_v x_vi).

    Two joins and two sums over the ratings; the sum per item is combined before its shuffle.
    """
    norms = user_norms(pairs).where("norm_sq > 0").select(USER_IDX, "norm")
    rows = pairs.join(norms, USER_IDX).select(USER_IDX, ITEM_IDX, (F.col("rating").cast("double") / F.col("norm")).alias("x"))
    per_item = rows.groupBy(ITEM_IDX).agg(F.sum("x").alias("all"))
    return rows.join(per_item, ITEM_IDX).groupBy(USER_IDX).agg(F.sum(F.col("x") * F.col("all")).alias("mass"))


def cosine_rows(pairs: DataFrame, users: DataFrame) -> DataFrame:
    """``(u, v, cos)`` for the chosen users ``u`` (column ``reviewer_index``) and every user ``v`` that shares an item, ``u``
    itself included: the chosen users' ratings meet the others' in one equi-join, other pairs are never made."""
    chosen = users.select(F.col(USER_IDX).alias("u")).distinct()
    norms = user_norms(pairs)
    # the chosen users' norms travel with their few ratings: one join of the pairs less
    nu = norms.select(F.col(USER_IDX).alias("u"), F.col("norm").alias("nu")).join(chosen, "u", "left_semi")
    mine = pairs.select(F.col(USER_IDX).alias("u"), ITEM_IDX, F.col("rating").cast("double").alias("ru")).join(nu, "u")
    other = pairs.select(F.col(USER_IDX).alias("v"), ITEM_IDX, F.col("rating").cast("double").alias("rv"))
    dots = mine.join(other, ITEM_IDX).groupBy("u", "v").agg(
        F.sum(F.col("ru") * F.col("rv")).alias("dot"), F.max("nu").alias("nu")).where("dot > 0")
    nv = norms.select(F.col(USER_IDX).alias("v"), F.col("norm").alias("nv"))
    return dots.join(nv, "v").select("u", "v", (F.col("dot") / (F.col("nu") * F.col("nv"))).alias("cos"))


# ------------------------------------------------------------------ single-user neighbours

def similar_users(pairs: DataFrame, user: int | None = None, n: int = 10,
                  include_self: bool = False) -> DataFrame:
    """Top ``n`` users by cosine to ``user`` (default: the highest user index):
    ``(reviewer_index, sim_rank, similar_index, cos)``, ties by lower index.

    The target's ratings meet every other rating of the same item in one equi-join (at
    most one target row per item), then a per-user sum.
    """
    if user is None:
        user = max_id(pairs, USER_IDX)
    target = pairs.where(F.col(USER_IDX) == user).select(ITEM_IDX, F.col("rating").alias("r0"))
    norm0 = target.agg(F.sum(F.col("r0").cast("double") * F.col("r0").cast("double"))).first()[0]
    if not norm0:
        return pairs.sparkSession.createDataFrame(
            [], f"{USER_IDX} int, sim_rank int, similar_index int, cos double")
    dots = (pairs.join(target, ITEM_IDX)
            .groupBy(F.col(USER_IDX).alias("v"))
            .agg(F.sum(F.col("rating").cast("double") * F.col("r0").cast("double")).alias("dot")))
    norms = user_norms(pairs).select(F.col(USER_IDX).alias("v"), "norm")
    cos = dots.join(norms, "v").select(
        "v", (F.col("dot") / (F.lit(math.sqrt(norm0)) * F.col("norm"))).alias("cos"))
    if not include_self:
        cos = cos.where(F.col("v") != user)
    top = cos.orderBy(F.desc("cos"), F.asc("v")).limit(n)
    w = Window.orderBy(F.desc("cos"), F.asc("v"))
    return top.select(F.lit(user).cast("int").alias(USER_IDX), F.row_number().over(w).alias("sim_rank"),
                      F.col("v").alias("similar_index"), "cos")


def similar_users_all(cos: DataFrame | None, n: int = 10, pairs: DataFrame | None = None, max_group_rows: int = 2_000_000,
                      max_products: int = 2_000_000) -> DataFrame:
    """Top ``n`` other users per user from a ``u <= v`` cosine table; the filter on
    ``row_number`` lets Catalyst insert a partial group limit before the shuffle. Without a table, from the ratings ``pairs``: a
    user's cosines are whole in their group, and only the ``n`` best leave it."""
    if cos is None:
        sym = _cosine_lists(pairs, max_group_rows, max_products, best=n)
    else:
        sym = symmetric(cos).where(F.col("u") != F.col("v"))
    w = Window.partitionBy("u").orderBy(F.desc("cos"), F.asc("v"))
    return (sym.withColumn("sim_rank", F.row_number().over(w)).where(F.col("sim_rank") <= n)
            .select(F.col("u").alias(USER_IDX), "sim_rank", F.col("v").alias("similar_index"), "cos"))


# ------------------------------------------------------------------ weighted scores

_SCORES = T.StructType([
    T.StructField(USER_IDX, T.IntegerType()),
    T.StructField(ITEM_IDX, T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])


_SCORES_ARROW = pa.schema([(USER_IDX, pa.int32()), (ITEM_IDX, pa.int32()), ("score", pa.float64())])
_PARTS = "ga int, gc int, part int, l binary, r binary, s binary"
_PARTS_ARROW = pa.schema([("ga", pa.int32()), ("gc", pa.int32()), ("part", pa.int32()), ("l", pa.binary()), ("r", pa.binary()), ("s", pa.binary())])
#: Products summed at a time, and left rows of a part of a group.
_SUM_CHUNK, _PART_ROWS = 1_000_000, 1_000_000


def _product_packs(a_blocks: int, c_blocks: int, parts: int):
    """Cogrouped ``applyInArrow`` body for all entries of some m: what meets in each (user block, item block), packed; the left
    side by part of the users."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _PARTS_ARROW.empty_table()
        one, two = [{c: _np(t, c) for c in ("m", x, "w")} for t, x in ((left, "u"), (right, "i"))]
        ids, at = np.unique(np.r_[one["m"], two["m"]], return_inverse=True)
        at_l, at_r = at[:left.num_rows], at[left.num_rows:]
        lp, rc = block_number(one["u"], a_blocks * parts), block_number(two["i"], c_blocks)
        la = lp // parts
        in_a, in_c = np.zeros((len(ids), a_blocks), bool), np.zeros((len(ids), c_blocks), bool)
        in_a[at_l, la], in_c[at_r, rc] = True, True
        out, of_c = [], segments(rc, c_blocks, two["m"])
        for a in range(a_blocks):
            for c, other in enumerate(of_c):
                y = other[in_a[at_r[other], a]]
                if len(y):
                    out.append((a, c, None, None, pack({k: v[y] for k, v in two.items()}), None))
        for p, mine in enumerate(segments(lp, a_blocks * parts, one["m"])):
            for c in range(c_blocks):
                x = mine[in_c[at_l[mine], c]]
                if len(x):
                    out.append((p // parts, c, p % parts, pack({k: v[x] for k, v in one.items()}), None, None))
        return pa.Table.from_arrays([pa.array([row[k] for row in out], t.type) for k, t in enumerate(_PARTS_ARROW)], schema=_PARTS_ARROW)
    return run


def _scale_packs(a_blocks: int, c_blocks: int, parts: int):
    """``mapInArrow`` body: the divisors of every user block, packed once for each item block."""
    def run(batches):
        for rb in batches:
            u, mass = rb.column(0).to_numpy(), rb.column(1).to_numpy()
            for a, seg in enumerate(segments(block_number(u, a_blocks * parts) // parts, a_blocks, u)):
                data = pack({"u": u[seg], "mass": mass[seg]})
                for c in range(c_blocks) if len(seg) else ():
                    yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip((a, c, None, None, None, data), _PARTS_ARROW)],
                                                     schema=_PARTS_ARROW)
    return run


def _product_sums(parts: int):
    """``applyInArrow`` body for a (user block, item block): its scores, as they are made. The right side is held whole, the left side
    and what it makes in ``parts`` parts of the users, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        right, scale = (unpack(table.column(c)) for c in ("r", "s"))
        if right is None or scale is None:
            return
        order = np.argsort(scale["u"])
        users, mass = scale["u"][order], scale["mass"][order]
        side = Side(right["m"], right["i"], right["w"])
        del order, right, scale
        number = table.column("part").to_numpy()
        for part in range(parts):
            left = unpack(table.column("l").filter(pa.array(number == part)))
            if left is None:
                continue
            for u, i, num in sums_with(side, left["m"], left["u"], left["w"], _SUM_CHUNK):
                at = np.minimum(np.searchsorted(users, u), len(users) - 1)
                known = users[at] == u
                yield pa.RecordBatch.from_arrays([pa.array(c[known], t.type) for c, t in zip((u, i, num / mass[at]), _SCORES_ARROW)],
                                                 schema=_SCORES_ARROW)
    return run


def _scores_of_rows(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """Weighted scores from cosine rows ``(u, v, cos)`` with few neighbours: one equi-join and one sum."""
    mass = near.groupBy("u").agg(F.sum("cos").alias("mass"))
    rated = pairs.select(F.col(USER_IDX).alias("v"), ITEM_IDX, F.col("rating").cast("double").alias("r"))
    sums = near.join(rated, "v").groupBy("u", ITEM_IDX).agg(F.sum(F.col("cos") * F.col("r")).alias("num")).where("num > 0")
    return sums.join(mass, "u").select(F.col("u").alias(USER_IDX), ITEM_IDX, (F.col("num") / F.col("mass")).alias("score"))


def _sparse_product(left: DataFrame, right: DataFrame, mass: DataFrame, n_users: int = 0, n_items: int = 0,
                    block_users: int | None = None, block_items: int | None = None, max_group_rows: int = 2_000_000) -> DataFrame:
    """``(reviewer_index, asin_index, score)``: Σ_m left(u, m) · right(m, i) / mass(u) over ``left(u, m, w)``,
    ``right(m, i, w)`` and ``mass(reviewer_index, mass)``, where the sum is not 0.

    Groups are (user block, item block). All entries of an m meet once, in a bucket of many m; from there a left row goes, packed,
    only to item blocks in which its m has an entry, a right row only to user blocks that have its m. The sums are whole in their
    group and leave it divided. A group meets about ``4 max_group_rows`` rows of a side and makes about 64 million products; it holds the
    right side, the packs of the left side, and one part of that side (whole users, about a million rows) with a million products at a time.
    """
    rows = left.count()
    size = right.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("m").alias("m")).first()
    most = 4 * max_group_rows
    c = math.ceil(max(n_items, 1) / block_items) if block_items else max(1, math.ceil(size["n"] / most))
    a = math.ceil(max(n_users, 1) / block_users) if block_users else max(
        1, math.ceil(rows / most), math.ceil(rows * size["n"] / max(size["m"], 1) / (64_000_000 * c)))
    bucket = F.pmod(F.xxhash64("m"), F.lit(max(1, math.ceil((rows + size["n"]) / max_group_rows)))).cast("int").alias("bucket")
    parts = max(1, math.ceil(rows / (a * _PART_ROWS)))      # the left rows of a group come in parts of whole users
    met = left.select(bucket, "m", "u", "w").groupBy("bucket").cogroup(
        right.select(bucket, "m", "i", "w").groupBy("bucket")).applyInArrow(_product_packs(a, c, parts), _PARTS)
    scale = mass.select(USER_IDX, "mass").mapInArrow(_scale_packs(a, c, parts), _PARTS)
    # a number of its own: packs are small for the work in them
    dealt = met.unionByName(scale).repartition(2 * a * c, "ga", "gc")
    return dealt.groupBy("ga", "gc").applyInArrow(_product_sums(parts), _SCORES)


def neighbour_scores(pairs: DataFrame, cos: DataFrame | None = None, block_users: int | None = None,
                     block_items: int | None = None, max_group_rows: int = 2_000_000,
                     users: DataFrame | None = None, top_n: int | None = None) -> DataFrame:
    """``(reviewer_index, asin_index, score)`` for every user (of ``users``, if given: a table
    with ``reviewer_index``) and every item rated by at least one of the user's neighbours (other
    scores are 0 and omitted).

    How the sums are made depends on what is given; the scores are the same:

    * ``top_n``: v runs over the user itself and its ``top_n`` most similar users only
      (``neighbours.top_neighbours``), which needs no table of all pairs.
    * ``users`` without ``cos``: only the cosine rows of these users are made.
    * neither: through the items. With x = r / ‖r‖, Σ_v (x_u · x_v) r_vi = Σ_j x_uj G_ji with G_ji = Σ_v r_vj r_vi / ‖r_v‖,
      a symmetric table of item pairs that share a user; no pair of users is made.
    * ``cos``: the product of the given cosine table (both directions) with the ratings.
    """
    if top_n is not None:
        from factorlab.operators.neighbours import top_neighbours
        own = user_norms(pairs).where("norm_sq > 0").select(
            F.col(USER_IDX).alias("u"), F.col(USER_IDX).alias("v"), (F.col("norm_sq") / (F.col("norm") * F.col("norm"))).alias("cos"))
        near = top_neighbours(pairs, top_n).select(F.col(USER_IDX).alias("u"), F.col("similar_index").alias("v"), "cos").unionByName(own)
        if users is not None:
            near = near.join(users.select(F.col(USER_IDX).alias("u")).distinct(), "u", "left_semi")
        return _scores_of_rows(pairs, near)
    if cos is None and users is not None:
        near = staged(cosine_rows(pairs, users), "cosine-rows")[0]
        rated = pairs.select(F.col(USER_IDX).alias("m"), F.col(ITEM_IDX).alias("i"), F.col("rating").cast("double").alias("w"))
        return _sparse_product(near.select("u", F.col("v").alias("m"), F.col("cos").alias("w")), rated.where("w is not null"),
                               near.groupBy(F.col("u").alias(USER_IDX)).agg(F.sum("cos").alias("mass")), max_group_rows=max_group_rows)

    stats = pairs.agg(F.max(USER_IDX).alias("nu"), F.max(ITEM_IDX).alias("ni")).first()
    sizes = (int(stats["nu"] or 0), int(stats["ni"] or 0), block_users, block_items, max_group_rows)
    if cos is None:
        norms = user_norms(pairs).where("norm_sq > 0").select(USER_IDX, "norm")
        rated = pairs.join(norms, USER_IDX)
        r = F.col("rating").cast("double")
        weighted = rated.select(F.col(ITEM_IDX).alias("u"), F.col(USER_IDX).alias("i"), (r / F.sqrt("norm")).alias("r"))
        together = cut_lineage(_block_dots(weighted, max_group_rows=max_group_rows))
        right = together.select(F.col("u").alias("m"), F.col("v").alias("i"), F.col("dot").alias("w")).unionByName(
            together.where("u <> v").select(F.col("v").alias("m"), F.col("u").alias("i"), F.col("dot").alias("w")))
        left = rated.select(F.col(USER_IDX).alias("u"), F.col(ITEM_IDX).alias("m"), (r / F.col("norm")).alias("w"))
        mass = similarity_mass_direct(pairs)
    else:
        sym = symmetric(cos)
        if users is not None:
            sym = sym.join(users.select(F.col(USER_IDX).alias("u")).distinct(), "u", "left_semi")
        left = sym.select("u", F.col("v").alias("m"), F.col("cos").alias("w"))
        right = pairs.select(F.col(USER_IDX).alias("m"), F.col(ITEM_IDX).alias("i"), F.col("rating").cast("double").alias("w"))
        mass = sym.groupBy(F.col("u").alias(USER_IDX)).agg(F.sum("cos").alias("mass"))
    return _sparse_product(left.where("w is not null"), right.where("w is not null"), mass, *sizes)


# ------------------------------------------------------------------ dense forms

def similarity_vectors(cos: DataFrame, n_users: int) -> DataFrame:
    """``(reviewer_index, Similarity array<double>)`` of length ``n_users``, position v-1 =
    cos(u, v), 0 where no item is shared; from pairs, or from lists of ``user_cosine(by_user=True)`` without a shuffle."""
    if "entries" in cos.columns:
        return cos.select(USER_IDX, scatter_dense("entries", n_users, zero=0.0).alias("Similarity"))
    sym = symmetric(cos)
    entries = sym.groupBy("u").agg(F.sort_array(F.collect_list(
        F.struct(F.col("v").alias("pos"), F.col("cos").alias("val")))).alias("e"))
    return entries.select(F.col("u").alias(USER_IDX), scatter_dense("e", n_users, zero=0.0).alias("Similarity"))


def score_vectors(scores: DataFrame, n_items: int, width: int = 4096) -> DataFrame:
    """``(reviewer_index, g_score_vector array<double>)`` of length ``n_items``.

    A user's scores become dense pieces of ``width`` numbers before they are one row: an aggregate that holds many users holds
    plain arrays of them, not a row object per score. One shuffle, by user, serves both."""
    pieces = _pieces(scores.repartition(USER_IDX), ITEM_IDX, "score", n_items, width, "part").groupBy(USER_IDX).agg(
        F.sort_array(F.collect_list(F.struct("piece", "part"))).alias("e"))
    none = lambda n: F.array_repeat(F.lit(0.0), n)
    whole = F.transform("e", lambda x, j: F.concat(
        none((x["piece"] - F.coalesce(F.get("e", j - 1)["piece"], F.lit(-1)) - 1) * width), x["part"]))
    last = F.least(F.lit(n_items), (F.element_at("e", -1)["piece"] + 1) * width)
    return pieces.select(USER_IDX, F.concat(F.flatten(whole), none(F.lit(n_items) - last)).alias("g_score_vector"))


def _pieces(rows: DataFrame, pos: str, value: str, length: int, width: int, name: str) -> DataFrame:
    at = F.col(pos) - F.col("piece") * width
    entries = rows.withColumn("piece", block_of(pos, width)).groupBy(USER_IDX, "piece").agg(
        F.sort_array(F.collect_list(F.struct(at.alias("pos"), F.col(value).alias("val")))).alias("e"))
    size = F.least(F.lit(width), F.lit(length) - F.col("piece") * width)
    return entries.select(USER_IDX, "piece", scatter_dense("e", size, zero=0.0).alias(name))


def similarity_pieces(cos: DataFrame | None, n_users: int, width: int = 4096, pairs: DataFrame | None = None,
                      max_group_rows: int = 2_000_000, max_products: int = 2_000_000) -> DataFrame:
    """``(reviewer_index, piece, Similarity array<double>)``: the vectors of ``similarity_vectors`` in pieces of ``width``
    positions (piece p starts at position ``p * width + 1``); pieces of zeros only are left out. From the table of pairs, or, without
    one, from the ratings ``pairs``: a user's pieces are made whole in their group, as the lists of ``user_cosine(by_user=True)``."""
    if cos is None:
        return _cosine_lists(pairs, max_group_rows, max_products, pieces=(n_users, width))
    return _pieces(symmetric(cos).withColumnRenamed("u", USER_IDX), "v", "cos", n_users, width, "Similarity")


def score_pieces(scores: DataFrame, n_items: int, width: int = 4096) -> DataFrame:
    """``(reviewer_index, piece, g_score_vector array<double>)``: the same for ``score_vectors``."""
    return _pieces(scores, ITEM_IDX, "score", n_items, width, "g_score_vector")
