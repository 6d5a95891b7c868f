"""Sequence packing by column generation for the cutting-stock problem (operator 3).

1. One pass tokenizes whole texts and cuts each document into full sequences and one rest; ids
   leave the pass only as length and checksum.
2. The rests are a histogram over length classes (exact up to ``EXACT``, then rounded up to a
   multiple of ``STEP``), whose size does not depend on the data. A linear program chooses how
   often each pattern (a multiset of classes that fits one sequence) is used; new patterns are
   priced by a knapsack dynamic program until Farley's bound is within ``GAP``.
3. The counts are rounded down; what is left over (bounded by classes times pattern length, not by
   documents) is packed best-fit decreasing into further patterns.
4. Pieces are ranked within their class without a global sort (a salted row_number plus offsets
   per salt), and piece number r of a class takes the r-th place of that class in the patterns.

Defined cases: null text is an empty text (one id, the end id); repeated rows and null doc_ids
are packed like any other row; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorlab.llm.common import byte_slices, read_documents, sized_partitions, written

LENGTH = 2048
END_ID = 1
EXACT = 256
STEP = 8
GAP = 2e-3
#: Pricing rounds at most (the work of the program does not depend on the data size).
ROUNDS = 1500
#: Smallest pivot of a basis change.
PIVOT = 1e-7
#: Distinct words remembered by a worker in each of two generations.
CACHE_WORDS = 200_000
#: Text bytes tokenized in one step.
BATCH_BYTES = 8 << 20


# ------------------------------------------------------------------ tokens

#: Texts made of these characters only are split here; any other goes to the tokenizer whole.
_SIMPLE = re.compile(r"[\x00-\x1b\x20-\x7f\xa0-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-\xff‘’“”–—…]*")
#: The word pattern of the vocabulary file over those characters, on lower-case text.
_WORDS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+")


class Cache:
    """Text -> ids in two generations: entries used again outlive a change of generation."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def get(self, keys: list[str], make) -> list[bytes]:
        """Ids of every key; ``make`` gives those of a list of unknown ones."""
        found = list(map(self.young.get, keys))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if gaps:
            again = list(map(self.older.get, [keys[i] for i in gaps]))
            new = [keys[i] for i, ids in zip(gaps, again) if ids is None]
            fresh = dict(zip(new, make(new)))
            for i, ids in zip(gaps, again):
                found[i] = fresh[keys[i]] if ids is None else ids
            if len(self.young) + len(gaps) > self.size:
                self.older, self.young = self.young, {}
            self.young.update((keys[i], found[i]) for i in gaps)
        return found


class WordTokens:
    """Ids of whole texts, as uint32 arrays, for a vocabulary with word ends.

    The vocabulary file's words are merged independently of each other and white space is dropped,
    so the ids of a text are those of its blank-separated parts one after another. The
    distinct parts of a batch are looked up (or tokenized once) and their ids gathered.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words = Cache(CACHE_WORDS)

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _tokenize(self, words: list[str]) -> list[bytes]:
        found = []
        for batch in itertools.batched(words, 2000):
            ids = self._plain(" ".join(batch))
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) == len(batch) and stops[-1] == 4 * len(ids):
                data = ids.tobytes()
                found += [data[a:b] for a, b in itertools.pairwise([0, *stops.tolist()])]
            else:   # a word that splits again: one by one
                found += [self._plain(w).tobytes() for w in batch]
        return found

    def _split(self, parts: list[str]) -> list[bytes]:
        """Ids of blank-separated parts; most are one word of letters only."""
        split = [p if p.isalpha() else _WORDS.findall(p) for p in parts]
        words = set()
        for s in split:
            if isinstance(s, str):
                words.add(s)
            else:
                words.update(s)
        words = list(words)
        ids = dict(zip(words, self.words.get(words, self._tokenize)))
        return [ids[s] if isinstance(s, str) else b"".join([ids[w] for w in s]) for s in split]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        texts = [t or "" for t in texts]
        simple = [bool(_SIMPLE.fullmatch(t)) and not any(s in t for s in self.special) for t in texts]
        lists = pc.utf8_split_whitespace(pa.array([t.lower() if s else "" for t, s in zip(texts, simple)], pa.large_string()))
        coded = lists.values.dictionary_encode()
        known = self._split(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
        pool, first = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        counts = sizes[index]
        before = np.r_[0, np.cumsum(counts, dtype=np.int64)]
        shift = first[index] - before[:-1]
        if before[-1] < 1 << 31:
            shift = shift.astype(np.int32)
        place = np.repeat(shift, counts)
        place += np.arange(len(place), dtype=place.dtype)
        ids = pool[place]
        bounds = before[lists.offsets.to_numpy()]
        return [ids[a:b] if s else self._plain(t) for t, s, (a, b) in zip(texts, simple, itertools.pairwise(bounds.tolist()))]


_LOADED: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this worker process (kept between tasks)."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: full sequences and the rest of each row."""
    end = np.array([END_ID], "<u4")

    def run(batches):
        tokens = word_tokens(path)
        for part in byte_slices(batches, 1, BATCH_BYTES):
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), tokens.encode(part.column(1).to_pylist())):
                ids = np.concatenate([ids, end])
                for start in range(0, len(ids), length):
                    cut = ids[start:start + length]
                    rows.append((doc, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes()), len(ids)))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# ------------------------------------------------------------------ cutting stock

def price(widths: np.ndarray, values: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack over ascending ``widths``: the most valuable pattern and its worth."""
    best = np.zeros(length + 1)
    choice = np.full(length + 1, -1)
    fitting = np.searchsorted(widths, np.arange(length + 1), side="right").tolist()
    for room in range(1, length + 1):
        k = fitting[room]
        best[room] = best[room - 1]
        if k:
            offers = best[room - widths[:k]] + values[:k]
            top = int(offers.argmax())
            if offers[top] > best[room]:
                best[room], choice[room] = offers[top], top
    pattern, room = np.zeros(len(widths), np.int64), length
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= int(widths[choice[room]])
    return float(best[length]), pattern


def _first_basis(widths: np.ndarray, need: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A good starting basis: patterns filled with the widest classes left, each used until one
    of its classes is exhausted. That class owns the column, so the basis is triangular."""
    m, left = len(widths), need.astype(float)
    basis, times = np.zeros((m, m)), np.zeros(m)
    open_ = np.ones(m, bool)
    for _ in range(m):
        pattern, room = np.zeros(m), length
        for i in np.flatnonzero(open_)[::-1].tolist():
            copies = room // int(widths[i])
            if copies:
                copies = min(copies, max(1, int(left[i])))
                pattern[i], room = copies, room - copies * int(widths[i])
        used = np.flatnonzero(pattern)
        share = left[used] / pattern[used]
        own = int(used[share.argmin()])
        basis[:, own], times[own] = pattern, share.min()
        left = np.maximum(left - share.min() * pattern, 0)
        open_[own] = False
    return basis, times


def _inverse(matrix: np.ndarray) -> np.ndarray | None:
    """Gauss-Jordan with row pivots; None if singular. Plain array steps: the driver's threaded BLAS isn't needed
    for a few hundred rows and stalls when other processes hold the cores."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        if pivot != k:
            both[[k, pivot]] = both[[pivot, k]]
        if abs(both[k, k]) < 1e-9:
            return None
        both[k] /= both[k, k]
        rows = np.flatnonzero(both[:, k])
        rows = rows[rows != k]
        both[rows] -= both[rows, k][:, None] * both[k]
    return both[:, n:].copy()


def solve(widths: np.ndarray, counts: np.ndarray, length: int, gap: float = GAP,
          rounds: int = ROUNDS) -> list[tuple[int, np.ndarray]]:
    """``(times, pattern)`` covering ``counts`` exactly, nearly as few sequences as possible.

    Column generation on the linear relaxation. Prices are smoothed towards the best dual point so
    far (at first the widths' shares of a sequence, whose bound is the sum of lengths), which
    keeps the number of rounds small.
    """
    widths, need = np.asarray(widths, np.int64), np.asarray(counts, np.int64)
    if not len(widths):
        return []
    basis, times = _first_basis(widths, need, length)
    inverse = _inverse(basis)
    centre = widths / length
    bound = float((centre * need).sum())
    for turn in range(rounds):
        if times.sum() <= (1 + gap) * bound:
            break
        duals = inverse.sum(axis=0)
        for smooth in (0.9, 0.5, 0.0):
            prices = np.maximum(smooth * centre + (1 - smooth) * duals, 0)
            worth, pattern = price(widths, prices, length)
            below = float((prices * need).sum()) / max(worth, 1)   # Farley's bound
            if below > bound:
                bound, centre = below, prices / max(worth, 1)
            if (duals * pattern).sum() > 1 + 1e-9:
                break
        else:
            break
        direction = (inverse * pattern).sum(axis=1)
        ratio = np.where(direction > PIVOT, times / np.maximum(direction, PIVOT), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        step = ratio[out]
        times = np.maximum(times - step * direction, 0)
        times[out] = step
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        if turn % 50 == 49:
            exact = _inverse(basis)
            if exact is None:
                break
            inverse = exact
            times = np.maximum((inverse * need).sum(axis=1), 0)
    whole = np.floor(times + 1e-9).astype(np.int64)
    chosen = []
    for j in np.argsort(-times, kind="stable").tolist():
        column = np.round(basis[:, j]).astype(np.int64)
        if column.any():
            use = min(max(0, int(whole[j])), int((need[column > 0] // column[column > 0]).min()))
            if use:
                chosen.append((use, column))
                need = need - use * column
    return chosen + _best_fit(widths, need, length)


def _best_fit(widths: np.ndarray, need: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Best-fit decreasing over what rounding left."""
    todo = np.repeat(np.arange(len(widths)), need)
    todo = todo[np.argsort(-widths[todo], kind="stable")]
    room, bins = np.zeros(len(todo), np.int64), []
    for i in todo.tolist():
        w = widths[i]
        left = np.where(room[:len(bins)] >= w, room[:len(bins)], length + 1)
        at = int(np.argmin(left)) if len(left) else 0
        if not len(left) or left[at] > length:
            at = len(bins)
            bins.append(np.zeros(len(widths), np.int64))
            room[at] = length
        bins[at][i] += 1
        room[at] -= w
    return [(1, b) for b in bins]


def width_class(lengths, exact: int = EXACT, step: int = STEP):
    """Class width of a piece: exact when short, else rounded up (works on columns and arrays)."""
    return np.where(lengths <= exact, lengths, -(-lengths // step) * step)


# ------------------------------------------------------------------ Spark plan

def _ranked(table: DataFrame, histogram: dict[int, int], group_rows: int = 2000) -> DataFrame:
    """Number the pieces of each class from 0. A class is dealt over salts of about ``group_rows``
    pieces by a hash, so no window grows with the table."""
    from pyspark.sql import Window

    salts = [-(-histogram.get(c, 0) // group_rows) or 1 for c in range(max(histogram) + 1)]   # at most ``length`` + 1
    of_class = F.element_at(F.array(*[F.lit(n) for n in salts]), F.col("class").cast("int") + 1)
    salted = table.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), of_class))
    within = Window.partitionBy("class", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    offsets = salted.groupBy("class", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select(F.col("class").alias("_c"), F.col("salt").alias("_s"),
                             F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = salted.withColumn("row", F.row_number().over(within) - 1)
    return (numbered.join(offsets, (F.col("class") == F.col("_c")) & (F.col("salt") == F.col("_s")))
            .withColumn("rank", F.col("row") + F.col("offset")).drop("salt", "row", "offset", "_c", "_s"))


def pack(table: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces (column ``length``)."""
    spark = table.sparkSession
    size = F.col("length")
    table = table.withColumn("class", F.when(size <= EXACT, size).otherwise(
        F.least(F.lit(length), F.ceil(size / STEP) * STEP)).cast("long"))
    histogram = {r["class"]: r["n"] for r in table.groupBy("class").agg(F.count("*").alias("n")).collect()}
    widths = np.array(sorted(histogram), np.int64)   # at most ``length`` classes
    counts = np.array([histogram[w] for w in widths.tolist()], np.int64)
    if not len(widths):
        return table.drop("class").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})

    # places of each class in pattern order: pieces first..last-1 go to sequences base, base + 1, ...
    places, taken, base = [], np.zeros(len(widths), np.int64), 0
    for times, pattern in solve(widths, counts, length):
        for i in np.flatnonzero(pattern).tolist():
            n = times * int(pattern[i])
            places.append((int(widths[i]), int(taken[i]), int(taken[i] + n), int(pattern[i]), base))
            taken[i] += n
        base += times
    by_class = pd.DataFrame(places, columns=["class", "first", "last", "each", "base"]).sort_values(["class", "first"])
    first, last = by_class.groupby("class")["first"].agg(list), by_class.groupby("class")["base"].agg(list)
    each = by_class.groupby("class")["each"].agg(list)
    lookup = {int(c): (np.array(first[c]), np.array(each[c]), np.array(last[c])) for c in first.index}

    def place(batches):
        for batch in batches:
            kind, rank = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.zeros(len(kind), np.int64)
            for c in np.unique(kind).tolist():
                starts, copies, bases = lookup[c]
                mine = kind == c
                at = np.searchsorted(starts, rank[mine], side="right") - 1
                sequence[mine] = bases[at] + (rank[mine] - starts[at]) // copies[at]
            keep = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("class", "rank")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence)], names)

    from pyspark.sql import Window

    rows = int(counts.sum())
    fields = [f for f in table.schema.fields if f.name != "class"]
    names = [*(f.name for f in fields), "sequence_id"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long"
    placed = _ranked(table, histogram).select(*[f.name for f in fields], "class", "rank").mapInArrow(place, schema)
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32", "doc_tokens")
    placed = placed.repartition(sized_partitions(spark, rows, 500_000), "sequence_id")
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, **columns) -> DataFrame:
    """Tokenize, cut and pack: one row per piece."""
    return pack(written(pieces(docs, path, length, **columns), "pieces"), length)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read_documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
