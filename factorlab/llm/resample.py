"""Importance resampling towards a target distribution, hashed with a position-table CRC (operator 13).

1. Features of a text are all runs of 1 to ``ngrams`` consecutive words, joined by one space; a feature's bucket is its
   CRC-32 modulo ``buckets``. CRC-32 is linear over XOR: a byte's contribution depends only on its value and its
   distance from the end of the span, and the span's length adds a constant. So all spans of a step are hashed at once:
   bytes look up their contributions in a (distance, byte) table and ``bitwise_xor.reduceat`` folds each span. Spans
   longer than the table are cut into blocks from their end, and neighbouring blocks are folded pairwise, the left one
   moved on by the zero bytes that the right one stands for.
2. Every task adds up its bucket counts (``buckets`` numbers) before they are shuffled. The counts of the corpus and of
   the target texts give each bucket's gain, ``floor(1000 ln(target share / corpus share))`` with one added to each count.
3. A document's weight is the sum of its features' gains. Adding keyed Gumbel noise to it and taking the highest scores draws
   without replacement in proportion to exp(weight / 1000). Ranks come from a range-partitioned sort.

Defined cases: a null or blank text has no features and weight 0; a null id draws its noise like an empty id and loses
ties; repeated rows are documents of their own (same score, neighbouring ranks); texts are read whole and a word of any
length is one feature; an empty corpus gives an empty result, an empty target gives gains from its added ones; columns
other than id and text are not read by ``scores``, and ``drawn`` returns all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorlab.llm.common import byte_slices, globally_ranked, read_documents, spare, text_buffer, written

NGRAMS = 1
BUCKETS = 10_000
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10
#: Distances of the contribution table: longer spans are folded in blocks of so many bytes.
BLOCK = 64
#: Text bytes handled in one step; span bytes hashed in one numpy step.
STEP_BYTES, SPAN_BYTES = 2 << 20, 1 << 20

#: The reflected CRC-32 polynomial, and its start and final register.
POLYNOMIAL, ONES = 0xEDB88320, 0xFFFFFFFF

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[0x80:] = True


# ------------------------------------------------------------------ CRC-32 of many spans

def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


_BYTE = _byte_table()


def _zero_byte(register: np.ndarray) -> np.ndarray:
    """Registers after one more zero byte."""
    return _BYTE[register & 0xFF] ^ (register >> 8)


def _contributions(distances: int) -> np.ndarray:
    rows = [_BYTE]
    for _ in range(distances - 1):
        rows.append(_zero_byte(rows[-1]))
    return np.concatenate(rows)   # index: distance from the end * 256 + byte


class _Moves:
    """``moves(level, register)``: registers after ``BLOCK << level`` zero bytes, by four byte tables a level."""

    def __init__(self):
        first = (np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        for _ in range(BLOCK):
            first = _zero_byte(first)
        self.tables = [first]

    def __call__(self, level: int, register: np.ndarray) -> np.ndarray:
        while len(self.tables) <= level:   # moving twice by half the bytes
            last = len(self.tables) - 1
            self.tables.append(self(last, self(last, np.array([[b << (8 * j) for b in range(256)] for j in range(4)], np.uint32))))
        t = self.tables[level]
        return t[0][register & 0xFF] ^ t[1][(register >> 8) & 0xFF] ^ t[2][(register >> 16) & 0xFF] ^ t[3][register >> 24]


_TABLE, _MOVES = _contributions(BLOCK), _Moves()


def _short_constants() -> np.ndarray:
    registers = [np.array([ONES], np.uint32)]
    for _ in range(BLOCK):
        registers.append(_zero_byte(registers[-1]))
    return np.concatenate(registers)


_CONSTANTS = _short_constants()


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of so many zero bytes: what a span's length alone contributes."""
    out = _CONSTANTS[lengths % BLOCK]
    blocks, level = lengths // BLOCK, 0
    while blocks.any():
        odd = (blocks & 1).astype(bool)
        out[odd] = _MOVES(level, out[odd])
        blocks, level = blocks >> 1, level + 1
    return out ^ np.uint32(ONES)


def _xor_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Contributions of non-empty spans of at most ``BLOCK`` bytes, each folded into one register."""
    lengths = stops - starts
    ends = np.cumsum(lengths)
    out, at = np.empty(len(starts), np.uint32), 0
    while at < len(starts):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SPAN_BYTES, side="right")))
        size, begin = lengths[at:to], ends[at:to] - lengths[at:to] - done
        left = np.repeat((begin + size).astype(np.int32), size)   # distance from the end, counted down
        left -= np.arange(1, len(left) + 1, dtype=np.int32)
        place = np.repeat(stops[at:to] - 1, size) - left
        out[at:to] = np.bitwise_xor.reduceat(_TABLE[(left << 8) + data[place]], begin)
        at = to
    return out


def crc32_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of every span ``data[start:stop]``; spans may overlap."""
    lengths = stops - starts
    out = length_constants(lengths)
    short = (lengths <= BLOCK) & (lengths > 0)
    out[short] ^= _xor_spans(data, starts[short], stops[short])
    long = np.flatnonzero(lengths > BLOCK)
    if len(long):
        blocks = -(-lengths[long] // BLOCK)
        span = np.repeat(np.arange(len(long)), blocks)
        from_end = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))
        block_stops = stops[long][span] - from_end * BLOCK
        block_starts = np.maximum(starts[long][span], block_stops - BLOCK)
        registers, level = _xor_spans(data, block_starts, block_stops), 0
        while len(registers) > len(long):   # fold neighbours: the left one of a pair moves on
            odd = (from_end & 1).astype(bool)
            registers[odd] = _MOVES(level, registers[odd])
            from_end = from_end >> 1
            pairs = np.flatnonzero(np.r_[True, (span[1:] != span[:-1]) | (from_end[1:] != from_end[:-1])])
            registers = np.bitwise_xor.reduceat(registers, pairs)
            span, from_end, level = span[pairs], from_end[pairs], level + 1
        out[long] ^= registers
    return out


# ------------------------------------------------------------------ features

def features(texts: pa.Array, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every feature, and the word count of every text."""
    data, offsets = text_buffer(texts)
    data = _LOWER[data]
    word = _WORD[data]
    filled = offsets[:-1] < offsets[1:]
    before, after = np.zeros(len(word), bool), np.zeros(len(word), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[offsets[:-1][filled]] = after[offsets[1:][filled] - 1] = False   # texts don't run into each other
    starts, stops = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    words = np.diff(np.searchsorted(starts, offsets))
    text = np.repeat(np.arange(len(words)), words)
    found, owner = [crc32_spans(data, starts, stops)], [text]
    if ngrams > 1 and len(starts):   # the words again, with one space after each
        size = stops - starts + 1
        new_stops = np.cumsum(size) - 1
        new_starts = new_stops - size + 1
        place = np.arange(int(size.sum())) + np.repeat(starts - new_starts, size)
        data = np.append(data, np.uint8(0))[place]
        data[new_stops] = ord(" ")
        for n in range(2, ngrams + 1):
            whole = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.zeros(0, np.int64)
            found.append(crc32_spans(data, new_starts[whole], new_stops[whole + n - 1]))
            owner.append(text[whole])
    return np.concatenate(found) % buckets, np.concatenate(owner), words


def bucket_counts(texts: DataFrame, text_col: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: one small table a task, summed by Spark; ``buckets`` numbers come back."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in byte_slices(batches, 0, STEP_BYTES):
            total += np.bincount(features(part.column(0), ngrams, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    partial = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():   # at most ``buckets`` rows
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket in thousandths of a nat, from the feature counts of corpus and target."""
    size, S, T = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (S + size) / ((s + 1.0) * (T + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


# ------------------------------------------------------------------ weights, scores, ranks

def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            ngrams: int = NGRAMS) -> DataFrame:
    """``(doc_id, text_key, n_words, n_features, weight)``: one row per row; ``gain`` (one number a bucket) goes along."""
    def run(batches):
        for part in byte_slices(batches, 1, STEP_BYTES):
            bucket, owner, words = features(part.column(1), ngrams, len(gain))
            n = np.bincount(owner, minlength=part.num_rows)
            # whole numbers below 2^53: exact in doubles
            weight = np.bincount(owner, weights=gain[bucket], minlength=part.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(words), pa.array(n), pa.array(weight)],
                ["doc_id", "text_key", "n_words", "n_features", "weight"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return source.mapInArrow(run, f"doc_id {kind}, text_key long, n_words long, n_features long, weight long")


def scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
           ngrams: int = NGRAMS, buckets: int = BUCKETS, seed: str = SEED, min_words: int = MIN_WORDS,
           percent: int = PERCENT) -> DataFrame:
    """``(doc_id, text_key, n_words, n_features, weight, score, rank)``: one row per document.

    ``rank`` numbers the drawn documents by falling score (ties: smaller id) and is null for the others: ``percent`` of the
    documents with ``min_words`` words or more.
    """
    gain = gains(bucket_counts(docs, text_col, ngrams, buckets), bucket_counts(target, target_col, ngrams, buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256),
                               1, 8), 16, 10).cast("long")
    uniform = (noise + F.lit(0.5)) / F.lit(4294967296.0)
    table = written(weights(docs, gain, id_col, text_col, ngrams), "weights")
    scored = table.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))))
    able = F.col("n_words") >= min_words
    n = scored.filter(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features"), F.col("text_key"),
             F.monotonically_increasing_id()]   # repeated rows: in any order, but never all in one range
    ranked = globally_ranked(scored.filter(able), "rank", *order)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return ranked.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that were drawn, with all their columns (repeated rows of a drawn one come along)."""
    key, text_key = spare(docs, "_doc", "_text_key")
    chosen = scores(docs, target, id_col, text_col, **options).filter("rank IS NOT NULL").select(
        F.col("doc_id").alias(key), F.col("text_key").alias(text_key)).distinct()
    mine = F.xxhash64(F.col(text_col).cast("string"))
    return docs.join(chosen, F.col(id_col).eqNullSafe(F.col(key)) & (mine == F.col(text_key)), "left_semi")


def query(spark, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return scores(read_documents(spark, sf_dir, "doc_id", "text"), target).select(
        "doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
split AS (SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lowered),
target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
corpus AS (SELECT doc_id, unnest(words) AS word FROM split),
table_ AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(0, 8)),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS b))),
vocabulary AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM corpus UNION SELECT word FROM target)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      [CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT) for i in range(0, length(h) // 2)]),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 10000 AS bucket
  FROM vocabulary, table_),
s AS (SELECT bucket, count(*) AS n FROM corpus JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM corpus) AS S_, (SELECT count(*) FROM target) AS T_),
gain AS (
  SELECT s.bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (S_ + 10000) AS DOUBLE)
    / CAST((s.n + 1) * (T_ + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket), sums),
weight AS (
  SELECT doc_id, count(*) AS n, sum(g) AS w FROM corpus JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
    CAST(coalesce(w, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM split LEFT JOIN weight USING (doc_id)),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN r <= 10 * n // 100 THEN CAST(r AS BIGINT) END AS rank
FROM scored LEFT JOIN able USING (doc_id)
"""
