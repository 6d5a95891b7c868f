"""Line de-duplication by a deletion-neighbourhood join (operator 8, DataFrame functions only).

A line is compared as its units: its words (split at single spaces, outer spaces trimmed), and in scripts written
without spaces its characters. Two lines are near when they are equal or, if both have ``fuzzy_words`` units or
more, one unit was inserted, deleted or replaced: the edit bound is a fifth of a line (similarity 0.8) at the
shortest, and no bound of whole units fits a shorter one. A line goes when an earlier line, by (doc_id, line_no), is
near it; the earliest such line is named. Whether that earlier line itself goes does not
matter, so the answer does not depend on any order of work. Blank lines always stay.

1. Equal lines collapse to one row (two 64-bit hashes, earliest place, count).
2. Candidates, without loss: two lines one word apart agree on their first or on their last
   half (counted at the shorter length), so each line has four half keys; lines that share none
   leave here. Their text is fetched again from the documents through a bitmap of
   fixed size (``filter_bits``) and an exact semi-join.
3. Deletion neighbourhood: a candidate emits the hash of itself and of itself without word i,
   for every i. Equal keys at the same i are replacements, the whole line against a
   shortened one is an insertion. The earliest line per key is an aggregate (combined before the
   shuffle), so a key shared by a third of all lines makes no pairs.
4. Each proposed pair is verified unit by unit before it counts.

Defined cases: a null text has no lines; a null doc_id sorts first; repeated rows of one doc_id
are one document (their equal lines are kept or dropped alike); other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorlab.llm.common import UNSPACED, own_columns, read_documents, spare, written

#: One edit in this many units is a similarity of 0.8.
FUZZY_WORDS = 5
#: Bits of the candidate bitmap (broadcast: an eighth as many bytes at any input size).
FILTER_BITS = 1 << 24
#: Positions in one bitmap of Spark's ``bitmap_construct_agg``.
_BUCKET = 32768


def _canonical(line: Column) -> Column:
    return F.trim(line)


def _units(line: Column) -> Column:
    """The units of a canonical line, joined by single spaces; a line without unspaced script is unchanged."""
    apart = F.trim(F.regexp_replace(F.regexp_replace(line, f"([{UNSPACED}])", " $1 "), " +", " "))
    return F.when((F.octet_length(line) > F.length(line)) & line.rlike(f"[{UNSPACED}]"), apart).otherwise(line)


def _line_key(number: Column, line: Column) -> Column:
    return F.xxhash64(number, _canonical(line))


def _text_keys(text: Column) -> list[Column]:
    """With the doc_id, the key of a row: rows of one key have one text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(7), text)]


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_keys: bool = False) -> DataFrame:
    """``(doc_id, line_no, line, h1, h2)``: the non-blank lines, trimmed; ``t1``, ``t2`` of their texts if asked."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = ["t1", "t2"] if row_keys else []
    keys = [k.alias(n) for k, n in zip(_text_keys(F.col("text")), own)]
    lines = source.select("doc_id", *keys, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return (lines.select("doc_id", *own, "line_no", _canonical(F.col("line")).alias("line")).filter("line <> ''")
            .select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")))


def _half_keys(line: Column, words: Column) -> Column:
    keys = []
    for shorter in (words, words - 1):
        first = F.floor(shorter / 2).cast("int")
        keys += [F.xxhash64(F.lit("first"), shorter, F.call_function("substring_index", line, F.lit(" "), first)),
                 F.xxhash64(F.lit("last"), shorter,
                            F.call_function("substring_index", line, F.lit(" "), first - shorter))]
    return F.array(*keys)


def _candidates(distinct: DataFrame, fuzzy_words: int) -> DataFrame:
    """Hashes of the lines that share a half key with another line."""
    keys = distinct.filter(F.col("words") >= fuzzy_words).select("h1", "h2", F.explode("halves").alias("key"))
    shared = (keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
              .filter("lo <> hi").select("key"))
    return keys.join(shared, "key", "left_semi").select("h1", "h2").distinct()


def _fetch(lines: DataFrame, wanted: DataFrame, filter_bits: int) -> DataFrame:
    """``(place, words)`` of the wanted distinct lines; ``wanted`` has h1, h2 and place."""
    def slot(h: Column) -> tuple[Column, Column]:
        at = F.pmod(h, F.lit(filter_bits))
        return F.floor(at / _BUCKET).cast("int"), (at % _BUCKET).cast("int")

    bucket, bit = slot(F.col("h1"))
    bitmaps = wanted.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    byte = F.conv(F.hex(F.call_function("substring", F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    maybe = (lines.select("*", bucket.alias("bucket"), bit.alias("bit")).join(F.broadcast(bitmaps), "bucket")
             .filter(F.call_function("getbit", byte, F.col("bit") % 8) == 1))
    place = F.struct("doc_id", "line_no", "h1", "h2")
    return (maybe.select("h1", "h2", "line", place.alias("at"))
            .join(wanted.select("h1", "h2", F.col("place").alias("first")), ["h1", "h2"])
            .filter("at <=> first").select(F.col("first").alias("place"), F.split(_units(F.col("line")), " ").alias("words"))
            .dropDuplicates(["place"]))


def _one_word_apart(a: Column, b: Column) -> Column:
    """Two arrays of units are one insertion, deletion or replacement apart (or equal, from different lines)."""
    la, lb = F.size(a), F.size(b)
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False).cast("int")
    rest = lambda w, start, n: F.slice(w, start, n)
    return ((la == lb) & (rest(a, at + 1, la) == rest(b, at + 1, lb))
            | (la == lb + 1) & (rest(a, at + 1, la) == rest(b, at, la))
            | (lb == la + 1) & (rest(a, at, lb) == rest(b, at + 1, lb)))


def _neighbours(texts: DataFrame) -> DataFrame:
    """``(place, partner)``: the earliest earlier line one word apart from each line."""
    hashed = texts.select("place.h1", F.transform("words", lambda w: F.xxhash64(w)).alias("w"))
    variants = hashed.select("h1", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("w")),
        lambda i: F.when(i == 0, F.xxhash64("w")).otherwise(
            F.xxhash64(F.slice("w", 1, i - 1), F.slice("w", i + 1, F.size("w")))))).alias("gone", "key"))
    variants = written(variants, "variants")
    shared = (variants.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
              .filter("lo <> hi").select("key"))
    variants = written(variants.join(shared, "key", "left_semi").join(
        texts.select(F.col("place.h1").alias("h1"), "place"), "h1").select("key", "gone", "place"), "shared-variants")
    by_gap = variants.groupBy("key", "gone").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    by_key = by_gap.groupBy("key").agg(
        F.min(F.when(F.col("gone") == 0, F.col("least"))).alias("whole"),
        F.min(F.when(F.col("gone") > 0, F.col("least"))).alias("shortened"),
        F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last")
    best = by_gap.join(by_key, "key").select("key", "gone", F.when(
        F.col("gone") == 0, F.col("shortened")).otherwise(F.least("least", "whole")).alias("partner"))
    pairs = (variants.join(best, ["key", "gone"]).filter("partner < place")
             .select("place", "partner").distinct())
    sides = (pairs.join(texts.withColumnRenamed("words", "a"), "place")
             .join(texts.select(F.col("place").alias("partner"), F.col("words").alias("b")), "partner"))
    return sides.filter(_one_word_apart(F.col("a"), F.col("b"))).groupBy("place").agg(F.min("partner").alias("partner"))


def _marked(docs: DataFrame, id_col: str, text_col: str, fuzzy_words: int = FUZZY_WORDS,
            filter_bits: int = FILTER_BITS, row_keys: bool = False) -> DataFrame:
    """The lines that go, with what they repeat (``kept``, ``word_edits``)."""
    lines = line_table(docs, id_col, text_col)
    words = F.length("units") - F.length(F.replace("units", F.lit(" "), F.lit(""))) + 1
    place = F.struct("doc_id", "line_no", "h1", "h2")
    distinct = (lines.withColumn("units", _units(F.col("line")))
                .select("doc_id", "line_no", "h1", "h2", words.alias("words"), _half_keys(F.col("units"), words).alias("halves"))
                .groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("n"),
                                         F.first("words").alias("words"), F.first("halves").alias("halves")))
    distinct = written(distinct, "lines")
    wanted = written(_candidates(distinct, fuzzy_words).join(distinct.select("h1", "h2", "place"), ["h1", "h2"]),
                     "candidates")
    texts = written(_fetch(lines, wanted, filter_bits), "candidate-texts")
    partners = _neighbours(texts).select(F.col("place.h1").alias("h1"), F.col("place.h2").alias("h2"), "partner")
    groups = (distinct.select("h1", "h2", "place", "n").join(partners, ["h1", "h2"], "left")
              .filter("n > 1 OR partner IS NOT NULL")
              .select("h1", "h2", F.coalesce("partner", "place").alias("kept"),
                      F.when(F.col("partner").isNull(), 0).otherwise(1).alias("word_edits")))
    groups = written(groups, "line-groups")
    if row_keys:
        found = line_table(docs, id_col, text_col, True).drop("line")
    else:
        found = lines.select("h1", "h2", "doc_id", "line_no", _line_key(F.col("line_no"), F.col("line")).alias("line_key"))
    return (found.join(groups, ["h1", "h2"])
            .filter(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("line_no") == F.col("kept.line_no"))
                      & (F.col("h1") == F.col("kept.h1")))))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, line_no, line_key, kept_doc_id, kept_line_no, word_edits)`` of the lines that go."""
    return (_marked(docs, id_col, text_col, **options)
            .select("doc_id", "line_no", "line_key", F.col("kept.doc_id").alias("kept_doc_id"),
                    F.col("kept.line_no").alias("kept_line_no"), "word_edits").distinct())


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the duplicate lines taken out of the text; every row and column stays."""
    key, t1, t2, numbers = spare(docs, "key", "t1", "t2", "numbers")
    # by row, not by doc_id: a list is never longer than one text, however many rows have no id
    gone = (_marked(docs, id_col, text_col, row_keys=True, **options).select("doc_id", "t1", "t2", "line_no").distinct()
            .groupBy(F.col("doc_id").alias(key), F.col("t1").alias(t1), F.col("t2").alias(t2))
            .agg(F.collect_list("line_no").alias(numbers)))
    source = F.col(text_col).cast("string")
    # split once; array_except looks up by hash
    rest = F.transform(F.array(F.split(source, "\n")), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(numbers)), lambda i: lines[i]), "\n"))[0]
    text = F.when(F.col(numbers).isNull(), source).otherwise(rest).alias(text_col)
    own = [k == F.col(t) for k, t in zip(_text_keys(source), (t1, t2))]
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col(key)) & own[0] & own[1], "left")
    return joined.select(*[text if name == text_col else column for name, column in zip(docs.columns, own_columns(docs))])


def query(spark, sf_dir: str) -> DataFrame:
    return duplicate_lines(read_documents(spark, sf_dir, "doc_id", "text"))
