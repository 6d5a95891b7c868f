"""Language identification by compression (operator 2).

Every language has a raw-content zstandard dictionary cut from a bounded sample of its labelled
texts. A text (letters only, lower case, whole) is compressed once with each dictionary; the
smallest result names the language, and the relative distance to the runner-up is the score. A
score below ``MARGIN`` is a rejection: the prediction stays, ``accepted`` is false.

Bounds: ``docs_per_language`` sampled rows of at most ``chars_per_doc`` characters each make a
dictionary of at most ``dictionary_bytes``. Every label is learned; with very many of them the dictionaries get
smaller, so that all together stay within ``all_bytes``. Every text is then classified whole, whatever its length.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any learned
language every text is ``und``; with one only, it has score 1. Ties go to the label with
more training rows. One row per input row; only the id and the text reach a prediction.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorlab.llm.common import read_documents, slices

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 300
CHARS_PER_DOC = 1500
DICTIONARY_BYTES = 112_640
#: Bytes of all dictionaries together, which go to every task: 128 MB, beyond 1,190 labels of the full size.
ALL_BYTES = 128 << 20
MARGIN = 0.02
LEVEL = 3

_LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> str:
    """The words of a text in lower case, joined by spaces."""
    return " ".join(_LETTERS.findall(text.lower())) if text else ""


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
        docs_per_language: int = DOCS_PER_LANGUAGE, chars_per_doc: int = CHARS_PER_DOC,
        dictionary_bytes: int = DICTIONARY_BYTES, all_bytes: int = ALL_BYTES) -> dict[str, bytes]:
    """Dictionary content per language from labelled rows (null text or label: not used)."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("draw")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not counts:
        return {}
    dictionary_bytes = min(dictionary_bytes, all_bytes // len(counts))
    docs_per_language = max(1, min(docs_per_language, dictionary_bytes // 100))
    # Thin each language to about twice its quota by a hash first, so that the ranking below sees few rows.
    scale = 1 << 20
    shares = docs.sparkSession.createDataFrame(
        [(c["lang"], min(scale, 1 + 2 * docs_per_language * scale // c["n"])) for c in counts], "lang string, share long")
    thin = rows.join(F.broadcast(shares), "lang").filter(F.pmod("draw", F.lit(scale)) < F.col("share"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    start = F.greatest(F.lit(1), F.floor((F.length("text") - chars_per_doc) / 2).cast("int"))
    drawn = (thin.withColumn("rank", rank).filter(F.col("rank") <= docs_per_language)
             .select("lang", "draw", F.substr("text", start, F.lit(chars_per_doc)).alias("part")).collect())
    contents: dict[str, bytes] = {}
    for row in sorted(drawn, key=lambda r: (r["lang"], r["draw"])):
        part = letters(row["part"]).encode("utf-8", "ignore")
        have = contents.get(row["lang"], b"")
        if part and len(have) + len(part) < dictionary_bytes:
            contents[row["lang"]] = have + b" " + part
    return {c["lang"]: contents[c["lang"]] for c in counts if c["lang"] in contents}


class Classifier:
    """Compressors of one worker."""

    def __init__(self, contents: dict[str, bytes]):
        self.languages = list(contents)
        self.compressors = []
        for content in contents.values():
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float]:
        plain = letters(text)
        if not self.languages or not any(map(str.isalpha, plain)):
            return UNKNOWN, 0.0
        data = plain.encode("utf-8", "ignore")
        sizes = [len(c.compress(data)) for c in self.compressors]
        first = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != first)
        return self.languages[first], (second - sizes[first]) / second


def predict(docs: DataFrame, contents: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
            margin: float = MARGIN) -> DataFrame:
    """``(doc_id, lang_pred, score, accepted)`` per row; ``contents`` comes from ``fit``."""
    def run(batches):
        classifier = Classifier(contents)
        for part in slices(batches):
            found = [classifier.predict(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[0] != UNKNOWN and f[1] >= margin for f in found], pa.bool_())],
                ["doc_id", "lang_pred", "score", "accepted"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """Every fourth document by checksum of its id is kept out of training (null id: not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    contents = fit(docs.filter(~held_out()))
    return predict(docs, contents).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
