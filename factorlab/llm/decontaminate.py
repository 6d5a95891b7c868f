"""Benchmark decontamination by template matching (operator 1).

Texts become token sequences in which numbers, names and units are typed placeholders, so a
question with other numbers or people keeps its template. Names are read in three ways (``VIEWS``),
so that neither case nor the place in a sentence hides a copy; the best way counts:

1. Every window of ``window`` template tokens gets a 64-bit hash; items shorter than that are one
   window of their own length. An item uses the windows that hold enough literal words; an item
   without any such window uses all of them, but then its slots must be equal, not only consistent.
2. Documents are scanned once. A bitmap of the item hashes (fixed size, whatever the benchmark
   holds) lets through only windows that may match; these are hash-joined with the item windows.
3. Slot consistency, per document, item and alignment: every slot value of the item (a
   name, a number, a unit) must stand for one value of the document, and different names for
   different names. An alignment counts if at least ``min_agreement`` of its slots agree.
4. A document is contaminated by an item if at least ``min_share`` of the item's windows are found
   in consistent alignments.

Defined cases: null or empty texts match nothing; rows without doc_id are one document per
distinct text (``drop_contaminated`` takes those without text too with any contaminated one); repeated rows of a doc_id are one document; items with fewer than ``min_tokens`` tokens are too
short to tell and match nothing; an empty benchmark gives an empty result.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorlab.llm.common import UNSPACED, read_documents, slices, spare, written

WINDOW = 8
MIN_TOKENS = 5
MIN_SHARE = 0.3
MIN_AGREEMENT = 0.9
#: Bits of the filter over the item windows (2 MB in every task).
FILTER_BITS = 1 << 24
_BUCKET = 32768
#: The item windows are broadcast up to this many rows; beyond it they are shuffled.
BROADCAST_ROWS = 200_000
#: Distinct raw tokens remembered by a worker before it starts over.
CACHE_TOKENS = 200_000

LITERAL, NUMBER, NAME, UNIT = range(4)
#: Names are capitalised words inside a sentence; any capitalised words but ``OPENERS``; plain words.
VIEWS = INNER, ANYWHERE, PLAIN = range(3)
#: A token, with the sentence end before it if there is one; in scripts without spaces each character is one.
TOKEN = re.compile(rf"(?:[.!?\n]\s*)?(?:\d+(?:[.,]\d+)*|[{UNSPACED}]|[^\W\d_{UNSPACED}]+(?:['’][^\W\d_{UNSPACED}]+)*)")
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand
million billion dozen half""".split())
UNITS = frozenset("""mm cm km meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet
inch inches yard yards mg kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml liter liters litre
litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents
dollar dollars euro euros mph kmh degree degrees percent""".split())


#: What can stand between the end of a sentence and the next word, as the token pattern has it.
SENTENCE_END = ".!? \t\r\n\f\v   \x85\x1c\x1d\x1e\x1f"
#: Words that open a sentence without being a name.
OPENERS = frozenset("""a about after all also although always an and another any are as at be because been before both but by
can could did do does during each either even every few find first for from given had has have he her here hers his how
however i if in is it its just last let many may might more most much must my neither next no nor not now of often on once
one only or other our out over please question answer several shall she should show since so some such suppose than that
the their them then there these they this those though through to together under until up upon us was we were what when
where whether which while who whom whose why will with without would yes yet you your""".split())


def read(raw: str) -> tuple[tuple[int, ...], str]:
    """Types (one per view) and value of one raw token (with its sentence end, if any)."""
    body = raw.lstrip(SENTENCE_END)
    low = body.lower()
    if body[:1].isdigit() or low in NUMBER_WORDS:
        return (NUMBER, NUMBER, NUMBER), low
    if low in UNITS:
        return (UNIT, UNIT, UNIT), low
    if body[:1].isupper() and not body.isupper():
        return (NAME if body == raw else LITERAL, LITERAL if low in OPENERS else NAME, LITERAL), low
    return (LITERAL, LITERAL, LITERAL), low


def classify(raw: str, view: int = INNER) -> tuple[int, str]:
    """Type and value of one raw token in one view."""
    kinds, value = read(raw)
    return kinds[view], value


def _code(text: str, kind: int) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) & ~3 | kind


class Codes(dict):
    """Raw token -> place of its 64-bit template codes, one per view; the low two bits are the type."""

    def __init__(self):
        self.codes = array("Q")
        self.seen = np.zeros((0, len(VIEWS)), np.uint64)
        self.holders = [_code(f"<{kind}>", kind) for kind in range(4)]   # of the placeholders

    def __missing__(self, raw: str) -> int:
        kinds, value = read(raw)
        literal = _code(value, LITERAL) if LITERAL in kinds else 0
        self.codes.extend([self.holders[kind] if kind else literal for kind in kinds])
        self[raw] = place = len(self)
        return place

    def views(self, places: np.ndarray) -> np.ndarray:
        """The codes of the tokens at ``places``: one row per view."""
        if len(self.seen) < len(self):
            self.seen = np.array(self.codes, np.uint64).reshape(-1, len(VIEWS))
        return np.ascontiguousarray(self.seen[places].T)

    def start_over(self) -> None:
        if len(self) >= CACHE_TOKENS:
            self.clear()
            self.__init__()


def template(text: str | None, codes: Codes) -> tuple[list[str], np.ndarray]:
    """The raw tokens of a text and their places in ``codes``."""
    raws = TOKEN.findall("\n" + text) if text else []
    return raws, np.fromiter(map(codes.__getitem__, raws), np.int64, len(raws))


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    count = len(codes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(count, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[j:j + count]
        out ^= out >> np.uint64(29)
    return out


def _slots(raws: list[str], codes: np.ndarray, start: int, width: int) -> list[str]:
    """``offset|type|value`` of every placeholder of a window."""
    return [f"{j}|{int(codes[start + j]) & 3}|{classify(raws[start + j])[1]}"
            for j in np.flatnonzero(codes[start:start + width] & np.uint64(3)).tolist()]


_WINDOW_FIELDS = "hash long, at long, slots array<string>"


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``(item_id, view, hash, at, slots, width, strict, of)``: the windows used, ``of`` per item and view."""
    def run(batches):
        codes = Codes()
        for part in slices(batches):
            codes.start_over()
            rows = []
            for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                raws, places = template(text, codes)
                if len(raws) < min_tokens:
                    continue
                width = min(window, len(raws))
                read = codes.views(places)
                for view, code in enumerate(read):
                    if any((code == other).all() for other in read[:view]):
                        continue
                    hashes = window_hashes(code, width).view(np.int64).tolist()
                    literal = np.convolve((code & np.uint64(3)) == 0, np.ones(width, int), "valid")
                    used = np.flatnonzero(literal * 2 >= width).tolist()
                    strict = not used
                    used = used or list(range(len(hashes)))
                    rows += [(item, view, hashes[p], p, _slots(raws, code, p, width), width, strict, len(used)) for p in used]
            cols = list(zip(*rows)) or [()] * 8
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int32(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["item_id", "view", "hash", "at", "slots", "width", "strict", "of"])

    source = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"item_id long, view int, {_WINDOW_FIELDS}, width int, strict boolean, of long")


def _filter(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Bitmap over the item hashes (at most ``FILTER_BITS`` bits) and the window widths in use."""
    at = F.pmod("hash", F.lit(FILTER_BITS))
    rows = items.groupBy(F.floor(at / _BUCKET).alias("bucket")).agg(
        F.bitmap_construct_agg((at % _BUCKET).cast("int")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        bits[row["bucket"] * _BUCKET // 8:(row["bucket"] + 1) * _BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits, sorted(r["width"] for r in items.select("width").distinct().collect())


_NO_TEXT = "-"


def _text_key(doc_id: Column, text: Column) -> Column:
    """Tells rows without doc_id apart; empty for all others."""
    return F.when(doc_id.isNull(), F.coalesce(F.sha2(text.cast("string"), 256), F.lit(_NO_TEXT))).otherwise("")


def document_windows(docs: DataFrame, bits: np.ndarray, widths: list[int], id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, hash, at, slots)`` of the document windows that pass the filter."""
    def run(batches):
        codes = Codes()
        mask = np.uint64(FILTER_BITS - 1)
        for part in slices(batches):
            codes.start_over()
            rows = []
            docs, keys = part.column(0).to_pylist(), part.column(1).to_pylist()
            found = [template(text, codes) for text in part.column(2).to_pylist()]
            ends = np.cumsum([len(raws) for raws, _ in found])
            # the texts of a slice are hashed as one; windows over their borders are left out
            read = codes.views(np.concatenate([places for _, places in found]))
            for width in widths:
                before = []
                for code in read:
                    hashes = window_hashes(code, width)
                    spot = hashes & mask
                    passed = bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1
                    for other in before:
                        passed[hashes == other] = 0
                    before.append(hashes)
                    passed = np.flatnonzero(passed)
                    owners = np.searchsorted(ends, passed, side="right")
                    for p, d in zip(passed.tolist(), owners.tolist()):
                        if p + width <= ends[d]:
                            raws = found[d][0]
                            first = int(ends[d]) - len(raws)
                            rows.append((docs[d], keys[d], int(hashes[p].view(np.int64)), p - first,
                                         _slots(raws, code[first:ends[d]], p - first, width)))
            cols = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "text_key", "hash", "at", "slots"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(F.col(id_col), F.col(text_col)).alias("text_key"),
                         F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id long, text_key string, {_WINDOW_FIELDS}")


def _consistency(matches: DataFrame, key: list[str]) -> DataFrame:
    """Per alignment: slots, slots that agree, slots with another value."""
    slot = F.explode(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))).alias("s")
    part = lambda c, k: F.split(c, r"\|", 3)[k]
    slots = (matches.select(*key, "strict", "q", slot)
             .select(*key, "strict", (F.col("q") + part(F.col("s.i"), 0).cast("long")).alias("place"),
                     part(F.col("s.i"), 1).alias("kind"), part(F.col("s.i"), 2).alias("item_value"),
                     part(F.col("s.d"), 2).alias("doc_value")).distinct())
    pairs = slots.groupBy(*key, "strict", "kind", "item_value", "doc_value").agg(F.count("*").alias("n"))
    equal = F.col("item_value") == F.col("doc_value")
    forward = pairs.groupBy(*key, "strict", "kind", "item_value").agg(
        F.sum("n").alias("n"), F.max(F.struct(F.col("n").alias("n"), equal.alias("same"), F.col("doc_value").alias("doc_value"))).alias("top"),
        F.sum(F.when(equal, F.col("n")).otherwise(0)).alias("same"))
    # two names of the item must not become one name of the document: only the larger one agrees
    back = forward.select(*key, "strict", "kind", "n", "same", F.col("top.n").alias("agreed"), F.col("top.doc_value").alias("doc_value"))
    back = back.groupBy(*key, "strict", "kind", "doc_value").agg(
        F.sum("n").alias("n"), F.sum("same").alias("same"),
        F.when(F.col("kind") == str(NAME), F.max("agreed")).otherwise(F.sum("agreed")).alias("agreed"))
    return back.groupBy(*key).agg(
        F.sum("n").alias("slots"), (F.sum("n") - F.sum("same")).alias("changed"),
        F.sum("agreed").alias("agreed"), F.max("strict").alias("strict"))


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_tokens: int = MIN_TOKENS,
           min_share: float = MIN_SHARE, min_agreement: float = MIN_AGREEMENT) -> DataFrame:
    """The result of ``contaminated`` with the ``text_key`` of rows without doc_id."""
    items = written(item_windows(benchmark, window=window, min_tokens=min_tokens), "item-windows")
    bits, widths = _filter(items)
    right = items.select("item_id", "view", "hash", F.col("at").alias("q"), F.col("slots").alias("item_slots"), "strict", "of")
    if items.count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    matches = document_windows(docs, bits, widths).join(right, "hash").withColumn("shift", F.col("at") - F.col("q"))
    matches = written(matches.drop("hash", "at"), "template-matches")
    key = ["doc_id", "text_key", "item_id", "view", "shift"]
    named = [F.col(k).alias(f"_{k}") for k in key]
    slots = _consistency(matches, key)
    alignments = matches.select(*key, "q", "of").distinct().join(
        slots.select(*named, "slots", "changed", "agreed", "strict"),
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("item_id").eqNullSafe(F.col("_item_id"))
        & (F.col("text_key") == F.col("_text_key")) & (F.col("view") == F.col("_view")) & (F.col("shift") == F.col("_shift")), "left")
    slot_count = F.coalesce("slots", F.lit(0))
    consistent = F.when(F.col("strict"), F.col("changed") == 0).otherwise(F.col("agreed") >= min_agreement * F.col("slots"))
    alignments = alignments.withColumn("good", (slot_count == 0) | consistent)
    # what the names inside sentences contradict, no other view may count
    refused = F.max((F.col("view") == INNER) & ~F.col("good")).over(Window.partitionBy("doc_id", "text_key", "item_id", "shift"))
    good = alignments.withColumn("refused", refused).filter(F.col("good") & ~F.col("refused"))
    changed = F.max(F.coalesce("changed", F.lit(0)))
    views = (good.groupBy("doc_id", "text_key", "item_id", "view").agg(
        F.countDistinct("q").alias("windows"), F.first("of").alias("of"),
        F.max(slot_count).alias("slots"), changed.alias("changed_slots"))
        .withColumn("share", F.col("windows") / F.col("of")).filter(F.col("share") >= min_share))
    # the view with the largest share, then the fewest changes
    best = F.max(F.struct("share", (-F.col("changed_slots")).alias("kept"), (-F.col("view")).alias("view"), "windows", "slots"))
    return (views.groupBy("doc_id", "text_key", "item_id").agg(best.alias("best"))
            .withColumn("changed_slots", -F.col("best.kept"))
            .select("doc_id", "text_key", "item_id", "best.windows", "best.share", "best.slots", "changed_slots",
                    (F.col("changed_slots") > 0).alias("reparameterised")))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, item_id, windows, share, slots, changed_slots, reparameterised)`` per leak."""
    return _leaks(docs, benchmark, **options).drop("text_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates; all columns stay."""
    key, own = spare(docs, "key", "own")
    # rows with neither id nor text go with any contaminated row without id
    owns = F.when(F.col("doc_id").isNull(), F.array("text_key", F.lit(_NO_TEXT))).otherwise(F.array("text_key"))
    gone = _leaks(docs, benchmark, **options).select(F.col("doc_id").alias(key), F.explode(owns).alias(own)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (_text_key(F.col("doc_id"), F.col("text")) == F.col(own))
    return docs.join(gone, same, "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(read_documents(spark, sf_dir, "doc_id", "text"),
                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
