"""Fill-in-the-middle transformation with a sparse exception index (operator 11).

A text is worked on as UTF-8 bytes. ``SparseIndex`` records only its multibyte characters: their positions and the
bytes they have beyond one. A binary search there converts a byte position into a code-point position or back; where all
characters are ASCII both are the same number, so an ASCII text has an empty index. Texts of an Arrow slice share one
buffer and one index.

Two keyed draws cut a text of n units (tokens ``[A-Za-z]+|[^A-Za-z]`` or code points) into prefix, middle and suffix;
a third keeps part of the texts as they are (``plain``), a fourth chooses between ``<P>prefix<S>suffix<M>middle``
(``psm``) and ``<S>suffix<P>prefix<M>middle`` (``spm``). Empty texts and texts that hold a mark stay plain, so
``restored`` rebuilds every text from output and form alone.

Defined cases: null text is an empty text; a null id draws like an empty id, so rows without id that have the
same text are cut alike, as are repeated rows; a very long text is cut whole, its unit positions are searched blockwise;
an empty table gives an empty result; other columns are kept, and if one has the name of a result column, the result
column gets an underscore (it is always among the last five).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorlab.llm.common import byte_slices, own_columns, read_documents, spare, text_buffer

#: Fixed marks of the output format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percentages of texts that are transformed, and of those the share in the order suffix, prefix, middle.
FIM_PERCENT, SPM_PERCENT = 90, 20
SEED = "1"
#: Text bytes handled in one step, and bytes searched at once for a unit's position.
STEP_BYTES, BLOCK = 4 << 20, 1 << 14

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


class SparseIndex:
    """Byte and code-point positions in a UTF-8 buffer, from its multibyte characters only."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.flatnonzero(data >= 0xC0)   # first bytes of multibyte characters
        first = data[self.bytes]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.excess = np.r_[0, np.cumsum(excess)]
        self.chars = self.bytes - self.excess[:-1]

    def char_of(self, byte: np.ndarray) -> np.ndarray:
        return byte - self.excess[np.searchsorted(self.bytes, byte)]

    def byte_of(self, char: np.ndarray) -> np.ndarray:
        return char + self.excess[np.searchsorted(self.chars, char)]


def token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mask of the bytes at which a token ``[A-Za-z]+|[^A-Za-z]`` begins; texts don't run into each other."""
    letter = _LETTER[data]
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return begins


def positions(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Position of the set entry number ``ranks`` (ascending, from 0) of ``mask``, found block by block."""
    if not len(ranks):
        return np.zeros(0, np.int64)
    before = np.r_[0, np.cumsum(np.add.reduceat(mask, np.arange(0, len(mask), BLOCK), dtype=np.int64))]
    block = np.searchsorted(before, ranks, side="right") - 1
    out = np.empty(len(ranks), np.int64)
    cuts = np.flatnonzero(np.diff(block)) + 1
    for part in np.split(np.arange(len(ranks)), cuts):
        at = int(block[part[0]])
        inside = np.flatnonzero(mask[at * BLOCK:(at + 1) * BLOCK])
        out[part] = at * BLOCK + inside[ranks[part] - before[at]]
    return out


def unit_counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Set entries of ``mask`` in every text."""
    counts = np.zeros(len(offsets) - 1, np.int64)
    filled = offsets[:-1] < offsets[1:]
    if filled.any():
        counts[filled] = np.add.reduceat(mask, offsets[:-1][filled], dtype=np.int64)
    return counts


def draws(seed: str, keys: list[str | None]) -> np.ndarray:
    """Four unsigned 32-bit draws of every key: the first digits of a SHA-256."""
    digests = b"".join(hashlib.sha256(f"{seed}:{k or ''}".encode()).digest()[:16] for k in keys)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def transform(texts: pa.Array, keys: list[str | None], unit: str = "token", seed: str = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of an Arrow string array of texts."""
    data, offsets = text_buffer(texts)
    index, h = SparseIndex(data), draws(seed, keys)
    starts, stops = offsets[:-1], offsets[1:]
    if unit == "token":
        begins = token_starts(data, offsets)
        n = unit_counts(begins, offsets)
    else:
        n = index.char_of(stops) - index.char_of(starts)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    if unit == "token":
        places = np.repeat(stops, 2).reshape(-1, 2)
        inside = cuts < n[:, None]
        places[inside] = positions(begins, (cuts + (np.cumsum(n) - n)[:, None])[inside])
    else:
        places = index.byte_of(index.char_of(starts)[:, None] + cuts)
    first, second = places[:, 0], places[:, 1]
    prefix_chars = index.char_of(first) - index.char_of(starts)
    middle_chars = index.char_of(second) - index.char_of(first)

    raw = data.tobytes()
    forms, outputs = [], []
    wish = np.where(h[:, 2] % 100 >= fim_percent, "plain", np.where(h[:, 3] % 100 < spm_percent, "spm", "psm"))
    for form, a, p, m, z in zip(wish.tolist(), starts.tolist(), first.tolist(), second.tolist(), stops.tolist()):
        text = raw[a:z]
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
            form = "plain"
        forms.append(form)
        if form == "psm":
            outputs.append(b"".join((PREFIX, raw[a:p], SUFFIX, raw[m:z], MIDDLE, raw[p:m])))
        elif form == "spm":
            outputs.append(b"".join((SUFFIX, raw[m:z], PREFIX, raw[a:p], MIDDLE, raw[p:m])))
        else:
            outputs.append(text)
    form = pa.array(forms, pa.string())
    plain = np.array([f == "plain" for f in forms], bool)
    return [pa.array(n), form, pa.array(prefix_chars, mask=plain), pa.array(middle_chars, mask=plain),
            pa.array(outputs, pa.large_binary()).view(pa.large_string()).cast(pa.string())]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "token",
                   seed: str = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with ``n, form, prefix_chars, middle_chars, output``: units, form, lengths in code points, new text.

    ``unit`` is ``token`` or ``char``. No row moves between partitions.
    """
    if unit not in ("token", "char"):
        raise ValueError(f"unit must be token or char, not {unit!r}")
    names = spare(docs, "n", "form", "prefix_chars", "middle_chars", "output")
    width = len(docs.columns)
    plain = [f"c{i}" for i in range(width + 5)]   # mapInArrow takes no names with dots

    def run(batches):
        for part in byte_slices(batches, width, STEP_BYTES):
            made = transform(part.column(width), part.column(width + 1).to_pylist(), unit, seed, fim_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([*part.columns[:width], *made], plain)

    kinds = [f.dataType for f in docs.schema.fields] + [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(plain, kinds)])
    quote = lambda c: F.col("`" + c.replace("`", "``") + "`").cast("string")
    source = docs.select(*own_columns(docs), quote(text_col), quote(id_col)).toDF(*plain[:width], "text", "key")
    return source.mapInArrow(run, schema).toDF(*docs.columns, *names)


def restored(output: Column, form: Column) -> Column:
    """The original text, from output and form only: a transformed output holds each mark once."""
    pieces = F.split(output, "<[PSM]>", -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    text = output
    for name, places in order.items():
        text = F.when(form == name, F.concat(*[F.get(pieces, F.lit(i)) for i in places])).otherwise(text)
    return text


def query(spark, sf_dir: str) -> DataFrame:
    done = fill_in_middle(read_documents(spark, sf_dir, "doc_id", "text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS toks,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
v AS (
  SELECT doc_id, text, toks, len(toks) AS n,
    least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS a, greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
         THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(list_slice(toks, 1, a), ''), '') AS p,
    coalesce(array_to_string(list_slice(toks, a + 1, b), ''), '') AS m,
    coalesce(array_to_string(list_slice(toks, b + 1, n), ''), '') AS s FROM v)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM w
"""
