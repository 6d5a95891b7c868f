"""Personal data: detection and keyed surrogates (operator 7).

1. Detection, over whole texts: e-mail, phone, card (Luhn), IBAN, SSN, IP addresses, access keys,
   passwords and tokens, and person names (title or known given name before a capitalised word; their
   surname or given name alone in the same text is the same person).
2. A surrogate is a function of a secret key, the type and the canonical form, so a mention in any
   spelling, in any document, gets the same one. It keeps type and format: separators, lengths, country codes,
   card checksums, IBAN check digits, private or public address range, letter case; names keep gender and script.
3. Collision check, over the distinct entities of the whole corpus: if two entities of a type have the
   same surrogate, or a surrogate is itself an entity of the corpus, all but the smallest owner move to
   their next attempt, until none collides; a crowded format widens, names grow, and what still collides after
   ``LEAVE`` attempts gets a keyed surrogate outside its format. Only these few exceptions have to reach the texts: as a
   broadcast table up to ``BROADCAST_ROWS``, beyond it by a join on the documents that mention them.
4. Texts are rewritten in one pass without a shuffle of the texts.

Defined cases: null text stays null, with no entities; an empty text stays empty; repeated rows are
rewritten alike; rows without doc_id too, told apart by their texts where exceptions are joined. All other columns stay; a
column named ``entities`` is replaced. A mask (``password: ******``) is no secret and stays;
so do ``::1`` and ``::``, which name no host.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import string
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from factorlab.llm.common import own_columns, read_documents, slices, spare, written

BROADCAST_ROWS = 100_000
#: Attempts within a format's own range before it widens, and after which a surrogate leaves its format: a
#: corpus can hold more entities of a type than the format has room for, and all of them must stay distinct.
WIDEN, LEAVE = 4, 50
#: How a surrogate outside its format begins.
FREE = "surrogate-"
ALPHANUMERIC = string.ascii_letters + string.digits

# Titles with their gender, and common given names with theirs.
TITLES = {"mr": "m", "mrs": "f", "ms": "f", "miss": "f", "sir": "m", "madam": "f", "lady": "f", "lord": "m", "dr": "",
          "prof": "", "herr": "m", "frau": "f", "monsieur": "m", "madame": "f", "mademoiselle": "f", "señor": "m",
          "señora": "f", "señorita": "f", "don": "m", "doña": "f", "господин": "m", "госпожа": "f"}
MALE = """James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony
Mark Steven Paul Andrew George Kevin Brian Edward Peter Frank Henry Hans Klaus Jürgen Wolfgang Stefan Pierre Jean
Jacques Michel Luc Carlos José Juan Luis Miguel Pedro Иван Сергей Алексей Дмитрий Николай""".split()
FEMALE = """Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Betty Margaret Sandra
Ashley Emily Donna Michelle Carol Amanda Anna Laura Julia Emma Alice Ursula Monika Sabine Petra Heike Marie Sophie
Camille Claire Isabelle María Carmen Ana Lucía Elena Анна Мария Елена Ольга Наталья""".split()
GENDER = {n.lower(): "m" for n in MALE} | {n.lower(): "f" for n in FEMALE}
#: Syllables of surrogate names by script, and endings by gender.
SYLLABLES = {"latin": "ba be bo da de di fa fe ga go ka ke ki la le lo ma me mi na ne no ra re ri sa se so ta te to va ve vi".split(),
             "cyrillic": "ба бе бо да де ди фа фе га го ка ке ки ла ле ло ма ме ми на не но ра ре ри са се со та те то ва ве ви".split()}
ENDINGS = {"latin": {"m": ["n", "s", "rd"], "f": ["lia", "na", "ra"], "": ["l", "m", "t"]},
           "cyrillic": {"m": ["н", "р", "д"], "f": ["лия", "на", "ра"], "": ["л", "м", "т"]}}

# Each kind is found by a scan that starts at a rare character, then matched in detail there.
_EMAIL = re.compile(r"[\w.+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_MARK = re.compile(r"[:=]")
_SECRET_NAME = re.compile(r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}$")
_SECRET_VALUE = re.compile(r"\s{0,3}[\"']?([^\s\"',;]{6,})")
#: One symbol repeated stands for a secret that is not there.
_MASK = re.compile(r"([\W_])\1*")
_KEYS = [re.compile(k) for k in (r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])", r"ASIA[A-Z0-9]{16}(?![A-Za-z0-9])",
                                 r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", r"sk-[A-Za-z0-9]{20,}")]
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IPV6 = re.compile(r"[0-9A-Fa-f]{1,4}:(?:[0-9A-Fa-f]{1,4}:){6}[0-9A-Fa-f]{1,4}(?![\w:])")
_IPV6_SHORT = re.compile(r"""(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?
                             (?:(?<=\d)(?:\.\d{1,3}){3})?(?!\w|\.\d|:[:0-9A-Fa-f])""", re.VERBOSE)
#: Ranges in use; the same spelling elsewhere is code (``a::b``).
_IPV6_RANGES = [ipaddress.ip_network(n) for n in ("2000::/3", "64:ff9b::/96", "fc00::/7", "fe80::/10", "ff00::/8")]
#: Digits with their separators; what they are is decided by the next pattern.
_RUN = re.compile(r"[+(0-9][0-9()+ .-]{6,}")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NUMERIC = re.compile(rf"""
  (?P<ipv4>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))
 |(?P<card>(?<![\w-])(?:\d{{13,19}}|\d{{4}}(?P<gap>[ -])\d{{4}}(?P=gap)\d{{4}}(?P=gap)\d{{1,7}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}})(?![\w-]))
 |(?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
 |(?P<phone>(?<![\w+.])(?!\d{{4}}-\d\d-\d\d)(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{2,4}}[ .-]?\d{{2,4}}(?:[ .-]?\d{{2,4}})?(?!\w))
 |(?P<intl>(?<![\w+.])\+\d{{9,15}}(?!\w))
""", re.VERBOSE)
_CAPITAL = "A-ZÀ-ÖØ-ÞЀ-Я"
_CAPITALISED = re.compile(rf"[{_CAPITAL}][^\W\d_]*\.?(?: [{_CAPITAL}][^\W\d_]*(?:[-'’][{_CAPITAL}][^\W\d_]+)*)+")
_LOWER_TITLE = re.compile(rf"госп(?:один|ожа)(?: [{_CAPITAL}][^\W\d_]+)+")


def luhn(digits: str) -> bool:
    numbers = [int(d) for d in reversed(digits)]
    return (sum(numbers[0::2]) + sum(sum(divmod(2 * d, 10)) for d in numbers[1::2])) % 10 == 0


def _iban_sum(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _ipv6(raw: str) -> str | None:
    """One spelling per address; None if it is none, or compressed and in no range in use."""
    try:
        address = ipaddress.IPv6Address(raw)
    except ValueError:
        return None
    return str(address) if "::" not in raw or any(address in n for n in _IPV6_RANGES) else None


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, stop, type, canonical)`` of every mention, in order, without overlaps.

    Types of names carry gender and script: ``given:f:latin``, ``surname::latin``.
    """
    found, surnames, givens, people = [], {}, {}, []
    if "@" in text:
        found += [(*m.span(), "email", m.group().lower()) for m in _EMAIL.finditer(text)]
    for mark in _MARK.finditer(text):
        at = mark.start()
        if _SECRET_NAME.search(text, max(0, at - 16), at) and (m := _SECRET_VALUE.match(text, at + 1)):
            if not _MASK.fullmatch(m[1]):
                found.append((*m.span(1), "secret", m[1]))
    for pattern in _KEYS:
        found += [(*m.span(), "key", m.group()) for m in pattern.finditer(text)
                  if not m.start() or not text[m.start() - 1].isalnum()]
    for m in _IBAN.finditer(text):
        plain = m.group().replace(" ", "")
        if 15 <= len(plain) <= 34 and plain.isascii() and _iban_sum(plain) == 1:
            found.append((*m.span(), "iban", plain))
    if text.count(":") >= 7:
        found += [(*m.span(), "ipv6", _ipv6(m.group())) for m in _IPV6.finditer(text)
                  if not m.start() or not (text[m.start() - 1].isalnum() or text[m.start() - 1] == ":")]
    if "::" in text:
        found += [(*m.span(), "ipv6", plain) for m in _IPV6_SHORT.finditer(text) if (plain := _ipv6(m.group()))]
    for run in _RUN.finditer(text):
        for m in _NUMERIC.finditer(text, run.start(), min(len(text), run.end() + 2)):
            raw = m.group()
            digits = "".join(filter(str.isdecimal, raw))
            if not raw.isascii():
                continue
            if m["card"]:
                if luhn(digits):
                    found.append((*m.span(), "card", digits))
            elif m["phone"] or m["intl"]:
                if 9 <= len(digits) <= 15 and (raw[0] in "+(" or len(digits) >= 10):
                    found.append((*m.span(), "phone", digits[1:] if len(digits) == 11 and digits[0] == "1" else digits))
            else:
                found.append((*m.span(), "ipv4" if m["ipv4"] else "ssn", raw))
    chains = list(_CAPITALISED.finditer(text))
    if "госп" in text:
        chains += _LOWER_TITLE.finditer(text)
    for chain in chains:
        words, at = chain.group().split(" "), chain.start()
        low = [w.lower().rstrip(".") for w in words]
        i = 0
        while i < len(words):
            titled = low[i] in TITLES and i + 1 < len(words)
            g = i + titled   # place of the given name, if there is one
            named = g + 1 < len(words) and low[g] in GENDER and not words[g].endswith(".")
            if titled or named:
                gender = (GENDER[low[g]] if named else "") or (TITLES[low[i]] if titled else "")
                start = at + sum(len(w) + 1 for w in words[:g])
                if named:
                    givens[words[g]] = givens[words[g].upper()] = (f"given:{gender}:{_script(words[g])}", low[g])
                    people.append((start, start + len(words[g]), *givens[words[g]]))
                    start += len(words[g]) + 1
                sur = words[g + named]
                surnames[sur] = surnames[sur.upper()] = (f"surname::{_script(sur)}", sur.lower())
                people.append((start, start + len(sur), *surnames[sur]))
                i = g + named
            i += 1
    if surnames:   # other mentions of a surname or given name alone
        taken = {p[0] for p in people}
        alone = givens | surnames
        again = re.compile(r"\b(?:%s)\b" % "|".join(map(re.escape, sorted(alone, key=lambda s: (-len(s), s)))))
        people += [(*m.span(), *alone[m.group()]) for m in again.finditer(text) if m.start() not in taken]
    order = {k: i for i, k in enumerate(("secret", "key", "email", "iban", "ipv6", "ipv4", "card", "ssn", "phone"))}
    spans, end = [], 0
    for span in sorted(found + people, key=lambda s: (s[0], order.get(s[2], 9), -s[1])):
        if span[0] >= end:
            spans.append(span)
            end = span[1]
    return spans


# ------------------------------------------------------------------ surrogates

class Stream:
    """Keyed pseudo-random numbers of one entity and attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hashlib.blake2b(f"{kind}\0{canonical}\0{attempt}".encode("utf-8", "surrogatepass"), key=key[:64]).digest()
        self.value = int.from_bytes(self.seed)
        self.left = 1 << 512

    def below(self, n: int) -> int:
        if self.left < n << 64:
            self.seed = hashlib.blake2b(self.seed).digest()
            self.value, self.left = int.from_bytes(self.seed), 1 << 512
        self.value, digit = divmod(self.value, n)
        self.left //= n
        return digit

    def pick(self, items):
        return items[self.below(len(items))]


@lru_cache(4096)
def _neighbours(c: str) -> str:
    """The letters around a letter outside ASCII: same block of 64 code points and same category."""
    block = map(chr, range(ord(c) & ~63, (ord(c) | 63) + 1))
    return "".join(n for n in block if not n.isascii() and unicodedata.category(n) == unicodedata.category(c))


def _alike(c: str, draw: Stream) -> str:
    """A character of the same class; hexadecimal letters stay hexadecimal."""
    if c.isdigit():
        return draw.pick("0123456789")
    if c in "abcdef":
        return draw.pick("abcdef")
    if c.isascii() and c.isalpha():
        return draw.pick("abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    if c.isalpha():
        return draw.pick(_neighbours(c))
    return c


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """Canonical form of the surrogate of an entity."""
    draw = Stream(key, kind, canonical, attempt)
    if kind.startswith(("given:", "surname:")):   # crowded names get longer
        _, gender, script = kind.split(":")
        count = 4 + max(0, attempt - WIDEN + 1)
        return "".join(draw.pick(SYLLABLES[script]) for _ in range(count)) + draw.pick(ENDINGS[script][gender])
    if attempt >= LEAVE:
        return f"{FREE}{kind}-" + "".join(draw.pick("0123456789abcdef") for _ in range(32))
    if kind == "email":
        local, _, domain = canonical.partition("@")
        tail = "".join(draw.pick("0123456789") for c in local if c.isdigit())
        site = Stream(key, "domain", domain, attempt)   # one surrogate per domain
        labels = ["".join(site.pick(SYLLABLES["latin"]) for _ in range(4)) for _ in domain.split(".")[:-1]]
        return "".join(draw.pick(SYLLABLES["latin"]) for _ in range(5)) + tail + "@" + ".".join([*labels, "example"])
    if kind == "card":
        body = canonical[0] + "".join(draw.pick("0123456789") for _ in canonical[1:-1])
        return body + next(d for d in "0123456789" if luhn(body + d))
    if kind == "iban":
        body = "".join(draw.pick("0123456789") if c.isdigit() else draw.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in canonical[4:])
        return canonical[:2] + f"{98 - _iban_sum(canonical[:2] + '00' + body):02d}" + body
    if kind == "phone":
        places = (0, 3) if len(canonical) == 10 else (0,)
        return "".join(draw.pick("23456789") if i in places else draw.pick("0123456789") for i in range(len(canonical)))
    if kind == "ssn":   # the 900 range is never issued; crowded ranges widen after some attempts
        if attempt >= WIDEN:
            return f"{draw.below(1000):03d}-{draw.below(100):02d}-{draw.below(10000):04d}"
        return f"9{draw.below(100):02d}-{1 + draw.below(99):02d}-{1 + draw.below(9999):04d}"
    if kind == "ipv4":
        a, b = map(int, canonical.split(".")[:2])
        private = {10: 1, 127: 1}.get(a) or (2 if (a, b) == (192, 168) or a == 172 and 16 <= b < 32 else 0)
        kept = canonical.split(".")[:private]
        if attempt >= WIDEN:   # a crowded range: reserved addresses
            kept = [str(240 + draw.below(16))]
        elif not kept:
            kept = [str(draw.pick([n for n in range(11, 224) if n not in (127, 169, 172, 192, 198)]))]
        return ".".join([*kept, *(str(draw.below(256)) for _ in range(4 - len(kept)))])
    if kind == "ipv6":
        return ":".join(["2001", "db8", *("%x" % (1 + draw.below(65535)) for _ in range(6))])
    if kind == "key":
        head = re.match(r"AKIA|ASIA|gh._|sk-", canonical).group()
        return head + "".join(_alike(c, draw) if not c.isupper() else draw.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in canonical[len(head):])
    # symbols alone, or a crowded pattern: any letters and digits
    if attempt >= WIDEN or not any(map(str.isalnum, canonical)):
        return "".join(draw.pick(ALPHANUMERIC) for _ in canonical)
    return "".join(_alike(c, draw) for c in canonical)


def render(kind: str, raw: str, plain: str) -> str:
    """The surrogate in the spelling of the mention."""
    if plain.startswith(FREE):
        return plain
    if kind in ("card", "phone"):
        digits = [i for i, c in enumerate(raw) if c.isdigit()]
        out = list(raw)
        for i, d in zip(reversed(digits), reversed(plain)):   # a country code before them stays
            out[i] = d
        return "".join(out)
    if kind == "iban":
        rest = iter(plain)
        return "".join(c if c == " " else next(rest) for c in raw)
    if kind == "email":
        return plain.upper() if raw.isupper() else plain
    if kind == "ipv6":
        return plain.upper() if raw.upper() == raw and raw.lower() != raw else plain
    if kind.startswith(("given:", "surname:")):
        return plain.upper() if raw.isupper() else plain.capitalize()
    return plain


def rewrite(text: str, key: bytes, attempts: dict, memo: dict) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and ``(type, start, stop)`` in the new text."""
    parts, spans, at, size = [], [], 0, 0
    for start, stop, kind, canonical in detect(text):
        entity = (kind, canonical)
        if entity not in memo:
            if len(memo) > 200_000:
                memo.clear()
            memo[entity] = surrogate(key, kind, canonical, attempts.get(entity, 0))
        new = render(kind, text[start:stop], memo[entity])
        parts += [text[at:start], new]
        size += start - at
        spans.append((kind.partition(":")[0], size, size + len(new)))
        size, at = size + len(new), stop
    return "".join([*parts, text[at:]]), spans


# ------------------------------------------------------------------ Spark plan

def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, kind, canonical)``, distinct within a document."""
    def run(batches):
        for part in slices(batches):
            rows = [(doc, own, kind, canonical) for doc, text, own in zip(*(c.to_pylist() for c in part.columns)) if text
                    for kind, canonical in sorted({s[2:] for s in detect(text)})]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])],
                                             ["doc_id", "text_key", "kind", "canonical"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         _text_key(F.col(id_col), F.col(text_col)))
    return source.mapInArrow(run, "doc_id long, text_key string, kind string, canonical string")


def _text_key(doc_id: Column, text: Column) -> Column:
    """Tells rows without doc_id apart by their text; empty for all others."""
    return F.when(doc_id.isNull(), F.sha2(text.cast("string"), 256)).otherwise("").alias("text_key")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, canonical, attempt, surrogate)`` for distinct ``entities(kind, canonical)``, without collisions."""
    def run(batches):
        for batch in batches:
            kinds, canon, tries = (batch.column(c) for c in ("kind", "canonical", "attempt"))
            made = [surrogate(key, k, c, t) for k, c, t in zip(kinds.to_pylist(), canon.to_pylist(), tries.to_pylist())]
            yield pa.RecordBatch.from_arrays([kinds, canon, tries, pa.array(made, pa.string())],
                                             ["kind", "canonical", "attempt", "surrogate"])

    schema = "kind string, canonical string, attempt int, surrogate string"
    table = written(entities.withColumn("attempt", F.lit(0)).mapInArrow(run, schema), "surrogates")
    # names of one kind family must differ whatever gender or script was seen
    family = F.substring_index("kind", ":", 1)
    originals = written(entities.select(family.alias("family"), F.col("canonical").alias("surrogate")).distinct(), "originals")
    while True:   # ends: names grow, other types leave their format after ``LEAVE`` attempts
        owned = table.withColumn("family", family)
        owners = (owned.groupBy("family", "surrogate").agg(F.count("*").alias("n"), F.min(F.struct("canonical", "kind")).alias("owner"))
                  .join(originals.withColumn("real", F.lit(True)), ["family", "surrogate"], "left")
                  .filter("n > 1 OR real").select("family", "surrogate", "owner", F.coalesce("real", F.lit(False)).alias("real")))
        clashes = written(owned.join(owners, ["family", "surrogate"])
                          .filter(F.col("real") | (F.struct("canonical", "kind") != F.col("owner")))
                          .select("kind", "canonical", (F.col("attempt") + 1).alias("attempt")), "clashes")
        if clashes.isEmpty():
            return table
        moved = clashes.mapInArrow(run, schema)
        table = written(table.join(clashes.select("kind", "canonical"), ["kind", "canonical"], "left_anti").unionByName(moved), "surrogates")


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text",
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with surrogates in the text, and ``entities`` (type, start, stop in the new text)."""
    found = written(mentions(docs, id_col, text_col), "mentions")
    table = assign(found.select("kind", "canonical").distinct(), key)
    moved = written(table.filter("attempt > 0").select("kind", "canonical", "attempt"), "exceptions")
    few = moved.count() <= broadcast_rows
    everywhere = {(r["kind"], r["canonical"]): r["attempt"] for r in moved.collect()} if few else {}
    key_id, key_text, moves = spare(docs, "key_id", "key_text", "moves")
    kept = [(f, c) for f, c in zip(docs.schema.fields, own_columns(docs)) if f.name not in (text_col, "entities")]
    names = [f.name for f, _ in kept]
    source = docs
    if few:
        source = source.withColumn(moves, F.lit(None).cast("array<struct<kind:string,canonical:string,attempt:int>>"))
    else:
        # a list holds what one id (or, without one, one text) mentions
        by_doc = (found.join(moved, ["kind", "canonical"]).groupBy(F.col("doc_id").alias(key_id), F.col("text_key").alias(key_text))
                  .agg(F.collect_set(F.struct("kind", "canonical", "attempt")).alias(moves)))
        source = source.join(by_doc, F.col(id_col).cast("long").eqNullSafe(F.col(key_id))
                             & (_text_key(F.col(id_col), F.col(text_col)) == F.col(key_text)), "left")
    # plain names inside the Arrow pass: the caller's may hold dots
    plain = [f"c{i}" for i in range(len(names))]
    source = source.select(*[c.alias(n) for n, (_, c) in zip(plain, kept)],
                           F.col(text_col).cast("string").alias("new_text"), F.col(moves).alias("moves"))

    def run(batches):
        memo = {}
        for part in slices(batches):
            texts, spans = [], []
            for text, own in zip(part.column(len(names)).to_pylist(), part.column(len(names) + 1).to_pylist()):
                if text is None:
                    texts.append(None)
                    spans.append([])
                    continue
                local = {(m["kind"], m["canonical"]): m["attempt"] for m in own} if own else None
                new, where = rewrite(text, key, local or everywhere, {} if local else memo)
                texts.append(new)
                spans.append([{"type": t, "start": a, "stop": b} for t, a, b in where])
            kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
            keep = [part.column(c) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string()), pa.array(spans, kind)],
                                             [*plain, "new_text", "entities"])

    spans = ArrayType(StructType([StructField("type", StringType()), StructField("start", IntegerType()), StructField("stop", IntegerType())]))
    schema = StructType([*(StructField(n, f.dataType) for n, (f, _) in zip(plain, kept)),
                         StructField("new_text", StringType()), StructField("entities", spans)])
    return source.mapInArrow(run, schema).toDF(*names, text_col, "entities")


#: Key of the registered query; a real run passes its own secret.
DEMO_KEY = b"surrogate key of the registered query"


def query(spark, sf_dir: str) -> DataFrame:
    done = pseudonymise(read_documents(spark, sf_dir, "doc_id", "text"), DEMO_KEY)
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")
