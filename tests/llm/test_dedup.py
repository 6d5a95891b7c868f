"""SimHash trie join and line de-duplication against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from factorlab.llm import components, linededup, simhash
from factorlab.llm.common import UNSPACED

SF = "/root/testdata/sf0.001"


def plain_print(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall("[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if sum(h >> j & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, bits):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= bits).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, "one", "A b\tC", "Éa b c d e f É", "x " * 40, "a b c d\n\x0be\x0cf\x85g"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_print(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select(F.xxhash64(F.lit("one two three four"))).first()[0]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three four", 42)


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = np.array([plain_print(r.text) for r in rows], np.uint64)
    roots = brute_components(prints, 4)
    least = defaultdict(lambda: 1 << 62)
    for r, root in zip(rows, roots):
        least[root] = min(least[root], r.doc_id)
    expected = {r.doc_id: (format(int(p), "016x"), least[root]) for r, p, root in zip(rows, prints, roots)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, SF).collect()}
    assert got == expected


@pytest.fixture(scope="module")
def cloud():
    """Random fingerprints with neighbours at 1 to 6 bits, and one dense ball."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 120, dtype=np.int64).astype(np.uint64)
    parts = [base]
    for k in range(1, 7):
        parts.append(base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (120, k)).astype(np.uint64), axis=1))
    parts.append(base[0] ^ rng.integers(0, 512, 300).astype(np.uint64))
    prints = np.unique(np.concatenate(parts))
    groups = defaultdict(set)
    for p, root in zip(prints.tolist(), brute_components(prints, 4)):
        groups[root].add(p)
    return prints, {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("options", [{}, {"segments": 6}, {"segments": 8, "max_leaves": 5}, {"max_leaves": 1}])
def test_trie_join(spark, cloud, options):
    prints, expected = cloud
    table = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(len(prints)), "fp": prints.view(np.int64)}))
    groups = defaultdict(set)
    for r in simhash.components(table, **options).collect():
        groups[r.root].add(r.fp & (1 << 64) - 1)
    assert {frozenset(g) for g in groups.values()} == expected


def test_forest_is_smaller_than_the_pairs(spark, cloud):
    prints, _ = cloud
    leaves = spark.createDataFrame(pd.DataFrame({"fp": prints.view(np.int64)}))
    edges = simhash.forest_edges(leaves, len(prints))
    assert edges.count() < 5 * len(prints)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (100, 101), (101, 100)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.connected_components(edges.limit(0)).count() == 0


def units(line):
    if not re.search(f"[{UNSPACED}]", line):
        return line.split(" ")
    return re.findall(f"[{UNSPACED}]|[^ {UNSPACED}]+", line)


def brute_lines(rows, least):
    lines = [((d is not None, d or 0, i), line.strip(" ")) for d, t in rows if t is not None
             for i, line in enumerate(t.split("\n")) if line.strip(" ")]

    def near(a, b):
        if a == b:
            return 0
        a, b = units(a), units(b)
        if min(len(a), len(b)) < least or abs(len(a) - len(b)) > 1:
            return None
        if len(a) == len(b):
            return 1 if sum(x != y for x, y in zip(a, b)) <= 1 else None
        a, b = max(a, b, key=len), min(a, b, key=len)
        return 1 if any(a[:k] + a[k + 1:] == b for k in range(len(a))) else None
    out = {}
    for place, words in lines:
        earlier = [(q, e) for q, other in lines if q < place and (e := near(words, other)) is not None]
        if earlier:
            out[place] = min(earlier)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_brute_force(spark, seed):
    random.seed(seed)
    rows = [(d, "\n".join(" ".join(random.choice("ab") for _ in range(random.randint(0, 6)))
                          for _ in range(random.randint(0, 5))) if d % 9 else None) for d in range(50)]
    rows += [(600 + d, "\n".join("".join(random.choice("中文 a") for _ in range(random.randint(1, 6))) for _ in range(4))) for d in range(25)]
    rows += [(None, "a b a b a"), (500, "  a b  a b \n\n"), (501, "page 1 of the long book\npage 2 of the long book\n the page 2 of the long book")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    flat = lambda d, n: (d is not None, d or 0, n)
    got = {flat(r.doc_id, r.line_no): (flat(r.kept_doc_id, r.kept_line_no), r.word_edits)
           for r in linededup.duplicate_lines(df, fuzzy_words=3).collect()}
    expected = brute_lines(rows, 3)
    assert got == expected
    kept = {r.doc_id: r.text for r in linededup.drop_lines(df, fuzzy_words=3).collect()}
    for d, text in rows:
        if text is not None:
            assert kept[d] == "\n".join(line for i, line in enumerate(text.split("\n")) if flat(d, i) not in expected)


def test_short_and_unspaced_lines_are_near(spark):
    """One word of seven, one word of five, one character of a line without spaces; two of five are too many."""
    pairs = [("the cat sat on the red mat", "the cat sat on the red hat", True), ("one two three four five", "one two three four six", True),
             ("今天天气非常好我们去公园", "今天天气非常好我们去花园", True), ("これは短い文です", "これは長い文です", True),
             ("ยินดีต้อนรับทุกคน", "ยินดีต้อนรับทุกคม", True), ("one two three four", "one two three six", False),
             ("aa bb cc dd ee", "aa bb cc xx yy", False)]
    for first, second, near in pairs:
        df = spark.createDataFrame([(1, first), (2, second)], "doc_id long, text string")
        assert (linededup.duplicate_lines(df).count() == 1) == near, first


def test_line_query_is_native(spark):
    df = linededup.query(spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = brute_lines(rows, linededup.FUZZY_WORDS)
    got = {(True, r.doc_id, r.line_no): ((True, r.kept_doc_id, r.kept_line_no), r.word_edits) for r in df.collect()}
    assert got == expected
