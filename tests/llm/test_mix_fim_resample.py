"""Fill-in-the-middle, mixing and importance resampling against brute force and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factorlab.llm import fim, mixing, resample
from factorlab.llm.common import globally_ranked, text_buffer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wörd{i % 997}" for i in range(30_000))
ROWS = [(1, "one two three", "en", "a", 1), (1, "one two three", "en", "a", 1), (1, "other text", "en", "a", 1), (2, None, None, None, None),
        (3, "", "en", "b", 0), (None, "no id here", "en", None, 3), (None, "no id here", "en", None, 3), (None, None, None, None, None),
        (4, LONG, "en", "c", 5), (5, " \n\t\n ", "de", "c", 5), (6, "été ß 😀 \x00 x <P> y", "fr", "c", 5), (7, "中文" * 5000, "zh", "d", 1)]
CLASHES = ["n", "form", "output", "_text", "_key", "size", "taken", "rank", "score", "weight", "src", "shard", "quota", "copies", "a.b", "_part"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES})


# ------------------------------------------------------------------ fill-in-the-middle

TEXTS = st.text(alphabet=st.sampled_from("abZ é😀中\n<PSM>"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_sparse_index_converts_both_ways(texts):
    data, offsets = text_buffer(pa.array(texts))
    joined = "".join(texts)
    index = fim.SparseIndex(data)
    bytes_of = np.array([len(joined[:i].encode()) for i in range(len(joined) + 1)])
    assert (index.byte_of(np.arange(len(joined) + 1)) == bytes_of).all()
    assert (index.char_of(bytes_of) == np.arange(len(joined) + 1)).all()
    assert len(index.bytes) == sum(c > "\x7f" for c in joined)
    begins = fim.token_starts(data, offsets)
    assert fim.unit_counts(begins, offsets).tolist() == [len(re.findall("[A-Za-z]+|[^A-Za-z]", t)) for t in texts]


def brute_fim(doc, text, unit):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text) if unit == "token" else list(text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["token", "char"])
def test_fim_equals_brute_force(spark, docs, unit):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab é😀中\n<P>") for _ in range(rng.randrange(80)))) for i in range(300)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    out = fim.fill_in_middle(table, unit=unit)
    got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) + len(ROWS)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_fim(r.doc_id, r.text, unit)
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fim_keeps_clashing_columns_and_empty_tables(docs):
    out = fim.fill_in_middle(docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    assert out.columns[len(docs.columns):] == ["n_", "form_", "prefix_chars", "middle_chars", "output_"]
    row = out.filter("doc_id = 4").first()
    assert row["n"] == "clash" and row["n_"] == len(re.findall("[A-Za-z]+|[^A-Za-z]", LONG))
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, unit="word")


# ------------------------------------------------------------------ mixing

def brute_seats(votes, seats):
    """Highest quotients, one after another; ties to the smaller unit."""
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(5)
    groups = [([53000, 24000, 23000], 7), ([1, 1, 1, 1], 6), ([10, 0, 5], 0), ([1000000.0, 1, 1, 1], 1), ([7], 5)]
    groups += [([rng.choice([rng.random(), 3, 1000 * rng.random()]) for _ in range(rng.randrange(1, 40))], rng.randrange(500)) for _ in range(12)]
    rows = [(g, i, float(v), s) for g, (votes, s) in enumerate(groups) for i, v in enumerate(votes)]
    got = defaultdict(dict)
    for r in mixing.apportion(spark.createDataFrame(rows, "grp int, unit long, votes double, seats long")).collect():
        got[r.grp][r.unit] = r.quota
    for g, (votes, seats) in enumerate(groups):
        positive = [v for v in votes if v > 0]
        assert list(dict(sorted(got[g].items())).values()) == brute_seats(positive, seats), (votes, seats)


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, repeat=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > repeat * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = repeat * sizes[s]
            left -= target[s]
            open_.remove(s)


def check_mix(rows, got, **kinds):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    targets = brute_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((r[0], size(r[1]), r[3]) for r in rows)
    taken, shards = Counter(), kinds.get("shards", 1)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert math.isclose(r.target, targets[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert sum(s.last - s.first for s in r.spans) == r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK_TOKENS * shards, s


def test_mix_on_odd_rows(docs):
    check_mix(ROWS, mixing.mix(docs).collect())
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = mixing.mix(docs.filter("text IS NULL OR trim(text) = ''")).collect()
    assert nothing and all(r.taken == 0 and r.target == 0 for r in nothing)


def test_mix_in_shards_reruns_agree(spark):
    rng = random.Random(9)
    rows = [(i if i % 7 else None, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(300))), "en",
             rng.choice(["hot", "hot", "b", "c", None]), 0) for i in range(600)]
    rows += [(None, "the same row " * 5, "en", "hot", 0)] * 200
    table = spark.createDataFrame(rows, SCHEMA)
    once = mixing.mix(table, shard_rows=40).collect()
    check_mix(rows, once, shards=12)
    again = mixing.mix(table.repartition(7), shard_rows=40).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.source or "", r.taken)
    assert sorted(map(key, once), key=str) == sorted(map(key, again), key=str)


def test_mixed_texts_hold_the_words_taken(docs, spark):
    rows = [(1, " a b\tc  d e ", "en", "s", 0), (2, "f g h i j k l m", "en", "t", 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    taken = {r.doc_id: r.taken for r in mixing.mix(table, block_tokens=1).collect()}
    words, texts = Counter(), defaultdict(list)
    for r in mixing.mixed_texts(table, block_tokens=1).collect():
        words[r.doc_id] += len(r.text.split())
        texts[r.doc_id].append(r.text)
        assert r.text in dict((d, t) for d, t, *_ in rows)[r.doc_id]
    assert dict(words) == {d: n for d, n in taken.items() if n}
    assert sum(r.taken for r in mixing.mix(docs).collect()) == sum(len(r.text.split(" ")) if r.doc_id == 4 else len(re.findall(
        r"[^\x20\x09-\x0D]+", r.text)) for r in mixing.mixed_texts(docs).collect())


def test_mix_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|MapInArrow|MapInPandas|ArrowEval", plan)


# ------------------------------------------------------------------ importance resampling

@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=700), st.lists(st.tuples(st.integers(0, 700), st.integers(0, 700)), min_size=1, max_size=20))
def test_position_table_crc(data, spans):
    starts, stops = np.array([[min(a, b, len(data)), min(max(a, b), len(data))] for a, b in spans]).T
    got = resample.crc32_spans(np.frombuffer(data, np.uint8), starts, stops)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, stops)]


def test_crc_of_very_long_spans():
    data = np.random.default_rng(1).integers(0, 256, 3_000_000).astype(np.uint8)
    starts, stops = np.array([0, 5, 64, 100]), np.array([3_000_000, 2_000_000, 64 + 64 * 64, 100 + 129])
    assert resample.crc32_spans(data, starts, stops).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, stops)]


def brute_features(text, ngrams):
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)], len(words)


@pytest.mark.parametrize("ngrams", [1, 3])
def test_scores_equal_brute_force(spark, docs, ngrams):
    rng = random.Random(2)
    pool = [f"word{i}" for i in range(60)] + ["Été", "中文", "A1"]
    more = [(100 + i, " ".join(rng.choices(pool, k=rng.randrange(60))), "en", "s", 0) for i in range(150)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, SCHEMA).select("doc_id", "text"))
    target = spark.createDataFrame([(1, "word1 word2 Été word3 word1"), (2, None)], "item_id long, text string")
    got = resample.scores(table, target, ngrams=ngrams).collect()

    found = [(d, *brute_features(t, ngrams)) for d, t, *_ in ROWS + more]
    s = Counter(b for _, f, _ in found for b in f)
    t = Counter(brute_features("word1 word2 Été word3 word1", ngrams)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in s}
    rows = []
    for d, f, words in found:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((d, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(rows)
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = [(r[0], r[4]) for r in able[:len(able) * 10 // 100]]
    assert [(r.doc_id, r.score) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == ranks
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(ranks) + 1))


def test_drawn_rows_keep_their_columns(spark, docs):
    target = spark.createDataFrame([("wörd1 wörd2",)], "text string")
    out = resample.drawn(docs, target, min_words=1, percent=30)
    assert out.columns == docs.columns and out.count() >= 1
    assert resample.drawn(docs.limit(0), target).count() == 0
    assert resample.scores(docs, target.limit(0)).count() == len(ROWS)
    assert {r["rank"] for r in resample.scores(docs.filter("text IS NULL"), target).collect()} == {None}


def test_global_ranks_with_equal_rows(spark):
    table = spark.createDataFrame([(i % 3, 1) for i in range(500)], "a int, _part int")
    rows = globally_ranked(table.repartition(5), "rank", F.col("a").desc(), F.monotonically_increasing_id()).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 501))
    assert [r.a for r in sorted(rows, key=lambda r: r["rank"])] == sorted((i % 3 for i in range(500)), reverse=True)
