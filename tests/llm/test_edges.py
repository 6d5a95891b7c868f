"""Every operator on nulls, blank and long texts, ties, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from factorlab.llm import ann, chat, decontaminate, langid, linededup, packing, pii, quality, simhash, warc

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
ROWS = [(1, "a b c d e f g h i j", "en", "s1", 1), (1, "a b c d e f g h i j", "en", "s1", 1), (2, None, None, None, None),
        (3, "", "en", "s1", 0), (None, "a b c d e f g h i j", "en", None, 3), (None, None, None, None, None),
        (4, LONG, "en", "s2", 5), (5, " \n\t\n ", "de", "s2", 5), (6, "été ß 😀 \x00 x", "fr", "s2", 5)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = ["key", "keys", "rows", "own", "fp", "root", "component_id", "line", "line_no", "h1", "place", "n", "words", "class",
           "rank", "length", "start", "offset", "moves", "key_id", "host", "path", "keep", "hash", "at", "slots", "vector", "leaf", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def test_simhash(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    zero = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {2}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_simhash_without_ids(spark):
    df = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (None, "p q r s t u v")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_first(df).collect()) == ["p q r s t u v", "x y z"]


def test_line_dedup(docs, empty):
    out = linededup.drop_lines(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    got = {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()}
    # null doc_id sorts first and keeps its line; both rows of document 1 lose theirs
    assert (None, ROWS[0][1]) in got and (1, "") in got and (1, ROWS[0][1]) not in got
    assert (2, None) in got and (3, "") in got and (5, " \n\t\n ") in got
    assert linededup.drop_lines(empty).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (4, 1, 1), (None, 0, 1), (99, None, None), (6, 0, 0)], LABELS)
    out = quality.classify(docs, labels).collect()
    assert len(out) == len(ROWS) and all(r.keep is not None and 0 <= r.p_good <= 1 and 0 <= r.p_toxic <= 1 for r in out)
    none = quality.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(ROWS) and all(r.keep for r in none)
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert quality.classify(empty, labels).count() == 0


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (2, None), (3, ""), (None, "x y")], ITEMS)
    found = decontaminate.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (None, 1)} and len(found) == 2
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [2, 3, 4, 5, 6]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(empty, items).count() == 0


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    out = packing.pack_documents(docs, path).collect()
    assert sum(r.doc_tokens for r in out if r.start == 0 and r.doc_id in (2, 3, 5)) == 3
    filled = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    nothing = packing.pack_documents(empty, path)
    assert nothing.count() == 0 and "sequence_id" in nothing.columns


def test_language(docs, empty):
    contents = langid.fit(docs)
    out = langid.predict(docs, contents).collect()
    assert len(out) == len(ROWS)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in out if r.doc_id in (2, 3, 5))
    assert langid.fit(empty) == {} and langid.predict(empty, {}).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}


def test_pii(docs, empty):
    out = pii.pseudonymise(docs, b"k")
    assert set(out.columns) == {*docs.columns, "entities"} and out.count() == len(ROWS)
    assert pii.pseudonymise(empty, b"k").count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0


def test_chat(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversations(chat.chain(rows)).count() == 0


def test_neighbours(spark):
    rows = [(0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [2.0, 0.0], "x"), (3, None, "x"), (4, [0.0, 0.0], "x"),
            (5, [float("nan"), 1.0], "x"), (6, [float("inf"), 1.0], "x"), (7, [1.0, None], "x"), (8, [1.0, 2.0, 3.0], "x"), (None, [1.0, 1.0], "x"),
            (9, [], "x"), (50, [0.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector string")
    index, usable = ann.build(df)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in
           ann.search(index, usable.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0), (50, 3, 2, 0.0)]
    index, usable = ann.build(df.limit(0))
    assert ann.search(index, usable).count() == 0
