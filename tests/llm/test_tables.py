"""Conversations, nearest neighbours, archives, the pipeline and the registration."""

import hashlib
import io
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from factorlab.llm import ann, chat, linededup, queries, warc

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ conversations

NASTY = ["\\", "\\\\", "#", "##", "###", "####", "#\\#\\", "</turn>", " </turn>\n### assistant: x", "<\\/", "</", "\\c", ":", ": a",
         "é\n\n", "", None, "\\#", "#\\", "<\\\\/", "😀## </" * 3]


def plain_chat(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda r: [(v is not None, v if v is not None else 0) for v in r[1:]])
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations_round_trip(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)]
    frame = chat.query(spark, SF)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}
    assert got == plain_chat(rows)


def test_odd_turns_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "us:er ### </turn>\\", t) for i, t in enumerate(NASTY)]
    rows += [(2, None, None, "a"), (2, None, None, "a"), (None, 1, "user", "q"), (None, 1, "assistant", "r"), (3, 5, "assistant", "x" * 70_000)]
    rows += [(4, i, "assistant", f"t{i}") for i in range(200)]
    frame = chat.read_back(chat.conversations(chat.chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().toString())
    expected = plain_chat(rows)
    got = {}
    for r in frame.collect():
        told = "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        got[r.tree_id] = (len(r.turns), hashlib.sha256(told.encode()).hexdigest(), len(r.loss_text), hashlib.sha256(r.loss_text.encode()).hexdigest())
        assert r.formatted.count("### ") == r.formatted.count(" </turn>\n") == r.n_turns
    assert got == expected


def test_best_branches(spark):
    random.seed(1)
    messages = [(t, i, None if i == 0 else random.randrange(i) if i != 14 else 999, "user", f"m{i}", random.random()) for t in range(4) for i in range(25)]
    frame = spark.createDataFrame([*messages, (9, 1, 2, "u", "a", 1.0), (9, 2, 1, "u", "b", 1.0), (8, 3, 3, "u", "self", 1.0)],
                                  "tree_id long, msg_id long, parent_id long, role string, text string, score double")
    got = {(r.tree_id, r.leaf_id): (r.path_rank, [t.text for t in r.turns]) for r in chat.read_back(chat.conversations(frame, 3)).collect()}
    expected = {(8, 3): (1, ["self"])}
    for t in range(4):
        parents = {m[1]: m[2] for m in messages if m[0] == t}
        score = {m[1]: m[5] for m in messages if m[0] == t}
        leaves = []
        for leaf in set(parents) - set(parents.values()):
            path, at = [], leaf
            while at in parents:
                path.append(at)
                at = parents[at]
            leaves.append((-sum(score[i] for i in path) / len(path), -len(path), leaf, [f"m{i}" for i in reversed(path)]))
        expected |= {(t, leaf): (n + 1, texts) for n, (_, _, leaf, texts) in enumerate(sorted(leaves)[:3])}
    assert got == expected


# ------------------------------------------------------------------ neighbours

def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    index, rows = ann.build(spark.read.parquet(f"{sf}/embeddings.parquet"), leaf_rows=64)
    assert index.tree.leaves > 8
    table = rows.toPandas()
    ids, vectors = table.vec_id.to_numpy(), np.array(table.vector.tolist())
    near = ann.unit(vectors)
    got = defaultdict(list)
    for r in ann.search(index, rows.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        scores = near @ near[i]
        scores[i] = -2
        best = np.sort(scores)[::-1][:5]
        found = got[ids[i]]
        assert len(found) == 5 and ids[i] not in {v for v, _ in found}
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        for v, s in found:
            assert s == pytest.approx(scores[np.flatnonzero(ids == v)[0]], abs=1e-12)
        hits += sum(s >= best[-1] - 1e-12 for _, s in found)
    assert hits / (5 * len(got)) >= 0.9


def test_equal_vectors_and_blocks(spark):
    rng = np.random.default_rng(3)
    vectors = [[1.0, 0.0, 0.0]] * 60 + rng.normal(size=(240, 3)).tolist()
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    index, rows = ann.build(frame, leaf_rows=20, calibration_rows=300, target_recall=1.0)
    got = {(r.query_id, r.rank): r.vec_id for r in ann.search(index, rows.filter("vec_id % 50 = 0"), block_rows=7).collect()}
    assert [got[0, k] for k in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [got[50, k] for k in range(1, 6)] == [0, 1, 2, 3, 4]
    near = ann.unit(np.array(vectors))
    for q in (100, 150, 200, 250):
        scores = near @ near[q]
        scores[q] = -2
        assert [got[q, k] for k in range(1, 6)] == np.lexsort((np.arange(300), -scores))[:5].tolist()


# ------------------------------------------------------------------ archives

def expected_pages(rows):
    ids = defaultdict(list)
    for page, _, html in rows:
        ids[html or ""].append(page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        named = [i for i in ids[html or ""] if i is not None]
        first = min(named) if named else None
        revisit = len(payload) >= 100 and first is not None and first != page
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


PAGES = [(1, "http://a/é b\r\nX: y", "x" * 500), (2, None, "x" * 500), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
         (None, "u", "x" * 500), (None, "u", "y" * 200), (7, "u", "WARC/1.0 \r\n\r\n" * 30), (1, "u", "x" * 500), (9, "z", "ü" * 100_000)]


@pytest.mark.parametrize("range_bytes", [7, 300, 1 << 20])
def test_archives_round_trip(spark, range_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.round_trip(pages, range_bytes).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == expected_pages(PAGES) and all(r.digest_valid for r in rows)


def test_archive_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, warc.query(spark, SF).collect()), key=str) == expected_pages(rows)


def test_false_members_are_not_records():
    good = warc.member(warc.record(1, "u", b"<p>" * 50, "d", None))
    fake = warc.member(b"not an archive record") + warc.MAGIC + b"\x00" * 30 + good[:40]
    data = fake + good + warc.MAGIC + good + good[:-9]
    found = [at for at, _ in warc.read_range(io.BytesIO(data), len(data), 0, len(data))]
    assert found == [len(fake), len(fake) + len(good) + 3]
    for cut in (1, 10, len(fake), len(fake) + 1):
        parts = [at for a, b in ((0, cut), (cut, len(data))) for at, _ in warc.read_range(io.BytesIO(data), len(data), a, b, chunk=16)]
        assert parts == found


# ------------------------------------------------------------------ pipeline and registration

def test_pipeline_stages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = source, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.written(stage(spark, kept, SF), name)
        assert kept.columns == source.columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
        seen.append(kept.count())
    assert seen == sorted(seen, reverse=True) and seen[0] == seen[1] and seen[2] < seen[1]
    assert kept.filter("n_chars <> length(text)").count() == 0
    assert linededup.duplicate_lines(kept).filter("word_edits = 0").count() == 0
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept.select("doc_id").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = {d for d, r in labels.items() if r.quality == 1 and r.toxic == 0}
    first = corpus_pipeline.quality_classifier(spark, source, SF)
    stayed = {r.doc_id for r in first.select("doc_id").collect()}
    assert len(clean & stayed) > 0.97 * len(clean)


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = {re.match(r"op\d+", n).group() for n in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
