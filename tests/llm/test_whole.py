"""Cases in which an operator once did less than its whole job."""

import re

from factorlab.llm import chat, decontaminate, linededup, pii

KEY = b"k"


def test_secrets_without_ascii_letters(spark):
    crowd = [f"password: {c}*****" for c in "abcdef"]
    texts = ["password: ******", "token=------", "password: пароль", "password: 密码密码密码", "secret: !@#$%^&*", *crowd]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in pii.pseudonymise(rows, KEY).orderBy("doc_id").collect()]
    assert got[:2] == texts[:2]   # masks hide nothing
    secrets = [t.split(": ")[1] for t in texts[2:]]
    new = [t.split(": ")[1] for t in got[2:]]
    assert [len(n) for n in new] == [len(s) for s in secrets]
    assert not set(new) & set(secrets) and len(set(new)) == len(new)
    assert all("Ѐ" <= c <= "ӿ" for c in new[0]) and all("一" <= c <= "鿿" for c in new[1])


def test_planted_mentions_are_replaced():
    planted = ["Anna", "ANNA", "Petrova", "8.8.8.8", "1.1.1.1", "2001:db8::1", "2001:DB8:0::2", "fe80::1ff:fe23:4567:890a",
               "2606:4700::1111", "2001:db8::", "64:ff9b::192.0.2.33"]
    text = ("Anna Petrova came. Anna said: ask 8.8.8.8, then 2001:db8::1. ANNA left\nPetrova saw 1.1.1.1\n"
            "[2001:DB8:0::2]:80 fe80::1ff:fe23:4567:890a%eth0 2606:4700::1111: up, net 2001:db8::/32, 64:ff9b::192.0.2.33;")
    new, spans = pii.rewrite(text, KEY, {}, {})
    assert not [p for p in planted if p in new]
    names = [new[a:b] for t, a, b in spans if t == "given"]
    assert names[0] == names[1] and names[2] == names[0].upper()
    assert {s[3] for s in pii.detect("at 2001:db8::1 and 2001:0DB8:0:0:0:0:0:1")} == {"2001:db8::1"}
    assert not pii.detect("std::vector a::b Face::Bad x[::2] ::1 at 12:30, version 3.0, 1.2.3")


def test_clean_rows_without_id_stay(spark):
    item = "On Monday the small farm sold 12 baskets of apples and kept 7 baskets for the winter"
    halves = [item[:40], item[40:]]   # two halves in different rows are no leak
    texts = ["Before that. " + item, "a clean text of its own", "", "a clean text of its own", *halves]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(1, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = [r.text for r in decontaminate.drop_contaminated(docs, bench).collect()]
    assert sorted(kept, key=str) == sorted(texts[1:], key=str)
    one = decontaminate.contaminated(docs, bench)
    assert "text_key" not in one.columns and sorted(r.doc_id or 0 for r in one.collect()) == [0, 1]


def test_escapes_before_a_backslash(spark):
    nasty = ["##\\", "##\\x", "###\\\\", "#\\h", "<\\t", "</\\", "a##\\\nb", "##:", "\\h", "\\\\h", "\\:"]
    rows = [(1, i, "assistant" if i % 2 else nasty[i // 2 % len(nasty)], nasty[i % len(nasty)]) for i in range(2 * len(nasty))]
    frame = chat.read_back(chat.conversations(chat.chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    (got,) = frame.collect()
    assert [(t.role, t.text) for t in got.turns] == [r[2:] for r in rows]
    assert got.loss_text == "".join(r[3] for r in rows if r[2] == "assistant")
    assert got.formatted.count("### ") == got.formatted.count(" </turn>\n") == got.n_turns


def test_lines_go_row_by_row(spark):
    rows = [(None, f"own {i}\nseen in every row\nlast {i}") for i in range(300)] + [(1, "x\nseen in every row"), (1, "seen in every row\ny")]
    docs = spark.createDataFrame([(None, "seen in every row"), *rows], "doc_id long, text string")
    out = linededup.drop_lines(docs)
    gone = {r.text for r in out.collect()}
    assert gone == {"seen in every row", *(f"own {i}\nlast {i}" for i in range(300)), "x", "y"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lists = [line for line in plan.splitlines() if "Aggregate" in line and "collect_list" in line]
    assert lists and all(re.search(r"Aggregate \[doc_id#\d+L?, t1#\d+L?, t2#", line) for line in lists)


def test_copies_in_another_case_or_place(spark):
    capital, farm = "What is the capital of France?", "Tom has 12 apples. Anna takes 3 apples. Tom eats 2 apples. Anna sells 4 apples."
    walk = "When Tom met Anna in Berlin they walked to Sara and Paul in Potsdam before Maria came home"
    zh = "小明有三个苹果他又买了五个"
    texts = ["Question: " + capital, "Paris is the capital of France.", walk.lower(), farm.replace("Tom", "Omar").replace("Anna", "Lena"),
             "前面的话。" + zh + "。后面", "小明去学校上课了。", "He said, \"" + capital + "\"", "Omar has 12 apples. Lena takes 3 apples. Uli eats 2 apples. Mia sells 4 apples."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate([capital, walk, farm, zh])), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.reparameterised for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(0, 0): False, (2, 1): False, (3, 2): True, (4, 3): False, (6, 0): False}
