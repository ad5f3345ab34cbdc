"""Decontamination: exact and substituted passages, clean texts, blocks."""

import random
from itertools import combinations

import pytest
from llm_cases import SF, edge_docs, empty_docs, sentence

from countpanel.llm import decontaminate


def test_longest_stretch_equals_brute_force():
    import numpy as np
    rng = np.random.default_rng(2)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 40)) < 0.75
        best = max((b - a for a in range(len(equal)) for b in range(a, len(equal) + 1)
                    if b > a and equal[a:b].mean() >= 0.8 - 1e-9), default=0)
        start, length = decontaminate.longest_stretch(equal, 0.8)
        assert length == best and (not length or equal[start:start + length].mean() >= 0.8 - 1e-9)


def planted():
    rnd = random.Random(4)
    items = [(k, sentence(9000 + k, 15 + 3 * k)) for k in range(12)] + [(50, "of the"), (51, None), (52, ""), (0, sentence(9000, 15)),
                                                                      (None, sentence(77, 20)), (None, None)]
    rows, expected = [(99, "so " + sentence(77, 20))], {99: None}
    for k in range(60):
        body = sentence(k, 100).split()
        if k % 3 == 0:
            item = k // 3 % 12
            words = items[item][1].split()
            if k % 2:  # every sixth word replaced
                words = [w if j % 6 != 5 else "zzz" for j, w in enumerate(words)]
            at = rnd.randint(0, len(body))
            body[at:at] = [w.upper() for w in words]
            expected[k] = item
        rows.append((k, " ".join(body) + "."))
    return items, rows, expected


@pytest.mark.parametrize("part", [decontaminate.PART, 1])
def test_planted(spark, part, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART", part)
    items, rows, expected = planted()
    bench = spark.createDataFrame([(i, t, None) for i, t in items], "item_id long, text string, hits string")
    out = decontaminate.scan(edge_docs(spark, rows), bench).collect()
    assert len(out) == len(rows)
    assert {r.row.doc_id: {h.item_id for h in r.hits} for r in out if r.hits} == {k: {v} for k, v in expected.items()}


def test_benchmark_texts_inside_documents(spark):
    """Every document that holds a whole benchmark text is found, and no other."""
    import duckdb
    bench = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    norm = lambda t: " " + " ".join(decontaminate.words_of(t or "")) + " "
    held = {i for i, t in docs if any(norm(b) in norm(t) for _, b in bench)}
    from countpanel.llm.queries import QUERIES
    got = {r.doc_id for r in QUERIES["op9_decontaminate"](spark, SF).collect()}
    assert got == held and held


def test_every_allowed_substitution_of_short_items_is_found(spark):
    """All patterns that leave 80 % of up to 13 words, inside other words."""
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(1, 14)]
    rows, expected = [], {}
    for n, text in items:
        own = text.split()
        for lost in range(n // 5 + 2):
            for pattern in combinations(range(n), lost):
                words = [f"z{k}" if k in pattern else w for k, w in enumerate(own)]
                if lost <= n // 5:
                    expected[len(rows)] = [n]
                rows.append((len(rows), " ".join(["so", "it", *words, "goes"])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.scan(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {r.row.doc_id: [h.item_id for h in r.hits] for r in out if r.hits} == expected


def brute(rows, items, min_words=13, identity=0.8):
    """Every item on every diagonal of every text."""
    import numpy as np
    out = {}
    for doc, text in rows:
        words = decontaminate.words_of(text or "")
        for item, content in items:
            own, best = decontaminate.words_of(content or ""), None
            for offset in range(-len(own) + 1, len(words)):
                lo, hi = max(0, -offset), min(len(own), len(words) - offset)
                equal = np.array([words[k + offset] == own[k] for k in range(lo, hi)])
                start, length = decontaminate.longest_stretch(equal, identity)
                n_equal = int(equal[start:start + length].sum())
                if length and length >= min(min_words, len(own)) and (best is None or n_equal > best[3]):
                    best = (item, lo + offset + start, length, n_equal, len(own))
            if best:
                out.setdefault(doc, []).append(best)
    return {d: sorted(h) for d, h in out.items()}


def test_equals_all_diagonals(spark):
    """Texts over few words, so that items meet them in many places by halves."""
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice("abcdefghijklmnopqrstuvw") + rnd.choice("xy") for _ in range(n))
    items = [(k, text(rnd.randint(1, 30))) for k in range(25)]
    rows = []
    for k in range(60):
        body = text(40).split()
        for _ in range(2):
            own = [w if rnd.random() < 0.87 else "zz" for w in rnd.choice(items)[1].split()]
            at = rnd.randint(0, len(body))
            body[at:at] = own[rnd.randint(0, 2):]
        rows.append((k, " ".join(body)))
    out = decontaminate.scan(edge_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.row.doc_id: sorted(tuple(h) for h in r.hits) for r in out if r.hits}
    assert got == brute(rows, items) and got


def test_shared_openings_and_repeats(spark):
    """Thousands of items with one opening, a text that repeats it, copies of
    that text: every item is reported once a row, from the place it fits best."""
    opening = [f"o{k}" for k in range(12)]
    items = [(k, " ".join([*opening, f"own{k}", f"end{k}"])) for k in range(3000)]
    rows = [(k, " ".join(opening * 40)) for k in range(20)] + [(100, " ".join([*opening, "own7", "end7"])), (101, " ".join(opening[:9]))]
    out = decontaminate.scan(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.row.doc_id: r.hits for r in out.collect()}
    assert all(len(got[k]) == 3000 and {(h.first_word, h.n_equal) for h in got[k]} == {(0, 12)} for k in range(20))
    assert len(got[100]) == 3000 and {h.item_id for h in got[100] if h.n_equal == 14} == {7} and not got[101]


def test_short_items_and_scripts_without_spaces(spark):
    zh, ja, th = "下列哪个城市是法国的首都，也是最大的城市？", "日本で一番高い山は何ですか。", "เมืองหลวงของประเทศไทยคือ"
    items = [(1, "Who wrote Faust?"), (2, "alpha beta gamma delta epsilon"), (3, "one two three four five six"), (4, zh),
             (5, ja), (6, "𠀀𠀁𠀂"), (7, "?!"), (8, th), (9, "42")]
    rows = [(10, "x who wrote FAUST, y who wrote faust"), (11, "who has written faust"), (12, "so alpha beta nope delta epsilon on"),
            (13, "one two three zzz five six"), (14, "one two zzz zzz five six"), (20, f"题目：{zh}答案是巴黎"),
            (21, "在文本中" + zh.replace("首", "古").replace("，", "") + "没有空格"), (22, "法国的首都是巴黎"), (23, "問題" + ja + "富士山"),
            (24, "a𠀀𠀁𠀂b"), (25, f"คำถาม{th}อะไร"), (26, "4 2 421"), (27, "(42)")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.scan(edge_docs(spark, rows), bench).collect()
    assert {r.row.doc_id: [h.item_id for h in r.hits] for r in out if r.hits} == {
        10: [1], 12: [2], 13: [3], 20: [4], 21: [4], 23: [5], 24: [6], 25: [8], 27: [9]}
    assert decontaminate.words_of("GPT-4和 é語") == ["gpt", "4", "和", "é", "語"]


def test_edges(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, sentence(1, 20))], "item_id long, text string")
    assert all(not r.hits for r in decontaminate.scan(edge_docs(spark), none).collect())
    hit = {r.row.doc_id for r in decontaminate.scan(edge_docs(spark), some).collect() if r.hits}
    assert hit == {7, 8, 9}  # the long texts begin with the item
    assert decontaminate.scan(empty_docs(spark), some).count() == 0
