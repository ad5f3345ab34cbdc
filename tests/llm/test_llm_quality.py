"""Quality ledger: measurements, masks, policies, ablations."""

import re
from collections import Counter

from llm_cases import WORDS, by_row, documents, edge_docs, edge_rows, empty_docs, sentence

from countpanel.llm import quality


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k, g in enumerate(zip(words, words[1:], words[2:])):
        if grams[g] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(covered), sum(w[0] in "#*$%&|<>" or w[-1] in "#*$%&|<>" for w in words),
            sum(bool(re.fullmatch(r"[A-Z]{2}[\x00-\x60\x7B-\x7F]*", w)) for w in words), len(set(words)))


ROWS = [*edge_rows(), (50, "THIS IS A12 SHOUT! ÄÖ ABc"), (51, "a b c a b c"), (52, "a a a a"), (53, "a a a"), (54, "x\ny\nx\n x"),
        (55, " ".join(str(k) for k in range(3000)) + " 1 2 3")]


def test_measurements(spark):
    rows = [*ROWS, *documents()]
    got = quality.ledger(edge_docs(spark, rows)).select("row.doc_id", "row.text", *quality.MEASURES).collect()
    assert by_row(got) == by_row((i, t, *brute(t)) for i, t in rows)


def test_policies_and_ablations(spark):
    docs = edge_docs(spark, [(1, sentence(1, 200)), (2, "short"), (3, "a b c " * 60), (4, "x# " * 80),
                             (5, "SHOUT LOUD " + " ".join(f"AA{k}X BB{k}Y" for k in range(60)))])
    book = quality.ledger(docs, keep=["doc_id"])
    kept = {r.doc_id: (r.b, r.v) for r in book.select(
        "row.doc_id", quality.kept(book["mask"], "base").alias("b"), quality.kept(book["mask"], "v1").alias("v")).collect()}
    # 2 is short, 3 repeats its trigrams, 4 does so and is full of symbols, 5 shouts
    assert kept == {1: (True, True), 2: (False, False), 3: (False, False), 4: (False, False), 5: (True, False)}
    alone = {r.doc_id: r.rule for r in book.select("row.doc_id", quality.only_rule(book["mask"], "v1").alias("rule")).collect()}
    assert alone[1] is None and alone[2] == "few_words" and alone[4] is None and alone[5] == "upper_case"
    masks = [r.mask for r in book.collect()]
    rules = quality._rules()
    whole = quality.policy_mask("v1")
    for r in quality.ablations(book, "v1").collect():
        bit = 1 << rules[r.rule][0]
        assert (r.n_failed, r.n_only, r.n_kept_without) == (
            sum(bool(m & bit) for m in masks), sum(m & whole == bit for m in masks), sum(m & whole & ~bit == 0 for m in masks))


def test_empty(spark):
    book = quality.ledger(empty_docs(spark))
    assert book.count() == 0
    assert {(r.n_failed, r.n_only, r.n_kept_without) for r in quality.ablations(book, "v1").collect()} == {(0, 0, 0)}


def test_clean_documents_are_kept(spark):
    """Of documents labelled good, those that pass the base rules are kept; bad ones go."""
    import duckdb
    from llm_cases import SF

    from countpanel.llm.queries import QUERIES
    label = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    got = {r.doc_id: r for r in QUERIES["op5_quality"](spark, SF).collect()}
    good = [got[i] for i, q in label.items() if q == 1 and not got[i].base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not got[i].kept for i, q in label.items() if q == 0) >= 0.95 * sum(q == 0 for q in label.values())
