"""Personal data: spans, validators, context and masking."""

import re

from llm_cases import CLASH, by_row, documents, edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from countpanel.llm import pii

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), r, m.end(), k) for r, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "")
             if passes(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


ODD = ["a@b.c_d@e.f, .x@y.z.w", "_@a.b-@c.d+1-1", "1.2.3.4.5.6.7.8 300.1.1.1 0255.1.1.1 1.2.3.256",
       "a" * 3000 + "@" + "b" * 3000, "1" * 3000 + " " + "1 " * 2000, "+1" + " " * 2000 + "5 +1 (487) 555-7209.",
       "1.1." * 900, "x@y." * 500 + "z", "a@b.c " * 700, "é🙂 mail: é@x.y.zé 4111 1111 1111 1111-4111 1111 1111 1111"
       " é+49 30 1234567", "4111-1111-1111-1111 +1 4111 1111 1111 1111", "1.2.3.4"]


def test_base_spans_equal_brute_force(spark):
    rows = [*edge_rows(), *documents(), *[(1000 + k, t) for k, t in enumerate(ODD)]]
    out = pii.spans(edge_docs(spark, rows)).select(
        "row.doc_id", "row.text", pii.written(pii.of_kind(F.col("spans"), *pii.BASE)).alias("s"))
    assert by_row(out.collect()) == by_row((i, t, brute(t)) for i, t in rows)


def spans_of(spark, text):
    row = pii.spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    return [(pii.KINDS[s.kind_rank], s.match, round(s.score, 6)) for s in row.spans]


def test_added_kinds_need_checksum_or_context(spark):
    assert spans_of(spark, "GB82 WEST 1234 5698 7654 32") == [("iban", "GB82 WEST 1234 5698 7654 32", 0.9)]
    assert spans_of(spark, "GB83 WEST 1234 5698 7654 32") == []
    assert spans_of(spark, "number 123-45-6789 here") == []
    assert spans_of(spark, "my SSN: 123-45-6789") == [("ssn", "123-45-6789", 0.6)]
    assert spans_of(spark, "my SSN: 000-45-6789") == []


def iban(country, n):
    """A valid one of n characters."""
    rest = "".join("0123456789ABC"[(3 * k + n) % (13 if k < 4 else 10)] for k in range(n - 4))
    value = int("".join(str(int(c, 36)) for c in f"{rest}{country}00"))
    return f"{country}{98 - value % 97:02d}{rest}"


def test_ibans_before_upper_case_words_and_numbers(spark):
    """All lengths, both written forms, what follows never taken in."""
    known = [iban(c, n) for n, codes in pii.IBAN_LENGTHS.items() for c in codes.split()]
    known += ["AT611904300234573201", "ES9121000418450200051332", "BE68539007547034"]
    spaced = [" ".join(x[k:k + 4] for k in range(0, len(x), 4)) for x in known]
    after = [" BIC: X", " EUR 50", " 7", " SWIFT", " USD1 AB12", "", ", BIC", " and more", f" {spaced[0]}"]
    rows = [(k, f"pay {x}{a} now") for k, (x, a) in enumerate((x, a) for x in known + spaced for a in after)]
    expected = {k: [x] + [spaced[0]] * (a == after[-1])
                for k, (x, a) in enumerate((x, a) for x in known + spaced for a in after)}
    docs = edge_docs(spark, rows)
    got = pii.spans(docs).select("row.doc_id", pii.of_kind(F.col("spans"), "iban").alias("s")).collect()
    assert {r.doc_id: [x.match for x in r.s] for r in got} == expected
    assert spans_of(spark, "NR12 3456 7890 AT61 1904 3002 3457 3201 EUR") == [("iban", "AT61 1904 3002 3457 3201", 0.9)]
    assert spans_of(spark, "AT61 1904 3002 3457 3202 BIC") == [] and spans_of(spark, "AT61 1904 3002 3457 3201B") == []
    texts = [(1, "to BE68 5390 0754 7034 BIC"), (2, "to BE68539007547034 EUR 50")]
    assert {r.doc_id: r.text for r in pii.mask(edge_docs(spark, texts)).collect()} == {
        1: "to <IBAN> BIC", 2: "to <IBAN> EUR 50"}


def test_context_moves_the_score(spark):
    card = "4111 1111 1111 1111"
    scores = [spans_of(spark, t)[0][2] for t in (card, f"credit card {card}", f"order no {card}")]
    assert scores == [0.8, 1.0, 0.5]


def test_mask_hides_every_span_and_keeps_columns(spark):
    docs = edge_docs(spark, [(1, "write a.b@c.org, 10.0.0.1 or +1 (487) 555-7209"), (2, None), (3, "clean 12.5 text"),
                             (4, "4111 1111 1111 1111")])
    out = pii.mask(docs)
    assert out.columns == ["doc_id", "text", *CLASH]
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "write <EMAIL>, <IP> or <PHONE>", 2: None, 3: "clean 12.5 text", 4: "<CARD>"}
    rows = documents()
    masked = pii.mask(edge_docs(spark, rows)).collect()
    assert len(masked) == len(rows) and not any(brute(r.text) for r in masked)
    assert {r.doc_id for r in masked if r.text != dict(rows)[r.doc_id]} == {i for i, t in rows if brute(t)}


def test_masked_text_can_be_filtered_and_aggregated(spark):
    """What is built on the masked text does not repeat its expressions."""
    docs = edge_docs(spark, [(1, "write a.b@c.org"), (2, "no"), (3, None)])
    out = pii.mask(docs).where(F.length("text") > 3).where(F.col("text").contains("<EMAIL>")).groupBy("text").count()
    assert [tuple(r) for r in out.collect()] == [("write <EMAIL>", 1)]
    plan = pii.mask(docs).where(F.length("text") > 3)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000
    spans = pii.spans(docs).where(F.size("spans") > 0).where(F.col("spans")[0]["start"] > 2)
    assert [r.row.doc_id for r in spans.collect()] == [1]


def test_masked_documents_can_be_written_with_any_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, "write a.b@c.org", "en", "s", 15), (2, None, None, "s", 0)], "doc_id long, text string, lang string, source string, n int")
    for k, out in enumerate((pii.mask(docs), pii.mask(docs).withColumn("n", F.length("text")), pii.mask(docs).select("lang", "text"),
                             pii.mask(docs).select("doc_id"), pii.mask(pii.mask(docs)).drop("lang"))):
        out.write.parquet(str(tmp_path / str(k)))
        back = spark.read.parquet(str(tmp_path / str(k)))
        assert back.columns == out.columns and back.count() == 2
        assert "text" not in back.columns or {r.text for r in back.collect()} == {"write <EMAIL>", None}


def test_overlapping_spans_are_hidden_together(spark):
    texts = [(1, "+1 10.20.30.40 5 x"), (2, "a 4111 1111 1111 1111 b 4111 1111 1111 1111"), (3, "u@10.0.0.1 and")]
    got = {r.doc_id: r.text for r in pii.mask(edge_docs(spark, texts)).collect()}
    assert got == {1: "<IP> x", 2: "a <CARD> b <CARD>", 3: "<EMAIL> and"}


def test_secrets_need_a_context_word_and_mixed_characters(spark):
    secret = "0123456789abcdef0123456789abcdef01234567"
    assert spans_of(spark, f'token = "{secret}"') == [("secret", secret, 0.5)]
    assert spans_of(spark, f"commit {secret} is fine") == [] and spans_of(spark, f"token commit {secret}") == []
    assert spans_of(spark, "token aaaaaaaaaaaaaaaaaaaaaaaaaaaa") == [] and spans_of(spark, "token " + "0a" * 20) == []
    rows = [(i, t) for i, t in documents("/root/testdata/sf0.01") if t and "token = " in t]
    masked = pii.mask(edge_docs(spark, rows)).collect()
    assert rows and not any(re.search("[0-9a-f]{40}", r.text) for r in masked)


def test_empty(spark):
    assert pii.spans(empty_docs(spark)).count() == 0 and pii.mask(empty_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.spans(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
