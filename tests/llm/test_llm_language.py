"""Language ID: mixtures, sets, held-out accuracy."""

import zlib

import numpy as np
from llm_cases import CLASH, edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from countpanel.llm import language

SF01 = "/root/testdata/sf0.01"


def texts(lang, k, n=40):
    import random
    rnd = random.Random(f"{lang}{k}")
    parts = {"aa": ["ba", "lo", "ki"], "bb": ["tsch", "und", "rü"], "cc": ["ñor", "que", "ez"]}[lang]
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def sample(spark):
    rows = [(100 * j + k, texts(lang, k), lang) for j, lang in enumerate(("aa", "bb", "cc")) for k in range(60)]
    return spark.createDataFrame([*rows, (None, "x", "aa"), (7777, None, "bb"), (7778, texts("aa", 999), None)],
                                 "doc_id long, text string, lang string")


def test_mixtures(spark):
    model = language.fit(sample(spark), lambda i: i % 3 != 1)
    assert model[0] == ["aa", "bb", "cc"]
    docs = edge_docs(spark, [(1, texts("aa", 900)), (2, texts("bb", 901) + " " + texts("bb", 902) + "\n" + texts("cc", 903)),
                             (3, texts("cc", 904, 8)), (4, "123 !!"), (5, None), (6, "")])
    got = {r.row.doc_id: r for r in language.identify(docs, model).collect()}
    assert (got[1].lang_pred, got[1].languages) == ("aa", ["aa"]) and got[1].score == 1.0
    assert (got[2].lang_pred, got[2].languages) == ("bb", ["bb", "cc"]) and 0.55 < got[2].score < 0.75
    assert got[3].lang_pred == "cc"
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (4, 5, 6))


def invented(lang, k, n=60):
    """Text of one of any number of languages, each with syllables of its own."""
    import random
    own = random.Random(f"syllables {lang}")
    parts = ["".join(own.choice("abcdefghijklmnopqrstuvwxyzäöüéñ") for _ in range(3)) for _ in range(6)]
    rnd = random.Random(f"{lang} {k}")
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_every_language_is_learned(spark):
    """Also the rarest of 260: two documents each, the first ten three."""
    names = [f"l{k:03d}" for k in range(260)]
    rows = [(10 * j + k, invented(x, k), x) for j, x in enumerate(names) for k in range(3 if j < 10 else 2)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model[0] == names
    docs = edge_docs(spark, [(j, invented(x, 9)) for j, x in enumerate(names)]
                     + [(1000, invented("l200", 10) + " " + invented("l259", 11))])
    got = {r.row.doc_id: r for r in language.identify(docs, model).collect()}
    assert [got[j].lang_pred for j in range(260)] == names
    assert sorted(got[1000].languages) == ["l200", "l259"]


def test_shares_equal_the_dense_table():
    rng = np.random.default_rng(5)
    counts = rng.poisson(0.3, (7, language.BUCKETS)).astype(float)
    pooled = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * language.BUCKETS)
    dense = ((counts + language.SMOOTHING * pooled) / (counts.sum(axis=1, keepdims=True) + language.SMOOTHING)).astype(np.float32)
    packed = language.shares([(np.flatnonzero(c).astype(np.int32), c[c > 0].astype(int)) for c in counts])
    seen = np.unique(rng.integers(0, language.BUCKETS, 900))
    assert np.allclose(packed.of(seen), dense[:, seen], rtol=1e-6, atol=0)
    assert language.shares([]).of(seen).shape == (0, len(seen))


def test_proportions_raise_the_likelihood():
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(50), 3)
    c = rng.integers(1, 20, 50).astype(float)
    fits = [language.proportions(p, c, n)[1] for n in range(1, 30, 4)]
    assert all(b >= a - 1e-9 for a, b in zip(fits, fits[1:]))


def test_pieces_of_long_texts_count_the_same(monkeypatch):
    text = texts("aa", 1, 3000)
    whole = language.trigram_counts(text)
    monkeypatch.setattr(language, "PIECE", 1000)
    assert (language.trigram_counts(text) == whole).all() and language.trigram_counts("12 !") is None


def test_edges(spark):
    model = language.fit(sample(spark))
    out = language.identify(edge_docs(spark), model)
    assert out.select("row.*").columns == ["doc_id", "text", *CLASH] and out.count() == len(edge_rows())
    assert language.identify(empty_docs(spark), model).count() == 0
    none = language.fit(sample(spark).limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(edge_docs(spark), none).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    from countpanel.llm.queries import QUERIES
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op8_language"](spark, SF01).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got) and len(got) == len(lang)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def test_held_out_rows_are_not_learned_from(spark):
    """Changing the text of held-out rows leaves the model as it is."""
    docs = sample(spark)
    a = language.fit(docs, lambda i: i % 3 != 1)
    b = language.fit(docs.withColumn("text", F.when(F.col("doc_id") % 3 == 1, "zzz").otherwise(F.col("text"))),
                     lambda i: i % 3 != 1)
    assert a[0] == b[0] and (a[1] == b[1]).all()


def test_set_search_equals_all_subsets():
    """The penalised likelihood of every subset of six languages, for texts of
    one to four of them, long and short."""
    from itertools import combinations
    rng = np.random.default_rng(11)
    dense = np.zeros((6, language.BUCKETS))
    for row in dense:  # distributions that overlap by halves
        row[rng.choice(400, 150, replace=False)] = rng.gamma(0.6, size=150)
    own = [np.flatnonzero(row) for row in dense]
    model = language.shares([(at.astype(np.int32), np.maximum(1, np.rint(20_000 * dense[k, at] / dense[k].sum())).astype(np.int64)) for k, at in enumerate(own)])
    full = model.of(np.arange(language.BUCKETS)).astype(float)
    for trial in range(40):
        k = rng.integers(1, 5)
        members, parts = rng.choice(6, k, replace=False), rng.dirichlet(np.full(k, 4.0))
        q = parts @ full[members]
        counts = rng.multinomial(int(rng.choice([60, 400, 5000])), q / q.sum())
        seen = np.flatnonzero(counts)
        price = 0.5 * np.log(counts.sum() + 1)
        fits = {s: language.proportions(full[list(s)][:, seen], counts[seen].astype(float))[1] - price * n
                for n in range(1, 7) for s in combinations(range(6), n)}
        langs, w = language.infer(model, counts)
        best = max(fits, key=fits.get)
        # the backward search may stop at a set that is as good but for a fraction of one language's price
        assert fits[tuple(langs.tolist())] >= fits[best] - 0.5 * price, (members, langs, best)
        assert abs(w.sum() - 1) < 1e-5
        if counts.sum() == 5000 and parts.min() > 0.1:
            assert set(langs.tolist()) == set(members.tolist()) == set(best)


def test_one_rule_for_any_number_of_languages():
    """Two hundred languages nobody uses do not change the set of a text."""
    rng = np.random.default_rng(5)
    counts = []
    for _ in range(203):
        at = rng.choice(language.BUCKETS, 200, replace=False)
        counts.append((np.sort(at).astype(np.int32), rng.integers(1, 400, 200)))
    few, many = language.shares(counts[:3]), language.shares(counts)
    text = np.zeros(language.BUCKETS, np.int64)
    for k, n in ((0, 3000), (2, 1000)):
        at, c = counts[k]
        text[at] += rng.multinomial(n, c / c.sum())
    for model in (few, many):
        langs, w = language.infer(model, text)
        assert langs.tolist() == [0, 2] and abs(w[0] - 0.75) < 0.03
