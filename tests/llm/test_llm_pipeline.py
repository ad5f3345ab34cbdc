"""The pipeline: stages on their own input, and run() against brute force."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from llm_cases import CLASH, SF, edge_docs, edge_rows, empty_docs
from test_llm_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from countpanel.llm import bpe, decontaminate, toxicity
from countpanel.llm.common import table

STAGES = dict(corpus_pipeline.STAGES)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "pii", "bpe"]


def test_run_equals_stage_by_stage_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    score = {r.row.doc_id: r.score for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if score[i] < 0.3]
    groups = {}
    for (i, t), c in zip(rows, brute_components([brute_fingerprint(t) for _, t in rows])):
        groups.setdefault(c, []).append((i, t))
    rows = [min(g) for g in groups.values()]
    norm = lambda t: " " + " ".join(decontaminate.words_of(t or "")) + " "
    items = [norm(r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = [(i, t) for i, t in rows if not any(b in norm(t) for b in items)]
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    masked = {r.doc_id: r for r in STAGES["pii"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()}
    expected = {}
    for i, _ in rows:
        ids = library.encode_ordinary(masked[i].text)
        expected[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(masked[i].text.encode()).hexdigest())
        assert not re.search(r"@[a-z-]+\.[a-z]", masked[i].text)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_the_columns_of_documents(spark, name):
    docs = edge_docs(spark)
    out = STAGES[name](spark, docs, SF)
    assert out.columns == ["doc_id", "text", *CLASH]
    rows = out.collect()
    if name in ("toxicity", "decontamination", "pii"):
        assert len(rows) == len(edge_rows())
    assert STAGES[name](spark, empty_docs(spark), SF).count() == 0


def test_last_stage(spark):
    out = STAGES["bpe"](spark, edge_docs(spark), SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == len(edge_rows())
