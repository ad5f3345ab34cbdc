"""Substring deduplication against brute force."""

from collections import Counter

import pytest
from llm_cases import WORDS, by_row, documents, edge_docs, edge_rows, empty_docs, sentence

from countpanel.llm import substrings


def brute(rows, window):
    words = [WORDS.findall(t or "") for _, t in rows]
    counts = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return by_row(out)


def passages():
    """Shared passages of 30 to 60 words at all alignments, and repeats within a text."""
    rows = []
    for k in range(40):
        shared = sentence(1000 + k % 5, 30 + k % 31)
        rows.append((k, f"{sentence(k, k % 23)} {shared} {sentence(k + 500, 11)}"))
    rows.append((90, " ".join([sentence(7, 20)] * 3)))
    return rows


@pytest.mark.parametrize("window", [3, 35])
def test_passages(spark, window):
    rows = passages()
    got = substrings.remove_repeats(edge_docs(spark, rows).repartition(7), window=window).collect()
    assert by_row(got) == brute(rows, window)


def test_edge_rows(spark):
    got = substrings.remove_repeats(edge_docs(spark)).collect()
    assert by_row(got) == brute(edge_rows(), 35)


def test_documents(spark):
    rows = documents()
    got = substrings.remove_repeats(edge_docs(spark, rows).repartition(5)).collect()
    assert by_row(got) == brute(rows, 35)


def test_empty(spark):
    assert substrings.remove_repeats(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("period", substrings.COVERS)
def test_covers(period):
    cover = substrings.COVERS[period]
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))
