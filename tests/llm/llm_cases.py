"""Small inputs and brute-force helpers of the corpus operator tests."""

import random
import re

import duckdb

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ["row", "score", "hash", "ids", "spans", "found", "fp", "root", "places", "n_words", "y", "hits", "label",
         "template", "mask", "copies", "masked", "lower", "key", "passages", "component_id", "text_hash"]


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(["ka", "lo", "mi", "ré", "su", "tan"]) for _ in range(rnd.randint(1, 4)))
                    for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and odd texts, repeats, a very long text."""
    long = sentence(1, 30_000)
    return [
        (1, "The quick brown fox jumps over the lazy dog"), (1, "The quick brown fox jumps over the lazy dog"),
        (1, "another text with the same id"), (2, None), (None, None), (None, "no id but text"), (None, "no id but text"),
        (3, ""), (4, " \t\n\r\x0b\x0c "), (5, "\x1c\x85 é\U0001F642"), (6, "x" * 100_000), (7, long), (8, long),
        (9, long + " tail"), (10, "a " * 5000), (11, sentence(2, 60)), (12, sentence(2, 60)), (13, "#$% &|<> 123"),
        (-5, sentence(3, 80) + "\n" + sentence(3, 80)), (14, "The\nThe\nThe\nThe\n\n \n")]


def edge_docs(spark, rows=None):
    """Documents with extra columns whose names operators might use."""
    extra = ", ".join(f"`{c}` string" for c in CLASH)
    rows = edge_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, *([None] * len(CLASH))) for i, t in rows], f"doc_id long, text string, {extra}")


def empty_docs(spark):
    return edge_docs(spark, [])


def documents(sf=SF):
    return duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()


def by_row(rows):
    """Rows as a sorted list of comparable tuples."""
    return sorted((tuple(r) for r in rows), key=repr)
