"""License scans: exact set-similarity join of text blocks with templates.

Column expressions and joins only.  A block (a line, or a run of words that
goes across line breaks) holds a template if at least ``threshold`` of the
template's distinct words stand in it.  Runs are a template's number of words
over ``threshold`` long, so a notice is found wherever its lines are wrapped,
with as many foreign words between as words may be missing.  They are taken
from overlapping pieces of the text: every run lies in one of them whole.

One pass over whole texts counts the words and notes which words of the
templates stand in each text; the text itself goes on only if it holds enough
of them for some template.  Words are then ordered by the number of texts of
the whole corpus that hold them, the rarest first.  A template of m words with
minimum overlap o must share one of its first m - o + 1 words (its prefix) with
any block that qualifies, so blocks become candidates by a join on those words.
Length (a block has o words of the template vocabulary at least) and position
(words before, at and after the shared word) bound the overlap further, and
what is left is verified exactly.

The only things broadcast are the templates' own words and prefixes, whose
number is fixed by ``TEMPLATES``.

Besides the join, fixed phrases (``PHRASES``) are located exactly: places
where their words stand consecutively.

Defined results: null text is empty; words are compared with A-Z lower-cased
only; a block repeated in a text counts once; rows repeating a doc_id are told
apart by their text's hash; each input row gives one output row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.llm.common import materialize

#: Phrases located word by word, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Template sentences, and their labels.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
]
NOT_WORD = r"\x00-\x2F\x3A-\x60\x7B-\x7F"  # of lower-cased text
WORD = f"[^{NOT_WORD}]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case.  Other letters change too, but never into ASCII (the
    one that would, the Kelvin sign, is put out of the way), so no word becomes
    or stops being one of the ASCII words looked for, and no border moves."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b")))


def words(lower: Column) -> Column:
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _phrase_pattern(phrase: str) -> str:
    return rf"(?<![^{NOT_WORD}])" + rf"[{NOT_WORD}]++".join(phrase.split()) + rf"(?![^{NOT_WORD}])"


def _literals(values) -> Column:
    return F.array(*[F.lit(x) for x in values])


def read_words(docs: DataFrame, doc_id: str, text: str, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """The one pass over whole texts: (doc_id, text_hash, n_words, held: the
    words of phrases and templates that stand in the text, lower: the text, if
    it may hold a phrase or a template at all)."""
    vocabulary = sorted({w for t, _ in templates for w in t.split()} | {w for t in PHRASES for w in t.split()})
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
                       lowered(F.col(f"`{text}`")).alias("lower"))
    rows = rows.withColumn("words", words(F.col("lower")))
    rows = rows.select("doc_id", "text_hash", "lower", F.size("words").cast("long").alias("n_words"),
                       F.array_intersect(_literals(vocabulary), "words").alias("held"))
    enough = [(set(t.split()), _least(t, threshold)) for t, _ in templates] + [(set(t.split()), None) for t in PHRASES]
    may = F.lit(False)
    for own, need in enough:
        may = may | (F.size(F.array_intersect("held", _literals(sorted(own)))) >= (need or len(own)))
    return rows.withColumn("lower", F.when(may, F.col("lower")))


def frequencies(read: DataFrame) -> dict[str, int]:
    """In how many texts of the corpus each word of the vocabulary stands: one
    row per word of the vocabulary at most."""
    counted = read.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


def _least(template: str, threshold: float) -> int:
    """Distinct words of a template that a block must hold."""
    return math.ceil(threshold * len(set(template.split())) - 1e-9)


def _run(template: str, threshold: float) -> int:
    """Words of a run that may hold a template across line breaks."""
    return math.ceil(len(template.split()) / threshold - 1e-9)


def template_matches(read: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, label, containment) of every block with a run of
    words that holds a template."""
    frequency = frequencies(read)
    order = sorted({w for t, _ in templates for w in t.split()}, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    index = []
    for number, (text, label) in enumerate(templates):
        own, need = sorted(set(text.split()), key=rank.__getitem__), _least(text, threshold)
        index += [(w, number, label, own, j, _run(text, threshold), need) for j, w in enumerate(own[:len(own) - need + 1])]
    prefix = read.sparkSession.createDataFrame(
        index, "prefix_word string, template int, label string, own array<string>, j int, run int, need int")
    texts = read.where("lower is not null")
    longest = max(_run(t, threshold) for t, _ in templates)
    several = texts.select("doc_id", "text_hash", words(F.col("lower")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(longest))
    # every run of up to ``longest`` words lies in a block
    blocks = several.select("doc_id", "text_hash", F.explode(F.transform(
        starts, lambda at: F.slice("words", at, F.lit(2 * longest - 1)))).alias("block"))
    # the block's words of the template vocabulary, in global order
    blocks = blocks.withColumn("held", F.array_intersect(_literals(order), "block"))
    blocks = blocks.where((F.size("held") >= min(r[-1] for r in index))
                          & F.arrays_overlap("held", _literals(sorted({r[0] for r in index}))))
    candidates = blocks.select("*", F.posexplode("held").alias("i", "word")).join(
        F.broadcast(prefix), F.col("word") == F.col("prefix_word"))
    length = F.size("held") >= F.col("need")
    position = (F.least("i", "j") + 1 + F.least(F.size("held") - F.col("i"), F.size("own") - F.col("j")) - 1
                >= F.col("need"))
    overlap = F.size(F.array_intersect("held", "own"))
    in_run = F.array_max(F.transform(F.sequence(F.lit(1), F.size("block")), lambda at: F.size(
        F.array_intersect(F.slice("block", at, F.col("run")), F.col("own")))))
    candidates = candidates.where(length & position).withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
    candidates = candidates.withColumn("overlap", in_run)
    return (candidates.where(F.col("overlap") >= F.col("need"))
            .select("doc_id", "text_hash", "label", (F.col("overlap") / F.size("own")).alias("containment")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) of every row: places of the phrases, their labels, and those of the
    templates; score is the best containment, 1 with a phrase."""
    read = materialize(read_words(docs, doc_id, text, threshold=threshold), "license-words")
    found = template_matches(read, threshold=threshold).groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    found = found.select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"), "found", "best")
    n_words = lambda c: F.size(words(c)).cast("long")
    located = read
    for k, phrase in enumerate(PHRASES):
        has = F.col("lower").rlike(_phrase_pattern(phrase))
        located = located.withColumn(f"pieces_{k}", F.when(has, F.split("lower", _phrase_pattern(phrase), -1)))
        located = located.withColumn(f"at_{k}", F.when(F.col(f"pieces_{k}").isNotNull(), F.struct(
            (F.size(f"pieces_{k}") - 1).cast("long").alias("n"),
            n_words(F.element_at(f"pieces_{k}", 1)).alias("first"),
            (F.col("n_words") - n_words(F.element_at(f"pieces_{k}", -1)) - len(phrase.split())).alias("last"))))
    count = range(len(PHRASES))
    base = F.array_compact(F.array(*[F.when(F.col(f"at_{k}").isNotNull(), F.lit(label))
                                     for k, label in enumerate(PHRASES.values())]))
    located = located.select(
        "doc_id", "text_hash", "n_words",
        sum((F.coalesce(F.col(f"at_{k}.n"), F.lit(0)) for k in count), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[F.col(f"at_{k}.first") for k in count]).alias("first_word"),
        F.greatest(*[F.col(f"at_{k}.last") for k in count]).alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base"))
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash"))
    both = located.join(found, same, "left")
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"))
