"""License scans against brute force."""

import math
import re

from llm_cases import by_row, documents, edge_docs, edge_rows, empty_docs, lower_ascii

from countpanel.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, threshold=0.8):
    lower = lower_ascii(text)
    words = WORD.findall(lower)
    starts, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    labels, best = set(base), 1.0 if base else 0.0
    for template, label in licenses.TEMPLATES:
        own, run = set(template.split()), math.ceil(len(template.split()) / threshold - 1e-9)
        need = math.ceil(threshold * len(own) - 1e-9)
        if len(own & set(words)) < need:
            continue
        for k in range(len(words)):  # every run of words, whatever its lines
            n = len(own & set(words[k:k + run]))
            if n >= need:
                labels.add(label)
                best = max(best, n / len(own))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), best)


ODD = ["Released under the MIT License.", "UNDER, the;mit\nlicense", "under the mit licenses", "xunder the mit license",
       "cc by nc cc-by-nc CC BY\tNC", "apache license version 2 apache license version 20",
       "under the mit license under the mit license\nApache License, Version 2.0 and CC BY-NC 4.0",
       "This work is licensed under GNU General Public License, version 3.", "the the the the the", "É under the mit licenseé",
       "permission is hereby granted, free of charge to any person obtaining copy of the software",
       "This Source Code Form is subject to the terms of the Mozilla Public License\n" * 3, "K cc by nc", "cc by nc" * 3, "this wor\u212a is licensed", "under the m\u0130t license", "\u212a under the MIT LICENSE \u0130"]


def test_equal_brute_force(spark):
    rows = [*edge_rows(), *documents(), *[(1000 + k, t) for k, t in enumerate(ODD)]]
    got = licenses.scan(edge_docs(spark, rows)).collect()
    assert by_row(got) == by_row((i, *brute(t)) for i, t in rows)


def test_frequencies_cover_all_texts(spark):
    rows = documents()
    counts = {}
    for _, t in rows:
        for w in set(WORD.findall(lower_ascii(t))):
            counts[w] = counts.get(w, 0) + 1
    got = licenses.frequencies(licenses.read_words(edge_docs(spark, rows), "doc_id", "text"))
    vocabulary = {w for t in [*licenses.PHRASES, *(t for t, _ in licenses.TEMPLATES)] for w in t.split()}
    assert got == {w: counts[w] for w in vocabulary if w in counts}


GPL = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
       "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
BSD = ["Redistribution and use in source and binary forms, with or without",
       "modification, are permitted provided that the following conditions", "are met:"]


def test_wrapped_notices(spark):
    """Notices over several lines, at every place relative to the pieces."""
    rows = [(k, "word " * k + "\n" + "\n".join(GPL)) for k in range(60)]
    rows += [(100 + k, "word\n" * k + "\n# ".join(BSD) + "\nword" * 70) for k in range(60)]
    rows += [(200, "\r\n * ".join(GPL)), (201, "\n".join(" ".join(BSD).split())), (202, "\n\n".join(GPL + BSD)),
             (203, "\n".join(w + "\nand so on, word by word" for w in " ".join(GPL + BSD).split())), (204, "\n" * 9), (205, GPL[0])]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(edge_docs(spark, rows)).collect()}
    assert all(got[k] == ("gpl-3", 1.0) and got[100 + k] == ("bsd", 1.0) for k in range(60))
    assert [got[k] for k in range(200, 206)] == [("gpl-3", 1.0), ("bsd", 1.0), ("bsd,gpl-3", 1.0), ("", 0.0), ("", 0.0), ("", 0.0)]
    assert got == {k: brute(t)[5:] for k, t in rows}


def test_scattered_words_of_a_long_line_are_no_notice(spark):
    """A template's words far apart on one line; together again; a very long line."""
    gpl = " ".join(GPL).split()
    far = " ".join(" ".join([w, *["word"] * 300]) for w in gpl)
    rows = [(1, far), (2, far + " " + " ".join(GPL)), (3, "word " * 100_000 + " ".join(BSD))]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(edge_docs(spark, rows)).collect()}
    assert got == {1: ("", 0.0), 2: ("gpl-3", 1.0), 3: ("bsd", 1.0)}


def test_empty(spark):
    assert licenses.scan(empty_docs(spark)).count() == 0


def test_no_python_and_no_data_sized_broadcast(spark):
    plan = licenses.scan(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
