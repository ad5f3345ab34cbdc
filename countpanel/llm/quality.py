"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: one map pass over the whole text
yields the measurements, and one expression turns them into a mask with a bit
per failed rule.  The ledger (measurements and mask) is stored; policies, which
are versioned sets of rules, are applied to it later without touching texts.
Ablations (how many documents each rule rejects, alone or first) come from
bitwise aggregation over the few distinct masks.

Defined results: null text has no words, lines or symbols and fails the rules
that a text without words fails; ratios over zero words or lines are zero;
each input row gives one ledger row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import byte_texts, ship

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that begin no code point
SHOUT = re.compile(rb"[A-Z]{2,}[^a-z\x80-\xff]*\Z")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_symbol_words",
            "n_upper_words", "n_unique_words"]



def _rules() -> dict[str, tuple[int, Column]]:
    c = F.col
    failing = [
        ("few_words", c("n_words") < 50),
        ("repeated_trigrams", 100 * c("n_repeat_words") > 50 * c("n_words")),
        ("symbols", 10 * c("n_symbols") > c("n_words")),
        ("duplicate_lines", (c("n_dup_lines") >= 4) & (100 * c("n_dup_lines") > 30 * c("n_lines"))),
        ("short_words", c("word_chars") < 3 * c("n_words")),
        ("long_words", c("word_chars") > 12 * c("n_words")),
        ("upper_case", 100 * c("n_upper_words") > 30 * c("n_words")),
        ("few_distinct_words", 100 * c("n_unique_words") < 15 * F.least(c("n_words"), F.lit(400))),
    ]
    return {name: (bit, condition) for bit, (name, condition) in enumerate(failing)}


#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_trigrams"),
    "v1": ("few_words", "repeated_trigrams", "symbols", "duplicate_lines", "short_words", "long_words", "upper_case",
           "few_distinct_words"),
}


def repeat_words(codes: np.ndarray) -> int:
    """Words under three-word windows that stand twice or more."""
    n = len(codes) - 2
    if n < 2:
        return 0
    size = np.int64(codes.max()) + 1
    if size < 2_000_000:  # three codes fit in 63 bits
        key = (codes[:-2] * size + codes[1:-1]) * size + codes[2:]
    else:
        pairs = np.unique(codes[:-1] * size + codes[1:], return_inverse=True)[1].astype(np.int64)
        key = pairs[:-1] * size + codes[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[np.append(False, same) | np.append(same, False)]] = True
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift:shift + n] |= again
    return int(covered.sum())


def measure(raw: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = raw.split()
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in raw.split(b"\n"):
        if not line or line.isspace():
            continue
        n_lines += 1
        if line in seen:
            n_dup += 1
        else:
            seen.add(line)
    joined = b"".join(words)
    upper = symbol_words = 0
    if len(numbers):
        counts = np.bincount(codes)
        distinct = list(numbers)
        upper = int(sum(c for w, c in zip(distinct, counts.tolist()) if w[:2].isupper() and SHOUT.match(w)))
        symbol_words = int(sum(c for w, c in zip(distinct, counts.tolist()) if w[-1] in SYMBOLS or w[0] in SYMBOLS))
    return (len(words), len(joined.translate(None, CONTINUATION)), len(joined.translate(None, NOT_SYMBOLS)), n_lines,
            n_dup, repeat_words(codes), symbol_words, upper, len(numbers))


def _measure_task(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            values = np.array([measure(raw) for _, raw in byte_texts(row.field(text))], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([row, *(pa.array(values[:, k]) for k in range(len(MEASURES)))],
                                             ["row", *MEASURES])

    return run


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row: the input row, or its columns ``keep``, the measurements, mask)
    per input row."""
    wanted = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*wanted, text])]).alias("row"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    measured = rows.mapInArrow(_measure_task(text), schema)
    mask = F.lit(0).cast("long")
    for bit, failed in _rules().values():
        mask = mask.bitwiseOR(F.when(failed, F.lit(1 << bit)).otherwise(0).cast("long"))
    return measured.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in wanted])).withColumn(
        "mask", mask)


def policy_mask(policy: str) -> int:
    rules = _rules()
    return sum(1 << rules[name][0] for name in POLICIES[policy])


def kept(mask: Column, policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return mask.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def only_rule(mask: Column, policy: str) -> Column:
    """The one rule of the policy that a ledger row fails, null if there are
    none or several: without it the policy would keep the document."""
    failed = mask.bitwiseAND(F.lit(policy_mask(policy)).cast("long"))
    out = F.lit(None).cast("string")
    for name in POLICIES[policy]:
        out = F.when(failed == 1 << _rules()[name][0], F.lit(name)).otherwise(out)
    return out


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else,
    and that the policy would keep without it.  The ledger is reduced to its
    distinct masks first (at most 2^rules rows)."""
    rules, whole = _rules(), policy_mask(policy)
    masks = book.groupBy(F.col("mask").bitwiseAND(F.lit(whole).cast("long")).alias("mask")).agg(F.count("*").alias("n"))
    out = []
    for name in POLICIES[policy]:
        bit = 1 << rules[name][0]
        failed = F.col("mask").bitwiseAND(F.lit(bit).cast("long")) != 0
        total = [F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (
            failed, F.col("mask") == bit, F.col("mask").bitwiseAND(F.lit(whole & ~bit).cast("long")) == 0)]
        out += [F.struct(F.lit(name).alias("rule"), *(F.coalesce(t, F.lit(0)).alias(a) for t, a in zip(
            total, ("n_failed", "n_only", "n_kept_without"))))]
    return masks.agg(F.array(*out).alias("rules")).select(F.explode("rules").alias("r")).select("r.*")


ship(__name__)
