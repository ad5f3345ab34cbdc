"""Personal data: patterns propose, checksums confirm, context adjusts.

Column expressions only.  Regular expressions propose spans of each kind;
validators drop proposals (Luhn for cards, mod-97 for IBANs, the range of IP
parts, the number of digits).  Every span has a score: its kind's prior, raised
when one of the kind's context words stands within 40 characters, lowered when
a word that denies it does (order, version, ...).  Base kinds are always kept;
the kinds the method adds (iban, ssn, secret) need a score of ``MIN_SCORE``.

Positions come from the text between matches: a span starts after the summed
lengths of what precedes it.  The sums run over blocks of ``RUN`` matches, so
texts with very many matches stay near linear.  The patterns use possessive
repeats and look-behinds that forbid starting inside a run that has failed
already, so long runs of letters or digits are scanned once.

Defined results: null text has no spans (and stays null when masked); spans of
different kinds may overlap; positions are code points, end exclusive; each
input row gives one output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 64
CONTEXT = 40
MIN_SCORE = 0.5
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")

#: Length of an IBAN by country, of the registry and of the codes
#: in use beside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CM CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR",
    27: "BI CF CG DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    """As many characters as the country's IBANs have, in groups of four with or
    without spaces between, so no following word is taken in.  Codes without a
    length may have any, up to where the next IBAN begins."""
    known = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    classes = []
    for n, codes in IBAN_LENGTHS.items():
        groups, rest = divmod(n - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        classes.append(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    gap = rf"(?:\x20(?!(?:{known})[0-9]{{2}}\x20?[A-Z0-9]{{4}}))?"
    classes.append(rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:{gap}[A-Z0-9]{{4}}){{2,7}}(?:{gap}[A-Z0-9]{{1,3}})?")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(classes)})(?![A-Za-z0-9])"


#: Proposing pattern of each kind.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban_pattern(),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{20,512}+={0,2}(?![A-Za-z0-9_+/=-])",
}
#: Prior score, supporting and denying context words of each kind.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "secret": 0.3}
SUPPORT = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|host|server|login", "card": "card|visa|master|credit|payment",
    "phone": "phone|call|tel|mobile|fax", "iban": "iban|account|bank|transfer", "ssn": "ssn|social|security",
    "secret": "token|secret|passw|api.?key|access.?key|bearer|credential",
}
DENY = {
    "email": "example|noreply", "ip": "version|release|build", "card": "order|serial|isbn|tracking",
    "phone": "order|serial|score", "iban": "serial|version", "ssn": "order|serial|part",
    "secret": "sha-?[0-9]|md5|checksum|commit|digest",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(F.length(c) == 0, acc).otherwise(
        (acc * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97).cast("int"))


def confirmed(kind: str, match: Column) -> Column:
    """Whether a proposed match passes its kind's validator."""
    if kind == "ip":
        return match.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(14, 19) & F.call_function(
            "luhn_check", F.when(F.length(digits) <= 19, digits).otherwise(F.lit("1")))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return _mod97(match) == 1
    if kind == "secret":  # letters and digits mixed, many different ones
        return match.rlike("[A-Za-z]") & match.rlike("[0-9]") & (F.size(F.array_distinct(F.split(match, ""))) >= 10)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9[0-9]{2})-|-00-|-0000$")
    return F.lit(True)


def _score(kind: str, before: Column, after: Column) -> Column:
    near = F.lower(F.concat_ws(" ", F.substring(before, -CONTEXT, CONTEXT), F.substring(after, 1, CONTEXT)))
    score = F.lit(PRIOR[kind]) + F.when(near.rlike(SUPPORT[kind]), 0.2).otherwise(0.0) - F.when(
        near.rlike(DENY[kind]), 0.3).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def _block_spans(kind: str, block: Column) -> Column:
    """(length, spans with starts relative to the block) of up to RUN matches."""
    rank = F.lit(KINDS.index(kind))
    empty = F.array().cast("array<struct<start:int,kind_rank:int,end:int,score:double,match:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        score = _score(kind, x["piece"], x["after"])
        span = F.struct(start.alias("start"), rank.alias("kind_rank"), end.alias("end"), score.alias("score"),
                        x["match"].alias("match"))
        good = confirmed(kind, x["match"])
        if kind not in BASE:
            good = good & (score >= MIN_SCORE)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(
            acc["spans"]).alias("spans"))

    return F.aggregate(block, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)


def _kind_spans(kind: str, found: Column, pieces: Column) -> Column:
    """All confirmed spans of a kind, from its matches and what lies between."""
    zipped = F.zip_with(F.arrays_zip(found.alias("match"), F.slice(pieces, F.lit(2), F.size(found)).alias("after")),
                        F.slice(pieces, F.lit(1), F.size(found)),
                        lambda x, piece: F.struct(piece.alias("piece"), x["match"].alias("match"), x["after"].alias("after")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / RUN).cast("int")),
                         lambda b: _block_spans(kind, F.slice(zipped, b * RUN + 1, F.lit(RUN))))
    empty = F.array().cast("array<array<struct<start:int,kind_rank:int,end:int,score:double,match:string>>>")
    moved = F.aggregate(
        blocks, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["spans"], F.array(F.transform(
            b["spans"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), s["kind_rank"].alias("kind_rank"),
                                           (s["end"] + acc["at"]).alias("end"), s["score"].alias("score"),
                                           s["match"].alias("match"))))).alias("spans")))
    return F.flatten(moved["spans"])


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row: the input row, spans: array of start, kind_rank, end, score, match
    in order of start and kind) per input row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return _with_spans(rows, ["row"], F.col("row").getField(text))


def _with_spans(rows: DataFrame, keep: list[str], text: Column) -> DataFrame:
    """The columns ``keep`` and the spans of ``text``."""
    content = F.coalesce(text, F.lit(""))
    out = rows.withColumns({f"found_{k}": F.regexp_extract_all(content, F.lit(PATTERNS[k]), F.lit(0)) for k in KINDS})
    nothing = F.array().cast("array<struct<start:int,kind_rank:int,end:int,score:double,match:string>>")
    some = {k: F.size(f"found_{k}") > 0 for k in KINDS}
    out = out.withColumns({f"pieces_{k}": F.when(some[k], F.split(content, PATTERNS[k], -1)) for k in KINDS})
    out = out.withColumns({f"spans_{k}": F.when(some[k], _kind_spans(k, F.col(f"found_{k}"), F.col(f"pieces_{k}")))
                           .otherwise(nothing) for k in KINDS})
    return _apart(out, keep, spans=F.array_sort(F.concat(*[F.col(f"spans_{k}") for k in KINDS])))


def _apart(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The columns ``keep`` and new ones, these behind a generator of one row:
    what is built on them (a filter, say) names them and does not repeat their
    expressions."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def of_kind(found: Column, *kinds: str) -> Column:
    ranks = [KINDS.index(k) for k in kinds]
    return F.filter(found, lambda s: s["kind_rank"].isin(ranks))


def written(found: Column) -> Column:
    """Spans as kind:start:end joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind_rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _regions(found: Column) -> Column:
    """Spans in order of start, overlapping ones merged; the earliest kind
    names the region."""
    empty = F.array().cast("array<struct<start:int,end:int,rank:int>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind_rank"].alias("rank"))
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), F.least(last["rank"], s["kind_rank"]).alias("rank"))
        overlaps = F.when(F.size(acc) > 0, s["start"] < last["end"]).otherwise(F.lit(False))
        return F.when(overlaps, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(both))).otherwise(F.concat(acc, F.array(own)))

    return F.aggregate(found, empty, step)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every confirmed span replaced by its kind in angle
    brackets, in one pass over the spans; overlapping spans are hidden together
    under the kind that is listed first."""
    # plain columns under names of their own: fields of a struct do not pass two generators
    names = {c: f"column_{j}" for j, c in enumerate(docs.columns)}
    keep, content = list(names.values()), F.col(names[text])
    rows = _with_spans(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), keep, content)
    rows = _apart(rows, keep, regions=_regions(F.col("spans")))
    masks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def piece(r: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(0)).otherwise(F.get("regions", i - 1)["end"])
        return F.concat(F.substr(content, before + 1, r["start"] - before), F.element_at(masks, r["rank"] + 1))

    hidden = F.concat(F.array_join(F.transform("regions", piece), ""), F.substr(content, F.element_at("regions", -1)["end"] + 1))
    rows = _apart(rows, keep, masked=F.when(F.size("regions") > 0, hidden).otherwise(content))
    return rows.select(*[F.col("masked" if c == text else n).alias(c) for c, n in names.items()])
