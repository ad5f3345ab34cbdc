"""URL filters by path templates.

Fixed rules (host suffix and path prefix, the longest fitting one) decide the
urls they fit.  The others are judged by a tree of path templates per host,
grown level by level from the distinct urls of the corpus:

* a segment stays literal if its branch holds ``min_count`` urls and its labels
  differ from the typical (median) branch of the node by a two-proportion test,
  whatever its share of the node; all other segments of the node become one
  wildcard, so variable segments are generalised and statistically similar
  branches merge;
* a template (host and its generalised segments) is rejected if its labelled
  purity, the share of bad ones among its labelled urls smoothed towards a
  neutral prior, reaches ``reject_at``; thin labels stay near the prior.

Labels are the rules' own verdicts unless a label table is given.  Urls are
reduced to distinct (host, path) with counts before the tree is grown, every
level is one pre-aggregated count per (host, branch, segment) joined back, and
the branches are cut into the shared folder between levels, so a host with a
third of all rows is spread by its branches.

Defined results: null urls and urls without ``://`` have an empty host and
path, fit no rule and are allowed; segments past ``depth`` count as one more
segment, judged like any other (its wildcard is ``**``);
each input row gives one output row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    rule: str  # host, then path
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


#: The rules of the registered query.
RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"),
         Rule("org/fr/", "allow"))


@dataclass(frozen=True)
class TreeParams:
    depth: int = 6
    min_count: int = 10  # urls that a literal branch needs
    z: float = 3.0  # difference of label shares that keeps a branch apart
    prior: float = 0.5  # neutral purity
    strength: float = 4.0  # pseudo-urls of the prior
    reject_at: float = 0.8


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as (rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):  # later ones win
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _z(share: Column, n: Column, typical: Column) -> Column:
    """Two-proportion statistic of a branch against the node's typical branch
    of the same size."""
    pooled = (share * n + typical * n + 1) / (2 * n + 2)
    return F.abs(share - typical) / F.sqrt(pooled * (1 - pooled) * 2 / n)


def templates(paths: DataFrame, params: TreeParams = TreeParams()) -> DataFrame:
    """(host, path, template) of distinct (host, path) rows with the columns
    n, n_bad, n_good."""
    pieces = F.filter(F.split("path", "/"), lambda s: s != "")
    tail = F.when(F.size("pieces") > params.depth, F.array(F.array_join(F.slice("pieces", params.depth + 1, F.size("pieces")), "/"))).otherwise(
        F.array().cast("array<string>"))
    tree = paths.withColumn("pieces", pieces).withColumn(
        "segments", F.concat(F.slice("pieces", 1, params.depth), tail)).drop("pieces").withColumn("template", F.lit(""))
    for level in range(params.depth + 1):
        wildcard = "*" if level < params.depth else "**"
        here = F.get("segments", F.lit(level))
        open_rows = tree.withColumn("segment", here)
        branch = open_rows.where("segment is not null").groupBy("host", "template", "segment").agg(
            *[F.sum(c).alias(c) for c in ("n", "n_bad", "n_good")])
        shares = {f"share_{c}": F.col(c) / F.col("n") for c in ("n_bad", "n_good")}
        frequent = branch.where(F.col("n") >= params.min_count).withColumns(shares)
        # branches of equal shares are counted together first: a node's median has few values to sort
        alike = frequent.groupBy("host", "template", *shares).agg(F.sum("n").alias("n"))
        typical = alike.groupBy("host", "template").agg(
            *[F.percentile(c, 0.5, F.col("n")).alias(f"typical_{c}") for c in shares])
        apart = F.greatest(*[_z(F.col(c), F.col("n"), F.col(f"typical_{c}")) for c in shares])
        literal = frequent.join(typical, ["host", "template"]).where(apart >= params.z).select(
            "host", "template", "segment", F.lit(True).alias("literal"))
        tree = materialize(
            open_rows.join(literal, ["host", "template", "segment"], "left").withColumn(
                "template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(
                    F.concat("template", F.lit("/"), F.when(F.col("literal"), F.col("segment")).otherwise(wildcard))))
            .select("host", "path", "n", "n_bad", "n_good", "segments", "template"), "url-tree")
    return tree


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, params: TreeParams = TreeParams(),
          url: str = "url", bad: Column | None = None) -> DataFrame:
    """(row: the input row, host, path, rule, verdict, template, purity) per
    input row.  ``bad`` is a boolean column of ``pages`` that labels urls; the
    default is the rules' verdict (no label where no rule fits)."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                        host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"),
                        *([bad.alias("bad")] if bad is not None else []))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    if bad is None:
        rows = rows.withColumn("bad", F.col("found.verdict") == "block")
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("bad"), 1).otherwise(0)).alias("n_bad"),
        F.sum(F.when(~F.col("bad"), 1).otherwise(0)).alias("n_good"))
    tree = templates(materialize(paths, "url-paths"), params)
    purity = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "n_bad", "n_good")])
    labelled = F.col("n_bad") + F.col("n_good")
    purity = purity.select(
        "host", "template", ((F.col("n_bad") + params.strength * params.prior) / (labelled + params.strength)).alias("purity"))
    judged = tree.select("host", "path", "template").join(purity, ["host", "template"])
    rejected = F.col("purity") >= params.reject_at
    return rows.join(judged, ["host", "path"], "left").select(
        "row", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(rejected, "block").otherwise("allow")).alias("verdict"), "template", "purity")
