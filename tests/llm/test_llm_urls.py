"""URL filters: hosts, paths and rules against brute force; the template tree."""

from llm_cases import CLASH, SF
from pyspark.sql import functions as F

from countpanel.llm import urls


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.rule), default=None)
    return host, path, rule


ODD = [None, "", "no scheme", "://", "http://", "http://x.net", "http://x.net/", "http://NET/a", "HTTP://A.Example.NET/en/1?x#y",
       "http://example.net/en", "http://example.com/de/1", "http://notexample.com/de/1", "http://a.org/fr/", "http://org/fr/x",
       "http://a.b?x=/de/", "http://a.b#/c", "x://y://z/w", "http://é.net/ü?", "http://a.net\n/b\nc", "http://É.ORG/fr/1",
       "http://u:p@h.net:80/a//b///c/d/e/f/g/h/i"]


def table(spark, rows):
    return spark.createDataFrame([(i, u, None) for i, u in rows], "page_id long, url string, verdict string")


def judged(spark, rows, **kw):
    return urls.judge(table(spark, rows), **kw).collect()


def test_hosts_paths_and_rules(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    rows = [*pages, *[(10_000 + k, u) for k, u in enumerate([*ODD, *ODD])], (None, "http://x.net/")]
    out = judged(spark, rows)
    assert len(out) == len(rows)
    for r in out:
        host, path, rule = brute(r.row.url)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.rule)
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)


def test_pure_bad_templates_are_rejected_and_others_merge(spark):
    rows = [(k, f"http://h.com/shop/item/{k}") for k in range(200)]
    rows += [(1000 + k, f"http://h.com/win/prize/{k}/") for k in range(200)]
    rows += [(2000 + k, f"http://h.com/{('news', 'blog')[k % 2]}/{k}") for k in range(200)]
    pages = table(spark, rows)
    label = F.when(F.col("page_id") % 10 < 7, F.col("url").contains("/win/"))
    got = {r.row.page_id: r for r in urls.judge(pages, (), bad=label).collect()}
    assert {got[1000 + k].verdict for k in range(200)} == {"block"}
    assert {got[i].verdict for i, _ in rows if not 1000 <= i < 2000} == {"allow"}
    assert {got[1000 + k].template for k in range(200)} == {"/win/*/*"}
    assert {got[2000 + k].template for k in range(200)} == {"/*/*"}


def test_sparse_labels_reject_nothing(spark):
    rows = [(k, f"http://h.com/a/{k}") for k in range(100)]
    bad = F.when(F.col("page_id") == 1, F.lit(True))
    assert {r.verdict for r in urls.judge(table(spark, rows), (), bad=bad).collect()} == {"allow"}


def test_small_sections_of_a_large_host_are_judged(spark):
    """A hundred sections of one per cent each, half of them purely bad; with
    all urls labelled, and with two in five."""
    rows = [(k, f"http://h.com/s{k % 100}/item/{k}") for k in range(20_000)]
    for labelled in (10, 4):
        bad = F.when(F.floor(F.col("page_id") / 100) % 10 < labelled, F.col("page_id") % 2 == 0)
        got = {r["row.page_id"]: r.verdict for r in urls.judge(table(spark, rows), (), bad=bad).select(
            F.col("row.page_id").alias("row.page_id"), "verdict").collect()}
        assert all(got[i] == ("block" if i % 2 == 0 else "allow") for i, _ in rows)


def test_segments_past_depth_are_judged_as_one(spark):
    deep = "a/b/c/d/e/f"
    rows = [(k, f"http://h.com/{deep}/{('win/big', 'news')[k % 2]}") for k in range(100)] + [(1000 + k, f"http://h.com/{deep}/x{k}/y") for k in range(100)]
    rows += [(5000, None), (5001, "h.com/" + deep)]
    got = {r.row.page_id: r for r in urls.judge(table(spark, rows), (), bad=F.col("url").contains("/win/")).collect()}
    assert {got[k].verdict for k in range(0, 100, 2)} == {"block"} and {got[k].verdict for k in range(1, 100, 2)} == {"allow"}
    assert got[0].template == "/*/*/*/*/*/*/win/big" and {got[1000 + k].template for k in range(100)} == {"/*/*/*/*/*/*/**"}
    assert (got[5000].verdict, got[5001].verdict, got[5000].host) == ("allow", "allow", "")


def test_empty_and_columns(spark):
    assert judged(spark, []) == []
    out = urls.judge(spark.createDataFrame([(1, "http://x.net/a", *([None] * len(CLASH)))],
                                           "page_id long, url string, " + ", ".join(f"`{c}` string" for c in CLASH)))
    assert out.first().row.page_id == 1
