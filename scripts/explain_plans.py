"""Write the formatted physical plans of the headline queries to PLANS.md.

usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from countpanel.plans.registry import load_all, runner  # noqa: E402
from countpanel.session import get_session  # noqa: E402

KEEP = ("Scan parquet", "PushedFilters", "ReadSchema", "Exchange", "BroadcastExchange", "HashAggregate",
        "BroadcastHashJoin", "SortMergeJoin", "Window", "WindowGroupLimit", "TakeOrderedAndProject",
        "Generate", "Expand")


def summary(text: str) -> list[str]:
    """Operator outline of the formatted plan (the tree part)."""
    tree = text.split("\n\n")[0]
    return [ln for ln in tree.splitlines() if ln.strip()]


def details(text: str) -> list[str]:
    out = []
    for ln in text.splitlines():
        if ln.startswith(("PushedFilters", "ReadSchema")):
            out.append(ln)
    return sorted(set(out))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    reg = load_all()
    parts = ["# Physical plans of the headline queries", "",
             f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf)}` (local[8], AQE on; the",
             "initial plan before runtime re-optimisation). Operator outline plus the scan pushdown details.", ""]
    texts = {}
    for name in HEADLINE:
        df = runner(reg[name])(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        texts[name] = buf.getvalue()
    parts += ["| query | shuffle exchanges | broadcasts | sort-merge joins | broadcast joins | windows | "
              "partial top-k limits | scans with pushed filters |", "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, text in texts.items():
        tree = text.split("\n\n")[0]
        ex = tree.count("Exchange (") - tree.count("BroadcastExchange (")
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
        parts.append(f"| {name} | {ex} | {tree.count('BroadcastExchange (')} | {tree.count('SortMergeJoin')} | "
                     f"{tree.count('BroadcastHashJoin')} | {tree.count('Window (')} | "
                     f"{tree.count('WindowGroupLimit (')} | {pushed} |")
    parts.append("")
    for name in HEADLINE:
        text = texts[name]
        parts += [f"## {name}", "", (reg[name].doc or "").splitlines()[0] if reg[name].doc else "", "", "```"]
        parts += summary(text)
        parts += ["```", ""]
        det = details(text)
        if det:
            parts += ["```"] + [re.sub(r"\s+", " ", d)[:400] for d in det] + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
