"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and an order-insensitive value hash.

usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from countpanel.fixtures import TABLES  # noqa: E402
from countpanel.plans.registry import load_all, runner  # noqa: E402
from countpanel.session import get_session  # noqa: E402


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, datetime.datetime):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, datetime.date):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0.0 and math.copysign(1.0, v) < 0:
            return "-0.0"
        if v.is_integer() and abs(v) < 2**53:
            return repr(int(v))
        return repr(v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return repr(v)


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_session(f"local[{os.environ.get('CHECK_CPUS', '8')}]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    ok = bad = skipped = 0
    for name, q in reg.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = runner(q)(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS {name}: {len(sdf)} rows ({ts:.1f}s)")
            skipped += 1
            continue
        try:
            ddf = con.execute(q.sql).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows(sdf)
        dc, dr = rows(ddf)
        if sc != dc:
            print(f"FAIL {name}: columns spark={sc} duck={dc}")
            bad += 1
        elif len(sr) != len(dr):
            print(f"FAIL {name}: rows spark={len(sr)} duck={len(dr)}")
            bad += 1
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"FAIL {name}: values differ ({len(sr)} rows) e.g. {diff}")
            print("   dtypes spark", dict(sdf.dtypes), "duck", dict(ddf.dtypes))
            bad += 1
        else:
            kinds = lambda df: {c: ("int" if str(t).lower().startswith(("int", "uint")) else
                                    "float" if str(t).startswith("float") else
                                    "time" if "datetime" in str(t) or "M8" in str(t) else str(t))
                                for c, t in df.dtypes.items()}
            sk, dk = kinds(sdf), kinds(ddf)
            widths = {c: (str(sdf.dtypes[c]), str(ddf.dtypes[c])) for c in sk
                      if sk[c] == dk.get(c) == "int" and str(sdf.dtypes[c]).lower() != str(ddf.dtypes[c]).lower()}
            kind_diff = {c: (sk[c], dk.get(c)) for c in sk if sk[c] != dk.get(c)}
            note = ""
            if widths or kind_diff:
                note = f" [dtypes: widths {widths} kinds {kind_diff}]"
            print(f"ok   {name}: {len(sr)} rows ({ts:.1f}s){note}")
            ok += 1
    print(f"== ok {ok}, fail {bad}, rows-only {skipped}")


if __name__ == "__main__":
    main()
