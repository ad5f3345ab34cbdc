"""Every corpus query with an oracle equals it in DuckDB."""

import duckdb
import pytest
from llm_cases import SF

from countpanel.llm.queries import ORACLES, QUERIES


def cells(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLES[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert cells(got.select(*order).collect()) == cells(want.select(", ".join(order)).fetchall())
