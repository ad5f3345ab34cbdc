"""Registry of named queries: a Spark builder plus (where SQL can express
it) the DuckDB oracle text over the same fixture views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from countpanel.fixtures import Fixtures, with_views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Fixtures], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}

# Date-valued output columns of the registered queries.  Both engines emit
# them as midnight timestamps (Spark: every DATE output column, see
# ``runner``; oracle: the columns listed here), so a checker sees one
# temporal type on both sides whatever client conversion it uses.
DATE_OUTPUTS: dict[str, list[str]] = {
    "p19_dedupe": ["ds"], "a20_kpis": ["first_day", "last_day"], "q1_incomplete_days": ["day"],
    "q2_month_coverage": ["month"], "v2_verify_by_day": ["day"], "f12_temporal_split": ["ds"],
    "f13_ordered_split": ["ds"], "x1_date_parts": ["date"], "x2_date_build": ["d"], "a2_complete_only": ["ds"],
    "a3_daily_totals": ["ds"], "a5_weather_daily": ["ds"], "s4_read_sites": ["date_from"],
    "s12_compact_years": ["ds"], "j12_reindex_daily": ["ds"], "w1_add_lags": ["ds"], "w4_rolling_mean": ["ds"],
    "w5_rolling_std": ["ds"], "w6_rolling_median": ["ds"], "w9_tail_per_group": ["ds"], "w11_zscore": ["ds"],
    "w14_interpolate": ["ds"], "w15_seasonal_fill": ["ds"], "w16_iso_features": ["ds"],
    "f19_forecast_panel": ["ds"], "n1_continuous_daily": ["ds"], "n2_rolling_outliers": ["ds"],
}


def _dates_as_timestamps(name: str, sql: str) -> str:
    cols = DATE_OUTPUTS.get(name)
    if not cols:
        return sql
    repl = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def query(name: str, sql: str | None = None):
    """Register ``fn(fx) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        text = _dates_as_timestamps(name, with_views(sql)) if sql else None
        REGISTRY[name] = Query(name, fn, text, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the plan modules fills the registry
    from countpanel.plans import (  # noqa: F401
        analytics, business, core, io_plans, ml_plans, model_plans, ordered, streams)
    return REGISTRY


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = q.build(Fixtures(spark, sf_dir))
        dates = [f.name for f in df.schema.fields if isinstance(f.dataType, DateType)]
        if dates:
            df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates})
        return df
    run.__name__ = q.name
    run.__doc__ = q.doc
    return run
