"""Physical-plan properties: pushdown, pruning, broadcast, shuffles."""

from countpanel.plans.registry import load_all, runner

REG = load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushes_filters_and_prunes(spark):
    df = runner(REG["s5_scan_parquet"])(spark, "/root/testdata/sf0.001")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_year_filter_reaches_reader(spark):
    p = _plan(runner(REG["s6_dataset_filter"])(spark, "/root/testdata/sf0.001"))
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_dimension_join_is_broadcast(spark):
    p = _plan(runner(REG["j9_attach_attr"])(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_grid_join_is_equi_join(spark):
    p = _plan(runner(REG["j15_count_within"])(spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_panel_features_share_one_window_sort(spark):
    from countpanel.plans.ordered import f4
    from countpanel.fixtures import Fixtures

    df = f4(Fixtures(spark, "/root/testdata/sf0.001"))
    p = df._jdf.queryExecution().executedPlan().toString()
    # one window over the site's hours computes all lag / rolling columns
    windows = [ln for ln in p.split("\n") if "Window [" in ln and "datetime_hour" in ln]
    assert len(windows) == 1
    assert all(name in windows[0] for name in ("lag_1", "lag_168", "count"))


def test_per_key_topk_is_limited_before_shuffle(spark):
    # row_number() <= k gets a partial WindowGroupLimit below the exchange:
    # a hot key sends at most k rows per map task across the network
    for name in ("p20_keep_extreme", "w10_head_per_group"):
        p = _plan(runner(REG[name])(spark, "/root/testdata/sf0.001"))
        lines = [ln for ln in p.split("\n") if "WindowGroupLimit" in ln or "Exchange hashpartitioning(site_id" in ln]
        kinds = ["limit" if "WindowGroupLimit" in ln else "exchange" for ln in lines]
        assert kinds[-1] == "limit" and "exchange" in kinds, (name, kinds)


def test_aggregations_are_partial(spark):
    # a hot site is pre-combined in every task before the shuffle
    p = _plan(runner(REG["a1_rollup_hourly"])(spark, "/root/testdata/sf0.001"))
    assert "partial_sum" in p and "partial_count" in p


def test_gap_filling_and_outliers_share_one_shuffle(fx):
    """N1 and N2 on a daily aggregate: one exchange for the aggregate, one on
    the key for the calendar and all windows, none but small broadcasts beside."""
    from countpanel.operators import anomaly as NA
    d = NA.rolling_outliers(NA.continuous_daily(fx.daily, keep_pos=True), positioned=True)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") <= 3, plan
    assert plan.count("BroadcastExchange") <= 1
