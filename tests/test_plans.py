"""Plans: what is pushed down, how often rows are shuffled, and where Python runs."""
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.operators import bars as B
from tickloom.operators import bi as Q
from tickloom.operators import features as X
from tickloom.operators import media as M
from tickloom.operators import quality as D
from tickloom.sources.adapters import Inputs
from tickloom.sources.tables import explain_plan

# queries whose tasks run Python: the option solver and the two object copiers
PYTHON = {"implied_vol_greeks", "macd", "copy_binaries_to_raw", "fetch_objects"}


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return Inputs(spark, sf_dir)


def shuffles(df):
    return explain_plan(df, "simple").count("Exchange hashpartitioning")


def test_bars_shuffle_partial_aggregates_once(inputs):
    plan = explain_plan(B.ohlc_bars(inputs.silver, "1 hour"), "simple")
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan
    assert "Window" not in plan.replace("windowspec", "")
    fast = explain_plan(B.ohlc_bars(inputs.silver, "1 hour", unique_ts=True), "simple")
    assert "HashAggregate" in fast and "SortAggregate" not in fast


def test_silver_is_a_projection(inputs):
    assert "Exchange" not in explain_plan(inputs.silver, "simple")


def test_features_shuffle_their_rows_once(inputs):
    plan = explain_plan(X.features(inputs.bars, bar_s=3600), "simple")
    # rows once, the edge rows of segments (limited before the shuffle) by segment and by key
    assert plan.count("Exchange hashpartitioning") == 3
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_time_windows_shuffle_once(inputs):
    assert shuffles(X.features_time(inputs.bars)) == 1
    assert shuffles(X.max_favourable_return(inputs.bars)) == 1


def test_unused_features_are_not_computed(inputs):
    plan = explain_plan(X.feature(inputs.bars, "f_ret_1"), "simple")
    assert "stddev_samp" not in plan and "range_1" not in plan


def test_dedupe_reduces_copies_before_the_shuffle(inputs):
    ticks = inputs.ticks.withColumn("ingest_ts", F.current_timestamp())
    plan = explain_plan(D.dedupe_ticks(ticks), "simple")
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


def test_date_partitions_and_filters_reach_the_scan(inputs):
    plan = explain_plan(Q.symbol_window_scan(inputs.quotes_by_day, "click", inputs.as_of))
    assert re.search(r"PartitionFilters: \[[^\]]*quote_date", plan)
    assert "EqualTo(symbol,click)" in plan
    plan = explain_plan(Q.price_series(inputs.quotes, inputs.as_of))
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    plan = explain_plan(M.filter_media(inputs.images, kb_range=(1, 2)))
    assert "GreaterThanOrEqual(n_chars,1024)" in plan


def test_latest_rows_keep_n_rows_per_task(inputs):
    assert "TakeOrderedAndProject" in explain_plan(Q.latest_rows(inputs.quotes, [F.desc("timestamp")]), "simple")


@pytest.mark.parametrize(
    "key", ["ohlc_bars", "features", "labels", "dim_contract", "pit_join", "log_documents", "sustained_alert",
            "feature_drift_psi", "risk_gate", "macd", "search_messages", "media_summary", "implied_vol_greeks"]
)
def test_python_runs_only_where_named(spark, sf_dir, key):
    plan = explain_plan(entry.queries()[key](spark, sf_dir), "simple")
    uses = "InPandas" in plan or "EvalPython" in plan or "InArrow" in plan
    assert uses == (key in PYTHON)


@pytest.mark.parametrize("key", ["features", "pit_join", "nearest_strike", "parity_diff", "fill_gaps", "iv_surface"])
def test_no_pairwise_joins(spark, sf_dir, key):
    plan = explain_plan(entry.queries()[key](spark, sf_dir), "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_drift_counts_without_copies_of_rows(inputs, monkeypatch):
    """Each histogram reads one column; the counts of all bins come from one aggregate of two rows."""
    from pyspark.sql.classic.dataframe import DataFrame

    from tickloom.operators import evaluation as V

    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: plans.append(explain_plan(self, "formatted")) or collect(self))
    cols = ["f_ret_1", "f_vol_20", "f_range_5"]
    plan = explain_plan(V.feature_drift_psi(inputs.features, inputs.features, cols), "simple")
    plans = [p for p in plans if "ReadSchema" in p]
    assert len(plans) == 2 and not any("Expand" in p or "Generate" in p for p in plans)
    for p in plans:
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
        assert len(schemas) == len(cols) and all(sum(c in s for c in cols) == 1 for s in schemas)
    assert "Join" not in plan and "Expand" not in plan and "Window" not in plan


def test_scan_shuffles_its_rows_once(inputs):
    from tickloom.operators import risk as R
    from tickloom.registry.risk_options import _port

    port = _port(inputs)
    plan = R.equity_curve(port)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("Initial Plan")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final
    assert "Join" not in explain_plan(R.max_drawdown(port), "simple")
