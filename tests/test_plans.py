"""Physical-plan properties the design relies on, read from ``explain()``."""

import contextlib
import io

import pytest

from panelcast.operators import rollup, windows
from panelcast.plans import queries as Q
from panelcast.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_rollup_combines_map_side_before_one_shuffle(spark):
    p = plan(rollup.monthly_rollup(tv.daily_obs(spark, SF), exact_scale=2), "simple")
    assert "partial_sum" in p and "partial_count" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_both_grains_take_one_scan_and_one_shuffle(spark):
    df = rollup.both_grains(tv.daily_obs(spark, SF), exact_scale=2)
    p = plan(df, "simple")
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1
    assert "Expand" in p and "partial_sum" in p


def test_period_filter_reaches_the_scan_and_prunes_columns(spark):
    p = plan(Q.period_filter(spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,2001-08-01" in p
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "l_orderkey" not in read and "l_returnflag" not in read


def test_per_entity_latest_window_limits_before_the_shuffle(spark):
    panel = windows.with_month_date(tv.entity_panel(spark, SF))
    p = plan(windows.latest_window(panel, ["year", "month"], 12, entity="district"), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_guard_reads_only_the_batch_months(spark):
    from panelcast.operators import history
    h = Q._district_history(spark, SF, reuse=False)
    batch = h.filter("year = 2001 AND month = 6")
    p = plan(history.rows_new_keys(h, batch, Q.KEYS), "simple")
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


@pytest.mark.parametrize("name", list(Q.queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(Q.queries()[name](spark, SF), "simple")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # Scores of Python models are stored once, before rows and errors are told apart: no plan runs a model again.
    assert not any(op in p for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow"))
    stored = "ExistingRDD" in p
    assert stored or name not in {"score_models", "score_tabular", "series_score_models"}


def test_python_runs_in_one_map_over_the_windows(spark):
    from panelcast.operators import scoring
    from panelcast.plans import models
    scores = scoring.score(Q._tensor(Q._ctx(spark, SF)), scoring.ModelSet.load(models.panel_models()))
    assert plan(scores, "simple").count("MapInPandas") == 1


def test_tree_scores_stay_in_the_jvm(spark):
    p = plan(Q.score_trees(spark, SF), "simple")
    assert "aggregate(" in p and not any(op in p for op in ("Python", "Pandas", "Arrow"))
