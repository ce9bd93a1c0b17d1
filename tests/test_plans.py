"""Plan guards: the physical plans keep the properties the design relies on."""

import pytest

from cardsentry.operators.above_limit import detect_above_limit
from cardsentry.operators.location import detect_location_jump
from cardsentry.operators.low_values import detect_low_values, p05_by_group
from cardsentry.operators.trailing import detect_trailing_repeat
from cardsentry.plans.detection import fraud_alerts
from cardsentry.sources.fixture import load_tx
from conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "AggregateInPandas", "WindowInPandas")


def plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("build", [detect_above_limit, detect_low_values, detect_trailing_repeat,
                                   p05_by_group])
def test_no_python_and_no_group_collection(spark, build):
    p = plan(spark, build(load_tx(spark, SF001)))
    assert not any(n in p for n in PYTHON_NODES), p
    assert "collect_list" not in p, p


def test_parts_are_found_from_partial_aggregates(spark):
    """Rows meet only in a partial aggregate (their grid cells); the windows that cut the parts run above it."""
    from cardsentry.operators.clustering import far_parts
    from cardsentry.operators.windows import assign_windows
    tx = assign_windows(load_tx(spark, SF001), "1 day")
    p = plan(spark, far_parts(tx, ["user_id", "window_start", "window_end"])).split("\n\n")[0]
    assert not any(n in p for n in PYTHON_NODES)
    assert p.count("HashAggregate") == 2 and p.rindex("HashAggregate") > p.rindex("Window")


def test_location_folds_once_and_scans_segments(spark, monkeypatch):
    """The fold runs once, into a written table; windows over the rows of large groups are cut by segment."""
    import re
    from cardsentry.operators import nearest
    monkeypatch.setattr(nearest, "SEGMENT_ROWS", 5)
    p = plan(spark, detect_location_jump(load_tx(spark, SF001)))
    assert not any(n in p for n in PYTHON_NODES)
    assert "collect_list" not in p
    over_rows = [line for line in p.splitlines() if re.search(r"windowspecdefinition\(.*seq#\d+L", line) and "_at" not in line]
    assert over_rows and all("_seg" in line for line in over_rows), over_rows


def test_first_k_is_limited_before_the_shuffle(spark):
    p = plan(spark, detect_above_limit(load_tx(spark, SF001)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, fraud_alerts(load_tx(spark, SF001)))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("event_type" not in s for s in schemas), schemas


def test_detectors_share_one_pruned_table(spark):
    """The source is read once, into the shared folder; no detector reads or parses it again."""
    p = plan(spark, fraud_alerts(load_tx(spark, SF001)))
    assert "events.parquet" not in p and "get_json_object" not in p
    assert p.count("/transactions-") == 4 and p.count("/clusters-") == 2      # D1 and D2 twice each; D3 its own table


def test_stashed_tables_can_be_dropped(spark):
    import os
    from cardsentry import tables
    made = tables.stash(spark.range(5), "t")
    folder = tables._folder(spark)
    assert made.count() == 5 and any(n.startswith("t-") for n in os.listdir(folder))
    tables.drop_stashed(spark)
    assert not os.path.exists(folder)


def test_fused_plan_equals_separate_detectors(spark):
    tx = load_tx(spark, SF001)
    fused = fraud_alerts(tx, fuse=True)
    apart = fraud_alerts(tx, fuse=False)
    assert fused.exceptAll(apart).count() == 0 and apart.exceptAll(fused).count() == 0


def test_fused_plan_reads_the_source_three_times(spark):
    """D2 needs two scans (statistics + low rows); D1+D3 share one."""
    p = plan(spark, fraud_alerts(load_tx(spark, SF001), fuse=True))
    assert p.count("Scan parquet") == 3 * 2     # node + its detail section


def test_single_cluster_shortcut_keeps_fused_results(spark):
    from cardsentry.plans.detection import user_day_alerts
    tx = load_tx(spark, SF001)
    a = user_day_alerts(tx, skip_single=True)
    b = user_day_alerts(tx, skip_single=False)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_window_spec_comparison_for_fusion():
    from cardsentry.streaming.detect import _same
    assert _same(("24 hours", None), ("1 day", None))
    assert _same(("3.5 days", None), ("84 hours", None))
    assert not _same(("24 hours", "12 hours"), ("1 day", None))
    assert not _same(("24 hrs", None), ("24 hrs", None))      # not understood: never fused
