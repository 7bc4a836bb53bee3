"""Plan-shape regression tests: the scale design is asserted on the physical plans."""
import re

from __spark_entry__ import queries

Q = queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lineitem_scan_is_pruned_and_dimensions_broadcast(spark, sf):
    p = plan(Q["price_path"](spark, sf))
    scan = [ln for ln in p.splitlines() if "lineitem" in ln and "FileScan" in ln][0]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert len(schema.split(",")) == 5
    assert "BroadcastHashJoin" in p
    # partial aggregation before the only large exchange
    assert p.count("HashAggregate") >= 2


def test_features_single_exchange(spark, sf):
    p = plan(Q["features_daily"](spark, sf))
    assert p.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(symbol" in p


def test_gene_fanout_is_not_shuffled(spark, sf):
    p = plan(Q["ga_positions"](spark, sf)).splitlines()
    gen = next(i for i, ln in enumerate(p) if "Generate explode" in ln)
    win = next(i for i, ln in enumerate(p) if "WindowGroupLimit" in ln)
    # between the top-3 window and the fan-out there is no exchange
    assert not any("Exchange" in ln for ln in p[win:gen])
    assert "REPARTITION_BY_NUM" in "\n".join(p[gen:gen + 3])


def test_recent_window_prunes_partitions(spark, sf):
    p = plan(Q["volume_watch"](spark, sf))
    assert re.search(r"PartitionFilters: \[[^\]]*year_month", p)
    assert "GreaterThanOrEqual(date" in p


def test_no_cross_or_nested_loop_joins(spark, sf):
    for name in ["ga_signals", "trade_log", "symbol_calendar_grid", "anomaly_segments", "arena_leaderboard"]:
        p = plan(Q[name](spark, sf))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
