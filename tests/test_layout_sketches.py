"""Clustered tables, wide frames, mergeable top counts, the numeric contract."""

import datetime as dt

from pyspark.sql import functions as F

from barforge.operators import evolution as E
from barforge.operators import features as FT
from barforge.operators import signals as S
from barforge.plans import catalog as C
from barforge.plans.silver import silver_clustered
from barforge.sources import files as SF


def test_symbol_windows_on_the_clustered_table_need_no_exchange(spark, sf):
    table = silver_clustered(spark, sf)
    plan = S.ga_feature_signals(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(symbol" not in plan and "Exchange" in S.ga_feature_signals(C.feat(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert table.count() == C.feat(spark, sf).count()


def test_wide_frames(spark):
    n = 400
    wide = spark.range(2).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                 *[F.lit(float(i)).alias(f"{f}|T{i}") if f != "Volume" else F.lit(i).cast("long").alias(f"{f}|T{i}")
                                   for i in range(n) for f in ("Close", "Open", "High", "Low", "Volume")])
    long = SF.wide_to_long(wide)
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()
    assert long.columns == ["date", "symbol", "open", "high", "low", "close", "volume"]
    assert long.agg(F.count(F.lit(1)), F.sum("volume"), F.sum("close")).first()[:] == (2 * n, n * (n - 1), float(n * (n - 1)))


def test_wide_to_long_edges(spark):
    rows = [(dt.date(2024, 1, 1), 1.0, 2, None, None, 5.0), (dt.date(2024, 1, 2), None, None, None, None, None)]
    wide = spark.createDataFrame(rows, "date date, `Open|A.B` double, `Volume|A.B` long, `Open|C` double, `Volume|C` long, `Open|D` double")
    # C has no data, D lacks a column: both are left out
    assert [tuple(r) for r in SF.wide_to_long(wide).collect()] == [(dt.date(2024, 1, 1), "A.B", 1.0, 2)]
    assert SF.wide_to_long(wide, ["NONE"]).count() == 0 and SF.wide_to_long(wide, ["A.B", "NONE"]).count() == 1


def test_sketches_merge_and_agree_with_the_mode(spark, sf):
    feat = C.feat(spark, sf)
    weeks = {r["week_start"]: r for r in E.week_zones(E.day_zone_sketches(feat)).collect()}
    exact = {r["week_start"]: r["dominant_zone"] for r in E.week_types(feat).collect()}
    assert set(weeks) == set(exact)
    clear = [w for w, r in weeks.items() if r["zone_share"] > 0.5]
    assert clear and all(weeks[w]["dominant_zone"] == exact[w] for w in clear)
    # days merged in two steps give what one step gives; few counters stay within their bound
    days = E.day_zone_sketches(feat)
    one = days.where("date < '1998-01-01'").unionByName(days.where("date >= '1998-01-01'"))
    assert sorted(map(str, E.week_zones(one).collect())) == sorted(map(str, weeks.values()))


def test_numeric_contract_types(spark, sf):
    stored = FT.feat_numeric_contract(C.feat(spark, sf))
    types = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    assert types["close"] == types["rsi_14"] == "decimal(38,9)" and types["volume"] == "bigint" and types["_extracted_at"] == "timestamp"
