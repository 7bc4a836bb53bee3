"""Hand-made golden cases for back-test, GA and arena semantics (FIXTURES.md section 3)."""
import datetime as dt

from pyspark.sql import functions as F

from barforge.operators import arena, backtest, evolution, signals


def test_all_predictions_null(spark):
    feat = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 1.5), (dt.date(2024, 1, 3), "A", -2.0)],
                                 "date date, symbol string, next_day_return double")
    scores = spark.createDataFrame([], "date date, symbol string, momentum_pred double, breakout_pred double, "
                                       "volume_confirm_pred double, reversal_pred double")
    bt = backtest.backtest_results(feat, scores, dt.date(2024, 1, 3), 180)
    assert {r["signal"] for r in bt.collect()} == {"HOLD"}
    pnl = backtest.backtest_daily_pnl(bt).collect()
    assert sorted(r["momentum_pnl"] for r in pnl) == [-2.0, -1.5]
    s = backtest.backtest_model_summary(bt).first()
    assert s["momentum_dir_accuracy"] == 0.0 and s["momentum_avg_return_when_correct"] == 0.0


def test_tied_signals_break_by_symbol(spark):
    sig = spark.createDataFrame(
        [(dt.date(2024, 1, 2), s, 1, "g", 1, 0.5, 3) for s in ["D", "C", "B", "A"]],
        "date date, symbol string, gene_id long, strategy_name string, generation long, raw_signal double, max_positions long")
    pos = evolution.ga_positions(sig)
    assert sorted(r["symbol"] for r in pos.collect()) == ["A", "B", "C"]


def test_null_inputs_clamp_to_null_and_count_as_zero(spark):
    feat = spark.createDataFrame(
        [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", None, None, 1.0, None, 0.5) for i in range(3)],
        "date date, symbol string, macd_histogram double, rsi_14 double, volume_vs_sma_ratio double, "
        "bb_bandwidth double, next_day_return double")
    fs = signals.ga_feature_signals(feat)
    r = fs.first()
    assert r["s_momentum"] is None and r["s_reversal"] is None and r["s_volume"] == 0.0
    genes = evolution.gene_pool_init(spark, 2, 42)
    sig = evolution.ga_signals(fs, genes)
    assert sig.filter(F.col("raw_signal").isNull()).count() == 0
    assert sig.agg(F.max(F.abs("raw_signal"))).first()[0] == 0.0


def test_week_changes_on_sunday(spark):
    pnl = spark.createDataFrame([("x", dt.date(2024, 3, 2), "A", 1.0), ("x", dt.date(2024, 3, 3), "A", 2.0)],
                                "entrant_name string, date date, symbol string, pnl double")
    lb = arena.arena_leaderboard(pnl).collect()
    assert sorted(r["week_start"] for r in lb) == [dt.date(2024, 2, 25), dt.date(2024, 3, 3)]
    # rolling sum is always divided by 4, also in the first weeks
    assert sorted(r["rolling_4w_pnl"] for r in lb) == [0.25, 0.75]
