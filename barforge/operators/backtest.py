"""Back-test (B1-B7) over any four prediction columns.

Cumulative curves use a two-stage plan: aggregate per date first (one row
per date, bounded by the calendar), run the running sum on that small table,
then broadcast it back.  This matches the reference's RANGE frame (all rows
of a date share the value) without an ``Exchange SinglePartition`` over all
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.core import r
from barforge.operators.signals import LABEL, strategy_signal
from barforge.plans.sizing import broadcast_by_construction

MODELS = ["momentum", "breakout", "volume_confirm", "reversal"]
BACKTEST_DAYS = 180
PERIODS_PER_YEAR = 252
# Fixed order of the composite signals in reports.
SIGNAL_ORDER = ["STRONG_MOMENTUM", "BREAKOUT_CONFIRM", "REVERSAL_BUY", "REVERSAL_SELL", "HOLD"]


def _hit(model: str):
    return F.signum(F.col(f"{model}_pred")) == F.signum(F.col("actual_return"))


def backtest_results(feat: DataFrame, scores: DataFrame, as_of, days: int = BACKTEST_DAYS) -> DataFrame:
    """B1: last ``days`` labelled rows, predictions left-joined, hit flags, composite label."""
    actual = feat.filter((F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days)) & F.col(LABEL).isNotNull()) \
        .select("date", "symbol", F.col(LABEL).alias("actual_return"))
    preds = scores.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days)) \
        .select("date", "symbol", *[f"{m}_pred" for m in MODELS])
    j = actual.join(preds, ["date", "symbol"], "left")
    return j.select(
        "date", "symbol", "actual_return", *[f"{m}_pred" for m in MODELS],
        *[_hit(m).alias(f"{m}_dir_correct") for m in MODELS],
        strategy_signal("momentum_pred", "breakout_pred", "volume_confirm_pred", "reversal_pred").alias("signal"),
    )


def backtest_model_summary(bt: DataFrame) -> DataFrame:
    """B2: one row of error and hit statistics per model."""
    a = F.col("actual_return")
    aggs = [F.count(F.lit(1)).alias("total_days"), r(F.avg(a), 4).alias("avg_actual_return")]
    for m in MODELS:
        aggs.append(r(F.avg(F.abs(F.col(f"{m}_pred") - a)), 4).alias(f"{m}_mae"))
    for m in MODELS:
        aggs.append(r(F.sqrt(F.avg(F.pow(F.col(f"{m}_pred") - a, 2))), 4).alias(f"{m}_rmse"))
    for m in MODELS:
        aggs.append(r(F.avg(F.when(_hit(m), F.lit(1)).otherwise(F.lit(0))), 4).alias(f"{m}_dir_accuracy"))
    for m in MODELS:
        aggs.append(r(F.avg(F.when(_hit(m), a).otherwise(F.lit(0.0))), 4).alias(f"{m}_avg_return_when_correct"))
    return bt.agg(*aggs)


def backtest_signal_performance(bt: DataFrame, periods: int = PERIODS_PER_YEAR) -> DataFrame:
    """Per composite signal statistics with an annualised Sharpe ratio."""
    a = F.col("actual_return")
    std = F.stddev_samp(a)
    sharpe = F.when(std == 0, F.lit(0.0)).otherwise(F.avg(a) / std * F.lit(float(periods) ** 0.5))
    order_expr = F.when(F.col("signal") == SIGNAL_ORDER[0], F.lit(1))
    for i, s in enumerate(SIGNAL_ORDER[1:], 2):
        order_expr = order_expr.when(F.col("signal") == s, F.lit(i))
    return (bt.groupBy("signal").agg(
        F.count(F.lit(1)).alias("signal_count"),
        r(F.avg(a), 4).alias("avg_return"),
        r(F.avg(F.abs(a)), 4).alias("avg_abs_return"),
        r(F.avg(F.when(a > 0, F.lit(1)).otherwise(F.lit(0))), 4).alias("win_rate"),
        r(F.avg(F.when(a > 0, a)), 4).alias("avg_win"),
        r(F.avg(F.when(a < 0, a)), 4).alias("avg_loss"),
        r(F.min(a), 4).alias("max_loss_single"),
        r(F.max(a), 4).alias("max_gain_single"),
        r(sharpe, 4).alias("sharpe_ratio_annualized"),
    ).withColumn("signal_order", order_expr.cast("long")).orderBy("signal_order").drop("signal_order"))


def _model_pnl(m: str):
    a = F.col("actual_return")
    return F.when(_hit(m), F.abs(a)).otherwise(-F.abs(a))


def _signal_pnl():
    a, s = F.col("actual_return"), F.col("signal")
    return (F.when(s == "HOLD", F.lit(0.0))
            .when(s.isin("STRONG_MOMENTUM", "BREAKOUT_CONFIRM", "REVERSAL_BUY"), F.when(a > 0, a).otherwise(-F.abs(a)))
            .when(s == "REVERSAL_SELL", F.when(a < 0, F.abs(a)).otherwise(-a))
            .otherwise(F.lit(0.0)))


PNL_COLUMNS = ["raw_return"] + [f"{m}_pnl" for m in MODELS] + ["signal_pnl"]


def backtest_daily_pnl(bt: DataFrame) -> DataFrame:
    """Per row P&L of each model (hit: +|ret|, miss or NULL: -|ret|) and of the composite."""
    return bt.select("date", "symbol", F.col("actual_return").alias("raw_return"),
                     *[_model_pnl(m).alias(f"{m}_pnl") for m in MODELS], _signal_pnl().alias("signal_pnl"))


def _curve_name(c: str) -> str:
    return c.replace("_pnl", "_cumul").replace("raw_return", "raw_cumul")


def backtest_cumulative_returns(bt: DataFrame) -> DataFrame:
    """Running sum by date / 100 + 1, shared by all rows of a date."""
    pnl = backtest_daily_pnl(bt)
    per_date = pnl.groupBy("date").agg(*[F.sum(c).alias(c) for c in PNL_COLUMNS])
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    curve = per_date.select("date", *[(F.sum(c).over(w) / F.lit(100.0) + F.lit(1.0)).alias(_curve_name(c))
                                      for c in PNL_COLUMNS])
    curve = broadcast_by_construction(curve, "one row per calendar day of the back-test window (180 days)")
    return pnl.join(curve, "date").select("date", "symbol", *PNL_COLUMNS, *[_curve_name(c) for c in PNL_COLUMNS])


def recent_cumulative(cum: DataFrame, k: int = 10) -> DataFrame:
    """Newest k rows by date (symbol breaks ties)."""
    return cum.orderBy(F.col("date").desc(), F.col("symbol")).limit(k)


def max_drawdown(bt: DataFrame) -> DataFrame:
    """Largest fall of each cumulative curve from its running peak.

    Works on the per-date curve (one row per date), long form:
    (curve, max_drawdown).
    """
    pnl = backtest_daily_pnl(bt)
    per_date = pnl.groupBy("date").agg(*[F.sum(c).alias(c) for c in PNL_COLUMNS])
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    curve = per_date.select("date", *[(F.sum(c).over(w) / F.lit(100.0) + F.lit(1.0)).alias(c) for c in PNL_COLUMNS])
    long = curve.select("date", F.explode(F.array(*[F.struct(F.lit(_curve_name(c)).alias("curve"), F.col(c).alias("value"))
                                                    for c in PNL_COLUMNS])).alias("p")).select("date", "p.*")
    wc = Window.partitionBy("curve").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    dd = long.withColumn("drawdown", F.max("value").over(wc) - F.col("value"))
    return dd.groupBy("curve").agg(r(F.max("drawdown"), 6).alias("max_drawdown"))
