"""Strategy arena (L1-L6): entrant P&L, weekly leaderboard, survival log.

L1 is a single scan: every back-test row is exploded into one (entrant, pnl)
row per entrant with ``explode(array(struct))`` instead of the reference's
ten-branch UNION ALL (ten scans).  L2 aggregates per (entrant, Sunday week)
with partial aggregation, then runs the rolling and ranking windows on the
aggregate, which is bounded by entrants x weeks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.core import r, sunday_week
from barforge.operators.backtest import MODELS, _model_pnl
from barforge.plans.sizing import broadcast_by_construction

# Fixed entrant names of the reference, in its order.
MODEL_ENTRANTS = ["1_momentum", "2_breakout", "3_volume_confirm", "4_reversal"]
RULE_ENTRANTS = [
    ("5_dow_specialist", "dow_signal"),
    ("6_month_end_hunter", "month_end_signal"),
    ("7_calm_before_storm", "calm_before_storm_signal"),
    ("8_sentiment", "sentiment_signal"),
    ("9_mean_reversion", "mean_rev_signal"),
]
ENSEMBLE_ENTRANT = "10_ensemble"
ROLLING_WEEKS = 4
STRIKES = 3


def entrant_daily_pnl(bt: DataFrame, rule_signals: DataFrame | None) -> DataFrame:
    """L1: (entrant_name, date, symbol, pnl) for model and rule entrants.

    Rule entrants are inner-joined to the back-test rows on (date, symbol),
    as in the reference; the ensemble branch is empty there and here.
    """
    items = [F.struct(F.lit(name).alias("entrant_name"), _model_pnl(m).alias("pnl"))
             for name, m in zip(MODEL_ENTRANTS, MODELS)]
    x = bt
    if rule_signals is not None:
        x = bt.join(rule_signals, ["date", "symbol"])
        items += [F.struct(F.lit(name).alias("entrant_name"), (F.col(c) * F.col("actual_return")).alias("pnl"))
                  for name, c in RULE_ENTRANTS if c in rule_signals.columns]
    return x.select("date", "symbol", F.explode(F.array(*items)).alias("e")).select(
        "e.entrant_name", "date", "symbol", "e.pnl")


def arena_leaderboard(pnl: DataFrame, weeks: int = ROLLING_WEEKS) -> DataFrame:
    """L2: weekly board with rolling 4-week P&L (always divided by 4) and rank."""
    wk = pnl.withColumn("week_start", sunday_week("date"))
    agg = wk.groupBy("entrant_name", "week_start").agg(
        F.count(F.lit(1)).alias("n_days"),
        r(F.avg("pnl"), 4).alias("avg_daily_pnl"),
        r(F.stddev_samp("pnl"), 4).alias("std_daily_pnl"),
        r(F.avg(F.when(F.col("pnl") > 0, F.lit(1)).otherwise(F.lit(0))), 4).alias("win_rate"),
        r(F.sum("pnl"), 4).alias("week_total_pnl"),
        F.sum("pnl").alias("_sum"),
    )
    roll = Window.partitionBy("entrant_name").orderBy("week_start").rowsBetween(-(weeks - 1), 0)
    rank = Window.partitionBy("week_start").orderBy(F.col("week_total_pnl").desc(), F.col("entrant_name"))
    x = agg.withColumn("rolling_4w_pnl", F.sum("_sum").over(roll) / F.lit(float(weeks)))
    return x.select(
        "entrant_name", "week_start", "n_days", "avg_daily_pnl", "std_daily_pnl", "win_rate", "week_total_pnl",
        "rolling_4w_pnl",
        F.row_number().over(rank).cast("long").alias("week_rank"),
        F.when(F.col("rolling_4w_pnl") > 0, F.lit("ALIVE")).otherwise(F.lit("WARNING")).alias("status"),
    )


def leaderboard_latest_week(lb: DataFrame) -> DataFrame:
    """L3: rows of the newest week, by rank."""
    latest = lb.agg(F.max("week_start").alias("week_start"))
    return lb.join(F.broadcast(latest), "week_start").orderBy("week_rank")


def leaderboard_alltime(lb: DataFrame, k: int = 10) -> DataFrame:
    """L4: per entrant totals over all weeks, top k by total P&L."""
    return (lb.groupBy("entrant_name").agg(
        r(F.sum("week_total_pnl"), 4).alias("total_pnl"),
        r(F.avg("win_rate"), 4).alias("avg_win_rate"),
        F.count(F.lit(1)).alias("weeks"))
        .orderBy(F.col("total_pnl").desc(), F.col("entrant_name")).limit(k))


def survival_log(lb: DataFrame, strikes: int = STRIKES) -> DataFrame:
    """ALIVE / WARNING_1 / WARNING_2 / ELIMINATED per entrant and week.

    A strike is a week with non-positive rolling P&L; the status is the
    length of the current run of strikes, and ELIMINATED (run >= strikes)
    is absorbing.  Gaps-and-islands on the (entrant, week) board.
    """
    w = Window.partitionBy("entrant_name").orderBy("week_start")
    wrun = w.rowsBetween(Window.unboundedPreceding, 0)
    strike = (F.col("rolling_4w_pnl") <= 0).cast("int")
    x = lb.select("*", strike.alias("_strike"), F.row_number().over(w).alias("_rn"))
    x = x.withColumn("_last_ok", F.coalesce(F.max(F.when(F.col("_strike") == 0, F.col("_rn"))).over(wrun), F.lit(0)))
    x = x.withColumn("_run", F.col("_rn") - F.col("_last_ok"))
    x = x.withColumn("_out", F.max((F.col("_run") >= strikes).cast("int")).over(wrun))
    status = (F.when(F.col("_out") == 1, F.lit("ELIMINATED"))
              .when(F.col("_run") == 0, F.lit("ALIVE"))
              .otherwise(F.concat(F.lit("WARNING_"), F.col("_run").cast("string"))))
    reason = (F.when(F.col("_out") == 1, F.lit("rolling 4-week P&L not positive for 3 weeks"))
              .when(F.col("_run") > 0, F.lit("rolling 4-week P&L not positive"))
              .otherwise(F.lit("rolling 4-week P&L positive")))
    return x.select("week_start", "entrant_name", status.alias("status"), "week_rank",
                    r(F.col("rolling_4w_pnl"), 6).alias("rolling_4w_pnl"), reason.alias("reason"))


def mask_eliminated(signals_long: DataFrame, log: DataFrame) -> DataFrame:
    """Drop an entrant's signals from the week after its elimination on.

    signals_long: (entrant_name, date, symbol, signal).  The elimination
    table holds one row per eliminated entrant (bounded by entrants).
    """
    out = log.filter(F.col("status") == "ELIMINATED").groupBy("entrant_name").agg(
        F.min("week_start").alias("_out_week"))
    out = broadcast_by_construction(out, "one row per eliminated entrant")
    j = signals_long.join(out, "entrant_name", "left")
    return j.filter(F.col("_out_week").isNull() | (F.col("date") < F.date_add("_out_week", 7))).drop("_out_week")


def entrant_signals_long(bt: DataFrame, rule_signals: DataFrame | None) -> DataFrame:
    """(entrant_name, date, symbol, signal in [-1, 1]) over the back-test rows.

    Model entrants trade the sign of their prediction; rule entrants their
    rule signal.  One scan with explode, like L1.
    """
    items = [F.struct(F.lit(name).alias("entrant_name"), F.signum(F.col(f"{m}_pred")).alias("signal"))
             for name, m in zip(MODEL_ENTRANTS, MODELS)]
    x = bt
    if rule_signals is not None:
        x = bt.join(rule_signals, ["date", "symbol"])
        items += [F.struct(F.lit(name).alias("entrant_name"), F.col(c).alias("signal"))
                  for name, c in RULE_ENTRANTS if c in rule_signals.columns]
    return x.select("date", "symbol", F.explode(F.array(*items)).alias("e")).select(
        "e.entrant_name", "date", "symbol", "e.signal")


def arena_signals(bt: DataFrame, rule_signals: DataFrame, ensemble: DataFrame) -> DataFrame:
    """Ten predictions per back-test row: four models, five rules, ensemble."""
    cols = ["date", "symbol", *[f"{m}_pred" for m in MODELS]]
    return (bt.select(*cols).join(rule_signals, ["date", "symbol"], "left")
            .join(ensemble, ["date", "symbol"], "left")
            .select(*cols, *[c for _, c in RULE_ENTRANTS], "ensemble_signal"))
