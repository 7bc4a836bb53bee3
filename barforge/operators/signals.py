"""Rule signals (R1-R7) and the deterministic feature scorer.

Output of every rule: (date, symbol, <name>_signal in [-1, 1]).  All rules
are evaluated in place on the feature table: window frames replace the
reference's self left joins, and the market-level sentiment is computed on
a date-level table (bounded by the number of calendar days, checked) that is
broadcast back, so no rule shuffles the feature rows more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.core import clamp, r, safe_div
from barforge.plans.sizing import broadcast_by_construction

# Fixed values of the reference's rules.
DOW_LOOKBACK, DOW_GAIN = 20, 0.5
ZONE_LOOKBACK = 12
MONTH_END_GAIN, MONTH_END_CAP = 0.5, 1.0
LAST_WEEK_GAIN, LAST_WEEK_CAP = 0.3, 0.5
CALM_NARROW, CALM_WIDE, CALM_QUIET = 0.05, 0.10, 1.2
CALM_WEAK, CALM_STRONG = 0.3, 0.5
SENTIMENT_GAIN = 3.0
# (rsi below, %B below, signal) for buys; (rsi above, %B above, signal) for sells
MEAN_REV_RULES = [("<", 30, 0.1, 1.0), ("<", 35, 0.2, 0.5), (">", 70, 0.9, -1.0), (">", 65, 0.8, -0.5)]
# Bound on the date-level market table that is broadcast back (days).
DATE_BOUND = "one row per calendar day of the feature look-back window (5 years: <= 1,827 rows)"

LABEL = "next_day_return"


def _past_stats(part, n):
    w = Window.partitionBy(*part).orderBy("date").rowsBetween(-n, -1)
    return F.avg(LABEL).over(w), F.stddev_samp(LABEL).over(w)


def signal_dow(feat: DataFrame, n: int = DOW_LOOKBACK, gain: float = DOW_GAIN) -> DataFrame:
    """mean/std of the label over the previous n rows of the same weekday.

    Unlabelled rows are only each symbol's last row, so they never fall in a
    preceding frame; they get 0 (the reference's left-join miss).
    """
    mean, std = _past_stats(["symbol", F.dayofweek("date")], n)
    x = feat.select("date", "symbol", LABEL, mean.alias("_m"), std.alias("_s"))
    sig = (F.when(F.col(LABEL).isNull(), F.lit(0.0))
           .when((F.col("_s") > 0) & F.col("_m").isNotNull(), clamp(F.col("_m") / F.col("_s") * F.lit(gain), -1, 1))
           .otherwise(F.lit(0.0)))
    return x.select("date", "symbol", sig.alias("dow_signal"))


def signal_month_end(feat: DataFrame, n: int = ZONE_LOOKBACK) -> DataFrame:
    """R2 (point in time): mean/std over the previous n rows of the same (symbol, zone)."""
    mean, std = _past_stats(["symbol", "month_end_zone"], n)
    x = feat.select("date", "symbol", "month_end_zone", mean.alias("_m"), std.alias("_s"))
    ok = F.col("_m").isNotNull() & (F.col("_s") > 0)
    z = F.col("_m") / F.col("_s")
    sig = (F.when((F.col("month_end_zone") == "month_end") & ok, clamp(z * F.lit(MONTH_END_GAIN), -MONTH_END_CAP, MONTH_END_CAP))
           .when((F.col("month_end_zone") == "last_week") & ok, clamp(z * F.lit(LAST_WEEK_GAIN), -LAST_WEEK_CAP, LAST_WEEK_CAP))
           .otherwise(F.lit(0.0)))
    return x.select("date", "symbol", sig.alias("month_end_signal"))


def calm_expr():
    bw, ratio = F.col("bb_bandwidth"), F.col("volume_vs_sma_ratio")
    return (F.when(bw.isNotNull() & F.col("atr_14").isNotNull() & (bw < CALM_NARROW) & (ratio < CALM_QUIET), F.lit(CALM_WEAK))
            .when(F.col("volume_surge_flag") & (bw > CALM_WIDE), F.lit(CALM_STRONG))
            .otherwise(F.lit(0.0)))


def signal_calm_before_storm(feat: DataFrame) -> DataFrame:
    """Band squeeze with quiet volume, or surge with wide bands."""
    return feat.select("date", "symbol", calm_expr().alias("calm_before_storm_signal"))


def market_daily(feat: DataFrame) -> DataFrame:
    """(date, market_avg_return) over labelled rows; one row per date."""
    return feat.filter(F.col(LABEL).isNotNull()).groupBy("date").agg(F.avg(LABEL).alias("market_avg_return"))


def signal_sentiment(feat: DataFrame, gain: float = SENTIMENT_GAIN) -> DataFrame:
    """R4 (literal): same-date market mean label x gain.  Uses future returns (look-ahead)."""
    m = broadcast_by_construction(market_daily(feat), DATE_BOUND)
    return feat.select("date", "symbol").join(m, "date").select(
        "date", "symbol", clamp(F.col("market_avg_return") * F.lit(gain), -1, 1).alias("sentiment_signal"))


def signal_sentiment_lagged(feat: DataFrame, gain: float = SENTIMENT_GAIN) -> DataFrame:
    """Tradable variant, market mean label of the previous date."""
    m = market_daily(feat)
    # the date table holds one row per calendar day: a global window on it is small
    prev = m.select("date", F.lag("market_avg_return").over(Window.orderBy("date")).alias("prev_market"))
    prev = broadcast_by_construction(prev, DATE_BOUND)
    return feat.select("date", "symbol").join(prev, "date").select(
        "date", "symbol", clamp(F.col("prev_market") * F.lit(gain), -1, 1).alias("sentiment_lagged_signal"))


def mean_rev_expr():
    rsi, pb = F.col("rsi_14"), F.col("bb_pct_b")
    e = None
    for op, rv, pv, s in MEAN_REV_RULES:
        cond = (rsi < rv) & (pb < pv) if op == "<" else (rsi > rv) & (pb > pv)
        e = F.when(cond, F.lit(s)) if e is None else e.when(cond, F.lit(s))
    return e.otherwise(F.lit(0.0))


def signal_mean_reversion(feat: DataFrame) -> DataFrame:
    """RSI extremes confirmed by %B."""
    return feat.select("date", "symbol", mean_rev_expr().alias("mean_rev_signal"))


def rule_signals_wide(feat: DataFrame) -> DataFrame:
    """R1, R2, R3, R4, R5 side by side: (date, symbol, five signals)."""
    dow_mean, dow_std = _past_stats(["symbol", F.dayofweek("date")], DOW_LOOKBACK)
    z_mean, z_std = _past_stats(["symbol", "month_end_zone"], ZONE_LOOKBACK)
    x = feat.select("*", dow_mean.alias("_dm"), dow_std.alias("_ds"), z_mean.alias("_zm"), z_std.alias("_zs"))
    dow = (F.when(F.col(LABEL).isNull(), F.lit(0.0))
           .when((F.col("_ds") > 0) & F.col("_dm").isNotNull(), clamp(F.col("_dm") / F.col("_ds") * F.lit(DOW_GAIN), -1, 1))
           .otherwise(F.lit(0.0)))
    ok = F.col("_zm").isNotNull() & (F.col("_zs") > 0)
    z = F.col("_zm") / F.col("_zs")
    me = (F.when((F.col("month_end_zone") == "month_end") & ok, clamp(z * F.lit(MONTH_END_GAIN), -MONTH_END_CAP, MONTH_END_CAP))
          .when((F.col("month_end_zone") == "last_week") & ok, clamp(z * F.lit(LAST_WEEK_GAIN), -LAST_WEEK_CAP, LAST_WEEK_CAP))
          .otherwise(F.lit(0.0)))
    m = broadcast_by_construction(market_daily(feat), DATE_BOUND)
    return x.join(m, "date", "left").select(
        "date", "symbol",
        dow.alias("dow_signal"), me.alias("month_end_signal"), calm_expr().alias("calm_before_storm_signal"),
        clamp(F.col("market_avg_return") * F.lit(SENTIMENT_GAIN), -1, 1).alias("sentiment_signal"),
        mean_rev_expr().alias("mean_rev_signal"),
    )


# ------------------------------------------------------------- G3 scorer --
def ga_feature_signals(feat: DataFrame, carry: tuple = ()) -> DataFrame:
    """Four bounded feature signals over labelled rows.

    Values pass through r(x, 9) so that 1e-13 noise (MACD on a symbol's
    first rows) cannot flip a sign, a threshold or a ranking.
    """
    f = feat.filter(F.col(LABEL).isNotNull())
    w = Window.partitionBy("symbol").orderBy("date")
    bw = F.col("bb_bandwidth")
    brk = safe_div(bw - F.lag("bb_bandwidth", 20).over(w),
                   F.nullif(F.stddev_samp("bb_bandwidth").over(w.rowsBetween(-19, 0)), F.lit(0.0)))
    return f.select(
        "date", "symbol",
        r(clamp(F.col("macd_histogram") * F.lit(10.0), -1, 1), 9).alias("s_momentum"),
        r(clamp((F.col("volume_vs_sma_ratio") - F.lit(1.0)) * F.lit(3.0), -1, 1), 9).alias("s_volume"),
        r(clamp((F.lit(50.0) - F.col("rsi_14")) / F.lit(20.0), -1, 1), 9).alias("s_reversal"),
        r(clamp(brk, -0.5, 0.5), 9).alias("s_breakout"),
        LABEL, *carry,
    )


def feature_scores(feat: DataFrame) -> DataFrame:
    """Deterministic stand-in for the four model predictions (step 4 scorer).

    momentum, volume-confirm and reversal come from G3; breakout is scaled by
    5 so that the composite rule's ``breakout > 2`` branch is reachable.
    """
    g = ga_feature_signals(feat)
    return g.select(
        "date", "symbol",
        F.col("s_momentum").alias("momentum_pred"),
        r(F.col("s_breakout") * F.lit(5.0), 9).alias("breakout_pred"),
        F.col("s_volume").alias("volume_confirm_pred"),
        F.col("s_reversal").alias("reversal_pred"),
    )


def strategy_signal(m, b, v, rv):
    """The ordered composite rule; NULL comparisons fall through to HOLD."""
    m, b, v, rv = (F.col(c) if isinstance(c, str) else c for c in (m, b, v, rv))
    return (F.when((m > 0) & (v > m), F.lit("STRONG_MOMENTUM"))
            .when((b > 2) & (v > 0), F.lit("BREAKOUT_CONFIRM"))
            .when((m < 0) & (rv > F.abs(m)), F.lit("REVERSAL_BUY"))
            .when((m > 0) & (rv < F.lit(-0.5) * m), F.lit("REVERSAL_SELL"))
            .otherwise(F.lit("HOLD")))


def strategy_scores(scores: DataFrame) -> DataFrame:
    """Four predictions side by side plus the composite label."""
    return scores.select("date", "symbol", "momentum_pred", "breakout_pred", "volume_confirm_pred", "reversal_pred",
                         strategy_signal("momentum_pred", "breakout_pred", "volume_confirm_pred", "reversal_pred").alias("signal"))


def signal_ensemble(signals_long: DataFrame, leaderboard: DataFrame, top: int = 3) -> DataFrame:
    """Mean signal of the previous week's top-``top`` entrants.

    signals_long: (entrant_name, date, symbol, signal).  The board of the
    week *before* each date is used, so there is no look-ahead.  The board
    is one row per (entrant, week): bounded by entrants x weeks (checked).
    """
    from barforge.functions.core import sunday_week
    lb = leaderboard.filter(F.col("week_rank") <= top).select(
        "entrant_name", F.date_add("week_start", 7).alias("_apply_week"))
    lb = broadcast_by_construction(lb, "top entrants x weeks of the back-test window (3 x 27)")
    s = signals_long.withColumn("_apply_week", sunday_week("date"))
    return (s.join(lb, ["entrant_name", "_apply_week"])
            .groupBy("date", "symbol").agg(F.avg("signal").alias("ensemble_signal")))
