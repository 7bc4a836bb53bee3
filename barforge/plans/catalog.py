"""Registered queries: every operator of the inventory that has a query form.

Each entry reads the given tables (or tables Spark derives from them) at
``sf_dir`` and returns a DataFrame; the matching DuckDB SQL rebuilds the
same result from the raw Parquet views.  Double columns are rounded with
the portable r(x, 6) on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barforge.operators import arena, backtest, signals
from barforge.operators.features import features_daily
from barforge.plans import oracle_base as O
from barforge.plans import oracle_gbt as OB
from barforge.plans.registry import digits_for, finalize, register
from barforge.plans.silver import bronze_bars, bronze_metrics, default_as_of, silver_clustered, silver_features, silver_metrics, silver_since
from barforge.plans.trained import stored_models
from barforge.sources.bars import bars_from_tables, read_table


def sel(spec: str, k: int = 6) -> str:
    """'a b:d c' -> 'a, R(b) AS b, c' (':d' marks a DOUBLE column)."""
    out = []
    for tok in spec.replace(",", " ").split():
        if tok.endswith(":d"):
            n = tok[:-2]
            out.append(f"{O.R(n, digits_for(n, k))} AS {n}")
        else:
            out.append(tok)
    return ", ".join(out)


FEAT_SPEC = ("date symbol open:d high:d low:d close:d volume close_lag_1d:d close_lag_5d:d close_lag_20d:d "
             "sma_5:d sma_20:d sma_60:d std_20:d rsi_14:d volume_sma_5 volume_vs_sma_ratio:d volume_lag_1d "
             "volume_chg_pct:d volume_incr_streak volume_surge_flag macd_line:d macd_signal:d macd_histogram:d "
             "bb_upper:d bb_lower:d bb_pct_b:d bb_bandwidth:d atr_14:d _days_to_month_end month_end_zone "
             "quarter_end_flag next_day_return:d day_of_week month_of_year")

# ------------------------------------------------------------ shared SQL --
SCORES = f"""
fs AS (
  SELECT date, symbol, next_day_return, close,
    {O.R(O.clamp('macd_histogram * 10.0::DOUBLE', -1, 1), 9)} AS s_momentum,
    {O.R(O.clamp('(volume_vs_sma_ratio - 1.0::DOUBLE) * 3.0::DOUBLE', -1, 1), 9)} AS s_volume,
    {O.R(O.clamp('(50.0::DOUBLE - rsi_14) / 20.0::DOUBLE', -1, 1), 9)} AS s_reversal,
    {O.R(O.clamp(f'(bb_bandwidth - LAG(bb_bandwidth, 20) {O.WS}) / NULLIF(STDDEV_SAMP(bb_bandwidth) {O.W(20)}, 0)', -0.5, 0.5), 9)} AS s_breakout
  FROM feat WHERE next_day_return IS NOT NULL),
scores AS (
  SELECT date, symbol, s_momentum AS momentum_pred, {O.R('s_breakout * 5.0::DOUBLE', 9)} AS breakout_pred,
         s_volume AS volume_confirm_pred, s_reversal AS reversal_pred FROM fs)"""

BT = """
bt AS (
  SELECT a.date, a.symbol, a.next_day_return AS actual_return,
    s.momentum_pred, s.breakout_pred, s.volume_confirm_pred, s.reversal_pred,
    sign(s.momentum_pred) = sign(a.next_day_return) AS momentum_dir_correct,
    sign(s.breakout_pred) = sign(a.next_day_return) AS breakout_dir_correct,
    sign(s.volume_confirm_pred) = sign(a.next_day_return) AS volume_confirm_dir_correct,
    sign(s.reversal_pred) = sign(a.next_day_return) AS reversal_dir_correct,
    CASE
      WHEN s.momentum_pred > 0 AND s.volume_confirm_pred > s.momentum_pred THEN 'STRONG_MOMENTUM'
      WHEN s.breakout_pred > 2 AND s.volume_confirm_pred > 0 THEN 'BREAKOUT_CONFIRM'
      WHEN s.momentum_pred < 0 AND s.reversal_pred > abs(s.momentum_pred) THEN 'REVERSAL_BUY'
      WHEN s.momentum_pred > 0 AND s.reversal_pred < -0.5::DOUBLE * s.momentum_pred THEN 'REVERSAL_SELL'
      ELSE 'HOLD' END AS signal
  FROM feat a LEFT JOIN scores s ON a.date = s.date AND a.symbol = s.symbol
  WHERE a.date >= CAST((SELECT d FROM as_of) - INTERVAL 180 DAY AS DATE) AND a.next_day_return IS NOT NULL)"""

_DOW_FRAME = "OVER (PARTITION BY symbol, dayofweek(date) ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
_ZONE_FRAME = "OVER (PARTITION BY symbol, month_end_zone ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"

MEAN_REV_SQL = """CASE WHEN rsi_14 < 30 AND bb_pct_b < 0.1 THEN 1.0::DOUBLE
      WHEN rsi_14 < 35 AND bb_pct_b < 0.2 THEN 0.5::DOUBLE
      WHEN rsi_14 > 70 AND bb_pct_b > 0.9 THEN -1.0::DOUBLE
      WHEN rsi_14 > 65 AND bb_pct_b > 0.8 THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END"""

CALM_SQL = """CASE WHEN bb_bandwidth IS NOT NULL AND atr_14 IS NOT NULL AND bb_bandwidth < 0.05 AND volume_vs_sma_ratio < 1.2 THEN 0.3::DOUBLE
      WHEN volume_surge_flag AND bb_bandwidth > 0.10 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END"""

RULES = f"""
market AS (SELECT date, AVG(next_day_return) AS market_avg_return FROM feat WHERE next_day_return IS NOT NULL GROUP BY date),
rstats AS (
  SELECT *, AVG(next_day_return) {_DOW_FRAME} AS _dm, STDDEV_SAMP(next_day_return) {_DOW_FRAME} AS _ds,
         AVG(next_day_return) {_ZONE_FRAME} AS _zm, STDDEV_SAMP(next_day_return) {_ZONE_FRAME} AS _zs
  FROM feat),
rules AS (
  SELECT f.date, f.symbol,
    CASE WHEN f.next_day_return IS NULL THEN 0.0::DOUBLE
         WHEN f._ds > 0 AND f._dm IS NOT NULL THEN {O.clamp('f._dm / f._ds * 0.5::DOUBLE', -1, 1)} ELSE 0.0::DOUBLE END AS dow_signal,
    CASE WHEN f.month_end_zone = 'month_end' AND f._zm IS NOT NULL AND f._zs > 0 THEN {O.clamp('f._zm / f._zs * 0.5::DOUBLE', -1, 1)}
         WHEN f.month_end_zone = 'last_week' AND f._zm IS NOT NULL AND f._zs > 0 THEN {O.clamp('f._zm / f._zs * 0.3::DOUBLE', -0.5, 0.5)}
         ELSE 0.0::DOUBLE END AS month_end_signal,
    {CALM_SQL} AS calm_before_storm_signal,
    {O.clamp('m.market_avg_return * 3.0::DOUBLE', -1, 1)} AS sentiment_signal,
    {MEAN_REV_SQL} AS mean_rev_signal
  FROM rstats f LEFT JOIN market m ON f.date = m.date)"""


def _model_pnl_sql(m: str) -> str:
    return f"CASE WHEN sign({m}_pred) = sign(actual_return) THEN abs(actual_return) ELSE -abs(actual_return) END"


PNL = "pnl AS (\n" + "\n  UNION ALL\n".join(
    [f"  SELECT '{e}' AS entrant_name, date, symbol, {_model_pnl_sql(m)} AS pnl FROM bt"
     for e, m in zip(arena.MODEL_ENTRANTS, backtest.MODELS)]
    + [f"  SELECT '{e}', b.date, b.symbol, r.{c} * b.actual_return FROM bt b JOIN rules r ON b.date = r.date AND b.symbol = r.symbol"
       for e, c in arena.RULE_ENTRANTS]) + ")"

LB = f"""
wk AS (
  SELECT entrant_name, {O.sunday_week('date')} AS week_start, COUNT(*) AS n_days,
    {O.R('AVG(pnl)', 4)} AS avg_daily_pnl, {O.R('STDDEV_SAMP(pnl)', 4)} AS std_daily_pnl,
    {O.R('AVG(CASE WHEN pnl > 0 THEN 1 ELSE 0 END)', 4)} AS win_rate, {O.R('SUM(pnl)', 4)} AS week_total_pnl,
    SUM(pnl) AS _sum
  FROM pnl GROUP BY 1, 2),
lb AS (
  SELECT entrant_name, week_start, n_days, avg_daily_pnl, std_daily_pnl, win_rate, week_total_pnl,
    SUM(_sum) OVER (PARTITION BY entrant_name ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) / 4.0::DOUBLE AS rolling_4w_pnl,
    CAST(ROW_NUMBER() OVER (PARTITION BY week_start ORDER BY week_total_pnl DESC, entrant_name) AS BIGINT) AS week_rank,
    CASE WHEN SUM(_sum) OVER (PARTITION BY entrant_name ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) / 4.0::DOUBLE > 0 THEN 'ALIVE' ELSE 'WARNING' END AS status
  FROM wk)"""

LB_SPEC = "entrant_name week_start n_days avg_daily_pnl:d std_daily_pnl:d win_rate:d week_total_pnl:d rolling_4w_pnl:d week_rank status"


# ------------------------------------------------------- spark shortcuts --
def feat(spark, sf):
    return silver_features(spark, sf)


def as_of(spark, sf):
    return default_as_of(spark, sf)


def scores(spark, sf):
    return signals.feature_scores(feat(spark, sf))


def bt(spark, sf):
    # actuals come from the pruned recent window; the scorer needs full history for its lags
    recent = silver_since(spark, sf, backtest.BACKTEST_DAYS)
    return backtest.backtest_results(recent, scores(spark, sf), as_of(spark, sf))


def rules(spark, sf):
    return signals.rule_signals_wide(feat(spark, sf))


def pnl(spark, sf):
    return arena.entrant_daily_pnl(bt(spark, sf), rules(spark, sf))


def lb(spark, sf):
    return arena.arena_leaderboard(pnl(spark, sf))


# ================================================================ S / F ====
@register("price_path", O.on_bars(f"SELECT {sel('symbol date open:d high:d low:d close:d volume')} FROM bars"))
def q_price_path(spark, sf):
    """Bars with compounded integer-cent prices, derived from lineitem."""
    return bars_from_tables(spark, sf)


@register("features_daily", O.on_feat(f"SELECT {sel(FEAT_SPEC)} FROM feat"))
def q_features_daily(spark, sf):
    """full 35-column feature table over the bronze bars (derived from the raw tables)."""
    return features_daily(bronze_bars(spark, sf), as_of(spark, sf))


# ====================================================================== R ==
@register("signal_mean_reversion", O.on_feat(f"SELECT date, symbol, {MEAN_REV_SQL} AS mean_rev_signal FROM feat"))
def q_signal_mean_reversion(spark, sf):
    """R5."""
    return signals.signal_mean_reversion(feat(spark, sf))


# ====================================================================== L ==
@register("entrant_daily_pnl", O.on_feat("SELECT entrant_name, date, symbol, " + O.R("pnl") + " AS pnl FROM pnl",
                                         SCORES, BT, RULES, PNL))
def q_entrant_daily_pnl(spark, sf):
    """L1."""
    return pnl(spark, sf)


@register("arena_leaderboard", O.on_feat(f"SELECT {sel(LB_SPEC)} FROM lb", SCORES, BT, RULES, PNL, LB))
def q_arena_leaderboard(spark, sf):
    """L2."""
    return lb(spark, sf)


DOW_SQL = ("CASE WHEN next_day_return IS NULL THEN 0.0::DOUBLE WHEN _ds > 0 AND _dm IS NOT NULL THEN "
           + O.clamp("_dm / _ds * 0.5::DOUBLE", -1, 1) + " ELSE 0.0::DOUBLE END")
ZONE_SQL = ("CASE WHEN month_end_zone = 'month_end' AND _zm IS NOT NULL AND _zs > 0 THEN " + O.clamp("_zm / _zs * 0.5::DOUBLE", -1, 1)
            + " WHEN month_end_zone = 'last_week' AND _zm IS NOT NULL AND _zs > 0 THEN " + O.clamp("_zm / _zs * 0.3::DOUBLE", -0.5, 0.5)
            + " ELSE 0.0::DOUBLE END")


@register("signal_dow", O.on_feat("SELECT date, symbol, " + O.R(DOW_SQL) + " AS dow_signal FROM rstats", RULES))
def q_signal_dow(spark, sf):
    """R1."""
    return signals.signal_dow(feat(spark, sf))


@register("signal_month_end", O.on_feat("SELECT date, symbol, " + O.R(ZONE_SQL) + " AS month_end_signal FROM rstats", RULES))
def q_signal_month_end(spark, sf):
    """R2 (point in time)."""
    return signals.signal_month_end(feat(spark, sf))


@register("signal_calm_before_storm", O.on_feat(f"SELECT date, symbol, {CALM_SQL} AS calm_before_storm_signal FROM feat"))
def q_signal_calm(spark, sf):
    """R3."""
    return signals.signal_calm_before_storm(feat(spark, sf))


@register("signal_sentiment", O.on_feat(
    "SELECT f.date, f.symbol, " + O.R(O.clamp("m.market_avg_return * 3.0::DOUBLE", -1, 1)) + " AS sentiment_signal "
    "FROM feat f JOIN market m ON f.date = m.date", RULES))
def q_signal_sentiment(spark, sf):
    """R4 (literal, same-date market mean)."""
    return signals.signal_sentiment(feat(spark, sf))


@register("signal_sentiment_lagged", O.on_feat(
    "SELECT f.date, f.symbol, " + O.R(O.clamp("p.prev_market * 3.0::DOUBLE", -1, 1)) + " AS sentiment_lagged_signal "
    "FROM feat f JOIN (SELECT date, LAG(market_avg_return) OVER (ORDER BY date) AS prev_market FROM market) p ON f.date = p.date",
    RULES))
def q_signal_sentiment_lagged(spark, sf):
    """R4b."""
    return signals.signal_sentiment_lagged(feat(spark, sf))


RULES_SPEC = "date symbol dow_signal:d month_end_signal:d calm_before_storm_signal:d sentiment_signal:d mean_rev_signal:d"


@register("rule_signals", O.on_feat(f"SELECT {sel(RULES_SPEC)} FROM rules", RULES))
def q_rule_signals(spark, sf):
    """R1-R5 side by side."""
    return rules(spark, sf)


@register("ga_feature_signals", O.on_feat(
    f"SELECT {sel('date symbol s_momentum:d s_volume:d s_reversal:d s_breakout:d next_day_return:d')} FROM fs", SCORES))
def q_ga_feature_signals(spark, sf):
    """G3 (also the deterministic scorer of the back-test)."""
    return signals.ga_feature_signals(feat(spark, sf))


SIG_CASE = """CASE
      WHEN momentum_pred > 0 AND volume_confirm_pred > momentum_pred THEN 'STRONG_MOMENTUM'
      WHEN breakout_pred > 2 AND volume_confirm_pred > 0 THEN 'BREAKOUT_CONFIRM'
      WHEN momentum_pred < 0 AND reversal_pred > abs(momentum_pred) THEN 'REVERSAL_BUY'
      WHEN momentum_pred > 0 AND reversal_pred < -0.5::DOUBLE * momentum_pred THEN 'REVERSAL_SELL'
      ELSE 'HOLD' END"""
SS_SPEC = "date symbol momentum_pred:d breakout_pred:d volume_confirm_pred:d reversal_pred:d"


@register("strategy_scores", O.on_feat(f"SELECT {sel(SS_SPEC)}, {SIG_CASE} AS signal FROM scores", SCORES))
def q_strategy_scores(spark, sf):
    """M13 + M14 over the deterministic scores."""
    return signals.strategy_scores(scores(spark, sf))


@register("recent_predictions", O.on_feat(
    f"SELECT {sel(SS_SPEC)}, {SIG_CASE} AS signal FROM scores ORDER BY date DESC, symbol LIMIT 100", SCORES))
def q_recent_predictions(spark, sf):
    """Newest 100 predictions (a top-k report)."""
    s = signals.strategy_scores(scores(spark, sf))
    return s.orderBy(F.col("date").desc(), F.col("symbol")).limit(100)


# ====================================================================== B ==
BT_SPEC = ("date symbol actual_return:d momentum_pred:d breakout_pred:d volume_confirm_pred:d reversal_pred:d "
           "momentum_dir_correct breakout_dir_correct volume_confirm_dir_correct reversal_dir_correct signal")


@register("backtest_results", O.on_feat(f"SELECT {sel(BT_SPEC)} FROM bt", SCORES, BT))
def q_backtest_results(spark, sf):
    """B1."""
    return bt(spark, sf)


def _hit_sql(m):
    return f"sign({m}_pred) = sign(actual_return)"


_B2 = ["COUNT(*) AS total_days", f"{O.R('AVG(actual_return)', 4)} AS avg_actual_return"]
_B2 += [f"{O.R(f'AVG(abs({m}_pred - actual_return))', 4)} AS {m}_mae" for m in backtest.MODELS]
_B2 += [f"{O.R(f'sqrt(AVG(pow({m}_pred - actual_return, 2)))', 4)} AS {m}_rmse" for m in backtest.MODELS]
_B2 += [f"{O.R(f'AVG(CASE WHEN {_hit_sql(m)} THEN 1 ELSE 0 END)', 4)} AS {m}_dir_accuracy" for m in backtest.MODELS]
_B2 += [f"{O.R(f'AVG(CASE WHEN {_hit_sql(m)} THEN actual_return ELSE 0.0::DOUBLE END)', 4)} AS {m}_avg_return_when_correct"
        for m in backtest.MODELS]


@register("backtest_model_summary", O.on_feat("SELECT " + ", ".join(_B2) + " FROM bt", SCORES, BT))
def q_backtest_model_summary(spark, sf):
    """B2."""
    return backtest.backtest_model_summary(bt(spark, sf))


_B3 = f"""SELECT signal, COUNT(*) AS signal_count,
  {O.R('AVG(actual_return)', 4)} AS avg_return, {O.R('AVG(abs(actual_return))', 4)} AS avg_abs_return,
  {O.R('AVG(CASE WHEN actual_return > 0 THEN 1 ELSE 0 END)', 4)} AS win_rate,
  {O.R('AVG(CASE WHEN actual_return > 0 THEN actual_return END)', 4)} AS avg_win,
  {O.R('AVG(CASE WHEN actual_return < 0 THEN actual_return END)', 4)} AS avg_loss,
  {O.R('MIN(actual_return)', 4)} AS max_loss_single, {O.R('MAX(actual_return)', 4)} AS max_gain_single,
  {O.R('CASE WHEN STDDEV_SAMP(actual_return) = 0 THEN 0.0::DOUBLE ELSE AVG(actual_return) / STDDEV_SAMP(actual_return) * sqrt(252.0::DOUBLE) END', 4)} AS sharpe_ratio_annualized
FROM bt GROUP BY signal"""


@register("backtest_signal_performance", O.on_feat(_B3, SCORES, BT))
def q_backtest_signal_performance(spark, sf):
    """B3."""
    return backtest.backtest_signal_performance(bt(spark, sf))


_SIGNAL_PNL_SQL = """CASE WHEN signal = 'HOLD' THEN 0.0::DOUBLE
      WHEN signal IN ('STRONG_MOMENTUM', 'BREAKOUT_CONFIRM', 'REVERSAL_BUY') THEN CASE WHEN actual_return > 0 THEN actual_return ELSE -abs(actual_return) END
      WHEN signal = 'REVERSAL_SELL' THEN CASE WHEN actual_return < 0 THEN abs(actual_return) ELSE -actual_return END
      ELSE 0.0::DOUBLE END"""
DPNL = ("dpnl AS (SELECT date, symbol, actual_return AS raw_return, "
        + ", ".join(f"{_model_pnl_sql(m)} AS {m}_pnl" for m in backtest.MODELS)
        + f", {_SIGNAL_PNL_SQL} AS signal_pnl FROM bt)")
PNL_COLS = backtest.PNL_COLUMNS
CUM = ("perdate AS (SELECT date, " + ", ".join(f"SUM({c}) AS {c}" for c in PNL_COLS) + " FROM dpnl GROUP BY date),\n"
       "curve AS (SELECT date, " + ", ".join(
           f"SUM({c}) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 100.0::DOUBLE + 1.0::DOUBLE AS {backtest._curve_name(c)}"
           for c in PNL_COLS) + " FROM perdate)")


@register("backtest_daily_pnl", O.on_feat(f"SELECT {sel('date symbol ' + ' '.join(c + ':d' for c in PNL_COLS))} FROM dpnl",
                                          SCORES, BT, DPNL))
def q_backtest_daily_pnl(spark, sf):
    """B4."""
    return backtest.backtest_daily_pnl(bt(spark, sf))


_CUM_SPEC = "date symbol " + " ".join(c + ":d" for c in PNL_COLS) + " " + " ".join(backtest._curve_name(c) + ":d" for c in PNL_COLS)
CUMQ = "cum AS (SELECT * FROM dpnl JOIN curve USING (date))"


@register("backtest_cumulative_returns", O.on_feat(f"SELECT {sel(_CUM_SPEC)} FROM cum", SCORES, BT, DPNL, CUM, CUMQ))
def q_backtest_cumulative_returns(spark, sf):
    """B5."""
    return backtest.backtest_cumulative_returns(bt(spark, sf))


@register("recent_cumulative", O.on_feat(f"SELECT {sel(_CUM_SPEC)} FROM cum ORDER BY date DESC, symbol LIMIT 10",
                                         SCORES, BT, DPNL, CUM, CUMQ))
def q_recent_cumulative(spark, sf):
    """Newest 10 rows (top-k report)."""
    return backtest.recent_cumulative(backtest.backtest_cumulative_returns(bt(spark, sf)), 10)


_MDD = ("mdd_long AS (" + " UNION ALL ".join(
    f"SELECT '{backtest._curve_name(c)}' AS curve, date, {backtest._curve_name(c)} AS value FROM curve" for c in PNL_COLS) + ")")


@register("max_drawdown", O.on_feat(
    "SELECT curve, " + O.R("MAX(dd)") + " AS max_drawdown FROM (SELECT curve, MAX(value) OVER (PARTITION BY curve ORDER BY date "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - value AS dd FROM mdd_long) GROUP BY curve",
    SCORES, BT, DPNL, CUM, _MDD))
def q_max_drawdown(spark, sf):
    """B7."""
    return backtest.max_drawdown(bt(spark, sf))


# ====================================================================== L ==
@register("leaderboard_latest_week", O.on_feat(
    f"SELECT {sel(LB_SPEC)} FROM lb WHERE week_start = (SELECT max(week_start) FROM lb)", SCORES, BT, RULES, PNL, LB))
def q_leaderboard_latest_week(spark, sf):
    """L3."""
    return arena.leaderboard_latest_week(lb(spark, sf))


@register("leaderboard_alltime", O.on_feat(
    f"SELECT entrant_name, {O.R('SUM(week_total_pnl)', 4)} AS total_pnl, {O.R('AVG(win_rate)', 4)} AS avg_win_rate, "
    "COUNT(*) AS weeks FROM lb GROUP BY entrant_name ORDER BY total_pnl DESC, entrant_name LIMIT 10",
    SCORES, BT, RULES, PNL, LB))
def q_leaderboard_alltime(spark, sf):
    """L4: top 10 entrants over all weeks."""
    return arena.leaderboard_alltime(lb(spark, sf))


SURV = f"""
sv AS (SELECT *, CASE WHEN rolling_4w_pnl <= 0 THEN 1 ELSE 0 END AS _strike,
         ROW_NUMBER() OVER (PARTITION BY entrant_name ORDER BY week_start) AS _rn FROM lb),
sv2 AS (SELECT *, _rn - COALESCE(MAX(CASE WHEN _strike = 0 THEN _rn END) OVER (PARTITION BY entrant_name ORDER BY week_start
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS _run FROM sv),
sv3 AS (SELECT *, MAX(CASE WHEN _run >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY entrant_name ORDER BY week_start
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _out FROM sv2),
surv AS (SELECT week_start, entrant_name,
  CASE WHEN _out = 1 THEN 'ELIMINATED' WHEN _run = 0 THEN 'ALIVE' ELSE 'WARNING_' || CAST(_run AS VARCHAR) END AS status,
  week_rank, rolling_4w_pnl,
  CASE WHEN _out = 1 THEN 'rolling 4-week P&L not positive for 3 weeks' WHEN _run > 0 THEN 'rolling 4-week P&L not positive'
       ELSE 'rolling 4-week P&L positive' END AS reason FROM sv3)"""


@register("survival_log", O.on_feat(f"SELECT {sel('week_start entrant_name status week_rank rolling_4w_pnl:d reason')} FROM surv",
                                    SCORES, BT, RULES, PNL, LB, SURV))
def q_survival_log(spark, sf):
    """L5."""
    return arena.survival_log(lb(spark, sf))


SLONG = "slong AS (\n" + "\n  UNION ALL\n".join(
    [f"  SELECT '{e}' AS entrant_name, date, symbol, CAST(sign({m}_pred) AS DOUBLE) AS signal FROM bt"
     for e, m in zip(arena.MODEL_ENTRANTS, backtest.MODELS)]
    + [f"  SELECT '{e}', b.date, b.symbol, r.{c} FROM bt b JOIN rules r ON b.date = r.date AND b.symbol = r.symbol"
       for e, c in arena.RULE_ENTRANTS]) + ")"


def slong(spark, sf):
    return arena.entrant_signals_long(bt(spark, sf), rules(spark, sf))


@register("mask_eliminated", O.on_feat(
    "SELECT s.entrant_name, s.date, s.symbol, " + O.R("s.signal") + " AS signal FROM slong s LEFT JOIN "
    "(SELECT entrant_name, min(week_start) AS ow FROM surv WHERE status = 'ELIMINATED' GROUP BY 1) o USING (entrant_name) "
    "WHERE o.ow IS NULL OR s.date < CAST(o.ow + 7 AS DATE)", SCORES, BT, RULES, PNL, LB, SURV, SLONG))
def q_mask_eliminated(spark, sf):
    """L6."""
    return arena.mask_eliminated(slong(spark, sf), arena.survival_log(lb(spark, sf)))


ENS = f"""
topw AS (SELECT entrant_name, CAST(week_start + 7 AS DATE) AS apply_week FROM lb WHERE week_rank <= 3),
ens AS (SELECT s.date, s.symbol, AVG(s.signal) AS ensemble_signal FROM slong s JOIN topw t
        ON s.entrant_name = t.entrant_name AND {O.sunday_week('s.date')} = t.apply_week GROUP BY 1, 2)"""


def ensemble(spark, sf):
    return signals.signal_ensemble(slong(spark, sf), lb(spark, sf))


@register("signal_ensemble", O.on_feat("SELECT date, symbol, " + O.R("ensemble_signal") + " AS ensemble_signal FROM ens",
                                       SCORES, BT, RULES, PNL, LB, SLONG, ENS))
def q_signal_ensemble(spark, sf):
    """Previous week's top-3 entrants, mean signal."""
    return ensemble(spark, sf)


_R7_SPEC = ("date symbol momentum_pred:d breakout_pred:d volume_confirm_pred:d reversal_pred:d dow_signal:d month_end_signal:d "
            "calm_before_storm_signal:d sentiment_signal:d mean_rev_signal:d ensemble_signal:d")


@register("arena_signals", O.on_feat(
    f"SELECT {sel(_R7_SPEC)} FROM (SELECT b.date, b.symbol, b.momentum_pred, b.breakout_pred, b.volume_confirm_pred, "
    "b.reversal_pred, r.dow_signal, r.month_end_signal, r.calm_before_storm_signal, r.sentiment_signal, r.mean_rev_signal, "
    "e.ensemble_signal FROM bt b LEFT JOIN rules r ON b.date = r.date AND b.symbol = r.symbol "
    "LEFT JOIN ens e ON b.date = e.date AND b.symbol = e.symbol)", SCORES, BT, RULES, PNL, LB, SLONG, ENS))
def q_arena_signals(spark, sf):
    """R7."""
    return arena.arena_signals(bt(spark, sf), rules(spark, sf), ensemble(spark, sf))


# ====================================================================== G ==
from barforge.operators import evolution as E  # noqa: E402
from barforge.plans import oracle_ga as OG  # noqa: E402

GA = (SCORES, OG.GENES, OG.SIG)


def ga_parts(spark, sf):
    """Lazily chained GA frames for one (session, sf_dir)."""
    f = feat(spark, sf)
    fs = signals.ga_feature_signals(f, carry=("close",))
    genes = E.gene_pool_init(spark, E.POP_SIZE, OG.SEED_INIT)
    sig = E.ga_signals(fs, genes)
    pos = E.ga_positions(sig)
    trades = E.ga_trades(pos)
    weekly = E.ga_weekly_pnl(trades)
    fit = E.ga_fitness_recent(weekly, as_of(spark, sf))
    cur = E.ga_current_generation(genes, fit)
    return dict(feat=f, fs=fs, genes=genes, sig=sig, pos=pos, trades=trades, weekly=weekly, fit=fit, cur=cur)


@register("week_types", O.on_feat(
    f"SELECT {sel('week_start avg_volatility:d avg_trend_strength:d avg_volume_ratio:d dominant_zone reversal_opportunity:d market_return:d week_cluster vol_regime market_regime')} FROM wt",
    OG.WEEK_TYPES))
def q_week_types(spark, sf):
    """G2."""
    return E.week_types(feat(spark, sf))


@register("week_zone_sketch", O.on_feat(
    "SELECT week_start, month_end_zone AS dominant_zone, n AS zone_rows, " + O.R("n::DOUBLE / total") + " AS zone_share FROM ("
    f"SELECT *, sum(n) OVER (PARTITION BY week_start) AS total FROM (SELECT {O.sunday_week('date')} AS week_start, month_end_zone, count(*) AS n "
    "FROM feat WHERE next_day_return IS NOT NULL GROUP BY ALL)) "
    "QUALIFY row_number() OVER (PARTITION BY week_start ORDER BY n DESC, month_end_zone) = 1"))
def q_week_zone_sketch(spark, sf):
    """Dominant zone of every week from mergeable sketches per day, stored and read back."""
    path = _fresh(spark, "zone-sketches")
    E.day_zone_sketches(feat(spark, sf)).write.parquet(path)
    return E.week_zones(spark.read.parquet(path))


@register("clustered_feature_signals", O.on_feat(
    f"SELECT {sel('date symbol s_momentum:d s_volume:d s_reversal:d s_breakout:d next_day_return:d')} FROM fs", SCORES))
def q_clustered_feature_signals(spark, sf):
    """S13 + G3: the feature signals read from the table that is bucketed and sorted by symbol."""
    return signals.ga_feature_signals(silver_clustered(spark, sf))


SIG_SPEC = ("date symbol gene_id generation strategy_name threshold:d stop_loss:d take_profit:d max_hold_days max_positions "
            "raw_signal:d next_day_return:d s_momentum:d s_volume:d s_reversal:d s_breakout:d close:d")


@register("ga_signals", O.on_feat(f"SELECT {sel(SIG_SPEC)} FROM sig", *GA))
def q_ga_signals(spark, sf):
    """Every gene x every labelled row."""
    return ga_parts(spark, sf)["sig"]


@register("ga_positions", O.on_feat(
    f"SELECT {sel('date gene_id strategy_name generation symbol raw_signal:d side signal_strength:d close:d')} FROM pos", *GA))
def q_ga_positions(spark, sf):
    """G5."""
    return ga_parts(spark, sf)["pos"]


@register("ga_trades", O.on_feat(
    f"SELECT {sel('gene_id strategy_name generation week_start symbol raw_signal:d side entry_close:d exit_close:d entry_date exit_date pnl_pct:d')} FROM trades2",
    *GA))
def q_ga_trades(spark, sf):
    """G6."""
    return ga_parts(spark, sf)["trades"]


WEEKLY_SPEC = "gene_id strategy_name generation week_start n_trades avg_pnl:d std_pnl:d week_pnl:d win_rate:d"


@register("ga_weekly_pnl", O.on_feat(f"SELECT {sel(WEEKLY_SPEC)} FROM weekly", *GA))
def q_ga_weekly_pnl(spark, sf):
    """G7."""
    return ga_parts(spark, sf)["weekly"]


@register("ga_fitness_recent", O.on_feat(
    f"SELECT {sel('gene_id strategy_name generation cumulative_pnl:d avg_win_rate:d weeks_alive')} FROM fitness", *GA))
def q_ga_fitness_recent(spark, sf):
    """G8."""
    return ga_parts(spark, sf)["fit"]


@register("ga_current_generation", O.on_feat(f"SELECT {sel(OG.GENE_SPEC + ' cumulative_pnl:d')} FROM cur", *GA))
def q_ga_current_generation(spark, sf):
    """G9."""
    return ga_parts(spark, sf)["cur"]


@register("ga_select_parents", O.on_feat(f"SELECT {sel(OG.GENE_SPEC + ' cumulative_pnl:d parent_rank')} FROM par", *GA))
def q_ga_select_parents(spark, sf):
    """G10."""
    return E.ga_select_parents(ga_parts(spark, sf)["cur"]).withColumn("parent_rank", F.col("parent_rank").cast("long"))


@register("ga_next_generation", O.on_feat(f"SELECT {sel(OG.GENE_SPEC)} FROM nextgen", *GA, OG.NEXTGEN))
def q_ga_next_generation(spark, sf):
    """Elites, crossover children, mutants, random newcomers."""
    return E.ga_next_generation(ga_parts(spark, sf)["cur"], OG.SEED_EVOLVE)


@register("gene_pool_append", O.on_feat(
    f"SELECT {sel(OG.GENE_SPEC)} FROM (SELECT * FROM genes UNION ALL BY NAME SELECT * FROM nextgen)", *GA, OG.NEXTGEN))
def q_gene_pool_append(spark, sf):
    """Append the next generation, ids continuing from the pool's max."""
    p = ga_parts(spark, sf)
    return E.append_generation(p["genes"], E.ga_next_generation(p["cur"], OG.SEED_EVOLVE))


@register("ga_fitness_by_generation", O.on_feat(
    "SELECT generation, " + O.R("AVG(p)") + " AS avg_cumulative_pnl, " + O.R("STDDEV_SAMP(p)") + " AS std_cumulative_pnl, "
    "COUNT(*) AS n_genes FROM (SELECT generation, gene_id, SUM(week_pnl) AS p FROM weekly GROUP BY 1, 2) GROUP BY generation", *GA))
def q_ga_fitness_by_generation(spark, sf):
    """G14."""
    return E.ga_fitness_by_generation(ga_parts(spark, sf)["weekly"])


@register("ga_top_strategies_week", O.on_feat(
    "SELECT week_start, strategy_name, " + O.R("SUM(week_pnl)") + " AS week_pnl FROM weekly "
    "WHERE week_start = (SELECT max(week_start) FROM weekly) GROUP BY 1, 2 ORDER BY week_pnl DESC, strategy_name LIMIT 5", *GA))
def q_ga_top_strategies_week(spark, sf):
    """Top 5 of the newest week."""
    return E.ga_top_strategies_week(ga_parts(spark, sf)["weekly"])


@register("ga_gene_diversity", O.on_feat(
    "SELECT weight, " + O.R("std") + " AS std FROM (" + " UNION ALL ".join(
        f"SELECT '{w}' AS weight, STDDEV_SAMP({w}) AS std FROM genes WHERE gene_id IN "
        "(SELECT gene_id FROM weekly WHERE week_start = (SELECT max(week_start) FROM weekly))" for w in E.WEIGHTS) + ")", *GA))
def q_ga_gene_diversity(spark, sf):
    """G16."""
    p = ga_parts(spark, sf)
    return E.ga_gene_diversity(p["weekly"], p["genes"])


FITSCORE = """
fscore AS (SELECT gene_id, strategy_name, n_trades,
   (_m * _w) / NULLIF(_s, 0) - 0.1::DOUBLE * n_trades AS fitness
  FROM (SELECT gene_id, strategy_name, AVG(week_pnl) AS _m, STDDEV_SAMP(week_pnl) AS _s, AVG(win_rate) AS _w,
               CAST(SUM(n_trades) AS BIGINT) AS n_trades FROM weekly GROUP BY 1, 2))"""


@register("fitness_score", O.on_feat(f"SELECT {sel('gene_id strategy_name n_trades fitness:d')} FROM fscore", *GA, FITSCORE))
def q_fitness_score(spark, sf):
    """X3."""
    return E.fitness_score(ga_parts(spark, sf)["weekly"])


@register("cull_tiers", O.on_feat(
    f"SELECT {sel('gene_id strategy_name n_trades fitness:d fitness_rank tier')} FROM (SELECT *, "
    "CAST(ROW_NUMBER() OVER (ORDER BY fitness DESC NULLS LAST, gene_id) AS BIGINT) AS fitness_rank FROM fscore) x, "
    "LATERAL (SELECT CASE WHEN fitness_rank <= 3 THEN 'PARENT' WHEN fitness_rank <= 7 THEN 'SURVIVE' ELSE 'CULL' END AS tier)",
    *GA, FITSCORE))
def q_cull_tiers(spark, sf):
    """X4."""
    return E.cull_tiers(E.fitness_score(ga_parts(spark, sf)["weekly"])).withColumn(
        "fitness_rank", F.col("fitness_rank").cast("long"))


PAIRS = ("pairs AS (SELECT CAST(a.parent_rank AS BIGINT) AS pair_id, "
         + ", ".join(f"a.{c} AS _a_{c}, b.{c} AS _b_{c}" for c in E.GENE_COLS)
         + " FROM par a JOIN par b ON b.parent_rank = a.parent_rank + 1)")


def _pairs(spark, sf):
    par = E.ga_select_parents(ga_parts(spark, sf)["cur"])
    a = par.select(F.col("parent_rank").cast("long").alias("pair_id"), *[F.col(c).alias(f"_a_{c}") for c in E.GENE_COLS])
    b = par.select((F.col("parent_rank") - 1).cast("long").alias("pair_id"), *[F.col(c).alias(f"_b_{c}") for c in E.GENE_COLS])
    return a.join(b, "pair_id")


_TWO_POINT = []
for _i, _c in enumerate(E.GENE_COLS):
    _c1 = f"CAST(floor({OG.U(OG.SEED_EVOLVE, 'pair_id', OG.q('cut1'))} * {float(len(E.GENE_COLS))}::DOUBLE) AS INTEGER)"
    _c2 = f"CAST(floor({OG.U(OG.SEED_EVOLVE, 'pair_id', OG.q('cut2'))} * {float(len(E.GENE_COLS))}::DOUBLE) AS INTEGER)"
    _TWO_POINT.append(f"CASE WHEN {_i} >= least({_c1}, {_c2}) AND {_i} < greatest({_c1}, {_c2}) THEN _b_{_c} ELSE _a_{_c} END AS {_c}")
GSPEC = " ".join(c + (":d" if c in E.REAL_GENES else "") for c in E.GENE_COLS)


@register("crossover_two_point", O.on_feat(
    f"SELECT {sel('pair_id ' + GSPEC)} FROM (SELECT pair_id, {', '.join(_TWO_POINT)} FROM pairs)", *GA, PAIRS))
def q_crossover_two_point(spark, sf):
    """X5 (two-point crossover of adjacent-ranked parents)."""
    return E.crossover_two_point(_pairs(spark, sf), OG.SEED_EVOLVE)


@register("blend_fixed", O.on_feat(
    f"SELECT {sel('pair_id ' + GSPEC)} FROM (SELECT pair_id, " + ", ".join(
        (O.R(f"_a_{c} * 0.3::DOUBLE + _b_{c} * 0.7::DOUBLE", 9) if c in E.REAL_GENES else f"_a_{c}") + f" AS {c}"
        for c in E.GENE_COLS) + " FROM pairs)", *GA, PAIRS))
def q_blend_fixed(spark, sf):
    """X5 (fixed alpha 0.3 blend)."""
    return E.blend_fixed(_pairs(spark, sf))


@register("week_strategy_map", O.on_feat(
    "SELECT vol_regime, market_regime, gene_id, wins, (SELECT '[' || concat_ws(',', " + ", ".join(
        f"CAST(floor({c} * 10000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)" for c in E.WEIGHTS) + ") || ']' FROM genes g "
    "WHERE g.gene_id = best.gene_id) AS weight_vector FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vol_regime, market_regime "
    "ORDER BY wins DESC, gene_id) AS rn FROM (SELECT t.vol_regime, t.market_regime, w.gene_id, COUNT(*) AS wins FROM "
    "(SELECT week_start, gene_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start ORDER BY week_pnl DESC, gene_id) AS rn "
    "FROM weekly) WHERE rn = 1) w JOIN wt t ON w.week_start = t.week_start GROUP BY 1, 2, 3)) best WHERE rn = 1",
    *GA, OG.WEEK_TYPES))
def q_week_strategy_map(spark, sf):
    """X6."""
    parts = ga_parts(spark, sf)
    return E.week_strategy_map(parts["weekly"], E.week_types(feat(spark, sf)), parts["genes"])


@register("ga_rolling_pnl", O.on_feat(
    "SELECT gene_id, week_start, " + O.R("week_pnl") + " AS week_pnl, " + O.R(
        "AVG(week_pnl) OVER (PARTITION BY gene_id ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
    + " AS rolling_pnl FROM weekly", *GA))
def q_ga_rolling_pnl(spark, sf):
    """X15."""
    return E.ga_rolling_pnl(ga_parts(spark, sf)["weekly"])


# ====================================================================== A ==
from barforge.operators import anomaly as A  # noqa: E402
from barforge.operators import health as H  # noqa: E402
from barforge.operators import models as M  # noqa: E402

_DOWN = "CASE dayofweek(date) " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(A.DOW_NAMES)) + " END"
_SEASON = "CASE month(date) " + " ".join(f"WHEN {m} THEN '{s}'" for m, s in A.SEASONS.items()) + " END"
# label of each segment type over a row of seg: one list per row, unnested
_SEG_LABELS = ", ".join(f"{{'seg_type': '{t}', 'seg_value': {v}}}" for t, v in {
    "segment": "'all'", "season": "season", "month": "mth::VARCHAR", "month_week_zone": "month_week_zone",
    "month_end_zone": "month_end_zone", "dow": "dow::VARCHAR", "dow_name": "dow_name"}.items())
SEG = f"""
seg AS (
  SELECT date, symbol, close, volume, next_day_return, {O.dow('date')} AS dow, CAST(month(date) AS BIGINT) AS mth,
    CAST(floor((dayofyear(date) + 7 - (dayofweek(date) + 1)) / 7.0) AS BIGINT) AS wk, {_DOWN} AS dow_name, month_end_zone,
    CASE WHEN day(date) <= 7 THEN 'week1' WHEN day(date) <= 14 THEN 'week2' WHEN day(date) <= 21 THEN 'week3' ELSE 'week4' END AS month_week_zone,
    {_SEASON} AS season
  FROM feat WHERE next_day_return IS NOT NULL),
unp AS (
  SELECT symbol, next_day_return, volume, k.seg_type, k.seg_value FROM (
    SELECT symbol, next_day_return, volume, unnest([{_SEG_LABELS}]) AS k FROM seg)),
sagg AS (
  SELECT seg_type, seg_value, COUNT(*) AS n, COUNT(DISTINCT symbol) AS n_symbols, AVG(next_day_return) AS _avg,
    STDDEV_SAMP(next_day_return) AS _std,
    AVG(next_day_return) / NULLIF(STDDEV_SAMP(next_day_return) / sqrt(COUNT(*)), 0) AS _t,
    AVG(CASE WHEN next_day_return > 0 THEN 1 ELSE 0 END) AS _win, AVG(volume) AS _vol
  FROM unp GROUP BY 1, 2),
segs AS (
  SELECT seg_type, seg_value, n, n_symbols, {O.R('_avg', 4)} AS avg_return, {O.R('_std', 4)} AS std_return,
    {O.R('_t', 2)} AS t_stat, {O.R('_win', 4)} AS win_rate,
    {O.R('_avg - AVG(_avg) OVER (PARTITION BY seg_type)', 6)} AS excess_return,
    {O.R('_vol / NULLIF(AVG(_vol) OVER (PARTITION BY seg_type), 0)', 4)} AS volume_ratio,
    {O.R('2.0::DOUBLE * (1.0::DOUBLE - ' + O.clamp('abs(_t)', 0.0001, 0.9999) + ')', 4)} AS p_value_approx
  FROM sagg)"""
SEGS_SPEC = "seg_type seg_value n n_symbols avg_return:d std_return:d t_stat:d win_rate:d excess_return:d volume_ratio:d p_value_approx:d"

CROSS = f"""
xb AS (SELECT next_day_return, CAST({O.dow('date')} AS VARCHAR) AS dow, CAST(month(date) AS VARCHAR) AS mth, month_end_zone,
          CAST(quarter_end_flag AS VARCHAR) AS qe, CASE WHEN volume_surge_flag THEN 'surge' ELSE 'normal' END AS vol_mode
       FROM feat WHERE next_day_return IS NOT NULL),
xk AS (SELECT next_day_return, unnest(['dow=' || dow || '|mend=' || month_end_zone, 'mon=' || mth || '|qend=' || qe,
                                       'dow=' || dow || '|vol=' || vol_mode]) AS segment_key FROM xb),
xseg AS (SELECT segment_key, COUNT(*) AS n, {O.R('AVG(next_day_return)', 4)} AS avg_return,
           {O.R('AVG(CASE WHEN next_day_return > 0 THEN 1 ELSE 0 END)', 4)} AS win_rate FROM xk GROUP BY 1)"""

BYSYM = f"""
bk AS (SELECT symbol, next_day_return, 'dow' AS seg_type, CAST({O.dow('date')} AS VARCHAR) AS seg_value FROM feat WHERE next_day_return IS NOT NULL
       UNION ALL SELECT symbol, next_day_return, 'month', CAST(month(date) AS VARCHAR) FROM feat WHERE next_day_return IS NOT NULL
       UNION ALL SELECT symbol, next_day_return, 'month_end_zone', month_end_zone FROM feat WHERE next_day_return IS NOT NULL),
bys AS (SELECT symbol, seg_type, seg_value, COUNT(*) AS n, {O.R('AVG(next_day_return)', 4)} AS avg_return,
          {O.R('AVG(CASE WHEN next_day_return > 0 THEN 1 ELSE 0 END)', 4)} AS win_rate
        FROM bk GROUP BY 1, 2, 3 HAVING COUNT(*) >= 10)"""


@register("segment_labels", O.on_feat(
    f"SELECT {sel('date symbol close:d volume next_day_return:d dow mth wk dow_name month_end_zone month_week_zone season')} FROM seg",
    SEG))
def q_segment_labels(spark, sf):
    """A1."""
    return A.segment_labels(feat(spark, sf))


@register("anomaly_segments", O.on_feat(f"SELECT {sel(SEGS_SPEC)} FROM segs", SEG))
def q_anomaly_segments(spark, sf):
    """A2."""
    return A.anomaly_segments(feat(spark, sf))


@register("anomaly_cross_segments", O.on_feat(f"SELECT {sel('segment_key n avg_return:d win_rate:d')} FROM xseg", CROSS))
def q_anomaly_cross_segments(spark, sf):
    """A3."""
    return A.anomaly_cross_segments(feat(spark, sf))


@register("anomaly_by_symbol", O.on_feat(f"SELECT {sel('symbol seg_type seg_value n avg_return:d win_rate:d')} FROM bys", BYSYM))
def q_anomaly_by_symbol(spark, sf):
    """A4."""
    return A.anomaly_by_symbol(feat(spark, sf))


@register("anomaly_significant", O.on_feat(f"SELECT {sel(SEGS_SPEC)} FROM segs WHERE n >= 20 AND abs(t_stat) > 2", SEG))
def q_anomaly_significant(spark, sf):
    """A5."""
    return A.anomaly_significant(A.anomaly_segments(feat(spark, sf)))


@register("anomaly_top_cross", O.on_feat(
    f"SELECT {sel('segment_key n avg_return:d win_rate:d')} FROM xseg WHERE n >= 10 ORDER BY avg_return DESC, segment_key LIMIT 20",
    CROSS))
def q_anomaly_top_cross(spark, sf):
    """Top 20 cross segments."""
    return A.anomaly_top_cross(A.anomaly_cross_segments(feat(spark, sf)))


@register("anomaly_symbol_dow", O.on_feat(
    f"SELECT {sel('symbol seg_type seg_value n avg_return:d win_rate:d')} FROM bys WHERE seg_type = 'dow' AND win_rate > 0.6", BYSYM))
def q_anomaly_symbol_dow(spark, sf):
    """A7."""
    return A.anomaly_symbol_dow(A.anomaly_by_symbol(feat(spark, sf)))


@register("dow_zone_having", O.on_feat(
    "SELECT day_of_week AS dow, month_end_zone, " + O.R("AVG(next_day_return)") + " AS avg_return FROM feat "
    "GROUP BY 1, 2 HAVING COUNT(*) > 100"))
def q_dow_zone_having(spark, sf):
    """A8."""
    return A.dow_zone_having(feat(spark, sf))


_SCORE_SQL = O.R(O.clamp("(volume_vs_sma_ratio - 1.0::DOUBLE) * 20.0::DOUBLE + (CASE WHEN volume_chg_pct IS NOT NULL THEN "
                         "greatest(volume_chg_pct, 0.0::DOUBLE) END) * 0.5::DOUBLE + volume_incr_streak * 5.0::DOUBLE + "
                         "CASE WHEN volume_surge_flag THEN 30.0::DOUBLE ELSE 0.0::DOUBLE END", 0, 100), 2)
_ALERT = ("CASE " + " ".join(f"WHEN volume_increase_score >= {lv} THEN '{nm}'" for lv, nm in A.ALERT_LEVELS)
          + f" ELSE '{A.ALERT_DEFAULT}' END")
WATCH = f"""
recent AS (SELECT * FROM feat WHERE date >= CAST((SELECT d FROM as_of) - INTERVAL 30 DAY AS DATE)),
vw AS (
  SELECT symbol, date, close, volume, volume_sma_5, volume_vs_sma_ratio, volume_chg_pct, volume_incr_streak, volume_surge_flag,
    {_SCORE_SQL} AS volume_increase_score,
    AVG(volume_chg_pct) {O.W(5)} AS avg_vol_chg_5d,
    (close - LAG(close) {O.WS}) / NULLIF(LAG(close) {O.WS}, 0) * 100.0::DOUBLE AS price_chg_pct
  FROM recent)"""


@register("volume_watch", O.on_feat(
    "SELECT symbol, date, " + O.R("close") + " AS close, volume, volume_sma_5, "
    + O.R(O.R("volume_vs_sma_ratio", 2)) + " AS volume_vs_sma_ratio, " + O.R(O.R("volume_chg_pct", 2)) + " AS volume_chg_pct, "
    "volume_incr_streak, volume_surge_flag, " + O.R("volume_increase_score") + " AS volume_increase_score, "
    + O.R(O.R("avg_vol_chg_5d", 2)) + " AS avg_vol_chg_5d, " + O.R(O.R("price_chg_pct", 2)) + " AS price_chg_pct, "
    + _ALERT + " AS alert_level FROM vw WHERE date = (SELECT max(date) FROM recent) AND volume_increase_score >= 30", WATCH))
def q_volume_watch(spark, sf):
    """A9 (with M7 score)."""
    return A.volume_watch(silver_since(spark, sf, A.WATCH_DAYS), as_of(spark, sf))


@register("oversold_scan", O.on_feat(
    f"SELECT {sel('date symbol close:d rsi_14:d volume_vs_sma_ratio:d')} FROM feat WHERE rsi_14 < 30"))
def q_oversold_scan(spark, sf):
    """A10."""
    return A.oversold_scan(feat(spark, sf))


@register("daily_mean_close", O.on_bars("SELECT date, " + O.R("AVG(close)", 8) + " AS avg_close FROM bars GROUP BY date"), k=8)
def q_daily_mean_close(spark, sf):
    """X16 (all bars, whole history)."""
    return A.daily_mean_close(bronze_bars(spark, sf))


# ====================================================================== H ==
def _health_tables(spark, sf):
    return {
        "bronze": {"bars": (lambda: bronze_bars(spark, sf), ["symbol", "date"], "date", lambda: bronze_metrics(spark, sf))},
        "silver": {"features_daily": (lambda: feat(spark, sf), ["date", "symbol"], "date", lambda: silver_metrics(spark, sf))},
        "gold": {
            "backtest_results": (lambda: bt(spark, sf), ["date", "symbol"], "date"),
            "arena_leaderboard": (lambda: lb(spark, sf), ["entrant_name", "week_start"], "week_start"),
            "ga_weekly_pnl": (lambda: ga_parts(spark, sf)["weekly"], ["gene_id", "week_start"], "week_start"),
        },
    }


def _health_sql(tier, name, src, keys, dcol):
    return (f"SELECT '{tier}' AS tier, '{name}' AS table_name, (SELECT COUNT(*) FROM {src}) AS row_count, "
            f"(SELECT max({dcol}) FROM {src}) AS latest_date, "
            f"(SELECT COALESCE(SUM(c - 1), 0) FROM (SELECT COUNT(*) AS c FROM {src} GROUP BY {', '.join(keys)})) AS duplicate_keys, "
            f"(SELECT COUNT(*) FROM {src} WHERE {' OR '.join(k + ' IS NULL' for k in keys)}) AS null_keys, "
            "NULL::VARCHAR AS error")


_H1 = " UNION ALL ".join([
    _health_sql("bronze", "bars", "bars", ["symbol", "date"], "date"),
    _health_sql("silver", "features_daily", "feat", ["date", "symbol"], "date"),
    _health_sql("gold", "backtest_results", "bt", ["date", "symbol"], "date"),
    _health_sql("gold", "arena_leaderboard", "lb", ["entrant_name", "week_start"], "week_start"),
    _health_sql("gold", "ga_weekly_pnl", "weekly", ["gene_id", "week_start"], "week_start"),
])


@register("table_health", O.on_feat("SELECT tier, table_name, CAST(row_count AS BIGINT) AS row_count, latest_date, "
                                    "CAST(duplicate_keys AS BIGINT) AS duplicate_keys, CAST(null_keys AS BIGINT) AS null_keys, "
                                    "error FROM (" + _H1 + ")", SCORES, BT, RULES, PNL, LB, OG.GENES, OG.SIG))
def q_table_health(spark, sf):
    """H1: bronze and silver by the counts gathered while they were written, gold by counting."""
    return H.table_health(spark, _health_tables(spark, sf))


@register("layer_rowcount_check", O.on_feat(
    "SELECT symbol, bronze_rows, silver_rows, bronze_rows = silver_rows AS rows_match FROM "
    "(SELECT symbol, COUNT(*) AS bronze_rows FROM b5 GROUP BY 1) JOIN (SELECT symbol, COUNT(*) AS silver_rows FROM feat GROUP BY 1) USING (symbol)"))
def q_layer_rowcount_check(spark, sf):
    """H2: from the counts gathered while silver was written, by counting where they are incomplete or disagree."""
    found = H.layer_rowcounts_from_metrics(spark, silver_metrics(spark, sf))
    return found if found is not None else recount_layers(spark, sf)


def recount_layers(spark, sf):
    """H2 by counting both layers."""
    from barforge.operators.features import feat_lookback_filter
    return H.layer_rowcount_check(feat_lookback_filter(bronze_bars(spark, sf), as_of(spark, sf)), feat(spark, sf))


# ====================================================================== M ==
_NON_DOUBLE = {"date", "symbol", "volume", "volume_sma_5", "volume_lag_1d", "volume_incr_streak", "volume_surge_flag",
               "_days_to_month_end", "month_end_zone", "quarter_end_flag", "day_of_week", "month_of_year",
               "vol_expansion_flag", "is_eval"}


def spec_of(cols):
    return " ".join(c if c in _NON_DOUBLE else c + ":d" for c in cols)


_CUT = "date < CAST((SELECT d FROM as_of) - INTERVAL 180 DAY AS DATE) AND next_day_return IS NOT NULL"
DERIVED = f"""
der AS (
  SELECT *, (high - low) / NULLIF(std_20, 0) AS volatility_compression,
    std_20 / NULLIF(LAG(std_20) {O.WS}, 0) >= 1.3::DOUBLE AS vol_expansion_flag,
    {_SCORE_SQL} AS volume_increase_score,
    volume_chg_pct / NULLIF(abs((close - close_lag_1d) / NULLIF(close_lag_1d, 0) * 100.0::DOUBLE), 0) AS volume_price_divergence,
    (close - sma_20) / NULLIF(sma_20, 0) * 100.0::DOUBLE AS price_sma_distance,
    abs(rsi_14 - 50.0::DOUBLE) AS rsi_extremity
  FROM feat)"""


def _register_train_set(strategy):
    cols = ["date", "symbol"] + [c for c in M.STRATEGY_FEATURES[strategy] if c != "symbol"] + ["next_day_return"]

    @register(f"train_set_{strategy}", O.on_feat(f"SELECT {sel(spec_of(cols))} FROM feat WHERE {_CUT}"))
    def q(spark, sf):
        return M.train_set(feat(spark, sf), strategy, as_of(spark, sf))
    q.__doc__ = f"M1-M5 training set for {strategy}."


def _register_variant(strategy):
    cols = ["date"] + M.VARIANT_FEATURES[strategy] + ["next_day_return"]

    @register(f"train_set_variant_{strategy}", O.on_feat(f"SELECT {sel(spec_of(cols))} FROM der WHERE {_CUT}", DERIVED))
    def q(spark, sf):
        return M.train_set_variant(feat(spark, sf), strategy, as_of(spark, sf))
    q.__doc__ = f"M17 variant training set for {strategy}."


for _s in ["momentum", "breakout", "volume_confirm", "reversal", "full"]:
    _register_train_set(_s)
for _s in ["momentum", "breakout", "volume_confirm", "reversal"]:
    _register_variant(_s)

_DER_COLS = ["date", "symbol", "volatility_compression", "vol_expansion_flag", "volume_increase_score",
             "volume_price_divergence", "price_sma_distance", "rsi_extremity"]


@register("derived_features", O.on_feat(f"SELECT {sel(spec_of(_DER_COLS))} FROM der", DERIVED))
def q_derived_features(spark, sf):
    """M6-M9."""
    return M.with_derived(feat(spark, sf)).select(*_DER_COLS)


@register("train_eval_split", O.on_feat(
    "SELECT date, symbol, " + OG.U(OG.q("split"), "symbol", "date") + " < 0.2::DOUBLE AS is_eval FROM feat WHERE " + _CUT))
def q_train_eval_split(spark, sf):
    """Deterministic 80/20 hold-out flag over the full training set."""
    return M.train_eval_split(M.train_set(feat(spark, sf), "full", as_of(spark, sf))).select("date", "symbol", "is_eval")


def _holdout(spark, sf):
    f = silver_since(spark, sf, M.HOLDOUT_DAYS)
    return f.filter(F.col("date") >= F.date_sub(F.lit(as_of(spark, sf)).cast("date"), M.HOLDOUT_DAYS))


def gbt_models(spark, sf, names):
    """The named models, each trained once per session and kept in the checkpoint folder."""
    a, f = as_of(spark, sf), feat(spark, sf)
    jobs = {s: (M.train_set(f, s, a), M.STRATEGY_FEATURES[s]) for s in names}
    return stored_models(spark, "gbt", (sf, str(a)), jobs, lambda missing: M.gbt_train_many(missing))


_IMPORTANCE = ("SELECT f.feature, " + O.R("coalesce(s.gain / (SELECT sum(sgain) FROM splits), 0)") + " AS importance FROM "
               "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(M.STRATEGY_FEATURES["full"])) + ") f(i, feature) "
               "LEFT JOIN (SELECT sf, sum(sgain) AS gain FROM splits GROUP BY sf) s ON s.sf = f.i")


@register("gbt_global_importance", OB.with_recursive(O.on_feat(
    _IMPORTANCE, OB.boosted("full", M.STRATEGY_FEATURES["full"]),
    "splits AS (SELECT DISTINCT it, was, sf, sgain FROM full_walk WHERE sf IS NOT NULL)")))
def q_gbt_global_importance(spark, sf):
    """M10 + M15: the full model (26 columns), feature importances."""
    return M.global_importance(gbt_models(spark, sf, ["full"])["full"], spark)


_STRATEGIES = ["momentum", "breakout", "volume_confirm", "reversal"]


@register("gbt_strategy_scores", OB.with_recursive(O.on_feat(
    f"SELECT {sel(SS_SPEC)}, {SIG_CASE} AS signal FROM gbt", *[OB.boosted(s, M.STRATEGY_FEATURES[s]) for s in _STRATEGIES],
    "gbt AS (SELECT date, symbol, " + ", ".join(f"{s}_score.pred AS {s}_pred" for s in _STRATEGIES) + " FROM momentum_score "
    + " ".join(f"JOIN {s}_score USING (date, symbol)" for s in _STRATEGIES[1:]) + ")")))
def q_gbt_strategy_scores(spark, sf):
    """M10 + M12 + M13: four models scored over the hold-out window, composite signal."""
    models = gbt_models(spark, sf, _STRATEGIES)
    return signals.strategy_scores(M.gbt_predict({f"{s}_pred": models[s] for s in _STRATEGIES}, _holdout(spark, sf)))


@register("gbt_local_explain", OB.with_recursive(O.on_feat(
    f"SELECT {sel('date symbol feature attribution:d rank')} FROM full_top", OB.boosted("full", M.STRATEGY_FEATURES["full"]),
    OB.attributions("full", M.STRATEGY_FEATURES["full"]))))
def q_gbt_local_explain(spark, sf):
    """Top-10 attributions per hold-out row (full model, its symbol column too)."""
    return M.local_explain_topk(gbt_models(spark, sf, ["full"])["full"], _holdout(spark, sf), 10)


# ====================================================================== S ==
import json as _json  # noqa: E402
import uuid as _uuid  # noqa: E402

from barforge.plans.storage import scratch_path  # noqa: E402
from barforge.sources import bronze as SB  # noqa: E402
from barforge.sources import files as SF  # noqa: E402

BAR_SPEC = "symbol date open:d high:d low:d close:d volume"


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{_uuid.uuid4().hex[:8]}")


@register("bronze_csv_scan", O.on_bars(f"SELECT {sel(BAR_SPEC)} FROM bars"))
def q_bronze_csv_scan(spark, sf):
    """Bars written as per-symbol CSV (plus a '_combined' copy Spark must skip), read back."""
    path = _fresh(spark, "csv")
    b = bronze_bars(spark, sf)
    SF.write_bars_csv(b, path)
    SF.write_bars_csv(b, path + "/_combined")
    return SF.read_bars_csv(spark, path).select("symbol", "date", "open", "high", "low", "close", "volume")


@register("bronze_json_scan", O.on_bars(f"SELECT {sel(BAR_SPEC)} FROM bars WHERE day(date) <> 31"))
def q_bronze_json_scan(spark, sf):
    """Quote records as JSON lines with an unknown field; lines of day-31 bars are truncated
    (malformed) and must be dropped."""
    path = _fresh(spark, "json")
    b = SF.with_payload(bronze_bars(spark, sf))
    js = F.to_json(F.struct("symbol", "open", "high", "low", "close", "volume",
                            F.col("date").cast("timestamp").alias("timestamp"), "_raw_json",
                            F.lit("x").alias("unknown_field")))
    line = F.when(F.dayofmonth("date") == 31, F.expr("substring(_js, 1, length(_js) - 7)")).otherwise(F.col("_js"))
    b.select("date", js.alias("_js")).select(line.alias("value")).write.mode("overwrite").text(path)
    q = SF.read_quotes_json(spark, path)
    return q.select("symbol", F.to_date("timestamp").alias("date"), "open", "high", "low", "close", "volume")


@register("bronze_wide_to_long", O.on_bars(f"SELECT {sel('date symbol open:d high:d low:d close:d volume')} FROM bars"))
def q_bronze_wide_to_long(spark, sf):
    """S3: the wide download layout (field x ticker columns) back to long bars."""
    return SF.wide_to_long(SF.bars_to_wide(bronze_bars(spark, sf)))


_CUT_OLD = "CAST((SELECT d FROM as_of) - INTERVAL 25 DAY AS DATE)"


def _split(spark, sf):
    b = bronze_bars(spark, sf)
    a = F.lit(as_of(spark, sf)).cast("date")
    return b.filter(F.col("date") < F.date_sub(a, 25)), b.filter(F.col("date") >= F.date_sub(a, 30))


@register("bronze_incremental_append", O.on_bars(f"SELECT {sel(BAR_SPEC)} FROM bars"))
def q_bronze_incremental_append(spark, sf):
    """Stored bars + an overlapping incoming batch; only new keys are appended."""
    existing, incoming = _split(spark, sf)
    path = _fresh(spark, "bronze")
    existing.write.mode("overwrite").parquet(path)
    return SB.append_to_table(path, incoming, spark).select("symbol", "date", "open", "high", "low", "close", "volume")


@register("bronze_high_watermark", O.on_bars(
    f"SELECT symbol, CAST(max(date) + 1 AS DATE) AS fetch_start, (SELECT d FROM as_of) AS fetch_end, "
    f"CAST(max(date) + 1 AS DATE) < (SELECT d FROM as_of) AS needs_fetch FROM bars WHERE date < {_CUT_OLD} GROUP BY symbol"))
def q_bronze_high_watermark(spark, sf):
    """Next fetch window per symbol from the stored bars."""
    existing, _ = _split(spark, sf)
    return SB.next_fetch_window(existing, existing.select("symbol").distinct(), as_of(spark, sf))


@register("bronze_dedupe", O.on_bars(
    f"SELECT {sel(BAR_SPEC)}, CASE WHEN date >= CAST((SELECT d FROM as_of) - INTERVAL 30 DAY AS DATE) THEN 2 ELSE 1 END AS _load FROM bars"))
def q_bronze_dedupe(spark, sf):
    """A blind second load of the last 30 days; the newest load wins per key."""
    b = bronze_bars(spark, sf)
    a = F.lit(as_of(spark, sf)).cast("date")
    first = b.select("*", F.lit(1).alias("_load"), F.lit("2001-01-01 00:00:00").cast("timestamp").alias("_inserted_at"))
    second = b.filter(F.col("date") >= F.date_sub(a, 30)).select(
        "*", F.lit(2).alias("_load"), F.lit("2001-06-01 00:00:00").cast("timestamp").alias("_inserted_at"))
    return SB.dedupe_bars(first.unionByName(second)).drop("_inserted_at")


TICKS = """ticks_e AS (SELECT event_type AS symbol, ts, value AS price, CAST(1 AS BIGINT) AS size, event_id AS tick_id FROM events)"""


@register("bars_resample_ticks_1h", O.with_ctes(TICKS, body=(
    "SELECT symbol, date_trunc('hour', ts) AS bar_start, " + O.R("arg_min(price, (ts, tick_id))") + " AS open, "
    + O.R("max(price)") + " AS high, " + O.R("min(price)") + " AS low, " + O.R("arg_max(price, (ts, tick_id))")
    + " AS close, CAST(SUM(size) AS BIGINT) AS volume FROM ticks_e GROUP BY 1, 2")))
def q_bars_resample_ticks_1h(spark, sf):
    """Hourly OHLCV bars from tick rows (the events table)."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return SB.resample_ticks(SB.events_as_ticks(ev), "hour")


@register("bars_resample_weekly", O.on_bars(
    f"SELECT symbol, {O.sunday_week('date')} AS period_start, {O.R('arg_min(open, date)')} AS open, {O.R('max(high)')} AS high, "
    f"{O.R('min(low)')} AS low, {O.R('arg_max(close, date)')} AS close, CAST(SUM(volume) AS BIGINT) AS volume, COUNT(*) AS n_days "
    "FROM bars GROUP BY 1, 2"))
def q_bars_resample_weekly(spark, sf):
    """Daily bars to Sunday-week bars."""
    return SB.resample_bars(bronze_bars(spark, sf), "week")


@register("bars_resample_monthly", O.on_bars(
    f"SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS period_start, {O.R('arg_min(open, date)')} AS open, "
    f"{O.R('max(high)')} AS high, {O.R('min(low)')} AS low, {O.R('arg_max(close, date)')} AS close, "
    "CAST(SUM(volume) AS BIGINT) AS volume, COUNT(*) AS n_days FROM bars GROUP BY 1, 2"))
def q_bars_resample_monthly(spark, sf):
    """Daily bars to calendar-month bars."""
    return SB.resample_bars(bronze_bars(spark, sf), "month")


@register("trading_calendar", O.on_bars(
    "SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series((SELECT min(date) FROM bars), (SELECT max(date) FROM bars), "
    "INTERVAL 1 DAY)) AS d) WHERE dayofweek(d) NOT IN (0, 6)"))
def q_trading_calendar(spark, sf):
    """Weekdays between the first and last bar."""
    return SB.trading_calendar(bronze_bars(spark, sf))


@register("symbol_calendar_grid", O.on_bars(
    "SELECT g.symbol, g.date, b.symbol IS NULL AS missing_bar FROM (SELECT symbol, CAST(unnest(generate_series(min(date), max(date), "
    "INTERVAL 1 DAY)) AS DATE) AS date FROM bars GROUP BY symbol) g LEFT JOIN bars b ON g.symbol = b.symbol AND g.date = b.date "
    "WHERE dayofweek(g.date) NOT IN (0, 6)"))
def q_symbol_calendar_grid(spark, sf):
    """Dense symbol x weekday grid with missing-bar flags."""
    return SB.symbol_calendar_grid(bronze_bars(spark, sf))


@register("payload_json", O.on_bars("SELECT symbol, date, 'lineitem-bars' AS provider, CAST(date AS VARCHAR) AS fetched_at FROM bars"))
def q_payload_json(spark, sf):
    """JSON payload written and parsed back."""
    return SF.parse_payload(SF.with_payload(bronze_bars(spark, sf))).select("symbol", "date", "provider", "fetched_at")


@register("silver_upsert", O.on_feat(f"SELECT {sel(FEAT_SPEC)} FROM feat"))
def q_silver_upsert(spark, sf):
    """Silver rows older than the cut are stored; the full feature batch is merged in (insert only)."""
    f = feat(spark, sf)
    a = F.lit(as_of(spark, sf)).cast("date")
    path = _fresh(spark, "silver")
    f.filter(F.col("date") < F.date_sub(a, 25)).write.mode("overwrite").parquet(path)
    return SB.append_to_table(path, f, spark, keys=["date", "symbol"]).select(*f.columns)


@register("table_sink", O.on_feat(f"SELECT {sel(LB_SPEC)} FROM lb", SCORES, BT, RULES, PNL, LB))
def q_table_sink(spark, sf):
    """The leaderboard rebuilt as a gold table and read back."""
    path = _fresh(spark, "gold_lb")
    SF.write_gold(lb(spark, sf), path)
    return spark.read.parquet(path)


_PERS = _json.loads(SB.PERSONAS_JSON)
_PERS_VALUES = ", ".join(
    "('{}', '{}', '{}', '{}', '{}')".format(k, v["name"], v["title"].replace("'", "''"), v["emoji"], v["color"]) for k, v in _PERS.items())


@register("persona_join", O.on_feat(
    f"SELECT {sel(LB_SPEC)}, persona_name, persona_title, persona_emoji, persona_color FROM (SELECT lb.*, "
    f"COALESCE(p.name, lb.entrant_name) AS persona_name, COALESCE(p.title, '') AS persona_title, "
    f"COALESCE(p.emoji, '{SB.DEFAULT_PERSONA['emoji']}') AS persona_emoji, COALESCE(p.color, '{SB.DEFAULT_PERSONA['color']}') AS persona_color "
    f"FROM lb LEFT JOIN (VALUES {_PERS_VALUES}) p(p_entrant, name, title, emoji, color) ON lb.entrant_name = p.p_entrant)",
    SCORES, BT, RULES, PNL, LB))
def q_persona_join(spark, sf):
    """Leaderboard with persona fields from the JSON dictionary."""
    return SB.persona_join(lb(spark, sf), SB.persona_dim(spark))


# ====================================================================== T ==
from barforge.streaming import pipelines as T  # noqa: E402


def _events_source(spark, sf, name, slices=4, twins=False):
    """Tick files in event-time order: each time slice is written by its own job, in
    order, so file modification times follow event time as in a live feed.  Returns the
    events, the folder and the files per slice (one per million rows), which a batch takes together."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    if twins:
        ev = ev.unionByName(ev.filter("event_id % 5 = 0").withColumn("event_id", -F.col("event_id") - 1))
    src = _fresh(spark, name) + "/feed"
    lo, hi, n = ev.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()      # three scalars
    step, files = (hi - lo) / slices, -(-n // (slices * 1_000_000))
    for i in range(slices):
        a = lo + step * i
        cond = (F.col("ts") >= F.lit(a)) if i else F.lit(True)
        if i < slices - 1:
            cond = cond & (F.col("ts") < F.lit(lo + step * (i + 1)))
        ev.filter(cond).repartition(files).sortWithinPartitions("ts").write.mode("append").parquet(src)
    return ev, src, files


@register("stream_ticks_to_bars", O.with_ctes(TICKS, body=(
    "SELECT symbol, date_trunc('hour', ts) AS bar_start, " + O.R("arg_min(price, (ts, tick_id))") + " AS open, "
    + O.R("max(price)") + " AS high, " + O.R("min(price)") + " AS low, " + O.R("arg_max(price, (ts, tick_id))")
    + " AS close, CAST(SUM(size) AS BIGINT) AS volume FROM ticks_e GROUP BY 1, 2")))
def q_stream_ticks_to_bars(spark, sf):
    """Streamed hourly bars (update mode, changed windows only) equal the batch resample S7."""
    ev, src, files = _events_source(spark, sf, "t1src")
    return T.stream_ticks_to_bars(spark, src, ev.schema, _fresh(spark, "t1out"), _fresh(spark, "t1ckpt"), files_per_trigger=files)


@register("stream_dedupe", O.with_ctes(TICKS, body="SELECT DISTINCT symbol, ts, " + O.R("price") + " AS price, tick_id FROM "
          "(SELECT symbol, ts, price, tick_id FROM ticks_e UNION ALL SELECT symbol, ts, price, -tick_id - 1 FROM ticks_e WHERE tick_id % 5 = 0)"))
def q_stream_dedupe(spark, sf):
    """The last half day of ticks is delivered twice; those within the watermark are dropped.  Every fifth
    tick has a twin of another id at the same instant, which stays."""
    ev, src, files = _events_source(spark, sf, "t2src", twins=True)
    last = ev.agg(F.max("ts")).first()[0]
    import datetime as _dtm
    # re-delivery of the last 12 hours, arriving after everything else
    ev.filter(F.col("ts") >= F.lit(last - _dtm.timedelta(hours=12))).repartition(files).write.mode("append").parquet(src)
    return T.stream_dedupe(spark, src, ev.schema, _fresh(spark, "t2out"), _fresh(spark, "t2ckpt"), files_per_trigger=files)


@register("stream_bronze_to_silver", O.on_feat(f"SELECT {sel(FEAT_SPEC)} FROM feat"))
def q_stream_bronze_to_silver(spark, sf):
    """Bars arrive as four time-ordered files; each micro-batch appends its new keys to bronze and
    computes their features from the carried tails; the final silver equals the batch feature table."""
    b = bronze_bars(spark, sf)
    src = _fresh(spark, "t3src")
    b.repartitionByRange(4, "date").write.mode("overwrite").parquet(src)
    a = as_of(spark, sf)
    out = T.stream_bronze_to_silver(spark, src, b.schema, _fresh(spark, "t3bronze"), _fresh(spark, "t3silver"),
                                    _fresh(spark, "t3ckpt"), lambda hist: features_daily(hist, a))
    return out.select(*feat(spark, sf).columns)


@register("stream_bad_rows", O.on_bars(f"SELECT {sel(BAR_SPEC)} FROM bars WHERE day(date) <> 31"))
def q_stream_bad_rows(spark, sf):
    """T4: streamed quote lines; malformed lines (day-31 bars, truncated) go to quarantine, the rest to bronze."""
    path = _fresh(spark, "t4src")
    b = SF.with_payload(bronze_bars(spark, sf))
    js = F.to_json(F.struct("symbol", "open", "high", "low", "close", "volume",
                            F.col("date").cast("timestamp").alias("timestamp"), "_raw_json"))
    line = F.when(F.dayofmonth("date") == 31, F.expr("substring(_js, 1, length(_js) - 7)")).otherwise(F.col("_js"))
    b.select("date", js.alias("_js")).repartitionByRange(3, "date").select(line.alias("value")).write.mode("overwrite").text(path)
    good, _bad = T.stream_bad_rows(spark, path, _fresh(spark, "t4good"), _fresh(spark, "t4bad"), _fresh(spark, "t4ckpt"))
    return good.select("symbol", F.to_date("timestamp").alias("date"), "open", "high", "low", "close", "volume")


# ====================================================================== X ==
from barforge.operators import extra as X  # noqa: E402


def _screened(spark, sf):
    p = ga_parts(spark, sf)
    fs = signals.ga_feature_signals(p["feat"], carry=("close", "volume_vs_sma_ratio"))
    return X.screen_positions(E.ga_signals(fs, p["genes"]), X.trading_days(p["feat"])), p


# Day by day: today's candidates without the symbols that the day before entered, then the cap.
SCREEN = f"""
sdays AS MATERIALIZED (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS dn FROM (SELECT DISTINCT date FROM feat)),
sigx AS (SELECT s.gene_id, s.date, s.symbol, s.raw_signal, s.close, f.volume_vs_sma_ratio, d.dn FROM sig s JOIN feat f
         ON s.date = f.date AND s.symbol = f.symbol JOIN sdays d ON d.date = s.date),
c1 AS MATERIALIZED (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gene_id, date ORDER BY abs(raw_signal) DESC, symbol) AS _r
       FROM sigx WHERE raw_signal <> 0) WHERE _r <= 20 AND volume_vs_sma_ratio > 0.5 AND close > 100),
entry(dn, date, gene_id, symbol, raw_signal, screen_rank) AS (
  SELECT 0::BIGINT, NULL::DATE, NULL::BIGINT, NULL::VARCHAR, NULL::DOUBLE, NULL::BIGINT
  UNION ALL (
  SELECT dn, date, gene_id, symbol, raw_signal, screen_rank FROM (
    SELECT c.dn, c.date, c.gene_id, c.symbol, c.raw_signal, ROW_NUMBER() OVER (PARTITION BY c.gene_id ORDER BY c._r) AS screen_rank
    FROM c1 c JOIN (SELECT max(dn) + 1 AS dn FROM entry) t ON c.dn = t.dn LEFT JOIN entry e ON e.gene_id = c.gene_id AND e.symbol = c.symbol
    WHERE e.symbol IS NULL) WHERE screen_rank <= 3
  UNION ALL SELECT dn, NULL, NULL, NULL, NULL, NULL FROM (SELECT max(dn) + 1 AS dn FROM entry) WHERE dn <= (SELECT max(dn) FROM sdays))),
scr AS MATERIALIZED (SELECT date, gene_id, symbol, raw_signal, CASE WHEN raw_signal > 0 THEN 'LONG' ELSE 'SHORT' END AS side,
          abs(raw_signal) AS signal_strength, screen_rank FROM entry WHERE symbol IS NOT NULL)"""


@register("screen_positions", OB.with_recursive(O.on_feat(
    f"SELECT {sel('date gene_id symbol raw_signal:d side signal_strength:d screen_rank')} FROM scr", *GA, SCREEN)))
def q_screen_positions(spark, sf):
    """X1."""
    return _screened(spark, sf)[0]


_PNL_X = ("CASE WHEN side = 'LONG' THEN (bar_close - entry_price) / entry_price * 100.0::DOUBLE "
          "ELSE (entry_price - bar_close) / entry_price * 100.0::DOUBLE END")
TLOG = f"""
bx AS (SELECT symbol, date, close, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) AS bar_idx,
         {O.sunday_week('LEAD(date) OVER (PARTITION BY symbol ORDER BY date)')} <> {O.sunday_week('date')} AS _low FROM feat),
px AS (SELECT s.gene_id, s.symbol, s.date AS entry_date, s.side, b.close AS entry_price, b.bar_idx AS entry_idx,
         g.stop_loss, g.take_profit, g.max_hold_days AS hold
       FROM scr s JOIN bx b ON s.symbol = b.symbol AND s.date = b.date JOIN genes g ON s.gene_id = g.gene_id),
fan AS (SELECT px.*, k FROM px, LATERAL (SELECT unnest(range(1, greatest(px.hold, 1) + 1)) AS k)),
fut AS (SELECT f.*, b.date AS bar_date, b.close AS bar_close, b._low, r.side AS _pside
        FROM fan f JOIN bx b ON f.symbol = b.symbol AND b.bar_idx = f.entry_idx + f.k
        LEFT JOIN scr r ON r.gene_id = f.gene_id AND r.symbol = f.symbol AND r.date = b.date),
fut2 AS (SELECT *, {_PNL_X} AS pnl FROM fut),
hits AS (SELECT * FROM (SELECT gene_id, symbol, entry_date, k, bar_date, bar_close, pnl,
   CASE WHEN pnl <= -stop_loss OR pnl >= take_profit THEN 'TP_SL'
        WHEN _pside IS NOT NULL AND _pside <> side THEN 'SIGNAL_REVERSAL'
        WHEN _low AND {O.sunday_week('bar_date')} = {O.sunday_week('entry_date')} THEN 'WEEK_END'
        WHEN k = hold THEN 'MAX_HOLD' END AS exit_reason FROM fut2) WHERE exit_reason IS NOT NULL),
fh AS (SELECT gene_id, symbol, entry_date, arg_min(bar_date, k) AS exit_date, arg_min(bar_close, k) AS exit_price,
         arg_min(pnl, k) AS pnl, arg_min(exit_reason, k) AS exit_reason FROM hits GROUP BY 1, 2, 3),
tlog AS (SELECT p.entry_date AS date, p.gene_id, p.symbol, p.side AS signal_type, p.entry_price, h.exit_date, h.exit_price,
           h.pnl, h.exit_reason, {O.sunday_week('p.entry_date')} AS week_start
         FROM px p LEFT JOIN fh h ON p.gene_id = h.gene_id AND p.symbol = h.symbol AND p.entry_date = h.entry_date)"""


def _tlog(spark, sf):
    scr, p = _screened(spark, sf)
    return X.trade_log(scr, p["genes"], p["feat"])


@register("trade_log", OB.with_recursive(O.on_feat(
    f"SELECT {sel('date gene_id symbol signal_type entry_price:d exit_date exit_price:d pnl:d exit_reason week_start')} FROM tlog",
    *GA, SCREEN, TLOG)))
def q_trade_log(spark, sf):
    """X2."""
    return _tlog(spark, sf)


@register("pnl_by_exit_reason", OB.with_recursive(O.on_feat(
    "SELECT gene_id, exit_reason, " + O.R("AVG(pnl)") + " AS avg_pnl, COUNT(*) AS n_trades FROM tlog "
    "WHERE exit_reason IS NOT NULL GROUP BY 1, 2", *GA, SCREEN, TLOG)))
def q_pnl_by_exit_reason(spark, sf):
    """X14."""
    return X.pnl_by_exit_reason(_tlog(spark, sf))


_CAL = ", ".join([f"dayofweek(date) = {i} AS dow_{n}" for i, n in enumerate(X.DOWS)]
                 + [f"month(date) = {i + 1} AS month_{n}" for i, n in enumerate(X.MONTHS)]
                 + ["CAST(floor((dayofyear(date) + 7 - (dayofweek(date) + 1)) / 7.0) AS BIGINT) AS week_of_year",
                    "CAST(day(date) - 1 AS BIGINT) AS days_from_month_start", "CAST(quarter(date) AS BIGINT) AS quarter",
                    "(month(date) IN (3, 6, 9, 12) AND date_diff('day', date, last_day(date)) <= 7) AS quarter_end_week"])


@register("calendar_dummies", O.on_feat(f"SELECT date, symbol, {_CAL} FROM feat"))
def q_calendar_dummies(spark, sf):
    """X7."""
    return X.calendar_dummies(feat(spark, sf))


HOL = ("hol AS (SELECT make_date(CAST(y AS BIGINT), m, d) AS h FROM (SELECT unnest(range(min(year(date)), max(year(date)) + 1)) AS y FROM feat), "
       "(VALUES " + ", ".join(f"({m}, {d})" for m, d in X.FIXED_HOLIDAYS) + ") t(m, d))")


@register("preholiday_return", O.on_feat(
    "SELECT date, symbol, next_holiday, " + O.R("next_day_return") + " AS next_day_return, "
    + O.R("AVG(next_day_return) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)")
    + " AS preholiday_return_avg FROM (SELECT * FROM (SELECT date, symbol, next_day_return, "
    "LEAD(date) OVER (PARTITION BY symbol ORDER BY date) AS nb, (SELECT min(h) FROM hol WHERE h > f.date) AS next_holiday "
    "FROM feat f) WHERE next_holiday IS NOT NULL AND (nb IS NULL OR nb >= next_holiday))", HOL))
def q_preholiday_return(spark, sf):
    """Holidays by rule (Jan 1, Jul 4, Dec 25) over the data span."""
    f = feat(spark, sf)
    return X.preholiday_return(f, X.holidays_for(f))


@register("sq_week", O.on_feat(
    "SELECT date, symbol, sq_date, CAST(bar_idx - _sq_idx AS BIGINT) AS sq_offset, COALESCE(abs(bar_idx - _sq_idx) <= 5, false) AS sq_week "
    "FROM (SELECT *, MIN(CASE WHEN date >= sq_date THEN bar_idx END) OVER (PARTITION BY symbol, date_trunc('month', date)) AS _sq_idx "
    "FROM (SELECT date, symbol, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) AS bar_idx, "
    "CAST(date_trunc('month', date) AS DATE) + CAST((12 - dayofweek(date_trunc('month', date))) % 7 + 7 AS INTEGER) AS sq_date FROM feat))"))
def q_sq_week(spark, sf):
    """X9."""
    return X.sq_week(feat(spark, sf))


@register("event_gap", O.on_bars(
    "SELECT date, symbol, is_event, CAST(date_diff('day', date, first_value(CASE WHEN is_event THEN date END IGNORE NULLS) OVER "
    "(PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS BIGINT) AS days_to_event, "
    "CAST(date_diff('day', last_value(CASE WHEN is_event THEN date END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), date) AS BIGINT) AS days_since_event, "
    "CASE WHEN is_event THEN " + O.R("(open - pc) / NULLIF(pc, 0) * 100.0::DOUBLE") + " END AS event_gap_pct FROM "
    "(SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, date_trunc('quarter', date) ORDER BY date) = 1 AS is_event, "
    "LAG(close) OVER (PARTITION BY symbol ORDER BY date) AS pc FROM bars)"))
def q_event_gap(spark, sf):
    """events = first bar per (symbol, quarter), whole history."""
    return X.event_gap(bronze_bars(spark, sf))


# event table: the dates of each nation's customers' dearest order of a quarter; dividend = orders of the quarter in cents
EVENTS = """
qev AS (SELECT n.n_name AS symbol, date_trunc('quarter', o.o_orderdate) AS q, COUNT(*) AS n_orders,
               max(o.o_totalprice) AS top FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2),
ev AS (SELECT q.symbol, MIN(CAST(o.o_orderdate AS DATE)) AS date, any_value(q.n_orders) / 100.0::DOUBLE AS dividend
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN qev q ON q.symbol = n.n_name AND q.q = date_trunc('quarter', o.o_orderdate) AND q.top = o.o_totalprice
       GROUP BY q.symbol, q.q),
evb AS (SELECT symbol, bar_date AS date, SUM(dividend) AS dividend FROM (SELECT ev.symbol, ev.dividend,
        (SELECT MIN(b.date) FROM bars b WHERE b.symbol = ev.symbol AND b.date >= ev.date) AS bar_date FROM ev) WHERE bar_date IS NOT NULL GROUP BY 1, 2),
be AS (SELECT b.*, e.dividend, LAG(b.close) OVER (PARTITION BY b.symbol ORDER BY b.date) AS pc
       FROM bars b LEFT JOIN evb e ON b.symbol = e.symbol AND b.date = e.date)"""


def _events(spark, sf):
    """(symbol, date, dividend) of each nation and quarter, from orders."""
    o = read_table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("symbol"))
    x = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    day = F.to_date("o_orderdate")
    # the dearest order's date, the earliest of equal ones
    per = x.groupBy("symbol", F.trunc(day, "quarter").alias("q")).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(day, F.struct("o_totalprice", -F.unix_date(day))).alias("date"))
    return per.select("symbol", "date", (F.col("n") / F.lit(100.0)).alias("dividend"))


@register("event_gap_table", O.on_bars(
    "SELECT date, symbol, dividend IS NOT NULL AS is_event, CAST(date_diff('day', date, MIN(CASE WHEN dividend IS NOT NULL THEN date END) OVER "
    "(PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS BIGINT) AS days_to_event, "
    "CAST(date_diff('day', MAX(CASE WHEN dividend IS NOT NULL THEN date END) OVER (PARTITION BY symbol ORDER BY date), date) AS BIGINT) "
    "AS days_since_event, CASE WHEN dividend IS NOT NULL THEN " + O.R("(open - pc) / NULLIF(pc, 0) * 100.0::DOUBLE") +
    " END AS event_gap_pct FROM be", EVENTS))
def q_event_gap_table(spark, sf):
    """X10 with an event table."""
    return X.event_gap(bronze_bars(spark, sf), _events(spark, sf))


@register("dividend_adjusted", O.on_bars(
    "SELECT date, symbol, " + O.R("close") + " AS close, " + O.R("COALESCE(dividend, 0.0::DOUBLE)") + " AS dividend, "
    + O.R("f") + " AS dividend_factor, " + O.R("close * COALESCE(product(f) OVER (PARTITION BY symbol ORDER BY date "
    "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1.0::DOUBLE)") + " AS adj_close FROM "
    "(SELECT *, CASE WHEN dividend < pc THEN (pc - dividend) / pc ELSE 1.0::DOUBLE END AS f FROM be)", EVENTS))
def q_dividend_adjusted(spark, sf):
    """Closes adjusted for the dividends of an event table."""
    return X.dividend_adjusted(bronze_bars(spark, sf), _events(spark, sf))


@register("advance_decline", O.on_feat(
    "SELECT date, CAST(SUM(CASE WHEN close > close_lag_1d THEN 1 ELSE 0 END) AS BIGINT) AS advancers, "
    "CAST(SUM(CASE WHEN close < close_lag_1d THEN 1 ELSE 0 END) AS BIGINT) AS decliners, "
    "CAST(SUM(CASE WHEN close = close_lag_1d THEN 1 ELSE 0 END) AS BIGINT) AS unchanged, "
    + O.R("CAST(SUM(CASE WHEN close > close_lag_1d THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(SUM(CASE WHEN close < close_lag_1d THEN 1 ELSE 0 END), 0)")
    + " AS ad_ratio FROM feat GROUP BY date"))
def q_advance_decline(spark, sf):
    """X11."""
    return X.advance_decline(feat(spark, sf))


_RET = "(close - close_lag_1d) / NULLIF(close_lag_1d, 0) * 100.0::DOUBLE"
_W20 = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@register("rolling_index_corr", O.on_feat(
    f"SELECT date, symbol, {O.R('ret')} AS ret, {O.R('index_ret')} AS index_ret, "
    + O.R(f"CASE WHEN isfinite(corr(ret, index_ret) {_W20}) THEN corr(ret, index_ret) {_W20} END")
    + f" AS index_corr FROM (SELECT r.*, i.index_ret FROM (SELECT date, symbol, {_RET} AS ret FROM feat) r JOIN "
    f"(SELECT date, AVG({_RET}) AS index_ret FROM feat GROUP BY date) i ON r.date = i.date)"))
def q_rolling_index_corr(spark, sf):
    """X12."""
    return X.rolling_index_corr(feat(spark, sf))


@register("sector_strength", O.on_feat(
    f"SELECT date, symbol, sector, {O.R('ret')} AS ret, {O.R('sector_ret')} AS sector_ret, {O.R('ret - sector_ret')} AS relative_strength "
    f"FROM (SELECT x.*, AVG(ret) OVER (PARTITION BY sector, date) AS sector_ret FROM (SELECT f.date, f.symbol, s.sector, {_RET} AS ret "
    "FROM feat f JOIN (SELECT n.n_name AS symbol, r.r_name AS sector FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) s "
    "ON f.symbol = s.symbol) x)"))
def q_sector_strength(spark, sf):
    """sector = region of the symbol's nation."""
    return X.sector_strength(feat(spark, sf), X.symbol_sectors(spark, sf))


# ============================================ F1..F19 as separate operators ==
from barforge.operators import features as FT  # noqa: E402

FEATURE_OPS = {
    "feat_lags": (FT.feat_lags, "close_lag_1d:d close_lag_5d:d close_lag_20d:d"),
    "feat_sma": (FT.feat_sma, "sma_5:d sma_20:d sma_60:d"),
    "feat_std20": (FT.feat_std20, "std_20:d"),
    "feat_volume_sma5": (FT.feat_volume_sma5, "volume_sma_5"),
    "feat_volume_ratio": (FT.feat_volume_ratio, "volume_vs_sma_ratio:d"),
    "feat_volume_change": (FT.feat_volume_change, "volume_lag_1d volume_chg_pct:d"),
    "feat_volume_surge": (FT.feat_volume_surge, "volume_surge_flag"),
    "feat_next_day_return": (FT.feat_next_day_return, "next_day_return:d"),
    "feat_rsi14": (FT.feat_rsi14, "rsi_14:d"),
    "feat_volume_streak": (FT.feat_volume_streak, "volume_incr_streak"),
    "feat_macd": (FT.feat_macd, "macd_line:d macd_signal:d macd_histogram:d"),
    "feat_bollinger": (FT.feat_bollinger, "bb_upper:d bb_lower:d bb_pct_b:d bb_bandwidth:d"),
    "feat_atr14": (FT.feat_atr14, "atr_14:d"),
    "feat_days_to_month_end": (FT.feat_days_to_month_end, "_days_to_month_end"),
    "feat_month_end_zone": (FT.feat_month_end_zone, "month_end_zone"),
    "feat_quarter_end": (FT.feat_quarter_end, "quarter_end_flag"),
    "feat_calendar": (FT.feat_calendar, "day_of_week month_of_year"),
}


def bars_in_window(spark, sf):
    """bronze bars restricted to the 5 years before as_of (before any window)."""
    return FT.feat_lookback_filter(bronze_bars(spark, sf), as_of(spark, sf)).select(
        "symbol", "date", "open", "high", "low", "close", "volume")


def _register_feature_op(key, fn, spec):
    cols = [t.split(":")[0] for t in spec.split()]

    @register(key, O.on_feat(f"SELECT date, symbol, {sel(spec)} FROM feat"))
    def q(spark, sf):
        return fn(bars_in_window(spark, sf)).select("date", "symbol", *cols)
    q.__doc__ = f"{key} on the bars of the look-back window."


for _k, (_fn, _spec) in FEATURE_OPS.items():
    _register_feature_op(_k, _fn, _spec)


@register("feat_lookback_filter", O.on_feat(f"SELECT {sel(BAR_SPEC)} FROM b5"))
def q_feat_lookback_filter(spark, sf):
    """F18."""
    return bars_in_window(spark, sf)


_FIXED = " ".join(t[:-2] for t in FEAT_SPEC.split() if t.endswith(":d")).split()


@register("feat_numeric_contract", O.on_feat("SELECT " + ", ".join(
    f"CAST(CAST({O.R(c, digits_for(c, 6))} AS DECIMAL(38,9)) AS VARCHAR) AS {c}" if c in _FIXED else c
    for c in (t.removesuffix(":d") for t in FEAT_SPEC.split())) + ", true AS is_audited FROM feat"), raw=True)
def q_feat_numeric_contract(spark, sf):
    """the at-rest contract of the rounded features; fixed-point values as text, the audit time as a flag."""
    stored = FT.feat_numeric_contract(finalize(feat(spark, sf)))
    text = [F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in stored.schema.fields if f.name != "_extracted_at"]
    return stored.select(*text, F.col("_extracted_at").isNotNull().alias("is_audited"))


# ====================================== M6-M9 and G11/G12 as separate keys ==
for _key, _fn, _cols in [
    ("derived_breakout_features", M.derived_breakout_features, ["volatility_compression", "vol_expansion_flag"]),
    ("volume_increase_score", M.volume_increase_score, ["volume_increase_score"]),
    ("volume_price_divergence", M.volume_price_divergence, ["volume_price_divergence"]),
    ("derived_reversal_features", M.derived_reversal_features, ["price_sma_distance", "rsi_extremity"]),
]:
    def _mk(key, fn, cols):
        @register(key, O.on_feat(f"SELECT {sel(spec_of(['date', 'symbol'] + cols))} FROM der", DERIVED))
        def q(spark, sf):
            return fn(feat(spark, sf)).select("date", "symbol", *cols)
        q.__doc__ = f"{key} (M6-M9)."
    _mk(_key, _fn, _cols)

_CHILD_SPEC = "slot generation kind kind_idx parent_a parent_b " + GSPEC


def _cross_children(spark, sf, mutate: bool):
    cur = ga_parts(spark, sf)["cur"]
    g, maxid = cur.agg(F.max("generation"), F.max("gene_id")).first()
    slots = (spark.range(E.ELITES + 1, E.ELITES + E.CHILDREN + 1).withColumnRenamed("id", "slot")
             .withColumn("_maxid", F.lit(int(maxid)).cast("long")).withColumn("generation", F.lit(int(g) + 1).cast("long"))
             .withColumn("kind", F.lit("child")).withColumn("kind_idx", F.col("slot") - E.ELITES))
    x = E.ga_crossover(slots, E.ga_select_parents(cur), OG.SEED_EVOLVE)
    x = E.ga_mutate(x, OG.SEED_EVOLVE, "child_mut") if mutate else x
    return x.drop("_maxid")


@register("ga_crossover", O.on_feat(f"SELECT {sel(_CHILD_SPEC)} FROM crossed", *GA, OG.NEXTGEN))
def q_ga_crossover(spark, sf):
    """Three children of hashed parent picks (before mutation)."""
    return _cross_children(spark, sf, False)


@register("ga_mutate", O.on_feat(f"SELECT {sel(_CHILD_SPEC)} FROM children", *GA, OG.NEXTGEN))
def q_ga_mutate(spark, sf):
    """The children after mutation."""
    return _cross_children(spark, sf, True)


@register("ga_evolve", raw=True)
def q_ga_evolve(spark, sf):
    """G1-G13 + S14 looped: three generations evolved on the data (iterative; rows-only check)."""
    p = ga_parts(spark, sf)
    return E.ga_evolve(p["fs"], p["genes"], as_of(spark, sf), generations=3, seed=OG.SEED_EVOLVE)


@register("bars_resample_ticks_1d", O.with_ctes(TICKS, body=(
    "SELECT symbol, date_trunc('day', ts) AS bar_start, " + O.R("arg_min(price, (ts, tick_id))") + " AS open, "
    + O.R("max(price)") + " AS high, " + O.R("min(price)") + " AS low, " + O.R("arg_max(price, (ts, tick_id))")
    + " AS close, CAST(SUM(size) AS BIGINT) AS volume FROM ticks_e GROUP BY 1, 2")))
def q_bars_resample_ticks_1d(spark, sf):
    """Daily OHLCV bars from tick rows (the events table)."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return SB.resample_ticks(SB.events_as_ticks(ev), "day")


@register("stream_ticks_to_bars_1d_append", O.with_ctes(TICKS, body=(
    "SELECT * FROM (SELECT symbol, date_trunc('day', ts) AS bar_start, " + O.R("arg_min(price, (ts, tick_id))") + " AS open, "
    + O.R("max(price)") + " AS high, " + O.R("min(price)") + " AS low, " + O.R("arg_max(price, (ts, tick_id))")
    + " AS close, CAST(SUM(size) AS BIGINT) AS volume FROM ticks_e GROUP BY 1, 2) "
    "WHERE bar_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM ticks_e) - INTERVAL 1 DAY")))
def q_stream_ticks_to_bars_1d_append(spark, sf):
    """T1 in append mode: a daily bar is emitted once the 1-day watermark has passed its end."""
    ev, src, files = _events_source(spark, sf, "t1dsrc")
    return T.stream_ticks_to_bars(spark, src, ev.schema, _fresh(spark, "t1dout"), _fresh(spark, "t1dckpt"),
                                  interval="1 day", watermark="1 day", mode="append", files_per_trigger=files)


@register("ga_evolve_islands", raw=True)
def q_ga_evolve_islands(spark, sf):
    """G13 at scale: four islands of ten genes evolved for two generations, selection and
    parent lookups partitioned by island (iterative; rows-only check)."""
    p = ga_parts(spark, sf)
    pool = E.gene_pool_init(spark, E.POP_SIZE, OG.SEED_INIT, islands=4)
    return E.ga_evolve(p["fs"], pool, as_of(spark, sf), generations=2, seed=OG.SEED_EVOLVE)


@register("volume_watch_top20", O.on_feat(
    "SELECT * FROM (SELECT symbol, date, " + O.R("close") + " AS close, volume, volume_sma_5, "
    + O.R(O.R("volume_vs_sma_ratio", 2)) + " AS volume_vs_sma_ratio, " + O.R(O.R("volume_chg_pct", 2)) + " AS volume_chg_pct, "
    "volume_incr_streak, volume_surge_flag, " + O.R("volume_increase_score") + " AS volume_increase_score, "
    + O.R(O.R("avg_vol_chg_5d", 2)) + " AS avg_vol_chg_5d, " + O.R(O.R("price_chg_pct", 2)) + " AS price_chg_pct, "
    + _ALERT + " AS alert_level FROM vw WHERE date = (SELECT max(date) FROM recent) AND volume_increase_score >= 30) "
    "ORDER BY volume_increase_score DESC, symbol LIMIT 20", WATCH))
def q_volume_watch_top20(spark, sf):
    """A9 report: the watch list's top 20 by score (symbol breaks ties)."""
    w = A.volume_watch(silver_since(spark, sf, A.WATCH_DAYS), as_of(spark, sf))
    return w.orderBy(F.col("volume_increase_score").desc(), F.col("symbol")).limit(20)
