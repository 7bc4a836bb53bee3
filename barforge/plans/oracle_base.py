"""DuckDB SQL fragments used by the oracle queries.

Each oracle query is a single SQL string: ``WITH <shared CTEs>, <own CTEs>
SELECT ...``.  The shared CTEs rebuild bars and features from the raw
tables with the same integer recipe as ``barforge.sources.bars``.
"""

from __future__ import annotations


def R(x: str, k: int = 6) -> str:
    """Portable rounding, same as barforge.functions.core.r."""
    return f"(floor(({x}) * 1e{k} + 0.5) / 1e{k})"


def W(n: int, part: str = "symbol", order: str = "date") -> str:
    return f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


WS = "OVER (PARTITION BY symbol ORDER BY date)"
RUN = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def clamp(x: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN least({hi}::DOUBLE, greatest({lo}::DOUBLE, {x})) END)"


def sunday_week(d: str) -> str:
    return f"CAST({d} - CAST(dayofweek({d}) AS INTEGER) AS DATE)"


def dow(d: str) -> str:
    return f"CAST(dayofweek({d}) + 1 AS BIGINT)"


def safe_div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def u01(*parts: str) -> str:
    key = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0)"


BARS = f"""
ticks AS (
  SELECT n.n_name AS symbol, CAST(l.l_shipdate AS DATE) AS date,
         SUM(CAST(round(l.l_discount * 100) AS BIGINT)) AS sd,
         MAX(CAST(round(l.l_tax * 100) AS BIGINT)) AS mt,
         COUNT(*) AS n,
         CAST(SUM(l.l_quantity) AS BIGINT) AS volume
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2),
closes AS (
  SELECT symbol, date, mt, volume,
    CAST(floor(100000.0::DOUBLE * exp(SUM(ln(1.0::DOUBLE + 0.4::DOUBLE * (CAST(sd AS DOUBLE) / (100.0::DOUBLE * CAST(n AS DOUBLE)) - 0.05::DOUBLE))) {RUN}) + 0.5::DOUBLE) AS BIGINT) AS close_cents
  FROM ticks),
cents AS (
  SELECT *, COALESCE(LAG(close_cents) {WS}, close_cents) AS open_cents FROM closes),
bars AS (
  SELECT symbol, date,
    CAST(open_cents AS DOUBLE) / 100.0::DOUBLE AS open,
    CAST((greatest(open_cents, close_cents) * (400 + mt)) // 400 AS DOUBLE) / 100.0::DOUBLE AS high,
    CAST((least(open_cents, close_cents) * (400 - mt)) // 400 AS DOUBLE) / 100.0::DOUBLE AS low,
    CAST(close_cents AS DOUBLE) / 100.0::DOUBLE AS close,
    volume
  FROM cents),
as_of AS (SELECT max(date) AS d FROM bars)"""

_DTME = "CAST(date_diff('day', date, last_day(date)) AS BIGINT)"

FEAT = f"""
b5 AS (SELECT * FROM bars WHERE date >= CAST((SELECT d FROM as_of) - INTERVAL 5 YEAR AS DATE)),
f1 AS (
  SELECT *,
    LAG(close, 1) {WS} AS close_lag_1d, LAG(close, 5) {WS} AS close_lag_5d, LAG(close, 20) {WS} AS close_lag_20d,
    AVG(close) {W(5)} AS sma_5, AVG(close) {W(20)} AS sma_20, AVG(close) {W(60)} AS sma_60,
    STDDEV_SAMP(close) {W(20)} AS std_20,
    CAST(round(AVG(volume) {W(5)}) AS BIGINT) AS volume_sma_5,
    CAST(volume AS DOUBLE) / NULLIF(AVG(volume) {W(5)}, 0) AS volume_vs_sma_ratio,
    LAG(volume) {WS} AS volume_lag_1d,
    CAST(volume - LAG(volume) {WS} AS DOUBLE) / NULLIF(CAST(LAG(volume) {WS} AS DOUBLE), 0) * 100.0::DOUBLE AS volume_chg_pct,
    CAST(volume AS DOUBLE) / NULLIF(CAST(LAG(volume) {WS} AS DOUBLE), 0) >= 1.5::DOUBLE AS volume_surge_flag,
    (LEAD(close) {WS} - close) / NULLIF(close, 0) * 100.0::DOUBLE AS next_day_return,
    CASE WHEN close > LAG(close) {WS} THEN close - LAG(close) {WS} ELSE 0.0::DOUBLE END AS _gain,
    CASE WHEN close < LAG(close) {WS} THEN LAG(close) {WS} - close ELSE 0.0::DOUBLE END AS _loss,
    CASE WHEN volume > LAG(volume) {WS} THEN 1 ELSE 0 END AS _inc,
    AVG(close) {W(12)} AS _sf, AVG(close) {W(26)} AS _ss,
    CASE WHEN LAG(close) {WS} IS NOT NULL THEN greatest(high - low, abs(high - LAG(close) {WS}), abs(low - LAG(close) {WS})) END AS _tr
  FROM b5),
f2 AS (
  SELECT *,
    100.0::DOUBLE - 100.0::DOUBLE / (1.0::DOUBLE + AVG(_gain) {W(14)} / NULLIF(AVG(_loss) {W(14)}, 0)) AS rsi_14,
    SUM(1 - _inc) {WS} AS _grp,
    AVG(_sf) {W(9)} AS _sf9, AVG(_ss) {W(9)} AS _ss9,
    AVG(_tr) {W(14)} AS atr_14
  FROM f1),
f3 AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY symbol, _grp ORDER BY date) - 1 AS BIGINT) AS volume_incr_streak FROM f2),
feat AS (
  SELECT date, symbol, open, high, low, close, volume,
    close_lag_1d, close_lag_5d, close_lag_20d, sma_5, sma_20, sma_60, std_20, rsi_14,
    volume_sma_5, volume_vs_sma_ratio, volume_lag_1d, volume_chg_pct, volume_incr_streak, volume_surge_flag,
    _sf - _ss AS macd_line, _sf9 - _ss9 AS macd_signal, (_sf - _ss) - (_sf9 - _ss9) AS macd_histogram,
    sma_20 + 2.0::DOUBLE * std_20 AS bb_upper, sma_20 - 2.0::DOUBLE * std_20 AS bb_lower,
    (close - (sma_20 - 2.0::DOUBLE * std_20)) / NULLIF(4.0::DOUBLE * std_20, 0) AS bb_pct_b,
    (4.0::DOUBLE * std_20) / NULLIF(sma_20, 0) AS bb_bandwidth,
    atr_14,
    {_DTME} AS _days_to_month_end,
    CASE WHEN {_DTME} <= 2 THEN 'month_end' WHEN {_DTME} <= 7 THEN 'last_week' ELSE 'other' END AS month_end_zone,
    (month(date) IN (3, 6, 9, 12) AND {_DTME} <= 2) AS quarter_end_flag,
    next_day_return,
    CAST(dayofweek(date) + 1 AS BIGINT) AS day_of_week,
    CAST(month(date) AS BIGINT) AS month_of_year
  FROM f3)"""


def with_ctes(*parts: str, body: str) -> str:
    """Join CTE fragments (each 'name AS (...)' list) and a final SELECT."""
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts if p.strip()) + "\n" + body


def on_bars(body: str, *extra: str) -> str:
    return with_ctes(BARS, *extra, body=body)


def on_feat(body: str, *extra: str) -> str:
    return with_ctes(BARS, FEAT, *extra, body=body)
