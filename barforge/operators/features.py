"""Silver features (F0-F19): one wide feature row per (symbol, date).

Every feature is a window over ``PARTITION BY symbol ORDER BY date``.  All
window specs share that partitioning and ordering, so Catalyst plans a single
exchange on ``symbol`` and one sort; each dependency layer below is another
``Window`` node on the already-sorted stream (no extra shuffle).

Parallelism note: windows parallelise over symbols.  Daily bars are bounded
by one row per (symbol, date), so a hot symbol is at most a few thousand
rows per year; the per-symbol buffer Spark keeps for a window is spillable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.core import greatest_strict, safe_div, trailing


def _W() -> Window:
    return Window.partitionBy("symbol").orderBy("date")

FEATURE_COLUMNS = [
    "date", "symbol", "open", "high", "low", "close", "volume",
    "close_lag_1d", "close_lag_5d", "close_lag_20d",
    "sma_5", "sma_20", "sma_60", "std_20", "rsi_14",
    "volume_sma_5", "volume_vs_sma_ratio", "volume_lag_1d", "volume_chg_pct",
    "volume_incr_streak", "volume_surge_flag",
    "macd_line", "macd_signal", "macd_histogram",
    "bb_upper", "bb_lower", "bb_pct_b", "bb_bandwidth", "atr_14",
    "_days_to_month_end", "month_end_zone", "quarter_end_flag",
    "next_day_return", "day_of_week", "month_of_year",
]

# Fixed values of the reference's feature definitions.
LAG_DAYS = (1, 5, 20)
SMA_DAYS = (5, 20, 60)
STD_DAYS = 20
RSI_DAYS = 14
VOLUME_SMA_DAYS = 5
SURGE_RATIO = 1.5
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BB_DAYS, BB_K = 20, 2
ATR_DAYS = 14
MONTH_END_DAYS, LAST_WEEK_DAYS = 2, 7
QUARTER_END_MONTHS = (3, 6, 9, 12)
LOOKBACK_YEARS = 5


# ---------------------------------------------------------------- F1..F19 --
def feat_lags(df: DataFrame, ns=LAG_DAYS) -> DataFrame:
    return df.select("*", *[F.lag("close", n).over(_W()).alias(f"close_lag_{n}d") for n in ns])


def feat_sma(df: DataFrame, ns=SMA_DAYS) -> DataFrame:
    return df.select("*", *[F.avg("close").over(trailing(n)).alias(f"sma_{n}") for n in ns])


def feat_std20(df: DataFrame, n: int = STD_DAYS) -> DataFrame:
    return df.withColumn(f"std_{n}", F.stddev_samp("close").over(trailing(n)))


def _vol_avg(n: int) -> Column:
    return F.avg("volume").over(trailing(n))


def feat_volume_sma5(df: DataFrame, n: int = VOLUME_SMA_DAYS) -> DataFrame:
    return df.withColumn("volume_sma_5", F.round(_vol_avg(n)).cast("long"))


def feat_volume_ratio(df: DataFrame, n: int = VOLUME_SMA_DAYS) -> DataFrame:
    return df.withColumn("volume_vs_sma_ratio", safe_div("volume", _vol_avg(n)))


def feat_volume_change(df: DataFrame) -> DataFrame:
    prev = F.lag("volume").over(_W())
    return df.select("*", prev.cast("long").alias("volume_lag_1d"),
                     (safe_div(F.col("volume") - prev, prev) * F.lit(100.0)).alias("volume_chg_pct"))


def feat_volume_surge(df: DataFrame, ratio: float = SURGE_RATIO) -> DataFrame:
    return df.withColumn("volume_surge_flag", safe_div("volume", F.lag("volume").over(_W())) >= F.lit(ratio))


def feat_next_day_return(df: DataFrame) -> DataFrame:
    return df.withColumn("next_day_return",
                         safe_div(F.lead("close").over(_W()) - F.col("close"), "close") * F.lit(100.0))


def feat_rsi14(df: DataFrame, n: int = RSI_DAYS) -> DataFrame:
    """Simple-mean RSI; NULL (not 100) when the window holds no loss."""
    prev = F.lag("close").over(_W())
    gain = F.when(F.col("close") > prev, F.col("close") - prev).otherwise(F.lit(0.0))
    loss = F.when(F.col("close") < prev, prev - F.col("close")).otherwise(F.lit(0.0))
    g = df.select("*", gain.alias("_gain"), loss.alias("_loss"))     # layer: gain/loss use the lag
    ag, al = F.avg("_gain").over(trailing(n)), F.avg("_loss").over(trailing(n))
    rs = F.try_divide(ag, F.nullif(al, F.lit(0.0)))
    rsi = F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + rs)
    return g.withColumn(f"rsi_{n}", rsi).drop("_gain", "_loss")


def feat_volume_streak(df: DataFrame) -> DataFrame:
    """Consecutive rising-volume days.

    The reference numbers islands with a running sum and a second
    ROW_NUMBER over (symbol, island).  Equivalent and cheaper: the streak is
    the row index minus the row index of the last non-rising day, both on
    the same window spec, so no second sort is needed.
    """
    rising = F.when(F.col("volume") > F.lag("volume").over(_W()), F.lit(1)).otherwise(F.lit(0))
    x = df.select("*", rising.alias("_inc"), F.row_number().over(_W()).alias("_rn"))
    last_reset = F.max(F.when(F.col("_inc") == 0, F.col("_rn"))).over(
        _W().rowsBetween(Window.unboundedPreceding, 0))
    return x.withColumn("volume_incr_streak", (F.col("_rn") - last_reset).cast("long")).drop("_inc", "_rn")


def feat_macd(df: DataFrame, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL) -> DataFrame:
    """SMA approximation of MACD (line = SMA12 - SMA26; signal = SMA9 of each)."""
    a = df.select("*", F.avg("close").over(trailing(fast)).alias("_sf"),
                  F.avg("close").over(trailing(slow)).alias("_ss"))
    b = a.select("*", F.avg("_sf").over(trailing(signal)).alias("_sf9"),
                 F.avg("_ss").over(trailing(signal)).alias("_ss9"))
    return b.select(
        *[c for c in df.columns],
        (F.col("_sf") - F.col("_ss")).alias("macd_line"),
        (F.col("_sf9") - F.col("_ss9")).alias("macd_signal"),
        ((F.col("_sf") - F.col("_ss")) - (F.col("_sf9") - F.col("_ss9"))).alias("macd_histogram"),
    )


def feat_bollinger(df: DataFrame, n: int = BB_DAYS, k: float = BB_K) -> DataFrame:
    """Needs sma_20 and std_20 (computed here if absent)."""
    x = df
    if f"sma_{n}" not in x.columns:
        x = x.withColumn(f"sma_{n}", F.avg("close").over(trailing(n)))
    if f"std_{n}" not in x.columns:
        x = x.withColumn(f"std_{n}", F.stddev_samp("close").over(trailing(n)))
    sma, std = F.col(f"sma_{n}"), F.col(f"std_{n}")
    kk = F.lit(float(k))
    return x.select(
        "*",
        (sma + kk * std).alias("bb_upper"),
        (sma - kk * std).alias("bb_lower"),
        safe_div(F.col("close") - (sma - kk * std), F.lit(2 * float(k)) * std).alias("bb_pct_b"),
        safe_div(F.lit(2 * float(k)) * std, sma).alias("bb_bandwidth"),
    )


def feat_atr14(df: DataFrame, n: int = ATR_DAYS) -> DataFrame:
    prev = F.lag("close").over(_W())
    x = df.select("*", greatest_strict(F.col("high") - F.col("low"), F.abs(F.col("high") - prev),
                                       F.abs(F.col("low") - prev)).alias("_tr"))
    return x.withColumn(f"atr_{n}", F.avg("_tr").over(trailing(n))).drop("_tr")


def _dtme() -> Column:
    return F.datediff(F.last_day("date"), F.col("date")).cast("long")


def feat_days_to_month_end(df: DataFrame) -> DataFrame:
    return df.withColumn("_days_to_month_end", _dtme())


def month_end_zone_expr(days: Column) -> Column:
    return (F.when(days <= MONTH_END_DAYS, F.lit("month_end"))
            .when(days <= LAST_WEEK_DAYS, F.lit("last_week")).otherwise(F.lit("other")))


def feat_month_end_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("month_end_zone", month_end_zone_expr(_dtme()))


def feat_quarter_end(df: DataFrame) -> DataFrame:
    return df.withColumn("quarter_end_flag",
                         F.month("date").isin(*QUARTER_END_MONTHS) & (_dtme() <= MONTH_END_DAYS))


def feat_calendar(df: DataFrame) -> DataFrame:
    return df.select("*", F.dayofweek("date").cast("long").alias("day_of_week"),
                     F.month("date").cast("long").alias("month_of_year"))


def lookback_start(as_of, years: int = LOOKBACK_YEARS) -> Column:
    return F.add_months(F.lit(as_of).cast("date"), -12 * years)


def feat_lookback_filter(bars: DataFrame, as_of, years: int = LOOKBACK_YEARS) -> DataFrame:
    """keep rows within ``years`` of ``as_of``; applied before any window."""
    return bars.filter(F.col("date") >= lookback_start(as_of, years))


def feat_numeric_contract(feat: DataFrame, precision: int = 38, scale: int = 9) -> DataFrame:
    """the at-rest contract: fixed-point numerics plus an audit timestamp."""
    out = []
    for f in feat.schema.fields:
        if f.dataType.typeName() == "double":
            out.append(F.col(f.name).cast(f"decimal({precision},{scale})").alias(f.name))
        else:
            out.append(F.col(f.name))
    return feat.select(*out, F.current_timestamp().alias("_extracted_at"))


# ------------------------------------------------------------------- F0 ----
def features_daily(bars: DataFrame, as_of=None, years: int = LOOKBACK_YEARS) -> DataFrame:
    """the 35 feature columns (audit timestamp added by F19 at write time).

    ``as_of`` is a date (or ISO string); the reference uses the wall clock.
    Layers: [lags, SMAs, std, volume stats, label, gain/loss, rising flag,
    fast/slow SMA, true range, row index] -> [RSI, streak reset, SMA9 of
    SMAs, ATR] -> projections.  All layers share one window partitioning.
    """
    if as_of is None:
        raise ValueError("as_of is required (use barforge.plans.silver.default_as_of)")
    x = feat_lookback_filter(bars, as_of, years).select("symbol", "date", "open", "high", "low", "close", "volume")
    prev_c = F.lag("close").over(_W())
    prev_v = F.lag("volume").over(_W())
    vavg = _vol_avg(VOLUME_SMA_DAYS)
    l1 = x.select(
        "*",
        *[F.lag("close", n).over(_W()).alias(f"close_lag_{n}d") for n in LAG_DAYS],
        *[F.avg("close").over(trailing(n)).alias(f"sma_{n}") for n in SMA_DAYS],
        F.stddev_samp("close").over(trailing(STD_DAYS)).alias("std_20"),
        F.round(vavg).cast("long").alias("volume_sma_5"),
        safe_div("volume", vavg).alias("volume_vs_sma_ratio"),
        prev_v.cast("long").alias("volume_lag_1d"),
        (safe_div(F.col("volume") - prev_v, prev_v) * F.lit(100.0)).alias("volume_chg_pct"),
        (safe_div("volume", prev_v) >= F.lit(SURGE_RATIO)).alias("volume_surge_flag"),
        (safe_div(F.lead("close").over(_W()) - F.col("close"), "close") * F.lit(100.0)).alias("next_day_return"),
        F.when(F.col("close") > prev_c, F.col("close") - prev_c).otherwise(F.lit(0.0)).alias("_gain"),
        F.when(F.col("close") < prev_c, prev_c - F.col("close")).otherwise(F.lit(0.0)).alias("_loss"),
        F.when(F.col("volume") > prev_v, F.lit(1)).otherwise(F.lit(0)).alias("_inc"),
        F.row_number().over(_W()).alias("_rn"),
        F.avg("close").over(trailing(MACD_FAST)).alias("_sf"),
        F.avg("close").over(trailing(MACD_SLOW)).alias("_ss"),
        greatest_strict(F.col("high") - F.col("low"), F.abs(F.col("high") - prev_c),
                        F.abs(F.col("low") - prev_c)).alias("_tr"),
    )
    ag, al = F.avg("_gain").over(trailing(RSI_DAYS)), F.avg("_loss").over(trailing(RSI_DAYS))
    l2 = l1.select(
        "*",
        (F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + F.try_divide(ag, F.nullif(al, F.lit(0.0))))).alias("rsi_14"),
        F.max(F.when(F.col("_inc") == 0, F.col("_rn"))).over(_W().rowsBetween(Window.unboundedPreceding, 0)).alias("_reset"),
        F.avg("_sf").over(trailing(MACD_SIGNAL)).alias("_sf9"),
        F.avg("_ss").over(trailing(MACD_SIGNAL)).alias("_ss9"),
        F.avg("_tr").over(trailing(ATR_DAYS)).alias("atr_14"),
    )
    std, sma = F.col("std_20"), F.col("sma_20")
    dtme = _dtme()
    line = F.col("_sf") - F.col("_ss")
    sig = F.col("_sf9") - F.col("_ss9")
    cols = {
        "volume_incr_streak": (F.col("_rn") - F.col("_reset")).cast("long"),
        "macd_line": line,
        "macd_signal": sig,
        "macd_histogram": line - sig,
        "bb_upper": sma + F.lit(2.0) * std,
        "bb_lower": sma - F.lit(2.0) * std,
        "bb_pct_b": safe_div(F.col("close") - (sma - F.lit(2.0) * std), F.lit(4.0) * std),
        "bb_bandwidth": safe_div(F.lit(4.0) * std, sma),
        "_days_to_month_end": dtme,
        "month_end_zone": month_end_zone_expr(dtme),
        "quarter_end_flag": F.month("date").isin(*QUARTER_END_MONTHS) & (dtme <= MONTH_END_DAYS),
        "day_of_week": F.dayofweek("date").cast("long"),
        "month_of_year": F.month("date").cast("long"),
    }
    return l2.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in FEATURE_COLUMNS])


def as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))
