"""Anomaly mining, watch list and scans (A1-A10).

The reference unions seven (and three) scans of the feature table to build
segment rows.  Here each row is exploded once into its segment keys with
``explode(array(struct))`` and a single partially-aggregated ``groupBy``
computes every segment; the per-type reference values (mean of segment
means) are a window over the small aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.core import clamp, greatest_strict, r, safe_div

LABEL = "next_day_return"
# Fixed values of the reference's segment labels.
DOW_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
SEASONS = {1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer",
           7: "summer", 8: "summer", 9: "fall", 10: "fall", 11: "fall", 12: "winter"}
WEEK_ZONE_DAYS = [(7, "week1"), (14, "week2"), (21, "week3")]
SEGMENT_TYPES = ["segment", "dow", "dow_name", "month", "month_week_zone", "month_end_zone", "season"]
WATCH_DAYS, WATCH_MIN_SCORE = 30, 30
ALERT_LEVELS = [(80, "🔴 強烈"), (60, "🟠 顕著"), (40, "🟡 注意")]
ALERT_DEFAULT = "⚪ 静穏"


def _case(col, mapping):
    e = None
    for k, v in mapping.items():
        e = F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v))
    return e


def segment_labels(feat: DataFrame) -> DataFrame:
    """A1: calendar segment labels of every labelled row."""
    d = F.col("date")
    dom = F.dayofmonth(d)
    wz = F.when(dom <= 7, "week1").when(dom <= 14, "week2").when(dom <= 21, "week3").otherwise("week4")
    return feat.filter(F.col(LABEL).isNotNull()).select(
        "date", "symbol", "close", "volume", LABEL,
        F.dayofweek(d).cast("long").alias("dow"),
        F.month(d).cast("long").alias("mth"),
        # Sunday-based week of year: days before the first Sunday are week 0
        F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / 7).cast("long").alias("wk"),
        _case(F.dayofweek(d), {i + 1: n for i, n in enumerate(DOW_NAMES)}).alias("dow_name"),
        "month_end_zone",
        wz.alias("month_week_zone"),
        _case(F.month(d), SEASONS).alias("season"),
    )


def _t_stat():
    return F.try_divide(F.avg(LABEL), F.nullif(F.stddev_samp(LABEL) / F.sqrt(F.count(F.lit(1))), F.lit(0.0)))


def anomaly_segments(feat: DataFrame) -> DataFrame:
    """A2: per (segment type, value) statistics with excess over the type's mean of means."""
    seg = segment_labels(feat)
    keys = {"segment": F.lit("all"), "dow": F.col("dow").cast("string"), "dow_name": F.col("dow_name"),
            "month": F.col("mth").cast("string"), "month_week_zone": F.col("month_week_zone"),
            "month_end_zone": F.col("month_end_zone"), "season": F.col("season")}
    x = seg.select("symbol", LABEL, "volume", F.explode(F.array(*[
        F.struct(F.lit(t).alias("seg_type"), keys[t].alias("seg_value")) for t in SEGMENT_TYPES])).alias("k")
    ).select("k.seg_type", "k.seg_value", "symbol", LABEL, "volume")
    a = x.groupBy("seg_type", "seg_value").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("symbol").alias("n_symbols"),
        F.avg(LABEL).alias("_avg"),
        F.stddev_samp(LABEL).alias("_std"),
        _t_stat().alias("_t"),
        F.avg(F.when(F.col(LABEL) > 0, F.lit(1)).otherwise(F.lit(0))).alias("_win"),
        F.avg("volume").alias("_vol"),
    )
    wt = Window.partitionBy("seg_type")
    p = F.lit(2.0) * (F.lit(1.0) - clamp(F.abs("_t"), 0.0001, 0.9999))
    return a.select(
        "seg_type", "seg_value", "n", "n_symbols",
        r(F.col("_avg"), 4).alias("avg_return"),
        r(F.col("_std"), 4).alias("std_return"),
        r(F.col("_t"), 2).alias("t_stat"),
        r(F.col("_win"), 4).alias("win_rate"),
        r(F.col("_avg") - F.avg("_avg").over(wt), 6).alias("excess_return"),
        r(F.try_divide(F.col("_vol"), F.nullif(F.avg("_vol").over(wt), F.lit(0.0))), 4).alias("volume_ratio"),
        r(p, 4).alias("p_value_approx"),
    )


def anomaly_cross_segments(feat: DataFrame) -> DataFrame:
    """A3: weekday x month-end zone, month x quarter end, weekday x volume mode."""
    lab = feat.filter(F.col(LABEL).isNotNull())
    dow = F.dayofweek("date").cast("string")
    vol_mode = F.when(F.col("volume_surge_flag"), F.lit("surge")).otherwise(F.lit("normal"))
    keys = [F.concat(F.lit("dow="), dow, F.lit("|mend="), F.col("month_end_zone")),
            F.concat(F.lit("mon="), F.month("date").cast("string"), F.lit("|qend="), F.col("quarter_end_flag").cast("string")),
            F.concat(F.lit("dow="), dow, F.lit("|vol="), vol_mode)]
    x = lab.select(LABEL, F.explode(F.array(*keys)).alias("segment_key"))
    return x.groupBy("segment_key").agg(
        F.count(F.lit(1)).alias("n"),
        r(F.avg(LABEL), 4).alias("avg_return"),
        r(F.avg(F.when(F.col(LABEL) > 0, F.lit(1)).otherwise(F.lit(0))), 4).alias("win_rate"))


def anomaly_by_symbol(feat: DataFrame, min_n: int = 10) -> DataFrame:
    """A4: per symbol x {weekday, month, month-end zone}, groups of at least min_n rows."""
    lab = feat.filter(F.col(LABEL).isNotNull())
    keys = [F.struct(F.lit("dow").alias("seg_type"), F.dayofweek("date").cast("string").alias("seg_value")),
            F.struct(F.lit("month").alias("seg_type"), F.month("date").cast("string").alias("seg_value")),
            F.struct(F.lit("month_end_zone").alias("seg_type"), F.col("month_end_zone").alias("seg_value"))]
    x = lab.select("symbol", LABEL, F.explode(F.array(*keys)).alias("k")).select("symbol", "k.*", LABEL)
    return x.groupBy("symbol", "seg_type", "seg_value").agg(
        F.count(F.lit(1)).alias("n"),
        r(F.avg(LABEL), 4).alias("avg_return"),
        r(F.avg(F.when(F.col(LABEL) > 0, F.lit(1)).otherwise(F.lit(0))), 4).alias("win_rate"),
    ).filter(F.col("n") >= min_n)


def anomaly_significant(seg: DataFrame, min_n: int = 20, t: float = 2.0) -> DataFrame:
    """A5."""
    return seg.filter((F.col("n") >= min_n) & (F.abs("t_stat") > t)).orderBy(F.abs("excess_return").desc())


def anomaly_top_cross(cross: DataFrame, min_n: int = 10, k: int = 20) -> DataFrame:
    """Top k cross segments by mean return (segment key breaks ties)."""
    return cross.filter(F.col("n") >= min_n).orderBy(F.col("avg_return").desc(), F.col("segment_key")).limit(k)


def anomaly_symbol_dow(by_sym: DataFrame, win: float = 0.6) -> DataFrame:
    """A7."""
    return by_sym.filter((F.col("seg_type") == "dow") & (F.col("win_rate") > win)).orderBy(F.col("win_rate").desc())


def dow_zone_having(feat: DataFrame, min_n: int = 100) -> DataFrame:
    """Weekday x zone mean label for groups with more than min_n rows."""
    return feat.groupBy(F.col("day_of_week").alias("dow"), "month_end_zone").agg(
        F.avg(LABEL).alias("avg_return"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_n).drop("_n")


def volume_increase_score_expr():
    """M7: clamp(score, 0, 100) rounded to 2, NULL if any input is NULL (surge NULL counts 0)."""
    raw = ((F.col("volume_vs_sma_ratio") - F.lit(1.0)) * F.lit(20.0)
           + greatest_strict(F.col("volume_chg_pct"), F.lit(0.0)) * F.lit(0.5)
           + F.col("volume_incr_streak") * F.lit(5.0)
           + F.when(F.col("volume_surge_flag"), F.lit(30.0)).otherwise(F.lit(0.0)))
    return r(clamp(raw, 0.0, 100.0), 2)


def volume_watch(feat: DataFrame, as_of, days: int = WATCH_DAYS, min_score: float = WATCH_MIN_SCORE) -> DataFrame:
    """Latest-date rows of the last ``days`` with volume score >= min_score."""
    w = Window.partitionBy("symbol").orderBy("date")
    recent = feat.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    prev = F.lag("close").over(w)
    x = recent.select(
        "symbol", "date", "close", "volume", "volume_sma_5", "volume_vs_sma_ratio", "volume_chg_pct",
        "volume_incr_streak", "volume_surge_flag",
        volume_increase_score_expr().alias("volume_increase_score"),
        F.avg("volume_chg_pct").over(w.rowsBetween(-4, 0)).alias("avg_vol_chg_5d"),
        (safe_div(F.col("close") - prev, prev) * F.lit(100.0)).alias("price_chg_pct"))
    latest = recent.agg(F.max("date").alias("_d"))
    s = F.col("volume_increase_score")
    alert = F.when(s >= ALERT_LEVELS[0][0], ALERT_LEVELS[0][1])
    for lvl, name in ALERT_LEVELS[1:]:
        alert = alert.when(s >= lvl, name)
    alert = alert.otherwise(ALERT_DEFAULT)
    return (x.join(F.broadcast(latest), x.date == latest._d).filter(s >= min_score).select(
        "symbol", "date", "close", "volume", "volume_sma_5",
        r(F.col("volume_vs_sma_ratio"), 2).alias("volume_vs_sma_ratio"),
        r(F.col("volume_chg_pct"), 2).alias("volume_chg_pct"),
        "volume_incr_streak", "volume_surge_flag", "volume_increase_score",
        r(F.col("avg_vol_chg_5d"), 2).alias("avg_vol_chg_5d"),
        r(F.col("price_chg_pct"), 2).alias("price_chg_pct"),
        alert.alias("alert_level"))
        .orderBy(F.col("volume_increase_score").desc(), F.col("volume_surge_flag").desc()))


def oversold_scan(feat: DataFrame, rsi: float = 30.0) -> DataFrame:
    """A10: oversold rows (RSI under 30), strongest volume ratio first."""
    return feat.filter(F.col("rsi_14") < rsi).select(
        "date", "symbol", "close", "rsi_14", "volume_vs_sma_ratio").orderBy(F.col("volume_vs_sma_ratio").desc())


def daily_mean_close(bars: DataFrame) -> DataFrame:
    """Mean close per date."""
    return bars.groupBy("date").agg(F.avg("close").alias("avg_close"))
