"""Model datasets, boosted-tree training, scoring and explanation.

Training sets are projections of the silver table (column pruning reaches
the Parquet scan).  Models are Newton-boosted trees with L1 and L2 terms
(``boosting``), trained by one histogram job per level; scores and
attributions (path-dependent Shapley values) are one pass over the rows, no
copy per feature and no join back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.functions.core import clamp, greatest_strict, r, safe_div, u01
from barforge.operators import boosting
from barforge.operators.boosting import Boosted

LABEL = "next_day_return"
HOLDOUT_DAYS = 180

# Fixed feature lists of the reference's four models and the full model.
STRATEGY_FEATURES = {
    "momentum": ["close_lag_1d", "close_lag_5d", "close_lag_20d", "sma_5", "sma_20", "sma_60", "rsi_14",
                 "volume_surge_flag", "volume_incr_streak", "volume_vs_sma_ratio"],
    "breakout": ["std_20", "atr_14", "bb_bandwidth", "bb_pct_b", "bb_upper", "bb_lower",
                 "close_lag_1d", "close_lag_5d", "close_lag_20d", "high", "low", "close"],
    "volume_confirm": ["volume", "volume_sma_5", "volume_vs_sma_ratio", "volume_chg_pct", "volume_incr_streak",
                       "volume_surge_flag", "close_lag_1d", "sma_5", "sma_20"],
    "reversal": ["rsi_14", "bb_pct_b", "bb_bandwidth", "bb_lower", "bb_upper", "close", "sma_5", "sma_20",
                 "close_lag_1d", "close_lag_5d", "close_lag_20d", "volume_surge_flag", "volume_vs_sma_ratio",
                 "month_end_zone", "quarter_end_flag"],
    "full": ["symbol", "open", "high", "low", "close", "volume", "close_lag_1d", "close_lag_5d", "close_lag_20d",
             "sma_5", "sma_20", "sma_60", "std_20", "rsi_14", "volume_sma_5", "volume_vs_sma_ratio", "volume_chg_pct",
             "volume_incr_streak", "volume_surge_flag", "macd_line", "macd_signal", "macd_histogram", "bb_upper",
             "bb_lower", "bb_pct_b", "bb_bandwidth"],
}
# Alternative column sets (M17) including derived columns (M6-M9).
VARIANT_FEATURES = {
    "momentum": ["symbol", "close", "close_lag_1d", "close_lag_5d", "close_lag_20d", "sma_5", "sma_20", "sma_60",
                 "rsi_14", "volume_sma_5", "volume_vs_sma_ratio", "volume_chg_pct", "volume_incr_streak",
                 "volume_surge_flag", "macd_line", "macd_signal", "macd_histogram", "bb_pct_b", "bb_bandwidth"],
    "breakout": ["symbol", "close", "high", "low", "std_20", "volatility_compression", "vol_expansion_flag",
                 "volume_vs_sma_ratio", "volume_surge_flag", "volume_chg_pct", "bb_bandwidth", "atr_14", "bb_pct_b"],
    "volume_confirm": ["symbol", "close", "close_lag_1d", "volume_increase_score", "volume_vs_sma_ratio",
                       "volume_chg_pct", "volume_incr_streak", "volume_surge_flag", "volume_price_divergence",
                       "macd_histogram", "atr_14"],
    "reversal": ["symbol", "close", "close_lag_1d", "close_lag_5d", "sma_20", "price_sma_distance", "rsi_14",
                 "rsi_extremity", "std_20", "bb_pct_b", "macd_histogram"],
}
EXPANSION_RATIO = 1.3
EVAL_SHARE = 0.2


def _cutoff(as_of, days):
    return F.date_sub(F.lit(as_of).cast("date"), days)


def train_set(feat: DataFrame, strategy: str, as_of, holdout_days: int = HOLDOUT_DAYS) -> DataFrame:
    """M1-M5: feature columns + label for rows older than the hold-out window."""
    cols = ["date", "symbol"] + [c for c in STRATEGY_FEATURES[strategy] if c != "symbol"] + [LABEL]
    return feat.filter((F.col("date") < _cutoff(as_of, holdout_days)) & F.col(LABEL).isNotNull()).select(*cols)


def derived_breakout_features(feat: DataFrame) -> DataFrame:
    """M6: range / std20 and std20 expansion flag."""
    w = Window.partitionBy("symbol").orderBy("date")
    return feat.select("*", safe_div(F.col("high") - F.col("low"), "std_20").alias("volatility_compression"),
                       (safe_div("std_20", F.lag("std_20").over(w)) >= F.lit(EXPANSION_RATIO)).alias("vol_expansion_flag"))


def volume_increase_score_expr():
    raw = ((F.col("volume_vs_sma_ratio") - F.lit(1.0)) * F.lit(20.0)
           + greatest_strict(F.col("volume_chg_pct"), F.lit(0.0)) * F.lit(0.5)
           + F.col("volume_incr_streak") * F.lit(5.0)
           + F.when(F.col("volume_surge_flag"), F.lit(30.0)).otherwise(F.lit(0.0)))
    return r(clamp(raw, 0.0, 100.0), 2)


def volume_increase_score(feat: DataFrame) -> DataFrame:
    """M7."""
    return feat.withColumn("volume_increase_score", volume_increase_score_expr())


def volume_price_divergence(feat: DataFrame) -> DataFrame:
    """M8: volume % change / |price % change|, NULL when either is undefined or 0."""
    price_chg = F.abs(safe_div(F.col("close") - F.col("close_lag_1d"), "close_lag_1d") * F.lit(100.0))
    return feat.withColumn("volume_price_divergence", safe_div("volume_chg_pct", F.nullif(price_chg, F.lit(0.0))))


def derived_reversal_features(feat: DataFrame) -> DataFrame:
    """M9: distance to SMA20 in percent and RSI extremity."""
    return feat.select("*", (safe_div(F.col("close") - F.col("sma_20"), "sma_20") * F.lit(100.0)).alias("price_sma_distance"),
                       F.abs(F.col("rsi_14") - F.lit(50.0)).alias("rsi_extremity"))


def with_derived(feat: DataFrame) -> DataFrame:
    """M6-M9 on one pass (the breakout lag shares the symbol window)."""
    return derived_reversal_features(volume_price_divergence(volume_increase_score(derived_breakout_features(feat))))


def train_set_variant(feat: DataFrame, strategy: str, as_of, holdout_days: int = HOLDOUT_DAYS) -> DataFrame:
    """Alternative column sets with derived features; one cut-off parameter (Q11)."""
    d = with_derived(feat)
    return d.filter((F.col("date") < _cutoff(as_of, holdout_days)) & F.col(LABEL).isNotNull()).select(
        "date", *VARIANT_FEATURES[strategy], LABEL)


def train_eval_split(df: DataFrame, eval_share: float = EVAL_SHARE) -> DataFrame:
    """Deterministic hold-out flag from an md5 hash of (symbol, date)."""
    return df.withColumn("is_eval", u01("split", F.col("symbol"), F.col("date")) < F.lit(eval_share))


# --------------------------------------------------------------- models --
def gbt_train(train: DataFrame, features: list[str], label: str = LABEL, max_iter: int = 50, step: float = 0.1,
              validation: bool = True, **kw) -> Boosted:
    """Boosted-tree regressor with the reference's iterations, rate, L1 and L2 terms (0.1 each)
    and least relative progress (0.01) of the rows that the M11 flag holds out."""
    data = train_eval_split(train) if validation else train
    return boosting.train(data, features, label, F.col("is_eval") if validation else None, max_iter=max_iter, step=step, **kw)


def gbt_train_many(jobs: dict, max_workers: int = 4, **kw) -> dict:
    """Fit several independent models at once (name -> (train_df, features)).

    Each fit is a sequence of small jobs; submitting the fits from driver
    threads lets the scheduler overlap them instead of idling between one
    model's levels.
    """
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max_workers) as ex:
        futs = {name: ex.submit(gbt_train, tr, feats, **kw) for name, (tr, feats) in jobs.items()}
        return {name: f.result() for name, f in futs.items()}


def _scorable(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.select(*dict.fromkeys(["date", "symbol", *features]))


def gbt_predict(models: dict[str, Boosted], rows: DataFrame) -> DataFrame:
    """Date, symbol and one column of scores per model for ``rows``, in one pass."""
    features = [f for m in models.values() for f in m.features]
    return boosting.predict(models, _scorable(rows, features)).select("date", "symbol", *models)


def global_importance(model: Boosted, spark: SparkSession) -> DataFrame:
    """Every feature's share of the gain of all splits (zero where it has none)."""
    return spark.createDataFrame(list(model.importance().items()), "feature string, importance double")


def local_explain_topk(model: Boosted, rows: DataFrame, k: int = 10) -> DataFrame:
    """The k largest attributions of every row, by size, then name: (date, symbol, feature, attribution, rank).

    Attributions are Shapley values along the trees' paths: those of all
    features add up to the row's score minus the mean score.  Ranked inside
    the row's array, so no row is shuffled.
    """
    names = F.array(*[F.lit(f) for f in model.features])
    found = boosting.attributions(model, _scorable(rows, model.features))
    pairs = F.transform(F.arrays_zip(F.col("_shapley").alias("v"), names.alias("f")),
                        lambda z: F.struct((-F.abs(z["v"])).alias("size"), z["f"].alias("feature"), z["v"].alias("attribution")))
    top = found.select("date", "symbol", F.posexplode(F.slice(F.array_sort(pairs), 1, k)).alias("pos", "e"))
    return top.select("date", "symbol", "e.feature", "e.attribution", (F.col("pos") + 1).alias("rank"))
