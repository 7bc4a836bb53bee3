"""Bronze maintenance.

All are DataFrame jobs: anti joins for idempotent appends, a partially
aggregated ``max_by`` for de-duplication (a hot key with many copies is
combined map-side instead of being sorted in one task), and generators per
symbol instead of cross joins for calendars.
"""

from __future__ import annotations

import colorsys
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from barforge.plans.sizing import broadcast_by_construction

KEY = ["symbol", "date"]


def one_per_key(df: DataFrame, keys=KEY) -> DataFrame:
    """Rows that share a key become one, the newest ``_inserted_at`` (else the largest row)."""
    others = [c for c in df.columns if c not in keys]
    newest = (["_inserted_at"] if "_inserted_at" in others else []) + [c for c in others if c != "_inserted_at"]
    single = df.groupBy(*keys).agg(F.max(F.struct(*newest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
    return single.select(*df.columns)


def append_new(existing: DataFrame, incoming: DataFrame, keys=KEY) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored (stored rows are kept), one per key of the batch."""
    return one_per_key(incoming, keys).join(existing.select(*keys), list(keys), "left_anti")


def append_to_table(existing_path: str, incoming: DataFrame, spark, keys=KEY, partition_by=None) -> DataFrame:
    """Append the new keys to a Parquet table and return the table."""
    existing = spark.read.parquet(existing_path)
    new = append_new(existing, incoming, keys).select(*existing.columns)
    w = new.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(existing_path)
    return spark.read.parquet(existing_path)


def next_fetch_window(existing: DataFrame, symbols: DataFrame, as_of, days_back: int = 365 * 2) -> DataFrame:
    """Per symbol, the next fetch starts the day after its newest stored bar
    (or ``as_of - days_back`` if none); nothing to fetch when start >= end."""
    newest = existing.groupBy("symbol").agg(F.max("date").alias("_newest"))
    end = F.lit(as_of).cast("date")
    x = symbols.join(newest, "symbol", "left")
    start = F.coalesce(F.date_add("_newest", 1), F.date_sub(end, days_back))
    return x.select("symbol", start.alias("fetch_start"), end.alias("fetch_end"), (start < end).alias("needs_fetch"))


def dedupe_bars(df: DataFrame, keys=KEY, order_col: str = "_inserted_at") -> DataFrame:
    """One row per key, the newest ``order_col`` wins."""
    others = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def resample_ticks(ticks: DataFrame, unit: str = "hour") -> DataFrame:
    """Tick rows (symbol, ts, price, size, tick_id) -> OHLCV bars per ``unit``.

    open/close are the first/last price by (ts, tick_id); all five are
    declarative aggregates, so hot symbols are combined map-side.
    """
    order = F.struct("ts", "tick_id")
    return ticks.groupBy("symbol", F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("bar_start")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("size").alias("volume"))


def events_as_ticks(events: DataFrame) -> DataFrame:
    """The driver's ``events`` table as ticks: symbol = event_type, price = value, size = 1."""
    return events.select(F.col("event_type").alias("symbol"), F.col("ts"), F.col("value").alias("price"),
                         F.lit(1).cast("long").alias("size"), F.col("event_id").alias("tick_id"))


def resample_bars(bars: DataFrame, period: str = "week") -> DataFrame:
    """S7 on daily bars: Sunday weeks or calendar months."""
    from barforge.functions.core import sunday_week
    start = sunday_week("date") if period == "week" else F.trunc("date", "month")
    return bars.groupBy("symbol", start.alias("period_start")).agg(
        F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"), F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("n_days"))


def trading_calendar(bars: DataFrame) -> DataFrame:
    """Every Monday-Friday between the first and last bar date (one row per day)."""
    span = bars.agg(F.min("date").alias("_s"), F.max("date").alias("_e"))
    days = span.select(F.explode(F.sequence("_s", "_e", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.filter(~F.dayofweek("date").isin(1, 7))


def symbol_calendar_grid(bars: DataFrame) -> DataFrame:
    """Dense (symbol, weekday) grid over each symbol's own span, with a
    flag for missing bars.  Generated per symbol (explode of its date
    range), then left-joined to the bars: no cross join."""
    spans = bars.groupBy("symbol").agg(F.min("date").alias("_s"), F.max("date").alias("_e"))
    grid = spans.select("symbol", F.explode(F.sequence("_s", "_e", F.expr("INTERVAL 1 DAY"))).alias("date")) \
        .filter(~F.dayofweek("date").isin(1, 7))
    have = bars.select("symbol", "date", F.lit(True).alias("_has"))
    return grid.join(have, ["symbol", "date"], "left").select(
        "symbol", "date", F.col("_has").isNull().alias("missing_bar"))


# Persona dictionary for the arena: our own wording, chess pieces as icons, colours evenly spaced around the wheel.
_PERSONAS = {
    "1_momentum": ("Momentum", "rides the trend"),
    "2_breakout": ("Breakout", "waits for the squeeze to break"),
    "3_volume_confirm": ("Volume Confirm", "needs volume first"),
    "4_reversal": ("Reversal", "fades the extremes"),
    "5_dow_specialist": ("Weekday", "trades the calendar"),
    "6_month_end_hunter": ("Month End", "hunts month-end flows"),
    "7_calm_before_storm": ("Calm Before Storm", "buys quiet squeezes"),
    "8_sentiment": ("Sentiment", "follows the crowd"),
    "9_mean_reversion": ("Mean Reversion", "RSI and bands"),
    "10_ensemble": ("Ensemble", "averages the top three"),
}


def _wheel(i: int, n: int) -> str:
    return "#" + "".join(f"{round(255 * c):02x}" for c in colorsys.hsv_to_rgb(i / n, 0.5, 0.75))


PERSONAS_JSON = json.dumps({
    k: {"name": name, "title": title, "emoji": chr(0x2654 + i), "color": _wheel(i, len(_PERSONAS))}
    for i, (k, (name, title)) in enumerate(_PERSONAS.items())}, ensure_ascii=False)
PERSONA_STRUCT = StructType([StructField(c, StringType()) for c in ["name", "title", "emoji", "color"]])
DEFAULT_PERSONA = {"title": "", "emoji": "♟", "color": "#808080"}


def persona_dim(spark, personas_json: str = PERSONAS_JSON) -> DataFrame:
    """JSON dictionary -> (entrant_name, name, title, emoji, color) rows."""
    one = spark.createDataFrame([(personas_json,)], "js string")
    m = one.select(F.explode(F.from_json("js", MapType(StringType(), PERSONA_STRUCT))).alias("entrant_name", "p"))
    return m.select("entrant_name", "p.*")


def persona_join(lb: DataFrame, personas: DataFrame) -> DataFrame:
    """Leaderboard rows with persona fields; unknown entrants get the default persona."""
    dim = broadcast_by_construction(personas, "one row per entry of the persona dictionary")
    j = lb.join(dim, "entrant_name", "left")
    return j.select(*lb.columns,
                    F.coalesce("name", "entrant_name").alias("persona_name"),
                    F.coalesce("title", F.lit(DEFAULT_PERSONA["title"])).alias("persona_title"),
                    F.coalesce("emoji", F.lit(DEFAULT_PERSONA["emoji"])).alias("persona_emoji"),
                    F.coalesce("color", F.lit(DEFAULT_PERSONA["color"])).alias("persona_color"))
