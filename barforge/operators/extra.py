"""Specified-only operators.

Range and as-of joins are expressed without theta joins:
* X2 finds the first bar that hits stop-loss or take-profit by halving:
  lowest and highest closes of blocks of 1, 2, 4, ... bars per symbol, and one
  equi-join on (symbol, index) per block size;
* X8, X10 use forward ``first(ignorenulls)`` frames over the symbol window
  or over the small per-date calendar table, never a join on inequality.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.core import safe_div, sunday_week
from barforge.plans.sizing import bounded_broadcast, broadcast_by_construction

LABEL = "next_day_return"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
DOWS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]
# Screening rules (fixed values of the specification).
SCREEN_TOP, SCREEN_MIN_RATIO, SCREEN_MIN_CLOSE, SCREEN_CAP = 20, 0.5, 100.0, 3
EXIT_PRIORITY = ["TP_SL", "SIGNAL_REVERSAL", "WEEK_END", "MAX_HOLD"]
# Holiday rule: (month, day) of fixed-date holidays, generated for every year of the data span.
FIXED_HOLIDAYS = [(1, 1), (7, 4), (12, 25)]


def with_bar_index(feat: DataFrame) -> DataFrame:
    """Per-symbol trading-day index (1, 2, ...)."""
    return feat.withColumn("bar_idx", F.row_number().over(Window.partitionBy("symbol").orderBy("date")).cast("long"))


# ------------------------------------------------------------------ X1 ----
def trading_days(feat: DataFrame) -> DataFrame:
    """(date, prev_date): every date of the table and the one before it (one row per calendar day)."""
    return feat.select("date").distinct().withColumn("prev_date", F.lag("date").over(Window.orderBy("date")))


def _enter(cap: int):
    """Fold over one gene's candidates, in order: what was entered the day before may not enter, the strongest ``cap`` do."""
    def run(gene: pa.Table) -> pa.Table:
        gene = gene.sort_by([("date", "ascending"), ("_r", "ascending")])
        day, before, today, keep, rank = None, set(), [], [], []
        for at, (date, prev, symbol) in enumerate(zip(gene["date"].to_pylist(), gene["prev_date"].to_pylist(), gene["symbol"].to_pylist())):
            if date != day:
                before = set(today) if prev is not None and prev == day else set()
                day, today = date, []
            if len(today) < cap and symbol not in before:
                today.append(symbol)
                keep.append(at)
                rank.append(len(today))
        return gene.select(["date", "gene_id", "symbol", "raw_signal"]).take(pa.array(keep, pa.int64())).append_column("screen_rank", pa.array(rank, pa.int64()))

    return run


def screen_positions(sig: DataFrame, days: DataFrame, top: int = SCREEN_TOP, min_ratio: float = SCREEN_MIN_RATIO,
                     min_close: float = SCREEN_MIN_CLOSE, cap: int = SCREEN_CAP) -> DataFrame:
    """Per gene and day: top ``top`` by |signal|, liquidity and price
    filters, no entry into a symbol entered on the trading day before, then
    the strongest ``cap``.

    What may enter today depends on what yesterday's cap let in, so a gene's
    candidates (at most ``top`` a day) are folded day by day in one task per
    gene.  ``sig`` needs gene_id, date, symbol, raw_signal, close,
    volume_vs_sma_ratio; ``days`` is ``trading_days``.
    """
    wday = Window.partitionBy("gene_id", "date").orderBy(F.abs("raw_signal").desc(), F.col("symbol"))
    c = (sig.filter(F.col("raw_signal") != 0).withColumn("_r", F.row_number().over(wday))
         .filter((F.col("_r") <= top) & (F.col("volume_vs_sma_ratio") > min_ratio) & (F.col("close") > min_close)))
    c = c.select("gene_id", "date", "symbol", "raw_signal", "_r").join(broadcast_by_construction(days, "one row per calendar day"), "date")
    types = {f.name: f.dataType.simpleString() for f in c.schema.fields}
    entered = c.groupBy("gene_id").applyInArrow(_enter(cap), f"date {types['date']}, gene_id {types['gene_id']}, symbol string, raw_signal double, screen_rank long")
    return entered.select("date", "gene_id", "symbol", "raw_signal",
                          F.when(F.col("raw_signal") > 0, "LONG").otherwise("SHORT").alias("side"),
                          F.abs("raw_signal").alias("signal_strength"), "screen_rank")


# ------------------------------------------------------------------ X2 ----
def price_blocks(bars: DataFrame, levels: int) -> DataFrame:
    """``bars`` (symbol, bar_idx, close) with lo_j, hi_j: lowest and highest close of the 2**j bars that begin here.

    A block is its two halves, the second found with ``lead``; all windows share one sort by (symbol, bar_idx).
    """
    w = Window.partitionBy("symbol").orderBy("bar_idx")
    b = bars.withColumns({"lo_0": F.col("close"), "hi_0": F.col("close")})
    for j in range(1, levels):
        half = 1 << (j - 1)
        b = b.withColumns({f"lo_{j}": F.least(f"lo_{j - 1}", F.lead(f"lo_{j - 1}", half).over(w)),
                           f"hi_{j}": F.greatest(f"hi_{j - 1}", F.lead(f"hi_{j - 1}", half).over(w))})
    return b


def _pnl_at(price: Column) -> Column:
    """P&L in percent of a position closed at ``price``; rises (LONG) or falls (SHORT) with it."""
    e = F.col("entry_price")
    return F.when(F.col("side") == "LONG", (price - e) / e * 100.0).otherwise((e - price) / e * 100.0)


def first_passage(pos: DataFrame, blocks: DataFrame, levels: int) -> DataFrame:
    """``pos`` with ``hit_idx``: the first bar after ``entry_idx`` whose P&L reaches stop_loss or take_profit, null if none of the
    next 2**levels - 1 does.

    Halving from the largest block down: a block whose extremes reach neither bound is passed over, so each
    level costs one equi-join on (symbol, index) and no position becomes more than one row.
    """
    p = pos.withColumn("_at", F.col("entry_idx") + 1)
    for j in reversed(range(levels)):
        b = blocks.select("symbol", F.col("bar_idx").alias("_at"), F.col(f"lo_{j}").alias("_lo"), F.col(f"hi_{j}").alias("_hi"))
        worst, best = F.least(_pnl_at(F.col("_lo")), _pnl_at(F.col("_hi"))), F.greatest(_pnl_at(F.col("_lo")), _pnl_at(F.col("_hi")))
        reached = F.coalesce((worst <= -F.col("stop_loss")) | (best >= F.col("take_profit")), F.lit(False))
        p = p.join(b, ["symbol", "_at"], "left").withColumn("_at", F.when(reached, F.col("_at")).otherwise(F.col("_at") + (1 << j))).drop("_lo", "_hi")
    end = F.col("entry_idx") + (1 << levels)
    return p.withColumn("hit_idx", F.when(F.col("_at") < end, F.col("_at"))).drop("_at")


def trade_log(pos: DataFrame, genes: DataFrame, bars: DataFrame) -> DataFrame:
    """Exit of each position at the first future bar (within max_hold_days)
    that hits stop-loss/take-profit, a reversed position of the same gene,
    the last bar of the entry week, or the holding limit (in this order at
    one bar).

    pos: (date, gene_id, symbol, side); bars: (symbol, date, close).
    Plan: the next opposite-side position of the same (gene, symbol) is a
    forward ``first(ignorenulls)`` over the positions (no self join), the
    week's last bar a window over the bars, the stop-loss/take-profit bar
    ``first_passage`` (joins grow with the logarithm of the longest holding
    time).  The exit is the least of the four, one more join brings its bar.
    Positions with no exit bar stay open (exit NULL).
    """
    b = with_bar_index(bars.select("symbol", "date", "close"))
    wsym = Window.partitionBy("symbol").orderBy("date")
    week = Window.partitionBy("symbol", sunday_week("date"))
    # the week's last bar, if the table goes on after it
    b = b.withColumn("_next", F.lead("date").over(wsym))
    b = b.withColumn("week_end_idx", F.max(F.when(sunday_week("_next") != sunday_week("date"), F.col("bar_idx"))).over(week)).drop("_next")
    hold = F.greatest(F.col("hold"), F.lit(1))
    longest = genes.agg(F.max("max_hold_days")).first()[0] or 1
    levels = max(1, int(longest).bit_length())
    bb = bounded_broadcast(price_blocks(b, levels))
    g = bounded_broadcast(genes.select("gene_id", "stop_loss", "take_profit", F.col("max_hold_days").alias("hold")), 100_000)
    p = (pos.select("date", "gene_id", "symbol", "side").join(bb.select("symbol", "date", "bar_idx", "close", "week_end_idx"), ["symbol", "date"])
         .join(g, "gene_id"))
    wnext = Window.partitionBy("gene_id", "symbol").orderBy("bar_idx").rowsBetween(1, Window.unboundedFollowing)
    nxt_long = F.first(F.when(F.col("side") == "LONG", F.col("bar_idx")), ignorenulls=True).over(wnext)
    nxt_short = F.first(F.when(F.col("side") == "SHORT", F.col("bar_idx")), ignorenulls=True).over(wnext)
    p = p.select("gene_id", "symbol", F.col("date").alias("entry_date"), "side", F.col("close").alias("entry_price"),
                 F.col("bar_idx").alias("entry_idx"), "stop_loss", "take_profit", "hold",
                 F.when(F.col("side") == "LONG", nxt_short).otherwise(nxt_long).alias("opposite_idx"),
                 F.when(F.col("week_end_idx") > F.col("bar_idx"), F.col("week_end_idx")).alias("week_end_idx"))
    p = first_passage(p, bb, levels)
    limit = F.col("entry_idx") + hold
    exits = {"TP_SL": F.col("hit_idx"), "SIGNAL_REVERSAL": F.col("opposite_idx"), "WEEK_END": F.col("week_end_idx"),
             "MAX_HOLD": F.when(F.col("hold") >= 1, limit)}
    first = F.least(*exits.values())
    p = p.withColumn("_exit", F.when(first <= limit, first))
    reason = F.coalesce(*[F.when(exits[name] == F.col("_exit"), F.lit(name)) for name in EXIT_PRIORITY])
    p = p.withColumn("_reason", reason).join(
        bb.select("symbol", F.col("bar_idx").alias("_exit"), F.col("date").alias("exit_date"), F.col("close").alias("exit_price")), ["symbol", "_exit"], "left")
    # a holding limit beyond the last bar leaves the position open
    return p.select(F.col("entry_date").alias("date"), "gene_id", "symbol", F.col("side").alias("signal_type"), "entry_price",
                    "exit_date", "exit_price", _pnl_at(F.col("exit_price")).alias("pnl"),
                    F.when(F.col("exit_date").isNotNull(), F.col("_reason")).alias("exit_reason"), sunday_week("entry_date").alias("week_start"))


def pnl_by_exit_reason(log: DataFrame) -> DataFrame:
    """Mean P&L per (gene, exit reason) of closed trades."""
    return log.filter(F.col("exit_reason").isNotNull()).groupBy("gene_id", "exit_reason").agg(
        F.avg("pnl").alias("avg_pnl"), F.count(F.lit(1)).alias("n_trades"))


# ------------------------------------------------------------ X7 - X13 ----
def calendar_dummies(df: DataFrame) -> DataFrame:
    """Weekday / month indicator columns, Sunday week number, quarter, quarter-end week."""
    d = F.col("date")
    return df.select(
        "date", "symbol",
        *[(F.dayofweek(d) == i + 1).alias(f"dow_{n}") for i, n in enumerate(DOWS)],
        *[(F.month(d) == i + 1).alias(f"month_{n}") for i, n in enumerate(MONTHS)],
        F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / 7).cast("long").alias("week_of_year"),
        (F.dayofmonth(d) - 1).cast("long").alias("days_from_month_start"),
        F.quarter(d).cast("long").alias("quarter"),
        (F.month(d).isin(3, 6, 9, 12) & (F.datediff(F.last_day(d), d) <= 7)).alias("quarter_end_week"))


def holidays_for(bars: DataFrame, rule=FIXED_HOLIDAYS) -> DataFrame:
    """Holiday dates by rule for every year of the bars' span (one row per holiday)."""
    years = bars.agg(F.min(F.year("date")).alias("_a"), F.max(F.year("date")).alias("_b")).select(
        F.explode(F.sequence("_a", "_b")).alias("y"))
    return years.select(F.explode(F.array(*[F.make_date("y", F.lit(m), F.lit(dd)) for m, dd in rule])).alias("holiday"))


def preholiday_return(feat: DataFrame, holidays: DataFrame, n: int = 4) -> DataFrame:
    """Last bar of each symbol before a holiday, and the rolling mean label of
    the previous n such bars (excluding the current one)."""
    dates = feat.select("date").distinct()
    cal = dates.select("date", F.lit(None).cast("date").alias("holiday")).unionByName(
        holidays.select(F.col("holiday").alias("date"), F.col("holiday")))
    # per-date table (bounded by the calendar): next holiday strictly after the date
    # holiday rows sort before a bar row of the same date, so "following" is strictly later
    w = Window.orderBy(F.col("date"), F.col("holiday").asc_nulls_last()).rowsBetween(1, Window.unboundedFollowing)
    nxt = cal.select("date", F.first("holiday", ignorenulls=True).over(w).alias("next_holiday")).groupBy("date") \
        .agg(F.min("next_holiday").alias("next_holiday"))
    nxt = broadcast_by_construction(nxt, "one row per calendar day of the silver window")
    ws = Window.partitionBy("symbol").orderBy("date")
    x = feat.select("date", "symbol", LABEL, F.lead("date").over(ws).alias("_next_bar")).join(nxt, "date", "left")
    pre = F.col("next_holiday").isNotNull() & (F.col("_next_bar").isNull() | (F.col("_next_bar") >= F.col("next_holiday")))
    x = x.withColumn("is_preholiday", F.coalesce(pre, F.lit(False)))
    p = x.filter("is_preholiday").withColumn(
        "preholiday_return_avg", F.avg(LABEL).over(Window.partitionBy("symbol").orderBy("date").rowsBetween(-n, -1)))
    return p.select("date", "symbol", "next_holiday", LABEL, "preholiday_return_avg")


def sq_week(feat: DataFrame, days: int = 5) -> DataFrame:
    """Second Friday of each month (SQ date) and bars within +-days trading days of it."""
    d = F.col("date")
    first = F.trunc(d, "month")
    sq = F.date_add(F.next_day(F.date_sub(first, 1), "Fri"), 7)
    x = with_bar_index(feat.select("date", "symbol")).withColumn("sq_date", sq)
    wm = Window.partitionBy("symbol", F.trunc("date", "month"))
    x = x.withColumn("_sq_idx", F.min(F.when(F.col("date") >= F.col("sq_date"), F.col("bar_idx"))).over(wm))
    off = (F.col("bar_idx") - F.col("_sq_idx")).cast("long")
    return x.select("date", "symbol", "sq_date", off.alias("sq_offset"),
                    F.coalesce(F.abs(off) <= days, F.lit(False)).alias("sq_week"))


def event_bars(bars: DataFrame, events: DataFrame) -> DataFrame:
    """(symbol, date, dividend): each event of (symbol, date, dividend) at its symbol's first bar on or after
    its date, dividends of one bar added up; events after the last bar have none."""
    both = bars.select("symbol", "date", F.col("date").alias("_bar"), F.lit(None).cast("double").alias("dividend")).unionByName(
        events.select("symbol", "date", F.lit(None).cast("date").alias("_bar"), F.col("dividend").cast("double")))
    # an event sorts before the bar of its own date
    following = Window.partitionBy("symbol").orderBy("date", F.col("_bar").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    is_event = F.col("_bar").isNull()
    placed = both.select("symbol", F.first("_bar", ignorenulls=True).over(following).alias("_at"), is_event.alias("_e"), "dividend")
    return placed.filter("_e and _at is not null").groupBy("symbol", F.col("_at").alias("date")).agg(
        F.coalesce(F.sum("dividend"), F.lit(0.0)).alias("dividend"))


def dividend_adjusted(bars: DataFrame, events: DataFrame) -> DataFrame:
    """Close adjusted for dividends: every close is multiplied by (previous close - dividend) / previous
    close of all later ex-dates; an event on the first bar, or with a dividend of the price or more, counts 1."""
    ws = Window.partitionBy("symbol").orderBy("date")
    x = bars.join(event_bars(bars, events), ["symbol", "date"], "left").withColumn("_pc", F.lag("close").over(ws))
    cut = F.when(F.col("dividend") < F.col("_pc"), F.try_divide(F.col("_pc") - F.col("dividend"), "_pc"))
    x = x.withColumn("dividend_factor", F.coalesce(cut, F.lit(1.0)))
    later = F.coalesce(F.sum(F.log("dividend_factor")).over(ws.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))
    return x.select("date", "symbol", "close", F.coalesce("dividend", F.lit(0.0)).alias("dividend"), "dividend_factor",
                    (F.col("close") * F.exp(later)).alias("adj_close"))


def event_gap(bars: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Days to the next event, days since the last one, and the opening gap on event days.

    ``events`` (symbol, date, dividend) fall on the first bar on or after their date; without a
    table the first bar of each (symbol, quarter) is an event."""
    ws = Window.partitionBy("symbol").orderBy("date")
    if events is None:
        q = F.trunc("date", "quarter")
        x = bars.withColumn("is_event", F.row_number().over(Window.partitionBy("symbol", q).orderBy("date")) == 1)
    else:
        x = bars.join(event_bars(bars, events).withColumn("_e", F.lit(True)), ["symbol", "date"], "left") \
            .withColumn("is_event", F.coalesce("_e", F.lit(False)))
    ev = F.when(F.col("is_event"), F.col("date"))
    x = x.withColumn("_next", F.first(ev, ignorenulls=True).over(ws.rowsBetween(0, Window.unboundedFollowing))) \
         .withColumn("_prev", F.last(ev, ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, 0))) \
         .withColumn("_prev_close", F.lag("close").over(ws))
    return x.select("date", "symbol", "is_event",
                    F.datediff("_next", "date").cast("long").alias("days_to_event"),
                    F.datediff("date", "_prev").cast("long").alias("days_since_event"),
                    F.when(F.col("is_event"), safe_div(F.col("open") - F.col("_prev_close"), "_prev_close") * 100.0)
                    .alias("event_gap_pct"))


def advance_decline(feat: DataFrame) -> DataFrame:
    """X11: risers, fallers and their ratio per date."""
    c, p = F.col("close"), F.col("close_lag_1d")
    return feat.groupBy("date").agg(
        F.sum(F.when(c > p, 1).otherwise(0)).cast("long").alias("advancers"),
        F.sum(F.when(c < p, 1).otherwise(0)).cast("long").alias("decliners"),
        F.sum(F.when(c == p, 1).otherwise(0)).cast("long").alias("unchanged"),
    ).withColumn("ad_ratio", safe_div("advancers", "decliners"))


def rolling_index_corr(feat: DataFrame, n: int = 20) -> DataFrame:
    """Rolling correlation of each symbol's daily return with the equal-weight index."""
    ret = safe_div(F.col("close") - F.col("close_lag_1d"), "close_lag_1d") * 100.0
    x = feat.select("date", "symbol", ret.alias("ret"))
    # pairs only: a day without a return of its own counts in neither series
    idx = broadcast_by_construction(x.groupBy("date").agg(F.avg("ret").alias("index_ret")), "one row per calendar day")
    j = x.join(idx, "date").withColumn("_i", F.when(F.col("ret").isNotNull(), F.col("index_ret")))
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(-(n - 1), 0)
    # corr() raises on zero variance under ANSI; covariance / (std x std) with try_divide gives NULL
    corr = F.try_divide(F.covar_samp("ret", "_i").over(w),
                        F.stddev_samp("ret").over(w) * F.stddev_samp("_i").over(w))
    return j.select("date", "symbol", "ret", "index_ret", corr.alias("index_corr"))


def sector_strength(feat: DataFrame, sectors: DataFrame) -> DataFrame:
    """Symbol daily return minus its sector's mean return that day."""
    ret = safe_div(F.col("close") - F.col("close_lag_1d"), "close_lag_1d") * 100.0
    s = bounded_broadcast(sectors.select("symbol", "sector"))
    x = feat.select("date", "symbol", ret.alias("ret")).join(s, "symbol")
    sec = x.groupBy("sector", "date").agg(F.avg("ret").alias("sector_ret"))
    return x.join(sec, ["sector", "date"]).select("date", "symbol", "sector", "ret", "sector_ret",
                                                  (F.col("ret") - F.col("sector_ret")).alias("relative_strength"))


def symbol_sectors(spark, sf_dir: str) -> DataFrame:
    """sector = region name of the symbol's nation."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    rg = spark.read.parquet(f"{sf_dir}/region.parquet")
    from barforge.plans.sizing import bounded_broadcast
    return n.join(bounded_broadcast(rg, 100_000), n.n_regionkey == rg.r_regionkey).select(
        F.col("n_name").alias("symbol"), F.col("r_name").alias("sector"))
