"""X1 day by day, X2 bar by bar, numbering against a sort."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barforge.operators import evolution as E
from barforge.operators import extra as X
from barforge.plans.numbering import number_rows

DAY = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_capped_out_candidate_returns_the_next_day(spark):
    rows = [(1, DAY(d), s, v, 500.0, 1.0) for d in (0, 1, 2, 7) for s, v in (("A", .9), ("B", -.8), ("C", .7), ("D", .6), ("E", .5))]
    sig = spark.createDataFrame(rows, "gene_id long, date date, symbol string, raw_signal double, close double, volume_vs_sma_ratio double")
    got = {}
    for r in X.screen_positions(sig, X.trading_days(sig)).orderBy("date", "screen_rank").collect():
        got.setdefault((r.date - DAY(0)).days, []).append(r.symbol)
    # D and E are capped out on day 0, so they may enter on day 1; A, B, C come back on day 2
    assert got == {0: ["A", "B", "C"], 1: ["D", "E"], 2: ["A", "B", "C"], 7: ["D", "E"]}


def test_screen_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(g, DAY(d), f"S{s:02}", rng.choice([0.0, .5, -.5, round(rng.uniform(-1, 1), 3)]), rng.choice([90.0, 150.0, None, 150.0, 150.0]), rng.choice([.4, 1.0, 1.0, None]))
            for g in (1, 2) for d in range(40) if d % 7 < 5 for s in range(30) if rng.random() < .8]
    sig = spark.createDataFrame(rows, "gene_id long, date date, symbol string, raw_signal double, close double, volume_vs_sma_ratio double").repartition(5)
    want, days = set(), sorted({r[1] for r in rows})
    for g in (1, 2):
        before = set()
        for day in days:
            today = sorted((r for r in rows if r[:2] == (g, day) and r[3]), key=lambda r: (-abs(r[3]), r[2]))[:20]
            today = [r for r in today if r[4] and r[4] > 100 and r[5] and r[5] > .5 and r[2] not in before][:3]
            want |= {(day, g, r[2], i + 1) for i, r in enumerate(today)}
            before = {r[2] for r in today}
    got = X.screen_positions(sig, X.trading_days(sig)).select("date", "gene_id", "symbol", "screen_rank").collect()
    assert set(map(tuple, got)) == want and len(got) == len(want)


def brute_exit(p, gene, bars, positions):
    """First bar after the entry with a reason to leave."""
    day, g, symbol, side = p
    mine = sorted((d, c) for s, d, c in bars if s == symbol)
    at = [d for d, _ in mine].index(day)
    entry, (stop, take, hold) = mine[at][1], gene
    sunday = lambda d: d - dt.timedelta(days=(d.weekday() + 1) % 7)
    for k in range(1, max(hold, 1) + 1):
        if at + k >= len(mine):
            return None
        d, c = mine[at + k]
        pnl = (c - entry) / entry * 100.0 if side == "LONG" else (entry - c) / entry * 100.0
        last = at + k + 1 < len(mine) and sunday(mine[at + k + 1][0]) != sunday(d)
        other = [x[3] for x in positions if x[:3] == (d, g, symbol)]
        if pnl <= -stop or pnl >= take:
            return d, c, pnl, "TP_SL"
        if other and other[0] != side:
            return d, c, pnl, "SIGNAL_REVERSAL"
        if last and sunday(d) == sunday(day):
            return d, c, pnl, "WEEK_END"
        if k == hold:
            return d, c, pnl, "MAX_HOLD"
    return None


@pytest.mark.parametrize("hold", [0, 1, 5, 250])
def test_trade_log_equals_bar_by_bar(spark, hold):
    rng = random.Random(hold)
    # one bar a week for symbol W, so that the week's end doesn't cut the long holding times
    bars = [(s, DAY(d if s != "W" else 7 * d), round(100 * (1 + .0008 * (d % 97)) + rng.uniform(-1, 1), 2)) for s in ("A", "B", "W") for d in range(400 if s == "W" else 60)]
    genes = [(1, 3.0, 4.0, hold), (2, 1.0, 50.0, hold), (3, 90.0, 6.5, max(hold - 1, 0))]
    keys = {(b[1], g, b[0]) for b in bars for g in (1, 2, 3) if rng.random() < .3}
    positions = [(*k, rng.choice(["LONG", "SHORT"])) for k in sorted(keys)]
    log = X.trade_log(spark.createDataFrame(positions, "date date, gene_id long, symbol string, side string"),
                      spark.createDataFrame(genes, "gene_id long, stop_loss double, take_profit double, max_hold_days long"),
                      spark.createDataFrame(bars, "symbol string, date date, close double"))
    got = {(r.date, r.gene_id, r.symbol): r for r in log.collect()}
    assert len(got) == len(positions)
    reasons = set()
    for p in positions:
        want = brute_exit(p, next(g[1:] for g in genes if g[0] == p[1]), bars, positions)
        r = got[p[:3]]
        assert (r.exit_date, r.exit_price, r.pnl, r.exit_reason) == (want or (None,) * 4), p
        reasons.add(r.exit_reason)
    assert hold < 250 or {"TP_SL", "SIGNAL_REVERSAL", "WEEK_END"} <= reasons


def test_first_passage_joins_grow_with_the_logarithm(spark):
    genes = spark.createDataFrame([(1, 3.0, 4.0, 250)], "gene_id long, stop_loss double, take_profit double, max_hold_days long")
    bars = spark.createDataFrame([("A", DAY(d), 100.0 + d) for d in range(9)], "symbol string, date date, close double")
    pos = spark.createDataFrame([(DAY(0), 1, "A", "LONG")], "date date, gene_id long, symbol string, side string")
    plan = X.trade_log(pos, genes, bars)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 8 + 3 and "Generate" not in plan


def test_numbering(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.randint(0, 50)])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(7)
    got = number_rows(df, [F.col("v").desc_nulls_last(), F.col("id")], "n")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r.id, r.v) for r in sorted(got.collect(), key=lambda r: r.n)] == want
    assert sorted(r.n for r in got.collect()) == list(range(1, 5001))
    assert number_rows(df.limit(0), ["id"], "n").count() == 0


def test_no_single_partition_in_numbered_plans(spark):
    genes = E.gene_pool_init(spark, 50)
    scored = genes.select("gene_id", "strategy_name", F.lit(0).alias("n_trades"), (-F.col("gene_id") % 7).cast("double").alias("fitness"))
    fs = spark.range(100).select(F.current_date().alias("date"), F.col("id").cast("string").alias("symbol"),
                                 *[F.lit(1.0).alias(c) for c in ("s_momentum", "s_volume", "s_reversal", "s_breakout", "next_day_return")])
    for df in (E.append_generation(genes, genes), E.cull_tiers(scored), E.ga_signals(fs, genes)):
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
    assert E.ga_signals(fs, genes).count() == 5000
    assert [r.gene_id for r in E.append_generation(genes, genes).orderBy("gene_id").collect()] == list(range(1, 101))
    tiers = [r.tier for r in E.cull_tiers(scored).orderBy("fitness_rank").collect()]
    assert tiers == ["PARENT"] * 3 + ["SURVIVE"] * 4 + ["CULL"] * 43
