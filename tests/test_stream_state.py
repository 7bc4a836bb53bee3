"""Restarts, replays, late rows, and what a batch costs."""

import datetime as dt
import os
import random
import time

from pyspark.sql import functions as F

from barforge.operators.features import features_daily
from barforge.plans import catalog as C
from barforge.sources import bronze as SB
from barforge.streaming import pipelines as T

TICKS = "event_type string, ts timestamp_ntz, value double, event_id long"
BARS = "symbol string, date date, open double, high double, low double, close double, volume long"
COLS = ["symbol", "bar_start", "open", "high", "low", "close", "volume"]


def feed(df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def test_bars_after_restart_late_ticks_and_replay(spark):
    rng, t0 = random.Random(1), dt.datetime(2024, 1, 1)
    ticks = [(rng.choice("AB"), t0 + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 6)), round(rng.uniform(1, 9), 2), i) for i in range(3000)]
    ticks.sort(key=lambda r: r[1])
    late = ticks.pop(-300)   # arrives with the last file, its window is open still
    frame = lambda rows: spark.createDataFrame(rows, TICKS)
    src, out, ckpt = (C._fresh(spark, f"t1{n}") for n in ("s", "o", "c"))
    for part in (ticks[:2000], ticks[2000:2600]):
        feed(frame(part), src)
    schema = frame(ticks[:1]).schema
    T.stream_ticks_to_bars(spark, src, schema, out, ckpt)
    before = size(out)
    feed(frame([*ticks[2600:], late]), src)
    got = T.stream_ticks_to_bars(spark, src, schema, out, ckpt).select(*COLS)
    want = SB.resample_ticks(SB.events_as_ticks(frame([*ticks, late])), "hour").select(*COLS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    stored = spark.read.parquet(out)
    batch = stored.agg(F.max("batch_id")).first()[0]
    last = stored.where(F.col("batch_id") == batch)
    # the last batch wrote its own windows only (13 % of the ticks), and the late tick's old bar is there in two versions
    assert 0 < last.count() < 0.3 * stored.count() and 0 < size(out) - before < 0.5 * before
    assert stored.groupBy("symbol", "bar_start").count().where("count > 1").count() >= 1
    # a replayed batch changes nothing
    T.upsert_bars(spark.createDataFrame(last.drop("bar_date", "batch_id").collect(), last.drop("bar_date", "batch_id").schema), batch, out)
    assert sorted(map(tuple, T.read_bars(spark, out).select(*COLS).collect())) == sorted(map(tuple, got.collect()))


def bars_of(symbols, days, seed=3):
    rng, rows = random.Random(seed), []
    for s in symbols:
        price, volume = 100.0, 1000
        for d in range(days):
            price = round(price * (1 + rng.uniform(-.03, .031)), 2)
            volume = volume + rng.randint(1, 20) if s == "UP" or rng.random() < .6 else rng.randint(500, 1500)
            rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=d), price, price + 1, price - 1, price, volume))
    return rows


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def test_features_from_carried_tails(spark):
    rows = bars_of(["A", "B", "UP"], 400)
    as_of = dt.date(2025, 2, 3)
    frame = lambda part: spark.createDataFrame(part, BARS)
    src, bronze, silver, ckpt = (C._fresh(spark, f"t3{n}") for n in ("s", "b", "v", "c"))
    seen = []

    def build(hist):
        seen.append(hist.count())
        return features_daily(hist, as_of)

    def run():
        return T.stream_bronze_to_silver(spark, src, frame(rows[:1]).schema, bronze, silver, ckpt, build)

    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    gap = [r for r in rows if r[0] == "B" and r[1] == day(200)]
    parts = [[r for r in rows if lo <= r[1] < hi and r not in gap] for lo, hi in ((day(0), day(300)), (day(300), day(301)), (day(301), day(380)), (day(380), day(400)))]
    done = []
    for n, part in enumerate(parts):        # a restart before every batch
        feed(frame(part), src)
        done += part
        got = run()
        assert same(got, features_daily(frame(done), as_of)), n
    # UP's volume rises without a break: its streak is older than the tail
    assert got.where("symbol = 'UP'").agg(F.max("volume_incr_streak")).first()[0] == 399
    assert seen == [len(parts[0]), *(3 * T.TAIL + len(p) for p in parts[1:])]
    # one batch fills B's gap and delivers rows of A again: only these two are computed from their history
    seen.clear()
    feed(frame([*gap, *[r for r in parts[3] if r[0] == "A"], ("NEW", day(399), 1.0, 2.0, 0.5, 1.0, 5)]), src)
    done += [*gap, ("NEW", day(399), 1.0, 2.0, 0.5, 1.0, 5)]
    assert same(run(), features_daily(frame(done), as_of))
    assert seen == [1, 801 - 1]
    assert spark.read.parquet(bronze).count() == len(done) == spark.read.parquet(bronze).select("symbol", "date").distinct().count()
