"""Hand-made edge frames for the feature table (the reference has no tests; cases from its semantics)."""
import datetime as dt

from barforge.operators.features import features_daily


def bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume long")


def days(start, n):
    return [start + dt.timedelta(days=i) for i in range(n)]


def feat(spark, rows, as_of=None):
    b = bars(spark, rows)
    as_of = as_of or max(r[1] for r in rows)
    return {r["date"]: r for r in features_daily(b, as_of).collect()}


def test_one_row(spark):
    f = feat(spark, [("A", dt.date(2024, 1, 2), 10.0, 11.0, 9.0, 10.0, 100)])
    r = f[dt.date(2024, 1, 2)]
    assert r["std_20"] is None and r["close_lag_1d"] is None and r["atr_14"] is None
    assert r["next_day_return"] is None and r["volume_incr_streak"] == 0 and r["volume_surge_flag"] is None


def test_constant_close(spark):
    rows = [("A", d, 10.0, 10.0, 10.0, 10.0, 100) for d in days(dt.date(2024, 1, 1), 30)]
    f = feat(spark, rows)
    r = f[dt.date(2024, 1, 30)]
    assert r["std_20"] == 0.0 and r["bb_pct_b"] is None and r["bb_bandwidth"] == 0.0 and r["rsi_14"] is None


def test_rising_only_rsi_null(spark):
    rows = [("A", d, 10.0 + i, 10.0 + i, 10.0 + i, 10.0 + i, 100 + i) for i, d in enumerate(days(dt.date(2024, 1, 1), 20))]
    f = feat(spark, rows)
    assert f[dt.date(2024, 1, 20)]["rsi_14"] is None
    assert f[dt.date(2024, 1, 20)]["volume_incr_streak"] == 19


def test_zero_previous_volume(spark):
    rows = [("A", dt.date(2024, 1, 1), 10.0, 10.0, 10.0, 10.0, 0), ("A", dt.date(2024, 1, 2), 10.0, 10.0, 10.0, 11.0, 50)]
    r = feat(spark, rows)[dt.date(2024, 1, 2)]
    assert r["volume_chg_pct"] is None and r["volume_surge_flag"] is None and r["volume_incr_streak"] == 1


def test_month_end_zones_and_quarter(spark):
    ds = days(dt.date(2024, 2, 20), 12) + days(dt.date(2024, 3, 22), 10)
    rows = [("A", d, 10.0, 10.0, 10.0, 10.0, 100) for d in ds]
    f = feat(spark, rows)
    assert f[dt.date(2024, 2, 27)]["month_end_zone"] == "month_end"      # 2 days to Feb 29
    assert f[dt.date(2024, 2, 26)]["month_end_zone"] == "last_week"
    assert f[dt.date(2024, 2, 21)]["month_end_zone"] == "other"
    assert f[dt.date(2024, 2, 29)]["quarter_end_flag"] is False
    assert f[dt.date(2024, 3, 29)]["quarter_end_flag"] is True
    assert f[dt.date(2024, 3, 28)]["quarter_end_flag"] is False


def test_streak_resets(spark):
    vols = [10, 20, 30, 25, 26, 27, 28]
    rows = [("A", d, 10.0, 10.0, 10.0, 10.0, v) for d, v in zip(days(dt.date(2024, 1, 1), 7), vols)]
    f = feat(spark, rows)
    assert [f[d]["volume_incr_streak"] for d in sorted(f)] == [0, 1, 2, 0, 1, 2, 3]


def test_lookback_filter_applies_before_windows(spark):
    rows = [("A", d, 10.0, 10.0, 10.0, float(i), 100) for i, d in enumerate(days(dt.date(2018, 12, 25), 20))]
    f = features_daily(bars(spark, rows), dt.date(2024, 1, 5)).collect()
    # rows before 2019-01-05 are dropped first, so the first kept row has no lag
    first = min(f, key=lambda r: r["date"])
    assert first["date"] == dt.date(2019, 1, 5) and first["close_lag_1d"] is None
