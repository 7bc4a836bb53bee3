"""Model, health and event cases on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from barforge.operators import extra as X
from barforge.operators import health as H
from barforge.operators import models as M
from barforge.plans import catalog as C


def test_full_model_importance_and_explanation(spark, sf):
    model = C.gbt_models(spark, sf, ["full"])["full"]
    feats = M.STRATEGY_FEATURES["full"]
    shares = {r["feature"]: r["importance"] for r in M.global_importance(model, spark).collect()}
    assert list(shares) == feats and len(feats) == 26 and abs(sum(shares.values()) - 1) < 1e-9
    rows = C._holdout(spark, sf)
    got = M.local_explain_topk(model, rows, k=26).collect()
    scores = {(r["date"], r["symbol"]): r["p"] for r in M.gbt_predict({"p": model}, rows).collect()}
    assert len(got) == 26 * len(scores) and {r["feature"] for r in got} == set(feats)
    # a row's attributions add up to its score minus the mean; ranks follow their sizes
    total, sizes = {}, {}
    for r in got:
        key = (r["date"], r["symbol"])
        total[key] = total.get(key, 0.0) + r["attribution"]
        sizes.setdefault(key, []).append((r["rank"], abs(r["attribution"])))
    means = [scores[k] - v for k, v in total.items()]
    assert max(means) - min(means) < 1e-9
    assert all([x for _, x in sorted(v)] == sorted((x for _, x in v), reverse=True) for v in sizes.values())


def test_query_scores_come_from_gbt_predict(spark, sf):
    models = C.gbt_models(spark, sf, C._STRATEGIES)
    got = {(r["date"], r["symbol"]): r["m"] for r in M.gbt_predict({"m": models["momentum"]}, C._holdout(spark, sf)).collect()}
    query = C.q_gbt_strategy_scores(spark, sf).collect()
    assert len(query) == len(got) and all(r["momentum_pred"] == got[r["date"], r["symbol"]] for r in query)


def test_stored_models_are_not_trained_again(spark):
    from barforge.operators.boosting import Boosted
    from barforge.plans.trained import stored_models
    calls = []

    def train(jobs):
        calls.append(sorted(jobs))
        return {name: Boosted(["a"], {}, [[1]], base=float(len(name))) for name in jobs}

    for names in (["a"], ["a", "bb"], ["bb"]):
        assert {n: m.base for n, m in stored_models(spark, "t", ("k",), dict.fromkeys(names), train).items()} == {n: float(len(n)) for n in names}
    assert calls == [["a"], ["bb"]]


def test_health_reports_a_table_that_fails_while_running(spark):
    good = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 2))], "k string, d date")
    bad = good.withColumn("k", F.raise_error(F.lit("broken")).cast("string"))
    none = good.where("false")
    tables = {"t": {"good": (lambda: good, ["k", "d"], "d"), "bad": (lambda: bad, ["k"], "d"), "absent": (lambda: good.select("nope"), ["k"], None),
                    "none": (lambda: none, ["k"], None)}}
    got = {r["table_name"]: r for r in H.table_health(spark, tables).collect()}
    assert tuple(got["good"])[2:] == (3, dt.date(2024, 1, 2), 1, 1, None)
    assert "broken" in got["bad"]["error"] and got["bad"]["row_count"] is None and got["absent"]["error"]
    assert tuple(got["none"])[2:] == (0, None, 0, 0, None)


def test_events_fall_on_the_next_bar(spark):
    day = lambda n: dt.date(2024, 1, n)
    bars = spark.createDataFrame([("A", day(n), 10.0, 10.0, 10.0, 10.0, 1) for n in (2, 3, 8, 9)],
                                 "symbol string, date date, open double, high double, low double, close double, volume long")
    events = spark.createDataFrame([("A", day(5), 1.0), ("A", day(8), 1.0), ("A", day(20), 5.0), ("B", day(3), 1.0)], "symbol string, date date, dividend double")
    gap = {r["date"].day: (r["is_event"], r["days_to_event"], r["days_since_event"]) for r in X.event_gap(bars, events).collect()}
    assert gap == {2: (False, 6, None), 3: (False, 5, None), 8: (True, 0, 0), 9: (False, None, 1)}
    adjusted = {r["date"].day: round(r["adj_close"], 9) for r in X.dividend_adjusted(bars, events).collect()}
    assert adjusted == {2: 8.0, 3: 8.0, 8: 10.0, 9: 10.0}


def test_single_and_wide_signals_agree(spark, sf):
    """R4 is an inner join with the dates that have a label; the wide table keeps every row."""
    from barforge.operators import signals as S
    feat = C.feat(spark, sf)
    single, wide = S.signal_sentiment(feat), S.rule_signals_wide(feat)
    both = wide.join(single.select("date", "symbol", F.col("sentiment_signal").alias("one")), ["date", "symbol"], "left")
    labelled = [r[0] for r in feat.where("next_day_return IS NOT NULL").select("date").distinct().collect()]
    assert both.where(F.col("date").isin(labelled)).where("NOT (one <=> sentiment_signal)").count() == 0
    assert both.where(~F.col("date").isin(labelled)).where("one IS NOT NULL OR sentiment_signal IS NOT NULL").count() == 0
    assert wide.count() == feat.count() > single.count()


def test_counts_gathered_while_writing_equal_a_recount(spark, sf):
    stored = {t: c(spark, sf) for t, c in (("bars", C.bronze_metrics), ("features_daily", C.silver_metrics))}
    assert all(stored.values())
    tables = C._health_tables(spark, sf)
    recounted = {tier: {n: t[:3] for n, t in named.items()} for tier, named in tables.items() if tier != "gold"}
    quick = {tier: named for tier, named in tables.items() if tier != "gold"}
    assert sorted(H.table_health(spark, quick).collect()) == sorted(H.table_health(spark, recounted).collect())
    assert sorted(C.q_layer_rowcount_check(spark, sf).collect()) == sorted(C.recount_layers(spark, sf).collect())


def test_watched_write_counts_duplicates_and_null_keys(spark):
    from barforge.plans.metrics import LayerWatch, stored_metrics
    from barforge.plans.storage import layer_path, materialize
    rows = [("a", dt.date(2024, 1, d), 1) for d in (1, 1, 1, 2)] + [(None, dt.date(2024, 1, 3), 2), ("b", None, 3)]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(3)
    watch = LayerWatch(["k", "d"], "d", "k")
    table = materialize(spark, "watched", ("test",), lambda: watch.source(df), watch=watch)
    path = layer_path(spark, "watched", ("test",))
    got = stored_metrics(spark, path, table)
    assert [got[c] for c in ("row_count", "latest_date", "duplicate_keys", "null_keys")] == [6, dt.date(2024, 1, 3), 2, 2]
    assert table.columns == df.columns and {(x["item"], x["n"]) for x in got["rows_by"]} == {("a", 4), ("b", 1), (None, 1)}
    assert stored_metrics(spark, path, table.limit(2)) is None      # files and counts disagree: count again
    assert H.layer_rowcounts_from_metrics(spark, got) is None and H.layer_rowcounts_from_metrics(spark, None) is None
    assert H.layer_rowcounts_from_metrics(spark, {"source_by": [{"item": "a", "n": 2}], "rows_by": [{"item": "a", "n": 1}]}) is None
