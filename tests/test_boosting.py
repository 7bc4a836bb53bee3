"""Boosted trees against a plain trainer, attributions against all subsets of features."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.operators import boosting as B
from barforge.operators import models as M

FEATURES = ["a", "b", "flag", "kind"]
SCHEMA = "id long, a double, b long, flag boolean, kind string, y double, held boolean"


def table(n=400, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        a, b, flag, kind = rng.choice([None, float("nan"), *[rng.uniform(-5, 50)] * 9]), rng.choice([None, *range(12)]), rng.choice([True, False, None]), rng.choice(["x", "y", "z", None])
        y = (a if a is not None and a == a else -3) * .1 + (2 if kind == "y" else 0) * (b or 0) * .1 + (1 if flag else 0) + rng.gauss(0, .2)
        rows.append((i, a, b, flag, kind, round(y, 4), rng.random() < .2))
    return rows


def bins_of(rows, model):
    """Bins by the definition: powers of two in 256 steps, edges of the model."""
    def one(f, v):
        if v is None or v != v:
            return 0
        if FEATURES[f] == "kind":
            return model.text["kind"].index(v) + 1 if v in model.text["kind"] else 0
        v = math.floor(float(v) * 1e8 + .5) / 1e8
        c = 0
        if v:
            p = math.floor(math.log2(abs(v)))
            p += (abs(v) >= 2.0 ** (p + 1)) - (abs(v) < 2.0 ** p)
            c = int(math.copysign((p + 1100) * 256 + math.floor((abs(v) / 2.0 ** p - 1) * 256) + 1, v))
        return 1 + sum(e < c for e in model.edges[f])

    return [[one(f, r[1 + f]) for f in range(4)] for r in rows]


def left_of(f, split, missing_left, x):
    return x == split if f == 3 else missing_left if x == 0 else x <= split


def brute_train(x, y, held, depth, iters, l1, l2, step, min_rel):
    def drawn(g):
        return g - l1 if g > l1 else g + l1 if g < -l1 else 0.0

    use = [i for i, h in enumerate(held) if not h]
    yi = [math.floor(v * 1e6 + .5) for v in y]
    base = sum(yi[i] for i in use) / len(use) / 1e6
    pred, trees, before = [base] * len(x), [], None
    for _ in range(iters):
        g = [math.floor(p * 1e6 - v + .5) for p, v in zip(pred, yi)]
        loss = float(sum(g[i] ** 2 for i in range(len(x)) if held[i]))
        if before is not None and min_rel is not None and (before - loss) / before < min_rel:
            break
        before, tree = loss, {}

        def grow(node, rows, level):
            G, H = sum(g[i] for i in rows), len(rows)
            worth = lambda g_, h_: drawn(g_ / 1e6) ** 2 / (h_ + l2)
            best = None
            if level < depth:
                for f in range(4):
                    none = any(x[i][f] == 0 for i in rows)
                    for b in sorted({x[i][f] for i in rows} - {0}):
                        for ml in (False, True) if none and f != 3 else (False,):
                            side = [i for i in rows if left_of(f, b, ml, x[i][f])]
                            if 0 < len(side) < H:
                                gl = sum(g[i] for i in side)
                                gain = worth(gl, len(side)) + worth(G - gl, H - len(side)) - worth(G, H)
                                if gain > 0 and (best is None or gain > best[0]):
                                    best = (gain, f, b, ml)
            tree[node] = (best, H, step * (-drawn(G / 1e6) / (H + l2)))
            if best:
                parts = [i for i in rows if left_of(*best[1:], x[i][best[1]])], [i for i in rows if not left_of(*best[1:], x[i][best[1]])]
                grow(2 * node, parts[0], level + 1)
                grow(2 * node + 1, parts[1], level + 1)

        grow(1, use, 0)
        trees.append(tree)
        for i in range(len(x)):
            node = 1
            while tree[node][0]:
                node = 2 * node + (not left_of(*tree[node][0][1:], x[i][tree[node][0][1]]))
            pred[i] += tree[node][2]
    return base, trees, pred


@pytest.fixture(scope="module")
def fitted(spark):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return rows, df, B.train(df, FEATURES, "y", F.col("held"), max_iter=12, step=.4, max_depth=3, bins=16)


def test_trees_equal_a_plain_trainer(spark, fitted):
    rows, df, model = fitted
    x = bins_of(rows, model)
    base, trees, pred = brute_train(x, [r[5] for r in rows], [r[6] for r in rows], 3, 12, .1, .1, .4, .01)
    assert model.base == base and len(model.trees) == len(trees) > 2
    for got, want in zip(model.trees, trees):
        assert {n for n, f in enumerate(got["feature"]) if f != -2} == set(want)
        for n, (best, cover, value) in want.items():
            assert (got["cover"][n], got["value"][n]) == (cover, value)
            assert got["feature"][n] == (best[1] if best else -1)
            if best:
                assert (got["gain"][n], got["bin"][n], got["missing_left"][n]) == (best[0], *best[2:])
    scores = {r.id: r.p for r in B.predict({"p": model}, df.select("id", *FEATURES)).collect()}
    assert [scores[i] for i in range(len(rows))] == pred


def test_trees_do_not_depend_on_partitions_or_storage(spark, fitted):
    rows, df, model = fitted
    other = B.train(df.repartition(17), FEATURES, "y", F.col("held"), max_iter=12, step=.4, max_depth=3, bins=16)
    assert other == model
    from barforge.plans.storage import scratch_path
    path = scratch_path(spark, "model-round-trip")
    model.save(spark, path)
    assert B.Boosted.load(spark, path) == model
    nodes = model.node_table(spark).collect()
    assert sum(r.gain for r in nodes if r.feature == "a") / sum(r.gain for r in nodes) == pytest.approx(model.importance()["a"])


def expected(tree, x, known, node=1):
    """Mean score of a tree where only the features ``known`` are told, by the training rows' shares."""
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    if f in known:
        return expected(tree, x, known, 2 * node + (not left_of(f, tree["bin"][node], tree["missing_left"][node], x[f])))
    return sum(expected(tree, x, known, c) * tree["cover"][c] for c in (2 * node, 2 * node + 1)) / tree["cover"][node]


def test_attributions_equal_all_subsets(spark, fitted):
    rows, df, model = fitted
    x = bins_of(rows, model)
    got = {r.id: r for r in B.attributions(model, df.select("id", *FEATURES)).collect()}
    score = {r.id: r.p for r in B.predict({"p": model}, df.select("id", *FEATURES)).collect()}
    for i in range(0, len(rows), 9):
        assert got[i]["_mean"] + sum(got[i]["_shapley"]) == pytest.approx(score[i], abs=1e-12)
        for f in range(4):
            want = 0.0
            for k in range(4):
                for s in itertools.combinations([j for j in range(4) if j != f], k):
                    weight = math.factorial(k) * math.factorial(3 - k) / math.factorial(4)
                    want += weight * sum(expected(t, x[i], {*s, f}) - expected(t, x[i], set(s)) for t in model.trees)
            assert got[i]["_shapley"][f] == pytest.approx(want, abs=1e-12)


def test_training_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = B.train(none, FEATURES, "y")
    assert model.trees == [] and B.predict({"p": model}, none).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None, 2.5, False), (2, None, None, None, None, None, False)], SCHEMA)
    model = B.train(one, FEATURES, "y", max_iter=2)
    assert model.base == 2.5 and [r.p for r in B.predict({"p": model}, one).collect()] == [2.5, 2.5]
    assert set(model.importance().values()) == {0.0}
    with pytest.raises(ValueError):
        B.train(spark.range(B.MAX_VALUES + 5).select(F.col("id").cast("string").alias("kind"), F.lit(1.0).alias("y")), ["kind"], "y")


def test_cells_rise_with_the_value():
    v = np.array([-1e300, -100.25, -1.0, -.5, -1e-8, 0.0, 1e-8, .5, 1.0, 1.0 + 1 / 256, 3.0, 100.25, 1e300])
    assert (np.diff(B.cell(v)) > 0).all() and B.cell(np.array([np.nan, np.inf, -np.inf])).tolist() == [B.MISSING] * 3


def test_no_copy_of_rows_per_feature(spark, fitted):
    _, df, model = fitted
    rows = df.withColumn("date", F.current_date()).withColumn("symbol", F.col("kind"))
    plan = M.local_explain_topk(model, rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Generate") == 1 and "Exchange" not in plan.split("MapInArrow")[0]
