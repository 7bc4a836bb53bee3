"""Regularised Newton boosting of regression trees, grown level by level.

Training is a sequence of jobs of one shape: an Arrow pass over the binned training table adds up the gradients
and counts of every (node, feature, bin) of the current level inside each task, ``groupBy`` merges them, windows
over the merged histograms give the gain of every split, and one row per node comes back, its best split.
Nothing that grows with the rows leaves the executors: a histogram has nodes x features x bins cells.

* **Bins.** A value's *cell* is its sign, its power of two and one of 256 steps between two powers.  Cells are counted
  by ``groupBy`` (a mergeable sketch of at most 0.4 % relative error), and edges are put where the running
  count passes a multiple of 1 / bins.  Missing values have bin 0, each value of a text column a bin of its own.
* **Exact sums.** Labels and gradients are whole millionths, so their sums do not depend on the order of
  the rows: another partitioning, a lost executor's retry or another engine gives the same trees.
* **Objective.** Squared error with L1 and L2 terms: with ``T(G)`` the sum of gradients drawn to zero by L1,
  a node is worth ``T(G)**2 / (H + L2)``, and a leaf's weight is ``-T(G) / (H + L2)`` times the step.
  A numeric split sends missing values to the side with the larger gain; a text split is one value against the rest.
* **Early stop.** After a tree that lowers the loss of the held-out rows by less than ``min_rel_progress``.

Scores and attributions are one Arrow pass each, with the node table in the closure.  Attributions are the path-dependent Shapley
values of every leaf: for a leaf whose path asks about m features the 2**m outcomes of the row's answers are
worked out once, a row then adds the entry of its own outcome.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType

from barforge.plans.storage import scratch_path

#: labels and gradients are whole numbers of this unit
UNIT = 1_000_000
CELLS = 256
BINS = 64
MISSING = -(1 << 62)
MAX_DEPTH = 6
MAX_VALUES = 4096
L1, L2 = 0.1, 0.1
MIN_CHILD = 1
MIN_GAIN = 0.0
MIN_REL_PROGRESS = 0.01
NODE_FIELDS = ("feature", "bin", "missing_left", "gain", "cover", "value")


@dataclass
class Boosted:
    """A trained ensemble: plain lists, so that it can be stored and sent to tasks."""

    features: list[str]
    text: dict[str, list[str]]
    edges: list[list[int]]
    base: float = 0.0
    depth: int = MAX_DEPTH
    losses: list[float] = field(default_factory=list)
    #: per tree and field one value for each of the heap's nodes (children of n: 2n and 2n + 1); feature -1: leaf, -2: no node
    trees: list[dict[str, list]] = field(default_factory=list)

    def node_table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, bin, missing_left, gain, cover, value) of every node; feature null for leaves."""
        rows = [(t, n, self.features[f] if f >= 0 else None, *(tree[c][n] for c in NODE_FIELDS[1:]))
                for t, tree in enumerate(self.trees) for n, f in enumerate(tree["feature"]) if f != -2]
        return spark.createDataFrame(rows, "tree int, node int, feature string, bin int, missing_left boolean, gain double, cover long, value double")

    def importance(self) -> dict[str, float]:
        """Share of the total gain by feature."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for f, gain in zip(tree["feature"], tree["gain"]):
                if f >= 0:
                    total[self.features[f]] += gain
        whole = sum(total.values())
        return {f: v / whole if whole else 0.0 for f, v in total.items()}

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        return cls(**json.loads(spark.read.parquet(path).first()["model"]))


# ------------------------------------------------------------------ bins --
def cell(value: np.ndarray) -> np.ndarray:
    """Cells of numbers, rising with them; NaN and infinite ones are missing."""
    known = np.isfinite(value)
    x = np.floor(np.where(known, value, 0.0) * 1e8 + 0.5) / 1e8
    part, power = np.frexp(np.abs(x))  # part in [0.5, 1): exact
    found = np.sign(x).astype(np.int64) * ((power.astype(np.int64) + 1099) * CELLS + np.floor((part * 2 - 1) * CELLS).astype(np.int64) + 1)
    return np.where(known, found, MISSING)


def values(df: DataFrame, features: list[str], text: dict[str, list[str]]) -> Column:
    """Array of the features as doubles, NaN for null; a text value is its place in the list of values (unknown: null)."""
    out = []
    for f in features:
        c = F.col(f"`{f}`")
        if f in text:
            known = F.array(*[F.lit(v) for v in text[f]]) if text[f] else F.array().cast("array<string>")
            c = F.nullif(F.array_position(known, c), F.lit(0))
        elif isinstance(df.schema[f].dataType, BooleanType):
            c = c.cast("int")
        out.append(F.coalesce(c.cast("double"), F.lit(float("nan"))))
    return F.array(*out)


def _to_cells(found: np.ndarray, text_at: set[int]) -> np.ndarray:
    out = cell(found)
    for f in text_at:
        out[:, f] = np.where(np.isnan(found[:, f]), MISSING, np.nan_to_num(found[:, f]).astype(np.int64))
    return out


def bin_edges(rows: DataFrame, n_features: int, text_at: set[int], bins: int = BINS) -> list[list[int]]:
    """Upper cells of the bins of every numeric feature, from exact counts per cell (rows: column ``cells``)."""
    counts = (rows.select(F.posexplode("cells").alias("f", "cell")).where(F.col("cell") != MISSING)
              .groupBy("f", "cell").agg(F.count(F.lit(1)).alias("n")))
    if text_at:
        counts = counts.where(~F.col("f").isin(sorted(text_at)))
    w = Window.partitionBy("f")
    upto, total = F.sum("n").over(w.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)), F.sum("n").over(w)
    marked = counts.select("f", "cell", "n", upto.alias("upto"), total.alias("total"))
    passed = F.expr(f"upto * {bins} div total > (upto - n) * {bins} div total AND upto < total")
    edges: list[list[int]] = [[] for _ in range(n_features)]
    for row in marked.where(passed).select("f", "cell").orderBy("f", "cell").collect():  # at most bins - 1 a feature
        edges[row["f"]].append(row["cell"])
    return edges


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(x: np.ndarray) -> pa.Array:
    """A matrix as an array of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def _to_bins(found: np.ndarray, edges: list[list[int]], text_at: set[int]) -> np.ndarray:
    out = np.zeros(found.shape, dtype=np.int32)
    for f, e in enumerate(edges):
        column = found[:, f]
        place = column if f in text_at else np.searchsorted(np.asarray(e, dtype=np.int64), column, side="left") + 1
        out[:, f] = np.where(column == MISSING, 0, place)
    return out


# ------------------------------------------------------------------ trees --
def _arrays(tree: dict[str, list]) -> dict[str, np.ndarray]:
    return {k: np.asarray(v) for k, v in tree.items()}


def _goes_left(x: np.ndarray, f: np.ndarray | int, split: np.ndarray, missing_left: np.ndarray, is_text: np.ndarray) -> np.ndarray:
    return np.where(is_text, x == split, np.where(x == 0, missing_left, x <= split))


def _walk(tree: dict[str, np.ndarray], x: np.ndarray, is_text: np.ndarray, depth: int) -> np.ndarray:
    """The node where each row ends (a leaf, or a node not split yet)."""
    node, rows = np.ones(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(depth):
        f = tree["feature"][node]
        inner = f >= 0
        left = _goes_left(x[rows, np.maximum(f, 0)], f, tree["bin"][node], tree["missing_left"][node], is_text[np.maximum(f, 0)])
        node = np.where(inner, 2 * node + ~left, node)
    return node


def _score(trees: list[dict[str, np.ndarray]], x: np.ndarray, is_text: np.ndarray, base: float, depth: int) -> np.ndarray:
    out = np.full(len(x), base)
    for tree in trees:
        out += tree["value"][_walk(tree, x, is_text, depth)]
    return out


def _histograms(model: Boosted, growing: dict[str, list] | None, level: int, bins: int):
    """Arrow pass: partial sums by (node, feature, bin) of the rows in the level's nodes; at level 0 also the held-out loss."""
    trees, part = [_arrays(t) for t in model.trees], _arrays(growing) if growing else None
    width, first, nodes = len(model.features), 1 << level, 1 << level
    is_text = np.array([f in model.text for f in model.features])
    base, depth = model.base, model.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g_sum = np.zeros(nodes * width * bins, dtype=np.int64)
        h_sum = np.zeros_like(g_sum)
        loss = rows = 0
        for b in batches:
            x = _matrix(b.column(0), width)
            y, held = b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            g = np.floor(_score(trees, x, is_text, base, depth) * UNIT - y + 0.5).astype(np.int64)
            if level == 0:
                e = g[held]
                hi, lo = e >> 15, e & 0x7FFF
                loss += (int((hi * hi).sum()) << 30) + (int((hi * lo).sum()) << 16) + int((lo * lo).sum())
                rows += len(e)
            use = ~held
            node = _walk(part, x, is_text, level) - first if part else np.zeros(len(x), dtype=np.int64)
            use &= node >= 0
            x, g, node = x[use], g[use], node[use]
            at = ((node[:, None] * width + np.arange(width)) * bins + x).ravel()
            # float sums of whole numbers below 2**53 are exact
            g_sum += np.bincount(at, np.repeat(g, width), len(g_sum)).astype(np.int64)
            h_sum += np.bincount(at, minlength=len(h_sum))
        at = np.flatnonzero(h_sum)
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // (width * bins) + first).astype(np.int32)), pa.array((at // bins % width).astype(np.int32)), pa.array((at % bins).astype(np.int32)),
             pa.array(g_sum[at]), pa.array(h_sum[at]), pa.nulls(len(at), pa.decimal128(38, 0))], ["node", "f", "bin", "g", "h", "loss"])
        if rows:
            one = [pa.array([v], pa.int32()) for v in (0, -1, -1)]
            yield pa.RecordBatch.from_arrays([*one, pa.array([0]), pa.array([rows]), pa.array([loss], pa.decimal128(38, 0))], ["node", "f", "bin", "g", "h", "loss"])

    return run


HISTOGRAM = "node int, f int, bin int, g long, h long, loss decimal(38,0)"


def _worth(g: str, h: str, l1: float, l2: float) -> str:
    """SQL of a node's worth; g is drawn to zero by L1 in label units."""
    x = f"(CAST({g} AS DOUBLE) / {UNIT})"
    drawn = f"(CASE WHEN {x} > {l1}D THEN {x} - {l1}D WHEN {x} < -{l1}D THEN {x} + {l1}D ELSE 0.0D END)"
    return f"({drawn} * {drawn} / ({h} + {l2}D))"


def best_splits(parts: DataFrame, text_at: set[int], l1: float, l2: float, min_child: int, min_gain: float) -> DataFrame:
    """One row per node of the tasks' histograms: total g and h, ``best`` (gain, feature, bin, missing_left, left g, left h) or null, loss.

    Ties go to the first feature, the first bin and missing values on the right.  A task's cells are summed
    already, so they go straight to where the windows over (node, f) need them.  (SQL text: one call to the JVM
    instead of some hundred, once a level.)
    """
    is_text = f"f IN ({', '.join(map(str, sorted(text_at)))})" if text_at else "false"
    gain = f"{_worth('g_left', 'h_left', l1, l2)} + {_worth('g_all - g_left', 'h_all - h_left', l1, l2)} - {_worth('g_all', 'h_all', l1, l2)}"
    return parts.sparkSession.sql(f"""
        WITH hist AS (SELECT node, f, bin, sum(g) AS g, sum(h) AS h, sum(loss) AS loss FROM {{parts}} GROUP BY node, f, bin),
        cum AS (SELECT *, sum(g) OVER a AS g_all, sum(h) OVER a AS h_all,
                       sum(CASE WHEN bin > 0 THEN 0 ELSE g END) OVER a AS g_none, sum(CASE WHEN bin > 0 THEN 0 ELSE h END) OVER a AS h_none,
                       sum(CASE WHEN bin > 0 THEN g ELSE 0 END) OVER u AS g_upto, sum(CASE WHEN bin > 0 THEN h ELSE 0 END) OVER u AS h_upto
                FROM hist WINDOW a AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY bin ROWS UNBOUNDED PRECEDING)),
        opt AS (SELECT *, inline(array(
                  struct(false AS missing_left, CASE WHEN {is_text} THEN g ELSE g_upto END AS g_left, CASE WHEN {is_text} THEN h ELSE h_upto END AS h_left),
                  struct(true AS missing_left, CASE WHEN NOT {is_text} AND h_none > 0 THEN g_upto + g_none END AS g_left,
                         CASE WHEN NOT {is_text} AND h_none > 0 THEN h_upto + h_none END AS h_left))) FROM cum),
        won AS (SELECT *, {gain} AS gain FROM opt)
        SELECT node, max(g_all) AS g, max(h_all) AS h,
               max(CASE WHEN bin > 0 AND h_left >= {min_child} AND h_all - h_left >= {min_child} AND gain > {min_gain}D
                   THEN struct(gain, -f AS f, -bin AS bin, NOT missing_left AS right, g_left, h_left) END) AS best, max(loss) AS loss
        FROM won GROUP BY node""", parts=parts.repartition("node", "f"))


def _leaf_value(g: int, h: int, step: float, l1: float, l2: float) -> float:
    x = g / UNIT
    drawn = x - l1 if x > l1 else x + l1 if x < -l1 else 0.0
    return step * (-drawn / (h + l2))


def _small_jobs(spark: SparkSession) -> SparkSession:
    """A session for the jobs of the levels: their shuffles hold histograms, however many rows there are, so few
    partitions are enough and planning them anew at run time only costs time."""
    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.enabled", "false")
    s.conf.set("spark.sql.shuffle.partitions", str(max(1, min(32, spark.sparkContext.defaultParallelism // 2))))
    return s


def train(rows: DataFrame, features: list[str], label: str, held_out: Column | None = None, max_iter: int = 50, step: float = 0.1, l1: float = L1,
          l2: float = L2, max_depth: int = MAX_DEPTH, bins: int = BINS, min_child: int = MIN_CHILD, min_gain: float = MIN_GAIN,
          min_rel_progress: float | None = MIN_REL_PROGRESS) -> Boosted:
    """Fit ``label`` (null labels are left out).  ``held_out`` marks the rows that only decide when to stop (none: no early stop)."""
    spark = rows.sparkSession
    text_cols = [f for f in features if isinstance(rows.schema[f].dataType, StringType)]
    text = {}
    for f in text_cols:
        distinct = [v[0] for v in rows.select(f"`{f}`").where(F.col(f"`{f}`").isNotNull()).distinct().limit(MAX_VALUES + 1).collect()]
        if len(distinct) > MAX_VALUES:
            raise ValueError(f"{f} has more than {MAX_VALUES} values: encode it as numbers")
        text[f] = sorted(distinct)
    text_at = {features.index(f) for f in text_cols}
    y = F.floor(F.col(f"`{label}`").cast("double") * UNIT + 0.5).cast("long")
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    base = scratch_path(spark, f"boosting-{uuid.uuid4().hex[:12]}")
    width = len(features)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([_lists(_to_cells(_matrix(b.column(0), width), text_at)), b.column(1), b.column(2)], ["cells", "y", "held"])

    found = rows.where(F.col(f"`{label}`").isNotNull()).select(values(rows, features, text).alias("values"), y.alias("y"), held.alias("held"))
    found.mapInArrow(to_cells, "cells array<long>, y long, held boolean").write.parquet(f"{base}/cells")
    jobs = _small_jobs(spark)
    found = jobs.read.schema("cells array<long>, y long, held boolean").parquet(f"{base}/cells")
    edges = bin_edges(found.where("not held"), len(features), text_at, bins)
    model = Boosted(list(features), text, edges, depth=max_depth)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([_lists(_to_bins(_matrix(b.column(0), width), edges, text_at)), b.column(1), b.column(2)], ["x", "y", "held"])

    found.mapInArrow(to_bins, "x array<int>, y long, held boolean").write.parquet(f"{base}/bins")
    table = jobs.read.schema("x array<int>, y long, held boolean").parquet(f"{base}/bins")
    total = table.where("not held").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).first()
    if total["n"]:
        model.base = total["y"] / total["n"] / UNIT
        wide = max([bins, *(len(v) for v in text.values())]) + 1
        for _ in range(max_iter):
            if not _grow(model, table, text_at, wide, step, l1, l2, min_child, min_gain, min_rel_progress):
                break
        else:
            if min_rel_progress is not None:
                _loss(model, table, wide)
    target = spark._jvm.org.apache.hadoop.fs.Path(base)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return model


def _parts(model: Boosted, table: DataFrame, growing: dict[str, list] | None, level: int, wide: int) -> DataFrame:
    return table.mapInArrow(_histograms(model, growing, level, wide), HISTOGRAM)


def _loss(model: Boosted, table: DataFrame, wide: int) -> None:
    last = _parts(model, table, None, 0, wide).where("f = -1").agg(F.sum("loss").alias("loss")).first()
    if last["loss"] is not None:
        model.losses.append(float(last["loss"]))


def _grow(model: Boosted, table: DataFrame, text_at: set[int], wide: int, step: float, l1: float, l2: float, min_child: int, min_gain: float,
          min_rel_progress: float | None) -> bool:
    """Add one tree, a job a level; False (and no tree) once the last one made too little progress."""
    size = 1 << (model.depth + 1)
    tree = {"feature": [-2] * size, "bin": [0] * size, "missing_left": [False] * size, "gain": [0.0] * size, "cover": [0] * size, "value": [0.0] * size}
    for level in range(model.depth):
        best = best_splits(_parts(model, table, tree if level else None, level, wide), text_at, l1, l2, min_child, min_gain)
        found = {row["node"]: row for row in best.collect()}  # one row per node of the level; node 0 brings the held-out loss
        if level == 0:
            if 0 in found:
                loss, before = float(found[0]["loss"]), model.losses[-1] if model.losses else None
                model.losses.append(loss)
                if min_rel_progress is not None and before is not None and (before == 0 or (before - loss) / before < min_rel_progress):
                    return False
            tree["feature"][1], tree["cover"][1] = -1, found[1]["h"]
            tree["value"][1] = _leaf_value(found[1]["g"], found[1]["h"], step, l1, l2)
        splits = {n: row for n, row in found.items() if n and row["best"] is not None}
        for n, row in splits.items():
            b = row["best"]
            tree["feature"][n], tree["bin"][n], tree["missing_left"][n], tree["gain"][n] = -b["f"], -b["bin"], not b["right"], b["gain"]
            for child, g, h in ((2 * n, b["g_left"], b["h_left"]), (2 * n + 1, row["g"] - b["g_left"], row["h"] - b["h_left"])):
                tree["feature"][child], tree["cover"][child], tree["value"][child] = -1, h, _leaf_value(g, h, step, l1, l2)
        if not splits:
            break
    model.trees.append(tree)
    return True


# ---------------------------------------------------- scores, attributions --
def predict(models: dict[str, Boosted], rows: DataFrame) -> DataFrame:
    """``rows`` with one column of scores per model, all in one pass."""
    names = list(models)
    keep = rows.columns
    for name in names:
        m = models[name]
        rows = rows.withColumn(f"_values_{name}", values(rows, m.features, m.text))
    parts = [(m.edges, {m.features.index(f) for f in m.text}, [_arrays(t) for t in m.trees], m.base, m.depth) for m in models.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = list(b.columns[:len(keep)])
            for column, (edges, text_at, trees, base, depth) in zip(b.columns[len(keep):], parts):
                x = _to_bins(_to_cells(_matrix(column, len(edges)), text_at), edges, text_at)
                out.append(pa.array(_score(trees, x, np.array([f in text_at for f in range(len(edges))]), base, depth)))
            yield pa.RecordBatch.from_arrays(out, [*keep, *names])

    schema = rows.select(*[f"`{c}`" for c in keep]).schema
    for name in names:
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema)


def _leaf_tables(tree: dict[str, np.ndarray]) -> tuple[float, list]:
    """(mean score of the tree, leaves); a leaf is (features, for each the nodes to ask and the answers wanted, 2**m x m attributions)."""
    mean, leaves = 0.0, []

    def down(node: int, path: list[tuple[int, bool]]) -> None:
        nonlocal mean
        if tree["feature"][node] >= 0:
            down(2 * node, [*path, (node, True)])
            down(2 * node + 1, [*path, (node, False)])
            return
        value = float(tree["value"][node])
        asked: dict[int, list[tuple[int, bool]]] = {}
        share: dict[int, float] = {}
        for at, left in path:
            f = int(tree["feature"][at])
            asked.setdefault(f, []).append((at, left))
            share[f] = share.get(f, 1.0) * float(tree["cover"][2 * at + (not left)]) / float(tree["cover"][at])
        mean += value * math.prod(share.values())
        m = len(asked)
        if not m or value == 0:
            return
        z = list(share.values())
        answers = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
        table = np.zeros((1 << m, m))
        for i in range(m):
            # coefficients of the product over the other features of (share + answer * y): subsets by size
            poly = np.zeros((1 << m, m))
            poly[:, 0] = 1.0
            for j in range(m):
                if j != i:
                    shifted = np.zeros_like(poly)
                    shifted[:, 1:] = poly[:, :-1] * answers[:, [j]]
                    poly = poly * z[j] + shifted
            weight = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
            table[:, i] = poly @ weight * (answers[:, i] - z[i]) * value
        leaves.append((list(asked), list(asked.values()), table))

    down(1, [])
    return mean, leaves


def attributions(model: Boosted, rows: DataFrame) -> DataFrame:
    """``rows`` with ``_mean`` and ``_shapley`` (array, in the order of the model's features): a score is the mean plus the row's values."""
    keep, width = rows.columns, len(model.features)
    edges, text_at = model.edges, {model.features.index(f) for f in model.text}
    trees = [_arrays(t) for t in model.trees]
    tables = [_leaf_tables(t) for t in trees]
    mean = model.base + sum(m for m, _ in tables)
    is_text = np.array([f in text_at for f in range(width)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _to_bins(_to_cells(_matrix(b.column(len(keep)), width), text_at), edges, text_at)
            out = np.zeros((len(x), width))
            for tree, (_, leaves) in zip(trees, tables):
                left = {n: _goes_left(x[:, f], f, tree["bin"][n], tree["missing_left"][n], is_text[f]) for n, f in enumerate(tree["feature"].tolist()) if f >= 0}
                for features, asked, table in leaves:
                    outcome = np.zeros(len(x), dtype=np.int64)
                    for j, questions in enumerate(asked):
                        yes = np.ones(len(x), dtype=bool)
                        for n, want_left in questions:
                            yes &= left[n] if want_left else ~left[n]
                        outcome |= yes.astype(np.int64) << j
                    out[:, features] += table[outcome]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(np.full(len(x), mean)), _lists(out)], [*keep, "_mean", "_shapley"])

    schema = rows.schema.add("_mean", "double").add("_shapley", ArrayType(DoubleType()))
    return rows.withColumn("_values", values(rows, model.features, model.text)).mapInArrow(run, schema)
