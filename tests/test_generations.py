"""A generation keeps its size and its islands with fewer scored parents than the selection wants."""

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from barforge.operators import evolution as E


@pytest.mark.parametrize("scored", [0, 1, 2, 3])
def test_generation_keeps_its_size(spark, scored):
    genes = E.gene_pool_init(spark, E.POP_SIZE, 42)
    first = genes.agg(F.min("gene_id")).first()[0]
    current = genes.withColumn("cumulative_pnl", F.when(F.col("gene_id") < first + scored, F.col("gene_id").cast("double")))
    new = E.ga_next_generation(current)
    assert new.count() == E.POP_SIZE and new.select("gene_id").distinct().count() == E.POP_SIZE


def test_islands_stay_apart(spark):
    genes = E.gene_pool_init(spark, 2 * E.POP_SIZE, 42)
    first = genes.agg(F.min("gene_id")).first()[0]
    for _ in range(2):
        island = F.floor((F.col("gene_id") - first) / E.POP_SIZE)
        current = genes.withColumn("cumulative_pnl", F.when((F.col("gene_id") == first) | (island == 1), F.col("gene_id").cast("double")))
        new = E.ga_next_generation(current).select("gene_id", "parent_a", "generation", *[c for c in genes.columns if c not in ("gene_id", "parent_a", "generation")]).cache()
        start = new.agg(F.min("gene_id")).first()[0]
        assert new.count() == 2 * E.POP_SIZE
        crossed = new.where(F.col("parent_a").isNotNull() & (F.floor((F.col("parent_a") - first) / E.POP_SIZE) != F.floor((F.col("gene_id") - start) / E.POP_SIZE)))
        assert crossed.count() == 0
        genes, first = new.select(*genes.columns), start


def draw(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2 ** 32


def r9(x):
    return math.floor(x * 1e9 + 0.5) / 1e9


def scores_of(genes, fs, as_of):
    """Recent P&L of every gene: signals, the strongest three a day, closed at the gene's next row of the symbol, weeks from Sunday."""
    out = {}
    for g in genes:
        days, rows = {}, {}
        for date, symbol, *s, close in fs:
            raw = r9(sum((v or 0.0) * g[w] for v, w in zip(s, ("w_momentum", "w_volume", "w_reversal", "w_breakout"))))
            if raw:
                days.setdefault(date, []).append((-abs(raw), symbol, raw, close))
        for date in sorted(days):
            for _, symbol, raw, close in sorted(days[date])[:E.TOP_POSITIONS]:
                rows.setdefault(symbol, []).append((date, raw, close))
        weeks = {}
        for held in rows.values():
            for (date, raw, entry), (_, _, left) in zip(held, held[1:]):
                week = date - dt.timedelta(days=(date.weekday() + 1) % 7)
                weeks.setdefault(week, []).append((left - entry) / entry * 100.0 if raw > 0 else (entry - left) / entry * 100.0)
        recent = [math.floor(sum(v) * 1e4 + 0.5) / 1e4 for w, v in weeks.items() if w >= as_of - dt.timedelta(days=28)]
        if recent:
            out[g["gene_id"]] = sum(recent)
    return out


def mutated(g, seed, generation, slot, purpose):
    out = dict(g)
    for c in E.GENE_COLS:
        if draw(seed, generation, slot, c, purpose + "_hit") < E.MUTATION_RATE:
            if c in E.INT_GENES:
                lo, hi = E.CLIP[c]
                out[c] = max(lo, min(hi, g[c] + E.INT_DELTAS[int(draw(seed, generation, slot, c, purpose + "_delta") * 4)]))
            else:
                lo, hi = (0.0, 1.0) if c in E.WEIGHTS else E.CLIP[c]
                normal = r9(math.sqrt(-2 * math.log(1 - draw(seed, generation, slot, c, purpose + "_n1"))) * math.cos(2 * math.pi * draw(seed, generation, slot, c, purpose + "_n2")))
                out[c] = r9(min(hi, max(lo, g[c] + normal * E.MUTATION_STD)))
    return out


def bred(genes, score, seed):
    first, last, generation = min(g["gene_id"] for g in genes), max(g["gene_id"] for g in genes), genes[0]["generation"] + 1
    new = []
    for slot in range(1, len(genes) + 1):
        island, local = (slot - 1) // E.POP_SIZE, (slot - 1) % E.POP_SIZE + 1
        parents = sorted((g for g in genes if (g["gene_id"] - first) // E.POP_SIZE == island and g["gene_id"] in score), key=lambda g: (-score[g["gene_id"]], g["gene_id"]))[:E.SELECTION]
        pick = lambda name: parents[int(draw(seed, generation, slot, name, "pick") * len(parents))]  # noqa: B023, E731
        if parents and local <= E.ELITES:
            child = {c: parents[(local - 1) % len(parents)][c] for c in E.GENE_COLS}
        elif parents and local <= E.ELITES + E.CHILDREN:
            a, b, child = pick("p1"), pick("p2"), {}
            for c in E.GENE_COLS:
                u = draw(seed, generation, slot, c, "cross")
                child[c] = (a if u < 0.5 else b)[c] if c in E.INT_GENES else r9(a[c] * u + b[c] * (1 - u))
            child = mutated(child, seed, generation, slot, "child_mut")
        elif parents and local <= E.ELITES + E.CHILDREN + E.MUTANTS:
            child = mutated({c: pick("m")[c] for c in E.GENE_COLS}, seed, generation, slot, "mutant_mut")
        else:
            child = {w: draw(seed, generation, slot, w, "random") * E.WEIGHT_SCALE[w] for w in E.WEIGHTS}
            for c, (base, span) in E.INIT_RANGES.items():
                v = base + draw(seed, generation, slot, c, "random") * span
                child[c] = math.floor(v) if c in E.INT_GENES else v
        new.append({"gene_id": last + slot, "generation": generation, **child})
    return new


@pytest.mark.parametrize("islands", [1, 2])
def test_two_generations_equal_brute_force(spark, islands):
    rng = random.Random(islands)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(40)]
    fs = [(d, f"S{s}", *[rng.choice([None, round(rng.uniform(-1, 1), 3)]) for _ in range(4)], round(rng.uniform(90, 110), 2)) for d in days for s in range(7)]
    pool = E.gene_pool_init(spark, E.POP_SIZE, 42, islands=islands)
    table = spark.createDataFrame([(*r[:6], 1.0, r[6]) for r in fs], "date date, symbol string, s_momentum double, s_volume double, s_reversal double, "
                                  "s_breakout double, next_day_return double, close double").repartition(3)
    got = {r["gene_id"]: r for r in E.ga_evolve(table, pool, days[-1], generations=2, seed=9).collect()}
    genes = [r.asDict() for r in pool.collect()]
    everyone = list(genes)
    for _ in range(2):
        genes = bred(genes, scores_of(genes, fs, days[-1]), 9)
        everyone += genes
    assert set(got) == {g["gene_id"] for g in everyone} and len(everyone) == 3 * islands * E.POP_SIZE
    for g in everyone:
        assert got[g["gene_id"]]["generation"] == g["generation"]
        for c in E.GENE_COLS:
            assert got[g["gene_id"]][c] == pytest.approx(g[c], abs=2e-9), (g["gene_id"], c)
