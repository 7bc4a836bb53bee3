"""Genetic strategy arena (G1-G16, S14, X3-X6, X15) as set-based DataFrame jobs.

Genes are rows; selection, crossover and mutation are column expressions
over joins of small, size-checked tables, never a driver loop.  Random draws
are md5-hashed uniforms ``u01(seed, generation, slot, gene, purpose)``, so a
generation is reproducible, independent of partitioning, and reproducible by
any SQL engine with md5.

Scale-out kernel (G4): every labelled feature row is paired with every gene
of the pool.  The pool is bounded (checked before it is broadcast); feature
rows are first hash-partitioned by date and then fanned out per gene slot
with ``explode(sequence(1, n))`` + a broadcast hash join on the slot, so the
top-k-per-(gene, date) window of G5 reuses the date partitioning and the
fanned-out rows are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.functions.core import r, sunday_week, u01
from barforge.plans.numbering import number_rows
from barforge.plans.sizing import estimated_bytes

WEIGHTS = ["w_momentum", "w_volume", "w_reversal", "w_breakout", "w_dow", "w_monthend", "w_sentiment", "w_mean_rev"]
INT_GENES = ["max_positions", "max_hold_days"]
REAL_GENES = WEIGHTS + ["threshold", "stop_loss", "take_profit"]
GENE_COLS = WEIGHTS + ["threshold", "max_positions", "stop_loss", "take_profit", "max_hold_days"]

# Fixed values of the reference's gene space.
WEIGHT_SCALE = {"w_momentum": 1.0, "w_volume": 1.0, "w_reversal": 0.8, "w_breakout": 0.7,
                "w_dow": 0.4, "w_monthend": 0.4, "w_sentiment": 0.6, "w_mean_rev": 0.5}
INIT_RANGES = {"threshold": (0.2, 0.8), "max_positions": (1, 2), "stop_loss": (2, 5), "take_profit": (3, 7),
               "max_hold_days": (3, 12)}           # value = base + u * span
CLIP = {"threshold": (0.1, 2.0), "stop_loss": (0.5, 10.0), "take_profit": (1.0, 15.0),
        "max_positions": (1, 3), "max_hold_days": (1, 21)}
MUTATION_RATE, MUTATION_STD = 0.1, 0.15
INT_DELTAS = [-2, -1, 1, 2]
POP_SIZE, ELITES, CHILDREN, MUTANTS, SELECTION = 10, 2, 3, 2, 3
TOP_POSITIONS = 3
MAX_POOL = 100_000          # genes that may be broadcast to every task

GENE_SCHEMA_COLS = (["gene_id", "generation", "parent_a", "parent_b", "strategy_name"] + GENE_COLS
                    + ["fitness", "n_trades", "win_rate", "weekly_pnl"])


# --- expression text (one py4j call per column instead of hundreds) -------
def _lit_sql(p) -> str:
    if isinstance(p, str) and p.startswith("@"):
        return f"CAST({p[1:]} AS STRING)"          # '@col' refers to a column
    return "'" + str(p).replace("'", "''") + "'"


def u01_sql(*parts) -> str:
    """Same value as functions.core.u01, as Spark SQL text."""
    key = "concat_ws('|', " + ", ".join(_lit_sql(p) for p in parts) + ")"
    return f"(CAST(CAST(conv(substring(md5({key}), 1, 8), 16, 10) AS BIGINT) AS DOUBLE) / 4294967296.0D)"


def _r_sql(x: str, k: int = 9) -> str:
    return f"(CAST(floor(CAST({x} AS DOUBLE) * {float(10 ** k)}D + 0.5D) AS DOUBLE) / {float(10 ** k)}D)"


def _clamp_sql(x: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN least({float(hi)}D, greatest({float(lo)}D, {x})) END)"


def _gene_row(df: DataFrame) -> DataFrame:
    """Fixed gene schema (Q7: every kind of individual gets the same columns)."""
    casts = {"gene_id": "long", "generation": "long", "parent_a": "long", "parent_b": "long",
             "max_positions": "long", "max_hold_days": "long", "n_trades": "long",
             "fitness": "double", "win_rate": "double", "weekly_pnl": "double", "strategy_name": "string"}
    return df.select(*[F.col(c).cast(casts.get(c, "double")).alias(c) for c in GENE_SCHEMA_COLS])


def _random_genes(gen, seed: int, purpose: str, int_rule: str) -> list:
    """Column expressions for a fresh random individual.

    ``gen`` is an int or '@generation'; int_rule 'round' (SQL cast: half away
    from zero) or 'trunc' (Python int()).
    """
    cols = []
    for w in WEIGHTS:
        cols.append(F.expr(f"{u01_sql(seed, gen, '@slot', w, purpose)} * {WEIGHT_SCALE[w]}D").alias(w))
    for g in ["threshold", "max_positions", "stop_loss", "take_profit", "max_hold_days"]:
        base, span = INIT_RANGES[g]
        v = f"({float(base)}D + {u01_sql(seed, gen, '@slot', g, purpose)} * {float(span)}D)"
        if g in INT_GENES:
            v = f"CAST({'round' if int_rule == 'round' else 'floor'}({v}) AS BIGINT)"
        cols.append(F.expr(v).alias(g))
    return cols


def gene_pool_init(spark: SparkSession, n: int = POP_SIZE, seed: int = 42, islands: int = 1) -> DataFrame:
    """G1: n random individuals of generation 1 per island (ids 1..n*islands).

    Island i holds ids i*n+1 .. (i+1)*n; draws are keyed by the global id,
    so island 0 is the same population for any number of islands.
    """
    ids = spark.range(1, n * islands + 1).withColumnRenamed("id", "slot")
    g = ids.select(
        F.col("slot").alias("gene_id"), F.lit(1).alias("generation"),
        F.lit(None).alias("parent_a"), F.lit(None).alias("parent_b"),
        F.concat(F.lit("GA_v1_"), F.col("slot").cast("string")).alias("strategy_name"),
        *_random_genes(1, seed, "init", "round"),
        F.lit(None).alias("fitness"), F.lit(0).alias("n_trades"), F.lit(None).alias("win_rate"),
        F.lit(None).alias("weekly_pnl"))
    return _gene_row(g)


def week_types(feat: DataFrame) -> DataFrame:
    """Weekly market regime table (one row per Sunday week)."""
    lab = feat.filter(F.col("next_day_return").isNotNull()).withColumn("week_start", sunday_week("date"))
    ws = lab.groupBy("week_start").agg(
        F.avg("std_20").alias("avg_volatility"),
        F.avg(F.abs("macd_histogram")).alias("avg_trend_strength"),
        F.avg("volume_vs_sma_ratio").alias("avg_volume_ratio"),
        F.mode("month_end_zone", deterministic=True).alias("dominant_zone"),
        F.avg(F.when((F.col("rsi_14") < 30) | (F.col("rsi_14") > 70), F.lit(1)).otherwise(F.lit(0))).alias("reversal_opportunity"),
        F.avg("next_day_return").alias("market_return"),
    ).withColumn("week_cluster", F.lit(None).cast("long"))
    # one row per calendar week: a global window over it is small
    allw = Window.partitionBy()
    mv, sv = F.avg("avg_volatility").over(allw), F.stddev_samp("avg_volatility").over(allw)
    mt = F.avg("avg_trend_strength").over(allw)
    return ws.select(
        "*",
        F.when(F.col("avg_volatility") > mv + sv, F.lit("HIGH_VOL"))
        .when(F.col("avg_volatility") < mv - sv, F.lit("LOW_VOL")).otherwise(F.lit("MID_VOL")).alias("vol_regime"),
        F.when(F.col("avg_trend_strength") > mt, F.lit("TRENDING")).otherwise(F.lit("RANGING")).alias("market_regime"),
    )


#: distinct values that a top-count sketch keeps apart; fewer values than that are counted exactly
TRACKED = 64


def day_zone_sketches(feat: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """G2, mergeable: per date a sketch of how often each month-end zone occurs among labelled rows."""
    lab = feat.filter(F.col("next_day_return").isNotNull() & F.col("month_end_zone").isNotNull())
    return lab.groupBy("date").agg(F.expr(f"approx_top_k_accumulate(month_end_zone, {int(tracked)})").alias("sketch"))


def week_zones(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """G2, mergeable: (week_start, dominant_zone, zone_rows, zone_share) from the sketches of a week's days.

    A new or corrected day needs its own sketch and the merge of its week's, not the week's rows.  Ties go to the
    first zone by name.
    """
    merged = sketches.groupBy(sunday_week("date").alias("week_start")).agg(F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"))
    items = F.expr(f"approx_top_k_estimate(sketch, {int(tracked)})")
    ranked = F.array_sort(F.transform(items, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("zone"))))
    total = F.aggregate(ranked, F.lit(0).cast("long"), lambda a, x: a - x["n"])
    return merged.select("week_start", ranked[0]["zone"].alias("dominant_zone"), (-ranked[0]["n"]).alias("zone_rows"),
                         (-ranked[0]["n"] / total).alias("zone_share"))


ROWS_PER_TASK = 1_000_000   # target fanned-out rows per task in G4/G5


def ga_signals(fs: DataFrame, genes: DataFrame, max_pool: int = MAX_POOL,
               rows_per_task: int = ROWS_PER_TASK, bytes_per_task: int = 64 * 1024 * 1024) -> DataFrame:
    """Every gene x every labelled row: weighted sum of the four signals.

    ``fs`` is G3 output (optionally with extra columns carried along).  The
    by-date repartition gets an explicit partition count sized for the
    fan-out (rows x genes / rows_per_task): AQE would otherwise coalesce the
    small pre-fan-out shuffle into very few tasks and one task would sort
    the whole fanned-out set.
    """
    pool = genes.select("gene_id", "generation", "strategy_name", "threshold", "stop_loss", "take_profit",
                        "max_hold_days", "max_positions", "w_momentum", "w_volume", "w_reversal", "w_breakout")
    pool = number_rows(pool, ["gene_id"], "slot").withColumn("slot", F.col("slot").cast("int"))
    n = pool.count()
    if n <= max_pool:
        pool = F.broadcast(pool)      # a checked size; a larger pool is joined by a shuffle on the slot
    spark = fs.sparkSession
    base = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    est = estimated_bytes(fs)
    if est is not None and est < (1 << 50):
        parts = max(base, -(-est * max(n, 1) // bytes_per_task))      # metadata estimate, no job
    else:
        parts = max(base, -(-fs.count() * max(n, 1) // rows_per_task))
    rows = fs.repartition(parts, "date").withColumn("slot", F.explode(F.sequence(F.lit(1), F.lit(max(n, 1)))))
    j = rows.join(pool, "slot").drop("slot")
    raw = (F.coalesce("s_momentum", F.lit(0.0)) * F.col("w_momentum")
           + F.coalesce("s_volume", F.lit(0.0)) * F.col("w_volume")
           + F.coalesce("s_reversal", F.lit(0.0)) * F.col("w_reversal")
           + F.coalesce("s_breakout", F.lit(0.0)) * F.col("w_breakout"))
    std = {"date", "symbol", "s_momentum", "s_volume", "s_reversal", "s_breakout", "next_day_return"}
    extra = [c for c in fs.columns if c not in std]
    return j.select("date", "symbol", "gene_id", "generation", "strategy_name", "threshold", "stop_loss",
                    "take_profit", "max_hold_days", "max_positions", r(raw, 9).alias("raw_signal"), "next_day_return",
                    "s_momentum", "s_volume", "s_reversal", "s_breakout", *extra)


def ga_positions(sig: DataFrame, k: int = TOP_POSITIONS, use_gene_max: bool = False) -> DataFrame:
    """Non-zero signals, top k per (gene, date) by |signal| (symbol breaks ties).

    ``use_gene_max`` caps at each gene's own max_positions instead of k.
    """
    w = Window.partitionBy("gene_id", "date").orderBy(F.abs("raw_signal").desc(), F.col("symbol"))
    x = sig.filter(F.col("raw_signal") != 0).withColumn("_rank", F.row_number().over(w))
    cap = F.col("max_positions") if use_gene_max else F.lit(k)
    extra = [c for c in ("close",) if c in sig.columns]
    return x.filter(F.col("_rank") <= cap).select(
        "date", "gene_id", "strategy_name", "generation", "symbol", "raw_signal",
        F.when(F.col("raw_signal") > 0, F.lit("LONG")).otherwise(F.lit("SHORT")).alias("side"),
        F.abs("raw_signal").alias("signal_strength"), *extra)


def _side_pnl():
    e, x = F.col("entry_close"), F.col("exit_close")
    return F.when(F.col("side") == "LONG", (x - e) / e * F.lit(100.0)).otherwise((e - x) / e * F.lit(100.0))


def ga_trades(pos: DataFrame, feat: DataFrame | None = None) -> DataFrame:
    """Entry at the position's close, exit at the next position row of the
    same gene and symbol (not the next day).  Close is carried from G4 when
    present, else joined from the feature table on (date, symbol)."""
    if "close" not in pos.columns:
        pos = pos.join(feat.select("date", "symbol", "close"), ["date", "symbol"])
    w = Window.partitionBy("gene_id", "symbol").orderBy("date")
    x = pos.select("*", F.lead("close").over(w).alias("exit_close"), F.lead("date").over(w).alias("exit_date"))
    return x.select("gene_id", "strategy_name", "generation", sunday_week("date").alias("week_start"), "symbol",
                    "raw_signal", "side", F.col("close").alias("entry_close"), "exit_close",
                    F.col("date").alias("entry_date"), "exit_date").withColumn("pnl_pct", _side_pnl())


def ga_weekly_pnl(trades: DataFrame) -> DataFrame:
    """Closed trades per gene and entry week."""
    p = F.col("pnl_pct")
    return trades.filter(F.col("exit_close").isNotNull()).groupBy(
        "gene_id", "strategy_name", "generation", "week_start").agg(
        F.count(F.lit(1)).alias("n_trades"),
        r(F.avg(p), 4).alias("avg_pnl"),
        r(F.stddev_samp(p), 4).alias("std_pnl"),
        r(F.sum(p), 4).alias("week_pnl"),
        r(F.avg(F.when(p > 0, F.lit(1)).otherwise(F.lit(0))), 4).alias("win_rate"))


def ga_fitness_recent(weekly: DataFrame, as_of, weeks: int = 4) -> DataFrame:
    """Per gene, the last ``weeks`` weeks before as_of."""
    return weekly.filter(F.col("week_start") >= F.date_sub(F.lit(as_of).cast("date"), 7 * weeks)).groupBy(
        "gene_id", "strategy_name", "generation").agg(
        F.sum("week_pnl").alias("cumulative_pnl"), F.avg("win_rate").alias("avg_win_rate"),
        F.count(F.lit(1)).alias("weeks_alive"))


def ga_current_generation(genes: DataFrame, fitness: DataFrame) -> DataFrame:
    """Genes of the newest generation with their recent cumulative P&L."""
    latest = genes.agg(F.max("generation").alias("generation"))
    cur = genes.join(F.broadcast(latest), "generation")
    return cur.join(fitness.select("gene_id", "cumulative_pnl"), "gene_id", "left")


def ga_select_parents(scored: DataFrame, k: int = SELECTION) -> DataFrame:
    """Top k by fitness (NULL fitness never selected; gene_id breaks ties), with rank."""
    w = Window.orderBy(F.col("cumulative_pnl").desc(), F.col("gene_id"))
    return scored.filter(F.col("cumulative_pnl").isNotNull()).withColumn(
        "parent_rank", F.row_number().over(w)).filter(F.col("parent_rank") <= k)


def _mutated_sql(c: str, seed, purpose: str, rate=MUTATION_RATE, sd=MUTATION_STD) -> str:
    """One gene value after mutation with probability ``rate`` (Box-Muller normal, rounded to 9)."""
    u = lambda tag: u01_sql(seed, "@generation", "@slot", c, purpose + tag)
    if c in INT_GENES:
        lo, hi = CLIP[c]
        delta = f"element_at(array({', '.join(str(d) for d in INT_DELTAS)}), CAST(floor({u('_delta')} * 4.0D) AS INT) + 1)"
        new = f"CAST(greatest({lo}, least({hi}, {c} + {delta})) AS BIGINT)"
    else:
        lo, hi = (0.0, 1.0) if c in WEIGHTS else CLIP[c]
        normal = _r_sql(f"sqrt(-2.0D * ln(1.0D - {u('_n1')})) * cos({2.0 * math.pi!r}D * {u('_n2')})")
        new = _r_sql(_clamp_sql(f"{c} + {normal} * {float(sd)}D", lo, hi))
    return f"CASE WHEN {u('_hit')} < {float(rate)}D THEN {new} ELSE {c} END"


def ga_mutate(genes: DataFrame, seed: int = 7, purpose: str = "mut", rate: float = MUTATION_RATE,
              sd: float = MUTATION_STD) -> DataFrame:
    """Each gene value mutates with probability ``rate``.  Needs 'slot'
    (any per-row integer) and 'generation' columns to seed the draws."""
    return genes.select(*[F.expr(_mutated_sql(c, seed, purpose, rate, sd)).alias(c) if c in GENE_COLS else F.col(c)
                          for c in genes.columns])


def ga_crossover(slots: DataFrame, parents: DataFrame, seed: int = 7) -> DataFrame:
    """One child per slot row from two hashed parent picks.

    slots: (slot, generation).  Integer genes come from either parent; real
    genes are blended with one alpha per gene.
    """
    gen = F.col("generation")
    # picks range over the parents that the island really has (SELECTION of them, or fewer)
    pick1 = (F.floor(u01(seed, gen, F.col("slot"), "p1", "pick") * F.col("_n").cast("double")) + 1).cast("int")
    pick2 = (F.floor(u01(seed, gen, F.col("slot"), "p2", "pick") * F.col("_n").cast("double")) + 1).cast("int")
    isl = ["_island"] if "_island" in slots.columns and "_island" in parents.columns else ["_all"]
    p = parents.withColumn("_all", F.lit(0)).select(*isl, "parent_rank", "gene_id", *GENE_COLS)
    counts = p.groupBy(*isl).agg(F.max("parent_rank").alias("_n"))
    p1 = p.select(*isl, F.col("parent_rank").alias("_r1"), F.col("gene_id").alias("parent_a"),
                  *[F.col(c).alias(f"_a_{c}") for c in GENE_COLS])
    p2 = p.select(*isl, F.col("parent_rank").alias("_r2"), F.col("gene_id").alias("parent_b"),
                  *[F.col(c).alias(f"_b_{c}") for c in GENE_COLS])
    x = (slots.withColumn("_all", F.lit(0)).join(counts, isl).withColumn("_r1", pick1).withColumn("_r2", pick2)
         .join(p1, isl + ["_r1"]).join(p2, isl + ["_r2"]))
    cols = []
    for c in GENE_COLS:
        u = u01_sql(seed, "@generation", "@slot", c, "cross")
        if c in INT_GENES:
            cols.append(F.expr(f"CASE WHEN {u} < 0.5D THEN _a_{c} ELSE _b_{c} END").alias(c))
        else:
            cols.append(F.expr(_r_sql(f"_a_{c} * {u} + _b_{c} * (1.0D - {u})")).alias(c))
    return x.select(*[c for c in slots.columns], "parent_a", "parent_b", *cols)


def ga_next_generation(current: DataFrame, seed: int = 7) -> DataFrame:
    """Per island, 2 elites, 3 children (crossover + mutation), 2 mutants, 3 random.

    ``current``: G9 output (genes of one generation with cumulative_pnl).  A
    generation's ids form one contiguous block, island after island
    (``POP_SIZE`` each), so the island of a gene is (id - first id) div
    POP_SIZE; selection is a window per island and every parent lookup
    joins on (island, rank), so islands evolve independently and in
    parallel.  New ids continue from the current max id in the reference's
    order; with one island this is exactly the reference's single population.
    """
    spark = current.sparkSession
    # The scored generation is one row per gene: write it to the checkpoint
    # folder once so the elite / child / mutant branches read that table
    # instead of each re-running the signal -> position -> P&L chain.
    from barforge.plans.storage import checkpoint_dir
    checkpoint_dir(spark)
    current = current.checkpoint(eager=True)
    # three scalars (generation, id range) are all that pass through the driver
    g, maxid, minid = current.agg(F.max("generation"), F.max("gene_id"), F.min("gene_id")).first()
    islands = max(1, -(-(int(maxid) - int(minid) + 1) // POP_SIZE))
    scored = current.withColumn("_island", F.floor((F.col("gene_id") - F.lit(int(minid))) / POP_SIZE).cast("long"))
    wsel = Window.partitionBy("_island").orderBy(F.col("cumulative_pnl").desc(), F.col("gene_id"))
    parents = scored.filter(F.col("cumulative_pnl").isNotNull()).withColumn(
        "parent_rank", F.row_number().over(wsel)).filter(F.col("parent_rank") <= SELECTION)
    local = ((F.col("slot") - 1) % POP_SIZE) + 1
    slots = (spark.range(1, POP_SIZE * islands + 1).withColumnRenamed("id", "slot")
             .withColumn("_island", F.floor((F.col("slot") - 1) / POP_SIZE).cast("long"))
             .withColumn("_local", local)
             .withColumn("_maxid", F.lit(int(maxid)).cast("long"))
             .withColumn("generation", F.lit(int(g) + 1).cast("long")))
    lc = F.col("_local")
    kind = (F.when(lc <= ELITES, F.lit("elite"))
            .when(lc <= ELITES + CHILDREN, F.lit("child"))
            .when(lc <= ELITES + CHILDREN + MUTANTS, F.lit("mutant")).otherwise(F.lit("random")))
    slots = slots.withColumn("kind", kind)
    idx = (lc - F.when(F.col("kind") == "elite", 0).when(F.col("kind") == "child", ELITES)
           .when(F.col("kind") == "mutant", ELITES + CHILDREN).otherwise(ELITES + CHILDREN + MUTANTS))
    slots = slots.withColumn("kind_idx", idx)
    # every island keeps its size: ranks wrap around at the parents it has, an island without any gets newcomers
    counts = parents.groupBy("_island").agg(F.max("parent_rank").alias("_n"))
    slots = slots.join(counts, "_island", "left")
    slots = slots.withColumn("kind_idx", F.when(F.col("_n").isNull(), lc).otherwise(F.col("kind_idx"))).withColumn(
        "kind", F.when(F.col("_n").isNull(), F.lit("random")).otherwise(F.col("kind")))
    base = ["slot", "generation", "_maxid", "_island", "kind", "kind_idx"]

    pb = parents.select("_island", "parent_rank", "gene_id", *GENE_COLS)
    elites = slots.filter(F.col("kind") == "elite").withColumn(
        "parent_rank", ((F.col("kind_idx") - 1) % F.col("_n") + 1).cast("int")).join(pb, ["_island", "parent_rank"]).select(
        *base, F.col("gene_id").alias("parent_a"), F.lit(None).cast("long").alias("parent_b"), *GENE_COLS)

    children = ga_mutate(ga_crossover(slots.filter(F.col("kind") == "child").select(*base), parents, seed),
                         seed, "child_mut")

    mpick = (F.floor(u01(seed, F.col("generation"), F.col("slot"), "m", "pick") * F.col("_n").cast("double")) + 1).cast("int")
    mutants = ga_mutate(slots.filter(F.col("kind") == "mutant").withColumn("parent_rank", mpick)
                        .join(pb, ["_island", "parent_rank"])
                        .select(*base, F.col("gene_id").alias("parent_a"), F.lit(None).cast("long").alias("parent_b"),
                                *GENE_COLS), seed, "mutant_mut")

    rnd = slots.filter(F.col("kind") == "random").select(
        *base, F.lit(None).cast("long").alias("parent_a"), F.lit(None).cast("long").alias("parent_b"),
        *_random_genes("@generation", seed, "random", "trunc"))

    allg = elites.unionByName(children).unionByName(mutants).unionByName(rnd)
    island_tag = [F.lit("_i"), F.col("_island").cast("string")] if islands > 1 else []
    out = allg.select(
        (F.col("_maxid") + F.col("slot")).alias("gene_id"), "generation", "parent_a", "parent_b",
        F.concat(F.lit("GA_gen"), F.col("generation").cast("string"), *island_tag, F.lit("_"), F.col("kind"),
                 F.lit("_"), F.col("kind_idx").cast("string")).alias("strategy_name"),
        *GENE_COLS, F.lit(None).alias("fitness"), F.lit(0).alias("n_trades"), F.lit(None).alias("win_rate"),
        F.lit(None).alias("weekly_pnl"))
    return _gene_row(out)


def append_generation(pool: DataFrame, nxt: DataFrame) -> DataFrame:
    """Re-number the new individuals from the pool's max id and append."""
    mx = pool.agg(F.max("gene_id")).first()[0] or 0
    renum = number_rows(nxt, ["gene_id"], "_number").withColumn("gene_id", F.lit(int(mx)) + F.col("_number")).drop("_number")
    return _gene_row(pool).unionByName(_gene_row(renum))


def ga_fitness_by_generation(weekly: DataFrame) -> DataFrame:
    """Mean and std over genes of summed weekly P&L, by generation."""
    per_gene = weekly.groupBy("generation", "gene_id").agg(F.sum("week_pnl").alias("_p"))
    return per_gene.groupBy("generation").agg(
        F.avg("_p").alias("avg_cumulative_pnl"), F.stddev_samp("_p").alias("std_cumulative_pnl"),
        F.count(F.lit(1)).alias("n_genes"))


def ga_top_strategies_week(weekly: DataFrame, k: int = 5) -> DataFrame:
    """Newest week, top k strategies by P&L."""
    latest = weekly.agg(F.max("week_start").alias("week_start"))
    x = weekly.join(F.broadcast(latest), "week_start").groupBy("week_start", "strategy_name").agg(
        F.sum("week_pnl").alias("week_pnl"))
    return x.orderBy(F.col("week_pnl").desc(), F.col("strategy_name")).limit(k)


def ga_gene_diversity(weekly: DataFrame, genes: DataFrame) -> DataFrame:
    """Std of each weight across the genes active in the newest week (long form)."""
    latest = weekly.agg(F.max("week_start").alias("week_start"))
    active = weekly.join(F.broadcast(latest), "week_start").select("gene_id").distinct()
    g = genes.join(active, "gene_id")
    wide = g.agg(*[F.stddev_samp(w).alias(w) for w in WEIGHTS])
    return wide.unpivot([], WEIGHTS, "weight", "std")


# ------------------------------------------------------------ X3-X6, X15 --
def fitness_score(weekly: DataFrame) -> DataFrame:
    """Mean weekly P&L x mean win rate / std of weekly P&L - 0.1 x trades (per gene)."""
    g = weekly.groupBy("gene_id", "strategy_name").agg(
        F.avg("week_pnl").alias("_m"), F.stddev_samp("week_pnl").alias("_s"),
        F.avg("win_rate").alias("_w"), F.sum("n_trades").alias("n_trades"))
    return g.select("gene_id", "strategy_name", "n_trades",
                    (F.try_divide(F.col("_m") * F.col("_w"), F.nullif(F.col("_s"), F.lit(0.0)))
                     - F.lit(0.1) * F.col("n_trades")).alias("fitness"))


def cull_tiers(scored: DataFrame, top: int = 3, middle: int = 4) -> DataFrame:
    """PARENT (top 3), SURVIVE (next 4), CULL (rest) by fitness."""
    x = number_rows(scored, [F.col("fitness").desc_nulls_last(), F.col("gene_id")], "fitness_rank").withColumn(
        "fitness_rank", F.col("fitness_rank").cast("int"))
    return x.withColumn("tier", F.when(F.col("fitness_rank") <= top, F.lit("PARENT"))
                        .when(F.col("fitness_rank") <= top + middle, F.lit("SURVIVE")).otherwise(F.lit("CULL")))


def crossover_two_point(pairs: DataFrame, seed: int = 7) -> DataFrame:
    """Two-point crossover over the 13-gene vector; pairs carry _a_/_b_ columns and 'pair_id'."""
    n = len(GENE_COLS)
    c1 = (F.floor(u01(seed, F.col("pair_id"), "cut1") * F.lit(float(n)))).cast("int")
    c2 = (F.floor(u01(seed, F.col("pair_id"), "cut2") * F.lit(float(n)))).cast("int")
    lo, hi = F.least(c1, c2), F.greatest(c1, c2)
    cols = [F.when((F.lit(i) >= lo) & (F.lit(i) < hi), F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")).alias(c)
            for i, c in enumerate(GENE_COLS)]
    return pairs.select("pair_id", *cols)


def blend_fixed(pairs: DataFrame, alpha: float = 0.3) -> DataFrame:
    """Fixed-alpha blend of real genes; integer genes from parent a."""
    cols = [(r(F.col(f"_a_{c}") * F.lit(alpha) + F.col(f"_b_{c}") * F.lit(1 - alpha), 9) if c in REAL_GENES
             else F.col(f"_a_{c}")).alias(c) for c in GENE_COLS]
    return pairs.select("pair_id", *cols)


def week_strategy_map(weekly: DataFrame, types: DataFrame, genes: DataFrame) -> DataFrame:
    """Per (vol_regime, market_regime): which gene wins most weeks, and its weights
    (``weight_vector``: a JSON array in the order of ``WEIGHTS``, each in ten-thousandths)."""
    wwin = Window.partitionBy("week_start").orderBy(F.col("week_pnl").desc(), F.col("gene_id"))
    winners = weekly.withColumn("_r", F.row_number().over(wwin)).filter(F.col("_r") == 1).select("week_start", "gene_id")
    j = winners.join(types.select("week_start", "vol_regime", "market_regime"), "week_start")
    cnt = j.groupBy("vol_regime", "market_regime", "gene_id").agg(F.count(F.lit(1)).alias("wins"))
    w = Window.partitionBy("vol_regime", "market_regime").orderBy(F.col("wins").desc(), F.col("gene_id"))
    best = cnt.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
    vector = F.to_json(F.array(*[F.floor(F.col(c) * F.lit(10000.0) + F.lit(0.5)).cast("long") for c in WEIGHTS]))
    return best.join(genes.select("gene_id", vector.alias("weight_vector")), "gene_id")


def ga_rolling_pnl(weekly: DataFrame, n: int = 4) -> DataFrame:
    """Rolling mean of the last n weekly P&L values per gene."""
    w = Window.partitionBy("gene_id").orderBy("week_start").rowsBetween(-(n - 1), 0)
    return weekly.select("gene_id", "week_start", "week_pnl", F.avg("week_pnl").over(w).alias("rolling_pnl"))


def ga_evolve(fs: DataFrame, pool: DataFrame, as_of, generations: int = 3, seed: int = 7) -> DataFrame:  # noqa: D417
    """The weekly evolution loop: score the newest generation, evolve, append; repeat.

    ``fs``: G3 signals (with ``close``); ``pool``: the gene pool (G1 output).
    Each round is one scored generation; the pool is cut with ``checkpoint()``
    in the shared checkpoint folder so the plan does not grow with the
    number of generations (never ``localCheckpoint``: it would not survive
    the loss of an executor).  Returns the pool with every generation.
    """
    from barforge.plans.storage import checkpoint_dir
    checkpoint_dir(pool.sparkSession)
    pool = _gene_row(pool).checkpoint(eager=True)
    for _ in range(generations):
        newest = pool.agg(F.max("generation")).first()[0]
        genes = pool.filter(F.col("generation") == newest)
        weekly = ga_weekly_pnl(ga_trades(ga_positions(ga_signals(fs, genes))))
        fit = ga_fitness_recent(weekly, as_of)
        nxt = ga_next_generation(ga_current_generation(genes, fit), seed)
        pool = append_generation(pool, nxt).checkpoint(eager=True)
    return pool
