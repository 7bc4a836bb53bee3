"""Mixing sources to target weights by hierarchical budgeting (operator 2), Spark expressions only.

Leaves are (domain, language, source).  A budget of tokens flows from the root down: each parent's budget
is split over its children by weight, a child gets no more than its capacity (the tokens below it times
the epochs allowed), and what it can't use goes to its siblings in proportion to their weights.  Because a
node's capacity is the sum over its leaves, a shortage is first made up by sibling sources, then by sibling
languages, and only when a whole domain is exhausted by other domains.

A leaf's budget is filled from seeded epochs: every epoch deals the leaf's documents in an order of its own
(an MD5 of seed, epoch and id), whole epochs are taken while they fit, and of the last one the longest
prefix that fits.  The prefix needs no global sort: token sums per slot of the order (4,096 slots from the
first hex digits) show which slot holds the cut, earlier slots are taken whole, and only rows of the cut slot
are ordered.  Nothing is ever ordered or summed per leaf in one task but those slot sums.

All arithmetic is on whole numbers; weights are whole parts.  Tokens lost to rounding are fewer than the
nodes of the tree.

Defined results: null languages, sources and domains count as 'unknown'; a null or blank text has no
tokens, costs nothing and goes with the slot or prefix it falls in; rows with equal or null ids share a place
and are ordered by size; leaves without weight (0) get nothing; an empty table gives an empty result; other
columns, also those named like this module's, are passed on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import save, words

SLOT_DIGITS = 3  # hex digits: 4,096 slots


@dataclass(frozen=True)
class Targets:
    """Weights in whole parts by name, others get ``default``; the budget as a ratio num / den of all tokens."""

    domains: dict[str, int] = field(default_factory=dict)
    languages: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    default: int = 1
    budget: tuple[int, int] = (1, 1)
    epochs: int = 2
    seed: int = 42


def weight(name: Column, weights: dict[str, int], default: int) -> Column:
    if not weights:
        return F.lit(default).cast("long")
    known = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])
    return F.coalesce(F.get(F.map_values(F.map_filter(known, lambda k, v: k == name)), F.lit(0)), F.lit(default)).cast("long")


def split_budget(children: DataFrame, parent: list[str]) -> DataFrame:
    """Add ``budget`` to children (columns w, cap) of parents (column b): shares by weight, capped, the
    surplus of capped children going to the others.

    In order of cap / w, a child is capped exactly if its capacity is at most its share of what the children
    before it leave; one pass of running sums finds all of them.
    """
    order = Window.partitionBy(*parent).orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(float("inf"))), "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    df = (children.withColumn("_caps", F.coalesce(F.sum("cap").over(before), F.lit(0)))
          .withColumn("_rest", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
          .withColumn("_full", (F.col("w") > 0) & (F.col("cap").cast("decimal(38,0)") * F.col("_rest")
                                                   <= F.greatest(F.col("b") - F.col("_caps"), F.lit(0)).cast("decimal(38,0)") * F.col("w"))))
    used = F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(whole)
    open_w = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("w"))).over(whole)
    df = df.withColumn("_used", used).withColumn("_open", open_w)
    share = F.expr("cast((cast(greatest(b - _used, 0) as decimal(38,0)) * w) div greatest(_open, 1) as bigint)")
    return (df.withColumn("budget", F.when(F.col("_full"), F.col("cap")).when(F.col("w") > 0, F.least("cap", share)).otherwise(F.lit(0)).cast("long"))
            .drop("_caps", "_rest", "_full", "_used", "_open"))


def budgets(leaves: DataFrame, targets: Targets) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with cap and budget."""
    num, den = targets.budget
    leaves = leaves.withColumn("cap", F.col("tokens") * targets.epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn("root", F.lit(0))
    # the domains, a handful of rows, carry the whole budget
    domains = domains.withColumn("tokens", F.sum("tokens").over(Window.partitionBy("root")))
    top = split_budget(domains.withColumn("b", F.expr(f"cast(cast(tokens as decimal(38,0)) * {num} div {den} as bigint)")).withColumn("name", F.col("domain"))
                       .withColumn("w", weight(F.col("domain"), targets.domains, targets.default)), ["root"])
    mid = split_budget(langs.drop("tokens").join(top.select("domain", F.col("budget").alias("b")), "domain").withColumn("name", F.col("lang"))
                       .withColumn("w", weight(F.col("lang"), targets.languages, targets.default)), ["domain"])
    low = split_budget(leaves.join(mid.select("domain", "lang", F.col("budget").alias("b")), ["domain", "lang"])
                       .withColumn("name", F.col("source")).withColumn("w", weight(F.col("source"), targets.sources, targets.default)), ["domain", "lang"])
    return low.select("domain", "lang", "source", "tokens", "cap", "budget")


def select_mixture(docs: DataFrame, targets: Targets, domain: Column, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Rows of the mixture, one per document and epoch taken: struct ``row`` (the columns ``keep``, all by
    default), domain, lang, source, epoch, n_tokens.  ``domain`` is an expression over the documents."""
    leaf = ["domain", "lang", "source"]
    unknown = F.lit("unknown")
    kept = docs.columns if keep is None else keep
    dealt = save(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{id_col}`").cast("string").alias("id"),
        F.coalesce(domain.cast("string"), unknown).alias("domain"), F.coalesce(F.col(f"`{lang_col}`"), unknown).alias("lang"),
        F.coalesce(F.col(f"`{source_col}`"), unknown).alias("source"), F.size(words(F.col(f"`{text_col}`"))).cast("long").alias("n_tokens")), "mixing")
    plan = save(budgets(dealt.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), targets), "budgets")

    def place(df: DataFrame) -> DataFrame:
        """A row per epoch that its leaf's budget reaches: its order and slot, and what of the budget the epoch has."""
        key = F.md5(F.concat_ws(":", F.lit(targets.seed), F.col("epoch"), F.coalesce("id", F.lit(""))))
        last = F.least(F.lit(targets.epochs - 1).cast("long"), F.expr("budget div greatest(tokens, 1)"))
        return (df.join(plan.select(*leaf, "tokens", "budget").where("budget > 0 or tokens = 0"), leaf)
                .withColumn("epoch", F.explode(F.sequence(F.lit(0), last.cast("int"))))
                .withColumn("left", F.col("budget") - F.col("epoch") * F.col("tokens"))
                .withColumn("key", key).withColumn("slot", F.conv(F.substring("key", 1, SLOT_DIGITS), 16, 10).cast("int")))

    # token sums by slot, only of epochs that don't fit whole
    cut_epochs = place(dealt.drop("row")).where("left < tokens")
    sums = cut_epochs.groupBy(*leaf, "epoch", "slot", "left").agg(F.sum("n_tokens").alias("n"))
    running = F.sum("n").over(Window.partitionBy(*leaf, "epoch").orderBy("slot"))
    # the first slot that doesn't fit whole, and what is left for it
    cuts = (sums.withColumn("upto", running).where(F.col("upto") > F.col("left")).groupBy(*leaf, "epoch")
            .agg(F.min(F.struct("slot", (F.col("left") - F.col("upto") + F.col("n")).alias("room"))).alias("cut")))
    cuts = save(cuts.select(*leaf, "epoch", F.col("cut.slot").alias("cut_slot"), F.col("cut.room").alias("room")), "cuts")

    placed = place(dealt).join(cuts, [*leaf, "epoch"], "left")
    out = ["row", *leaf, "epoch", "n_tokens"]
    whole = placed.where("cut_slot is null or slot < cut_slot").select(out)
    order = Window.partitionBy(*leaf, "epoch").orderBy("key", "n_tokens", F.xxhash64("row"))
    edge = placed.where("slot = cut_slot").withColumn("upto", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return whole.union(edge.where("upto <= room").select(out))
