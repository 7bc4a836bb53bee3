"""Quality rules by weak supervision (operator 10), Spark expressions only.

Each rule looks at a few measures of a text and votes good (+1) or bad (-1), or abstains (0).  The label
model has the share of good documents and, for each rule and either quality, the chances of its three
votes: its accuracies.  Expectation-maximisation runs on the table of distinct vote vectors with their row
counts, at most 3**rules rows whatever the corpus: the E-step is a column expression, the M-step one
aggregate whose single row of sums comes back to the driver.  A document is kept if its posterior
probability of good quality reaches the threshold, so no single rule rejects.  Beside it the contract's
two base tests stay hard limits.

Defined results: a null or blank text has no words and fails the base test; repeated rows and tied
values are measured alone, row by row; an empty table gives an empty result (the model keeps its start
values); null ids and other columns pass through untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import save, words

#: start values: share of good documents; chances of a vote for bad, none, a vote for good, in either class
START_PRIOR = 0.8
START_GOOD = (0.02, 0.48, 0.50)
START_BAD = (0.30, 0.30, 0.40)
PRIOR_RANGE = (0.05, 0.95)
ROUNDS = 30
THRESHOLD = 0.5
#: pseudo-counts of each vote in each class, as a share of all documents
SMOOTH = 0.002


def measures(text: Column) -> list[tuple[str, Column]]:
    """(name, expression) steps; later ones use earlier names."""
    w, h = F.col("_w"), F.col("_h")
    return [
        ("_t", F.coalesce(text, F.lit(""))),
        ("_w", words(F.col("_t"))),
        ("_l", F.filter(F.split(F.col("_t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))),
        ("n_words", F.size(w).cast("long")),
        # a hash and its place for each 3-word window, sorted so that equal windows are neighbours
        ("_h", F.array_sort(F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                                        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))),
        ("_r", F.transform(F.filter(h, lambda x, i: F.coalesce(F.get(h, i + 1)["h"] == x["h"], F.lit(False))
                                    | F.coalesce(F.get(h, i - 1)["h"] == x["h"], F.lit(False))), lambda x: x["p"])),
        ("word_chars", F.length(F.translate(F.col("_t"), " \t\n\x0b\f\r", "")).cast("long")),
        ("n_symbols", (F.length("_t") - F.length(F.translate(F.col("_t"), "#*$%&|<>", ""))).cast("long")),
        ("n_lines", F.size("_l").cast("long")),
        ("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long")),
        ("n_repeat_words", F.size(F.array_distinct(F.flatten(F.transform("_r", lambda p: F.array(p, p + 1, p + 2))))).cast("long")),
        ("n_upper", (F.length("_t") - F.length(F.translate(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long")),
        ("n_shouts", (F.length("_t") - F.length(F.translate(F.col("_t"), "!?", ""))).cast("long")),
        ("n_odd", F.length(F.regexp_replace("_t", r"[\p{L}\p{N}\x20\x09-\x0D.,]+", "")).cast("long")),
        ("n_ended", F.size(F.filter("_l", lambda x: x.rlike(r"[.!?:;\"')\]][\x20\x09-\x0D]*$"))).cast("long")),
        ("n_digits", (F.length("_t") - F.length(F.translate(F.col("_t"), "0123456789", ""))).cast("long")),
    ]


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains (SQL over the measures)."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 50", "n_words >= 80"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.01 * n_words"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 10 * n_words", "word_chars between 3 * n_words and 8 * n_words"),
    Rule("dup_lines", "n_dup_lines > 0.3 * n_lines", "n_lines > 2 and n_dup_lines = 0"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    Rule("capitals", "n_upper > 0.3 * word_chars", "n_upper <= 0.1 * word_chars"),
    Rule("shouting", "n_shouts > 0.1 * n_words", "n_shouts <= 0.02 * n_words"),
    Rule("odd_characters", "n_odd > 0.04 * word_chars", "n_odd <= 0.01 * word_chars"),
    Rule("line_ends", "n_ended < 0.3 * n_lines", "n_ended >= 0.8 * n_lines"),
    Rule("digits", "n_digits > 0.2 * word_chars", "n_digits <= 0.05 * word_chars"),
)

BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0).cast("tinyint")


def measured(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input as struct ``row``, its measures and its votes (array, one per rule)."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    steps = measures(F.col(f"row.`{text_col}`"))
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df.select("row", *[n for n, _ in steps if n[0] != "_"], F.array(*[vote(r) for r in rules]).alias("votes"))


@dataclass(frozen=True)
class Model:
    """Share of good documents and, for each rule, the chance of each vote given either quality."""

    prior: float
    good: tuple[tuple[float, float, float], ...]
    bad: tuple[tuple[float, float, float], ...]


VOTES = (-1, 0, 1)


def start(n_rules: int) -> Model:
    return Model(START_PRIOR, (START_GOOD,) * n_rules, (START_BAD,) * n_rules)


def posterior(votes: Column, model: Model) -> Column:
    """Probability of good quality given a vote vector, by Bayes' rule over independent votes."""
    ratios = F.lit([math.log(x / y) for g, b in zip(model.good, model.bad) for x, y in zip(g, b)])
    total = F.aggregate(F.transform(votes, lambda v, j: F.get(ratios, 3 * j + v + 1)),
                        F.lit([math.log(model.prior / (1 - model.prior))])[0], lambda x, y: x + y)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the table of vote vectors and their counts (votes, n)."""
    model = start(n_rules)
    for _ in range(rounds):
        scored = patterns.select("n", "votes", (F.col("n") * posterior(F.col("votes"), model)).alias("q"))
        rows = (scored.select("n", "q", F.posexplode("votes").alias("j", "v"))
                .groupBy("j", "v").agg(F.sum("q").alias("q"), F.sum("n").alias("n")).collect())  # at most 3 * rules rows
        if not rows:
            break
        good = {(r.j, r.v): r.q for r in rows}
        bad = {(r.j, r.v): r.n - r.q for r in rows}
        n, q = sum(r.n for r in rows if r.j == 0), sum(r.q for r in rows if r.j == 0)
        few = SMOOTH * n

        def shares(sums: dict, total: float, likely: tuple[float, float, float]) -> tuple:
            return tuple(tuple((sums.get((j, v), 0.0) + few * p) / (total + few) for v, p in zip(VOTES, likely)) for j in range(n_rules))

        new = Model(min(max(q / n, PRIOR_RANGE[0]), PRIOR_RANGE[1]), shares(good, q, START_GOOD), shares(bad, n - q, START_BAD))
        moved = abs(new.prior - model.prior)
        model = new
        if moved < 1e-5:
            break
    return model


def assess(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """The input's columns as struct ``row`` with measures, votes, base_failed, probability and kept."""
    marked = save(measured(docs, text_col, rules), "quality")
    patterns = save(marked.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes")
    model = fit(patterns, len(rules))
    return (marked.withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("probability", posterior(F.col("votes"), model))
            .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold)))


def filter_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns."""
    return assess(docs, text_col).where("kept").select("row.*")
