"""Filter interaction audit (operator 13): what each filter removes in every order of the filters.

A document that fails the filters of a mask is removed by the one of them that comes first.  With a matrix
of masks (0 where the mask has the filter, infinite elsewhere) and the matrix of the filters' positions in
every order (the inverse permutations), the min-plus product is the step at which each mask is removed in each
order.  Documents are counted by part and mask first, at most 2**k counts a part for k filters, so that the
product and the scatter of the counts to (order, step) work on counts, one part at a time.

Counts of a part: removed at the step, kept after it, redundant (failing the step's filter, but removed
before), unique_fails (failing that filter only), each weight's sum over what the step removes, and the
Shapley sum: what the filter removes, added up over all orders.

Defined results: a null part is the empty string; a filter or a weight that is null counts as not failed or 0;
repeated rows count each; parts are those of the rows given, so an empty table gives no rows; columns not
named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import save, word_blocks

#: 7 filters have 5,040 orders and 128 masks
MAX_FILTERS = 7
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MEASURES = "n_words long, n_distinct long, n_upper long, has_symbol boolean, digest binary"


def removal_steps(k: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, steps): orders[p] lists the filters of order p; steps[m, p] is the step (from 0) that removes mask m, k if none does."""
    orders = np.array(list(permutations(range(k))), dtype=np.int64)
    position = np.argsort(orders, axis=1).T.astype(float)
    bits = np.arange(1 << k)[:, None] >> np.arange(k) & 1
    masks = np.where(bits == 1, 0.0, np.inf)
    product = (masks[:, :, None] + position[None]).min(axis=1)
    return orders, np.where(np.isinf(product), k, product).astype(np.int64)


def _scatter(names: list[str], weights: list[str]):
    k = len(names)
    fields = ["kept", "removed", "redundant", "unique_fails", *weights, "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, steps = removal_steps(k)
        n_orders = len(orders)
        labels = ["".join(names[f] for f in order) for order in orders]
        column = np.broadcast_to(np.arange(n_orders), steps.shape)
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                table = np.zeros((1 + len(weights), 1 << k), dtype=np.int64)
                for c in counts:
                    table[:, c["mask"]] += [c["n"], *(c[f"w{i}"] for i in range(len(weights)))]
                gone = np.zeros((len(table), n_orders, k + 1), dtype=np.int64)
                for scattered, row in zip(gone, table):
                    np.add.at(scattered, (column, steps), np.broadcast_to(row[:, None], steps.shape))
                removed = gone[0, :, :k]
                fails = np.array([table[0, np.arange(1 << k) >> f & 1 == 1].sum() for f in range(k)])
                shapley = np.zeros(k, dtype=np.int64)
                np.add.at(shapley, orders, removed)
                found = {"kept": table[0].sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": fails[orders] - removed,
                         "unique_fails": table[0, 1 << orders], "shapley": shapley[orders]}
                found |= {w: gone[1 + i, :, :k] for i, w in enumerate(weights)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (n_orders * k), pa.string()), pa.array(np.repeat(labels, k).tolist(), pa.string()),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n_orders)), *(pa.array(found[f].ravel()) for f in fields)],
                    ["part", "filter_order", "step", *fields])

    return run, "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in fields)


def interaction_audit(rows: DataFrame, filters: dict[str, Column], part: Column, weights: dict[str, Column] | None = None) -> DataFrame:
    """One row per part, order of the filters and step; filters say which rows fail, weights are whole numbers."""
    names, weights = list(filters), weights or {}
    if not 0 < len(names) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {len(names)}")
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, 1 << i).otherwise(0)
    marked = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
                         *[F.coalesce(w.cast("long"), F.lit(0)).alias(f"w{i}") for i, w in enumerate(weights.values())])
    sums = [f"w{i}" for i in range(len(weights))]
    counts = marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *[F.sum(w).alias(w) for w in sums])
    lists = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *sums)).alias("counts"))
    run, schema = _scatter(names, list(weights))
    return lists.mapInArrow(run, schema)


def text_measures(text: Column) -> Column:
    """Struct of word, distinct word and [A-Z] counts, whether one of #$%&*| occurs, and the SHA-256 of a text (null: empty)."""
    symbol = re.compile(rb"[#$%&*|]")

    @F.pandas_udf(MEASURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            n, distinct = 0, set()
            for block in word_blocks(t):
                n += len(block)
                distinct.update(block)
            out.append((n, len(distinct), len(t) - len(t.translate(None, UPPER)), symbol.search(t) is not None, hashlib.sha256(t).digest()))
        return pd.DataFrame(out, columns=["n_words", "n_distinct", "n_upper", "has_symbol", "digest"])

    return of(F.coalesce(text, F.lit("")).cast("binary"))


def text_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, the columns of ``keep`` as a struct ``row``, and the failures A to E.

    A: under 100 words, B: under 80 % distinct words, C: over 10 % capitals, D: one of #$%&*|, E: a smaller id has the same text.
    Equal texts are those of equal SHA-256.  A row that no smaller id precedes is found by its text and id
    together, so the rows of one text are not gathered; a null id neither precedes nor follows.
    """
    text = F.col(f"`{text_col}`")
    own = F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in keep or []]).alias("row")
    rows = save(docs.select(F.col(f"`{id_col}`").alias("id"), own, F.coalesce(F.length(text), F.lit(0)).alias("n_chars"),
                            text_measures(text).alias("m")).select("id", "row", "n_chars", "m.*"), "measures")
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    return rows.join(first, ["digest", "id"], "left").select(
        "id", "row", (F.col("n_words") < 100).alias("A"), (100 * F.col("n_distinct") < 80 * F.col("n_words")).alias("B"),
        (100 * F.col("n_upper") > 10 * F.col("n_chars")).alias("C"), F.col("has_symbol").alias("D"),
        (F.col("is_first").isNull() & F.col("id").isNotNull()).alias("E"), "digest")


def audit_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of the five text filters by ``part_col``, with the labelled good and toxic documents that each step loses.

    A document is good (toxic) if any of its labels says so; documents without a label or an id count as neither.
    """
    failing = text_failures(docs, id_col, text_col, [part_col])
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"), F.lit(0).alias("salt"))
    # rows without an id match nothing: dealt by their text instead of all to one task
    failing = failing.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(65536))).otherwise(0).cast("int"))
    rows = failing.join(marks, ["id", "salt"], "left")
    return interaction_audit(rows, {f: F.col(f) for f in "ABCDE"}, F.col(f"row.`{part_col}`"),
                             {"good_lost": F.col("good").cast("int"), "toxic_lost": F.col("toxic").cast("int")})
