"""SimHash near-dedup by covering locality-sensitive hashing (operator 7).

Fingerprints are 64-bit SimHash values of word shingles.  Candidates come from a covering family of
bit masks: every bit position gets a non-zero vector phi of r + 1 bits, and for each non-zero v the mask
keeps the positions with <phi, v> odd.  Any r positions leave a v orthogonal to all their vectors, so two
fingerprints that differ in at most r bits agree on all of that mask's bits and share its bucket: no pair
within the radius is lost.  For r = 2 there are 7 tables of about 36 bits.

Exact copies and equal fingerprints are one node from the start.  Inside a bucket, pairs are compared in
blocks and only a spanning forest of each block pair's links leaves the task.

Defined results: a null text has no words; no words give fingerprint zero, linked like any other; repeated
rows stay rows of their own and share a class; a null doc_id is never a class's smallest id unless all
ids of the class are null; an empty table gives an empty result; other columns are ignored or passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import blocked_pairs, components, groups, local_roots, save, word_blocks

SEED = 42
BITS = 64
BLOCK = 512


def simhash(data: bytes | None, shingle: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text: bit set if set in over half of the shingles' hashes."""
    if not data:
        return 0
    digest = xxhash.xxh64_intdigest
    ones, n, carry = np.zeros(BITS, dtype=np.int64), 0, []
    for block in word_blocks(data.lower()):  # bytes.lower touches A-Z only
        carry += block
        if len(carry) < shingle:
            continue
        joined = b" ".join(carry)
        ends = np.cumsum(np.fromiter(map(len, carry), dtype=np.int64, count=len(carry)) + 1)
        starts = np.concatenate(([0], ends[:len(carry) - shingle])).tolist()
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())], dtype=np.uint64)
        for i in range(0, len(h), 65536):
            ones += np.unpackbits(h[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
        carry = carry[len(carry) - shingle + 1:] if shingle > 1 else []
    if not n:
        if not carry:
            return 0
        h = np.array([digest(b" ".join(carry), seed)], dtype="<u8")
        ones, n = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = SEED) -> Column:
    """Fingerprint (signed long) of a text column."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle, seed) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2**(radius + 1) - 1 masks of the covering family, as signed longs."""
    size = (1 << (radius + 1)) - 1
    phi = [i % size + 1 for i in range(bits)]  # every non-zero vector, dealt evenly over the positions
    masks = [sum(1 << i for i in range(bits) if bin(phi[i] & v).count("1") % 2) for v in range(1, size + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _links(radius: int):
    keys = ["t", "k", "_lo", "_hi"]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def convert(t: pa.Table) -> dict[str, np.ndarray]:
        return {c: t[c].to_numpy() for c in ("fp", "_lo", "_hi", "_blk")}

    def run(batches):
        a, b, rows = [], [], 0
        for g in groups(batches, keys, convert):
            fp = g["fp"].view(np.uint64)
            near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
            if g["_lo"][0] != g["_hi"][0]:  # pairs inside a block meet in that block's own group
                near &= g["_blk"][:, None] != g["_blk"][None, :]
            i, j = np.nonzero(np.triu(near, 1))
            if not len(i):
                continue
            root = local_roots(len(fp), i, j)
            own = np.flatnonzero(root != np.arange(len(fp)))
            a.append(g["fp"][own])
            b.append(g["fp"][root[own]])
            rows += len(own)
            if rows > 50_000:
                yield pa.RecordBatch.from_arrays([np.concatenate(a), np.concatenate(b)], schema=schema)
                a, b, rows = [], [], 0
        if a:
            yield pa.RecordBatch.from_arrays([np.concatenate(a), np.concatenate(b)], schema=schema)

    return run


def fingerprint_components(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """(fp, root) for every distinct fingerprint: root is the smallest signed value reachable over links
    of at most ``radius`` differing bits."""
    nodes = fps.select("fp").distinct()
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                                 for t, m in enumerate(covering_masks(radius))])).alias("b")
    rows = nodes.select("fp", tables).select("fp", "b.t", "b.k")
    links = blocked_pairs(rows, ["t", "k"], "fp", block).mapInArrow(_links(radius), "a long, b long")
    found = components(links).withColumnRenamed("node", "fp")
    return nodes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def _classes(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id, best): best is the fingerprint of the class's smallest id's row."""
    firsts = marked.groupBy("fp").agg(F.min("id").alias("id"))
    roots = save(firsts.join(fingerprint_components(firsts, radius), "fp"), "roots")
    # the smallest id first, rows without an id last, the smaller fingerprint among equal ids
    best = roots.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("m"))
    return roots.select("fp", "root").join(best, "root").select("fp", F.col("m.id").alias("component_id"), F.col("m.fp").alias("best"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """One row per document: id_col, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    marked = save(docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp")), "fingerprints")
    return marked.join(_classes(marked, radius), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         radius: int = 2) -> DataFrame:
    """The documents with one row left of each class: that of the smallest id (one of equal rows), all columns."""
    # only ids, fingerprints and hashes of rows are stored; the rows themselves are shuffled once
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = save(docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp"),
                              F.xxhash64(row).alias("h")), "fingerprints")
    best = _classes(marked, radius).where("fp = best").select(F.col("fp").alias("best_fp"), F.col("component_id").alias("best_id"))
    kept = (marked.join(best, (F.col("fp") == F.col("best_fp")) & F.col("id").eqNullSafe(F.col("best_id")))
            .groupBy("fp", "id").agg(F.min("h").alias("h")).select(F.col("id").alias("best_id"), F.col("h").alias("best_h")))
    rows = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(row).alias("h"))
    found = rows.join(kept, (F.col("h") == F.col("best_h")) & F.col("id").eqNullSafe(F.col("best_id")), "left_semi")
    order = Window.partitionBy("h", "id").orderBy(F.lit(0))  # equal rows
    return found.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").select("row.*")
