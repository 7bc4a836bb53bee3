"""Embedding near-dedup with randomised-rotation binary codes (operator 1).

Unit vectors are turned by random rotations; the signs are the code.  Two uses:

* Buckets.  Table t takes its own k sign bits as key.  A pair at the threshold angle agrees on one bit with
  probability p = 1 - angle / pi, on a table with p**k, so tables = log(miss) / log(1 - p**k) tables miss it with
  at most ``miss`` (closer pairs far less).  ``miss`` is 1e-5 or, if less, such that of all pairs of equal label, counted
  as if every one were at the threshold, fewer than ``LOST`` are expected to be missed.  k grows with the logarithm of the largest group, so buckets
  stay small and the number of tables grows as n**0.1.
* Estimates.  Beside the code o of the first rotation stands the correction factor <o, x> of its vector x.
  <o, y> / <o, x> is an unbiased estimate of <x, y>, off by more than z * sqrt((1 - <o, x>**2) / <o, x>**2 / (D - 1))
  with a probability that falls as exp(-z**2 / 2); z grows with the number of pairs in the same way.  A pair whose upper bound (from either side) is below the
  threshold is done; the others are recomputed exactly, in double precision, and only those link.

Copies (equal label and vector) are one node with a weight, so a group of copies is never expanded.  Inside a
bucket, pairs meet in blocks of bounded size.  A pair counts in the first table where its keys agree, so nothing
is counted twice and no pair leaves a task: only link counts and a spanning forest do.

Defined results: vectors that are null, empty, all zero or hold null or non-finite numbers, and rows without a
label, link with nothing and are their own component; vectors of different lengths don't link; repeated rows
are copies; a null id is never a component's smallest unless there is no other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import blocked_pairs, components, groups, local_roots, save

THRESHOLD = 0.98
MISS = 1e-5
BUCKET = 64
BLOCK = 256
SEED = 42
#: half-width of the confidence bounds in standard terms
Z = 5.0
#: expected number of pairs lost by the tables and by the bounds, each, at most
LOST = 0.01


def rotations(dim: int, n_bits: int, seed: int = SEED) -> np.ndarray:
    """Random orthogonal matrices, as many as give n_bits rows, one below the other."""
    rng, out = np.random.default_rng([seed, dim]), []
    for _ in range(-(-n_bits // dim)):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out)


def layout(largest: int, threshold: float = THRESHOLD, miss: float = MISS, bucket: int = BUCKET) -> tuple[int, int]:
    """(bits, tables) for groups of up to ``largest`` vectors."""
    p = 1 - math.acos(threshold) / math.pi
    bits = max(4, math.ceil(math.log2(max(largest, 1) / bucket)))
    return bits, math.ceil(math.log(miss) / math.log(1 - p ** bits))


def certainty(pairs: int, miss: float = MISS, lost: float = LOST) -> tuple[float, float]:
    """(miss, z) with which fewer than ``lost`` of so many pairs are expected to be lost, either way."""
    each = min(1.0, lost / max(pairs, 1))
    return min(miss, each), max(Z, math.sqrt(2 * math.log(2 / each)))  # a pair has a bound from either side


def near_one(x: np.ndarray) -> np.ndarray:
    """Vectors scaled by powers of two, which rounds nothing, so that no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _encode(bits: int, tables: int, seed: int):
    """Vectors -> bytes of the vector (double), its sign bits, its correction factor, its key in each table."""
    def run(batches):
        for b in batches:
            v = b.column(b.schema.get_field_index("vec")).cast(pa.list_(pa.float64()))
            lengths = np.asarray(pa.compute.list_value_length(v))
            order, parts = [], {"x": [], "code": [], "factor": [], "keys": []}
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                x = np.asarray(v.take(pa.array(at)).flatten()).reshape(len(at), dim)
                turned = unit(x) @ rotations(int(dim), max(bits * tables, int(dim)), seed).T
                sign = turned > 0
                keys = sign[:, :bits * tables].reshape(len(at), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
                order.append(at)
                parts["x"] += [r.tobytes() for r in x]
                parts["code"] += [r.tobytes() for r in np.packbits(sign[:, :dim], axis=1)]
                parts["factor"] += (np.abs(turned[:, :dim]).sum(axis=1) / math.sqrt(dim)).tolist()
                parts["keys"] += keys.tolist()
            if not order:
                continue
            rest = b.select(["node", "label", "weight"]).take(pa.array(np.concatenate(order)))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(np.concatenate([np.full(len(o), lengths[o[0]]) for o in order]), pa.int32()),
                 pa.array(parts["x"], pa.binary()), pa.array(parts["code"], pa.binary()), pa.array(parts["factor"], pa.float64()),
                 pa.array(parts["keys"], pa.list_(pa.int64()))],
                ["node", "label", "weight", "dim", "x", "code", "factor", "keys"])

    return run


def candidates(x: np.ndarray, code: np.ndarray, factor: np.ndarray, dim: int, threshold: float, seed: int, z: float = Z) -> np.ndarray:
    """Matrix of the pairs whose confidence bounds reach the threshold."""
    turned = unit(x) @ rotations(dim, dim, seed).T
    signs = np.unpackbits(code, axis=1, count=dim).astype(np.float64) * 2 - 1
    estimate = (signs @ turned.T) / (math.sqrt(dim) * factor[:, None])
    off = z * np.sqrt(np.maximum(1 - factor ** 2, 0) / factor ** 2 / max(dim - 1, 1e-9))
    upper = estimate + off[:, None]
    return np.minimum(upper, upper.T) >= threshold


def _links(threshold: float, seed: int, z: float = Z):
    keys = ["label", "dim", "t", "k", "_lo", "_hi"]
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def convert(t: pa.Table) -> dict[str, np.ndarray]:
        out = {c: t[c].to_numpy() for c in ("node", "weight", "dim", "factor", "t", "_lo", "_hi", "_blk")}
        for c in ("x", "code", "keys"):
            out[c] = np.empty(t.num_rows, dtype=object)
            out[c][:] = t[c].to_pylist()
        return out

    def run(batches):
        for g in groups(batches, keys, convert):
            n, dim = len(g["node"]), int(g["dim"][0])
            x = np.frombuffer(b"".join(g["x"])).reshape(n, dim)
            code = np.frombuffer(b"".join(g["code"]), dtype=np.uint8).reshape(n, -1)
            near = np.triu(candidates(x, code, g["factor"], dim, threshold, seed, z), 1)
            if g["_lo"][0] != g["_hi"][0]:  # pairs inside a block meet in that block's own group
                near &= g["_blk"][:, None] != g["_blk"][None, :]
            i, j = np.nonzero(near)
            if len(i):  # first table where the keys agree
                table = np.array(g["keys"].tolist(), dtype=np.int64)
                first = (table[i] == table[j]).argmax(axis=1) == g["t"][0]
                i, j = i[first], j[first]
            if len(i):
                x = near_one(x)
                norm = np.linalg.norm(x, axis=1)
                cosine = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j])
                i, j = i[cosine >= threshold], j[cosine >= threshold]
            if not len(i):
                continue
            links = np.zeros(n, dtype=np.int64)
            np.add.at(links, i, g["weight"][j])
            np.add.at(links, j, g["weight"][i])
            root = local_roots(n, i, j)
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([g["node"][at], links[at], g["node"][root[at]]], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, miss: float = MISS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vec", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    # a number for each distinct vector, fixed by writing the table
    nodes = save(rows.where("usable").groupBy("label", "vec").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
                 .withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = F.col("count")
    largest, pairs = nodes.groupBy("label").count().agg(F.max(n), F.sum((n * (n - 1)).cast("double") / 2)).first()
    largest = largest or 0
    miss, z = certainty(pairs or 0, miss)
    bits, tables = layout(largest, threshold, miss)
    kind = nodes.schema["label"].dataType.simpleString()
    coded = save(nodes.select("node", "label", "weight", "vec").mapInArrow(
        _encode(bits, tables, seed), f"node long, label {kind}, weight long, dim int, x binary, code binary, factor double, keys array<long>"), "codes")
    dealt = coded.select("*", F.posexplode("keys").alias("t", "k"))
    found = save(blocked_pairs(dealt, ["label", "dim", "t", "k"], "node", block)
                 .mapInArrow(_links(threshold, seed, z), "node long, links long, root long"), "links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (nodes.select("node", "label", "vec", "first_id", "weight")
             .join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    known = save(known, "known")
    firsts = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = known.join(firsts, "root").select(F.col("label").alias("l2"), F.col("vec").alias("v2"), "component_id",
                                              (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.join(known, F.col("usable") & (F.col("label") == F.col("l2")) & (F.col("vec") == F.col("v2")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
