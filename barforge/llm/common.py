"""Helpers shared by the operators: stored tables, blocked pairs, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.plans.storage import checkpoint_dir

#: Words are runs of anything but ASCII white space; the same class as ``bytes.split()``.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder (a URI, as the session names it)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``save`` that nothing will read again."""
    path, spark = getattr(df, "_llm_path", None), df.sparkSession
    if path:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def words(text: Column) -> Column:
    """Array of the words of a text; null or blank: no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), "")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, a block at a time, so that a very long text needs little memory.

    Blocks end at white space; ``bytes.split`` cuts at exactly the six ASCII space characters.
    """
    pos, n = 0, len(data)
    while pos < n:
        end = min(n, pos + size)
        while end < n and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[pos:end].split()
        pos = end


def blocked_pairs(rows: DataFrame, keys: list[str], node: str, block: int) -> DataFrame:
    """Deal the rows of every bucket so that each pair of a bucket meets in exactly one small group.

    A bucket of n rows is cut into ceil(n / block) blocks by a hash of ``node``; a row goes to one
    group per block of its bucket, so a group holds about two blocks however large the bucket is.
    Buckets of one row are left out.  Adds ``_lo``, ``_hi`` (the two blocks) and ``_blk`` (the row's).
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    dealt = (rows.join(counts, keys)
             .withColumn("_blk", F.pmod(F.xxhash64(F.col(node)), blocks).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("_lo", F.least("_blk", "_other")).withColumn("_hi", F.greatest("_blk", "_other"))
             .drop("_other", "_n"))
    group = [*keys, "_lo", "_hi"]
    return dealt.repartition(*group).sortWithinPartitions(*group)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str],
           convert: Callable[[pa.Table], dict[str, np.ndarray]]) -> Iterator[dict[str, np.ndarray]]:
    """Complete groups of a partition sorted by ``keys``, also those that cross Arrow batches."""
    rest: pa.Table | None = None

    def cut(t: pa.Table) -> list[int]:
        change = np.zeros(max(t.num_rows - 1, 0), dtype=bool)
        for k in keys:
            v = t[k].to_numpy()
            change |= v[1:] != v[:-1]
        return [0, *(np.flatnonzero(change) + 1).tolist()]

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        starts = cut(t)
        cols = convert(t.slice(0, starts[-1])) if len(starts) > 1 else {}
        for s, e in zip(starts, starts[1:]):
            yield {k: v[s:e] for k, v in cols.items()}
        rest = t.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield convert(rest)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a[i] - b[i]."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b) of long ids: (node, root), root the smallest id reachable.

    Alternating large-star and small-star steps (joins and partial minima only, so a hub's links are
    never gathered in one task), a written table per round, until a round changes nothing; about
    log2(longest path) rounds.  Only nodes with a link to another node are returned.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return small.union(low).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(now)
    while before[0]:
        new = save(stars(now), "stars")
        after = state(new)
        discard(now)
        now = new
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
