"""Exact dedup by Grace hash partitioning (operator 12).

Records go through hash tables of bounded size.  A first pass reads every record once: each task keeps an
open-addressing table of the contents it has seen (a new table when the contents held pass ``TABLE_BYTES``)
and spills one *carrier* row per content, the row that brings the text; its further copies are spilled as
narrow rows that name their carrier.  So a group of copies, however large, leaves a task as one text per table.

The carriers are then partitioned by hash.  A bucket within ``bucket_bytes`` is read by one task, which puts
its records in an open-addressing table that compares complete contents.  A larger bucket is partitioned
again by the next hash digits into the next level's spill files, until every bucket fits.  A large bucket
of one single hash can't be split by hash: its records are dealt into chunks, each chunk is collapsed to one
carrier per content, and what is left goes to the next level.

Each level is a table in the shared checkpoint folder.  The members of a group are never gathered: counts and
largest ids are partial aggregates per carrier, and a row finds its group through its carrier, which only rows
of one task share.

Defined results: a null text counts as empty; the row with the largest id of a group stays, any id before a
null one; of rows equal in text and id exactly one stays; a null id is the group's keep_id only where all its
ids are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import save

#: contents that a task of the first pass holds at once
TABLE_BYTES = 32 << 20
#: bytes of text that one bucket's table may hold
BUCKET_BYTES = 48 << 20
#: buckets that one level makes at most
FAN_OUT = 8192
#: rows of one hash that are compared together in any case
CHUNK_ROWS = 16


def content_hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class ContentTable:
    """Open addressing with linear probing; a slot holds the number of a content, equal hashes are compared in full."""

    def __init__(self) -> None:
        self.slots = [-1] * 64
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.held = 0

    def _slot(self, h: int, text: bytes) -> int:
        """The slot of this content, or the free slot where it belongs."""
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0 and (self.hashes[k] != h or self.texts[k] != text):
            at = at + 1 & mask
        return at

    def place(self, h: int, text: bytes) -> tuple[int, bool]:
        """(number of the content, whether it is new)."""
        at = self._slot(h, text)
        if self.slots[at] >= 0:
            return self.slots[at], False
        k = self.slots[at] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.held += len(text)
        if 2 * len(self.texts) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for i, x in enumerate(self.hashes):  # all contents differ, so a free slot is enough
                at = x & mask
                while self.slots[at] >= 0:
                    at = at + 1 & mask
                self.slots[at] = i
        return k, True


def _first_pass(hashed: Callable[[bytes], int], table_bytes: int):
    """(id, text) -> (id, rec, rep, and for carriers h, n_bytes, sha, text); rec numbers the records, rep names the carrier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rec = TaskContext.get().partitionId() << 40
        table, names = ContentTable(), []
        for b in batches:
            texts = b.column(1)
            rep, h, n, sha, new = [], [], [], [], []
            for text in texts.to_pylist():
                x = hashed(text)
                if table.held > table_bytes:
                    table, names = ContentTable(), []
                k, first = table.place(x, text)
                if first:
                    names.append(rec)
                rep.append(names[k])
                h.append(x if first else None)
                n.append(len(text) if first else None)
                sha.append(hashlib.sha256(text).digest() if first else None)
                new.append(first)
                rec += 1
            carried = pc.if_else(pa.array(new, pa.bool_()), texts, pa.scalar(None, texts.type))
            ids = pa.array(range(rec - len(rep), rec), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), ids, pa.array(rep, pa.int64()), pa.array(h, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(sha, pa.binary()), carried], ["id", "rec", "rep", "h", "n_bytes", "sha", "text"])

    return run


def _compare(table: pa.Table) -> pa.Table:
    """One bucket: every record's carrier and the first carrier of its content."""
    seen, names, first = ContentTable(), [], []
    for rep, h, text in zip(table["rep"].to_pylist(), table["h"].to_pylist(), table["text"].to_pylist()):
        k, new = seen.place(h, text)
        if new:
            names.append(rep)
        first.append(names[k])
    return pa.table({"rep": table["rep"], "class": pa.array(first, pa.int64())})


def _parts(n_bytes: Column, bucket_bytes: int) -> Column:
    return F.least(F.ceil(n_bytes * 2 / bucket_bytes), F.lit(FAN_OUT)).cast("long")


def group_carriers(carriers: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(rep, class) for carriers (rep, h, n_bytes, text): class is one carrier of all that have the same content."""
    total = carriers.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, min(FAN_OUT, -(-2 * total // bucket_bytes)))
    level = carriers.withColumn("bucket", F.pmod("h", F.lit(parts)).cast("string")).withColumn("before", F.lit(None).cast("long"))
    done, merged, depth = None, [], 0
    while True:
        depth += 1
        sizes = level.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("size"), (F.min("h") == F.max("h")).alias("one_hash"), F.max("before").alias("was"))
        # one hash: chunks as long as they are worth it (the last round at least halved the bucket)
        chunks = F.when(F.col("one_hash"), F.least(F.ceil(F.col("size") / bucket_bytes), F.floor(F.col("n") / CHUNK_ROWS)).cast("long"))
        whole = (F.col("size") <= bucket_bytes) | (F.coalesce(chunks, F.lit(2)) < 2) | F.coalesce(2 * F.col("n") > F.col("was"), F.lit(False))
        sizes = save(sizes.select("bucket", "n", "one_hash", chunks.alias("chunks"), _parts(F.col("size"), bucket_bytes).alias("parts"), whole.alias("whole")), "bucket-sizes")
        fit = level.join(sizes.where("whole"), "bucket").select("bucket", "rep", "h", "text").groupBy("bucket").applyInArrow(_compare, "rep long, class long")
        fit = save(fit, "classes")
        done = fit if done is None else done.unionByName(fit)
        if sizes.where("not whole").isEmpty():
            break
        rest = level.drop("before").join(sizes.where("not whole").drop("whole"), "bucket")
        split = rest.where("not one_hash").select(
            "rep", "h", "n_bytes", "text", F.concat_ws("/", "bucket", F.pmod(F.xxhash64("h", F.lit(depth)), "parts")).alias("bucket"), F.lit(None).cast("long").alias("before"))
        dealt = rest.where("one_hash").withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(depth)), "chunks"))
        collapsed = save(dealt.select("bucket", "chunk", "rep", "h", "text").groupBy("bucket", "chunk").applyInArrow(_compare, "rep long, class long"), "collapsed")
        merged.append(collapsed)
        left = collapsed.where("rep = class").select("rep")
        left = dealt.join(left, "rep").select("rep", "h", "n_bytes", "text", "bucket", F.col("n").alias("before"))
        level = save(split.unionByName(left), f"spill-{depth}")
    for step in reversed(merged):  # rows that a chunk merged follow their chunk's carrier
        last = done.select(F.col("rep").alias("class"), F.col("class").alias("final"))
        moved = step.where("rep <> class").join(last, "class").select("rep", F.col("final").alias("class"))
        done = done.unionByName(moved)
    return done


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None,
                bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES, hashed: Callable[[bytes], int] = content_hash) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, sha256 (of the normalised text, lowercase hex)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text = (normalise(text) if normalise else text).cast("binary").alias("text")
    kind = docs.schema[id_col].dataType.simpleString()
    records = save(docs.select(F.col(f"`{id_col}`").alias("id"), text).mapInArrow(
        _first_pass(hashed, table_bytes), f"id {kind}, rec long, rep long, h long, n_bytes long, sha binary, text binary"), "records")
    classes = group_carriers(records.where("rep = rec").select("rep", "h", "n_bytes", "text"), bucket_bytes)
    # the largest id first, the earliest record of equal ids
    best = F.max(F.struct("id", (-F.col("rec")).alias("rec"))).alias("best")
    carriers = records.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), best, F.max("sha").alias("sha"))
    carriers = save(carriers.join(classes, "rep"), "carriers")
    found = carriers.groupBy("class").agg(F.sum("n").alias("n"), F.max("best").alias("best"))
    found = carriers.select("rep", "class", "sha").join(found, "class").select("rep", "n", "best", "sha")
    return records.select("id", "rec", "rep").join(found, "rep").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("rec") == -F.col("best.rec")).alias("kept"), F.lower(F.hex("sha")).alias("sha256"))
