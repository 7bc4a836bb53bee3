"""Repeated passages by sparse suffix arrays (operator 5).

A suffix is kept only where content selects it: of every 16 neighbouring positions the one whose next 35 words
have the smallest hash.  Equal passages select equal positions, so any passage of 50 words (16 + 35 - 1) that
occurs twice has a kept suffix among its first 16 positions whose 35 words match.

1. Kept suffixes, about 2 of 17 positions, are sorted over range partitions, by the hash of their 35 words (any order
   serves in which equal beginnings are neighbours), and compared with their neighbours: one without an equal
   neighbour drops out.  Ranges are cut by (hash, document, position), so suffixes with the beginning a third of all
   documents hold are spread over many tasks; only the runs at the ends of partitions, two rows of totals a partition,
   are settled afterwards.
2. The others are extended in their text, up to 15 words to the left and to 50 words on the right: one window per
   start, hashed from prefix sums.  Each start belongs to the kept suffix that is smallest among its own 16 positions,
   the same one wherever the window occurs, so no window is made twice.  (A neighbour in suffix order has the longest
   match to the right, but another partner may match further to the left; a window for every number of left words loses
   none.)  Windows are sorted and compared with their neighbours in the same way.
3. Repeated windows that overlap or touch are one passage, as long as it goes: longest matches, however long.
   Where the first holder changes inside a passage, it has several matches (``holders``).

Results are exact for the windows (but for 64-bit hash collisions): a word is in a passage exactly if it lies in
50 words that occur again, in another document or at another place of the same one (``elsewhere`` tells them apart).
Copies are one document in step 1; of a text that occurs twice, every window is a repeat, so all of a text of 50 words
or more is a passage.

Defined results: a null, empty or short text (under 50 words) has no passages; repeated rows are copies of each
other; null ids are carried along; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from barforge.llm.common import discard, save

MIN_WORDS = 50
SPAN = 16
SEED = 42
#: odd multiplier of the rolling hash (fixed, any odd 64-bit number)
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of a text's words and of any run of them."""

    def __init__(self, data: bytes):
        words = data.split()  # ASCII white space
        self.n = len(words)
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(w, SEED) for w in words), dtype=np.uint64, count=self.n)
        self.power = np.ones(self.n + 1, dtype=np.uint64)
        np.multiply.accumulate(np.full(self.n, BASE, dtype=np.uint64), out=self.power[1:])
        # sums of h[i] * BASE**(n - i): a run's sum, scaled to one power, depends on its words only
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(h * self.power[self.n - np.arange(self.n)], out=self.sums[1:], dtype=np.uint64)

    def runs(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the runs of ``length`` words that start at these positions."""
        inverse = pow(BASE, -1, 1 << 64)
        scale = np.ones(self.n + 1, dtype=np.uint64)
        np.multiply.accumulate(np.full(self.n, inverse, dtype=np.uint64), out=scale[1:])
        return mixed((self.sums[at + length] - self.sums[at]) * scale[self.n - at - length + 1])


def smallest(keys: np.ndarray, span: int) -> np.ndarray:
    """For every start, the position of the smallest key (the leftmost of equal ones) among ``span`` neighbours."""
    if len(keys) < span:
        return np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(keys, span)
    return np.arange(len(views)) + views.argmin(axis=1)


def _suffixes(words: int, span: int):
    length = words - span + 1

    def run(batches):
        seen = set()  # texts of this task: a copy gives nothing new
        for b in batches:
            uid, pos, key = [], [], []
            for u, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if u in seen:
                    continue
                seen.add(u)
                w = Words(data)
                if w.n < words:
                    continue
                keys = w.runs(np.arange(w.n - length + 1), length)
                at = np.unique(smallest(keys, span))
                uid.append(np.full(len(at), u, dtype=np.int64))
                pos.append(at)
                key.append(keys[at].view(np.int64))
            if uid:
                yield pa.RecordBatch.from_arrays([np.concatenate(uid), np.concatenate(pos).astype(np.int32), np.concatenate(key)], ["uid", "at", "key"])

    return run


def _windows(words: int, span: int, names: list[str]):
    """Windows (uid, start, window, first_id, copied) of the starts that belong to the given kept positions of a text,
    of a copied text all; batches are uid, data, at, first_id, copied."""
    length = words - span + 1

    def run(batches):
        for b in batches:
            row, start, window = [], [], []
            for i, (data, at, copied) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist())):
                w = Words(data)
                last = w.n - words
                if last < 0:
                    continue
                mine = np.arange(last + 1)
                if not copied:
                    mine = np.flatnonzero(np.isin(smallest(w.runs(np.arange(w.n - length + 1), length), span), np.array(at, dtype=np.int64)))
                row.append(np.full(len(mine), i, dtype=np.int64))
                start.append(mine)
                window.append(w.runs(mine, words).view(np.int64))
            if row:
                of = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays([b.column(0).take(of), pa.array(np.concatenate(start).astype(np.int32)), pa.array(np.concatenate(window)),
                                                  b.column(3).take(of), b.column(4).take(of)], names)

    return run


def _compare(key: str, holder: str | None, names: list[str]):
    """Rows sorted by key, holder and uid: those with an equal neighbour, or of a copied text, with the run's first holder and
    whether the run has several documents.  Rows of a run about which other partitions may tell something have border 1, a
    row that only tells others of its run has border 2.  Without a holder a row with an equal neighbour is settled."""
    column = holder or "uid"

    def plain(t: pa.Table, holders: pa.Array, across: np.ndarray, border: int = 0) -> Iterator[pa.RecordBatch]:
        n = t.num_rows
        if n:
            yield from pa.table([*[t[c].combine_chunks() for c in t.column_names], holders, pa.array(across),
                                 pa.array(np.full(n, border, dtype=np.int32))], names=names).to_batches()

    def open_run(t: pa.Table, least: pa.Array, several: bool) -> Iterator[pa.RecordBatch]:
        yield from plain(t, least.take(pa.array(np.zeros(t.num_rows, dtype=np.int64))), np.full(t.num_rows, several), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the partition's first key; rows of a last run of one document; key, holder and last row of one of several; the last row
        first = rest = going = last = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            # the same place of copies, found by several tasks
            ids = np.stack([t[c].to_numpy().astype(np.int64) for c in (key, "uid", "at")])
            new = np.concatenate([[last is None or bool((ids[:, 0] != last).any())], (ids[:, 1:] != ids[:, :-1]).any(axis=0)])
            last = ids[:, -1]
            t = t.take(pa.array(np.flatnonzero(new)))
            if not t.num_rows:
                continue
            if rest is not None:
                t = pa.concat_tables([rest, t]).combine_chunks()
            k, u = t[key].to_numpy(), t["uid"].to_numpy()
            first = k[0] if first is None else first
            heads = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
            size = np.diff(np.append(heads, len(k)))
            of = np.repeat(np.arange(len(heads)), size)
            several = np.logical_or.reduceat(u != u[heads][of], heads)
            least = t[column].combine_chunks().take(pa.array(heads))
            twice = size > 1
            if going is not None and going[0] == k[0]:
                several[0] = twice[0] = True
                least = pa.concat_arrays([going[1], least.slice(1)])
            done, begin = len(k) if several[-1] else int(heads[-1]), 0
            if done and k[0] == first:
                if holder is None and twice[0]:
                    yield from plain(t.slice(0, 1), least.slice(0, 1), several[:1], 2)
                else:
                    begin = int(size[0])
                    yield from open_run(t.slice(0, begin), least.slice(0, 1), bool(several[0]))
            at = begin + np.flatnonzero((twice[of] | t["copied"].to_numpy())[begin:done])
            yield from plain(t.take(pa.array(at)), least.take(pa.array(of[at])), several[of[at]])
            going = (k[-1], least.slice(len(heads) - 1), t.slice(len(k) - 1)) if several[-1] else None
            rest = None if several[-1] else t.slice(done)
        if rest is not None:
            least = rest[column].combine_chunks().slice(0, 1)
            if holder is None and rest.num_rows > 1:
                yield from plain(rest, least.take(pa.array(np.zeros(rest.num_rows, dtype=np.int64))), np.zeros(rest.num_rows, dtype=bool))
                yield from plain(rest.slice(0, 1), least, np.zeros(1, dtype=bool), 2)
            else:
                yield from open_run(rest, least, False)
        elif going is not None:
            yield from plain(going[2], going[1], np.ones(1, dtype=bool), 2)

    return run


def repeated(rows: DataFrame, key: str, holder: str | None, name: str) -> DataFrame:
    """The rows (uid, at, key, copied) whose key occurs again, or whose text is copied; where a holder is named
    with ``least``, the smallest holder of the key, and ``across``, whether several documents hold it."""
    order = [F.col(key), *([F.col(holder).asc_nulls_last()] if holder else []), F.col("uid"), F.col("at")]
    schema = StructType([*rows.schema.fields, StructField("least", rows.schema[holder or "uid"].dataType), StructField("across", BooleanType()),
                         StructField("border", IntegerType())])
    found = save(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_compare(key, holder, schema.names), schema), name)
    # runs at the ends of partitions: at most two keys a partition, one row of totals each
    ends = found.where("border > 0").groupBy(key).agg(
        F.min("least").alias("_least"), (F.max("across") | (F.min("uid") != F.max("uid"))).alias("_across"), (F.count(F.lit(1)) > 1).alias("_again"))
    # every row meets the totals of its key at most once, so as many rows leave the join as enter it
    undecided = F.col("border") == 1
    out = (found.where("border < 2").join(F.broadcast(ends), key, "left").where(~undecided | F.col("_again") | F.col("copied"))
           .select("uid", "at", key, "copied", F.when(undecided, F.col("_least")).otherwise(F.col("least")).alias("least"),
                   F.when(undecided, F.col("_across")).otherwise(F.col("across")).alias("across")))
    return out if holder else out.drop("least", "across")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = MIN_WORDS, span: int = SPAN) -> DataFrame:
    """One row per passage of a document: id_col, start, end (word offsets, end exclusive), n_words of the
    document, first_id, the smallest id of a document that holds the passage's first window, elsewhere, whether another
    document holds a window of it, and holders, the matches that make up the passage: (start, end, first_id) of the
    windows in a row whose smallest holder is the same."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("uid"), text.alias("data"))
    n_words = F.size(F.array_remove(F.split(F.col("data").cast("string"), r"[\x20\x09-\x0D]+"), ""))
    known = save(src.select("id", "uid", n_words.alias("n_words")), "documents")
    firsts = known.groupBy("uid").agg(F.min("id").alias("first_id"), (F.count(F.lit(1)) > 1).alias("copied"), F.first("n_words").alias("n_words"))
    kept = save(src.select("uid", "data").mapInArrow(_suffixes(words, span), "uid long, at int, key long"), "suffixes")
    again = repeated(kept.withColumn("copied", F.lit(False)), "key", None, "neighbours")
    matched = save(again.groupBy("uid").agg(F.collect_list("at").alias("at")), "matched")
    discard(kept)
    wanted = firsts.join(matched, "uid", "left").where(F.col("at").isNotNull() | (F.col("copied") & (F.col("n_words") >= words)))
    one = src.drop("id").join(wanted.drop("n_words"), "uid").groupBy("uid").agg(*[F.first(c).alias(c) for c in ("data", "at", "first_id", "copied")])
    schema = StructType([StructField("uid", LongType()), StructField("at", IntegerType()), StructField("window", LongType()), one.schema["first_id"], one.schema["copied"]])
    windows = save(one.mapInArrow(_windows(words, span, schema.names), schema), "windows")
    repeats = repeated(windows, "window", "first_id", "repeats").select(
        "uid", F.col("at").alias("start"), F.col("least").alias("holder"), (F.col("across") | F.col("copied")).alias("across"))
    # overlapping or touching windows are one passage, those in a row with the same first holder one match of it
    order = Window.partitionBy("uid").orderBy("start")
    before = F.lag("start").over(order)
    passage = F.coalesce((F.col("start") > before + words).cast("int"), F.lit(1))
    match = F.coalesce(((F.col("start") > before + 1) | ~F.col("holder").eqNullSafe(F.lag("holder").over(order))).cast("int"), F.lit(1))
    marked = repeats.withColumn("p", passage).withColumn("m", match).withColumn("nr", F.sum("p").over(order)).withColumn("match", F.sum("m").over(order))
    matches = marked.groupBy("uid", "nr", "match").agg(F.min("start").alias("start"), (F.max("start") + words).alias("end"), F.first("holder").alias("first_id"),
                                                       F.max("across").alias("across"))
    parts = matches.groupBy("uid", "nr").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("first_id", "start").alias("first_id"),
                                             F.max("across").alias("elsewhere"), F.array_sort(F.collect_list(F.struct("start", "end", "first_id"))).alias("holders"))
    parts = save(parts.drop("nr"), "passages")
    discard(windows)
    return known.join(parts, "uid").select(F.col("id").alias(id_col), "start", "end", "n_words", "first_id", "elsewhere", "holders")
