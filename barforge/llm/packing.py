"""Best-fit packing by linear grouping (operator 9).

Tokenising is the only work on texts; it leaves one small row per piece (a document's ids, cut into pieces
of the sequence length only where it is longer).  Packing then needs no more than the histogram of piece
lengths, at most ``capacity`` rows whatever the corpus, so its plan is made from that histogram:

1. Pieces over ``capacity / 8`` are large.  Sorted by length they are cut into groups of equal cardinality
   and every length is rounded up to its group's largest: at most ``groups`` sizes.
2. Configurations (how many of each size fill a sequence) are optimised one after another: a knapsack over
   the few sizes finds the fullest one, and it is used as often as the remaining counts allow.
3. Real pieces take the places of the rounded sizes, which leaves their true, larger gaps.
4. Small pieces, longest first, go best-fit into the smallest gap that holds them, or into new sequences.

All four steps work on runs: "the pieces of length l and ranks [a, b) go to sequences [s, s + b - a) at offset
o".  Two pieces of one length are alike, so a run covers any number of pieces and the plan's size depends on
the number of lengths and groups only.  Ranks within a length come from counts per (length, bucket) and a
window inside each bucket, so a hot length is spread over many tasks.  Each piece then looks up its run.

Defined results: a null or empty text is just the end id; repeated rows are packed like any other rows; null ids
stay null; a very long text is many pieces; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict, deque
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import save

CAPACITY = 4096
END_ID = 1
GROUPS = 16
BUCKETS = 64
#: words remembered by a Python worker, about 500 MB
CACHE_WORDS = 2_500_000


#: a comma or full stop behind a letter or digit and at a word's end: the tokenizer parts the two anyway
MARK = re.compile(r"[,.](?<=[^\W_][,.])(?![^ \n])")


class Known(dict):
    """Numbers of words in order of appearance; a new word gets the next number and is put on the list ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins what white space separates: every word between spaces is
    tokenised once and remembered.

    So that more words are known already, texts of Latin-1 characters (composed, and lower case means the same to
    all) become lower case first, and a comma or full stop that ends a word is set apart.  New words of lower-case
    letters only are encoded many at a time, joined by spaces and without normalising again; each ends with the
    one token that carries the end-of-word mark.  Texts that may spell a special token are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for words that normalising and splitting leave as they are: lower-case letters in composed form
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.index = Known()
        self.starts = self.lengths = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of the words at these indexes, one after another."""
        lengths = self.lengths[at]
        shift = np.cumsum(lengths) - lengths
        return self.flat[np.repeat(self.starts[at] - shift, lengths) + np.arange(int(lengths.sum()))]

    def learn(self) -> None:
        """Encode the new words."""
        new, self.index.new = self.index.new, []
        starts, lengths = np.zeros(len(new), dtype=np.int64), np.zeros(len(new), dtype=np.int64)
        flat, n = [self.flat], len(self.flat)
        letters, other = [], []
        for i, w in enumerate(new):
            (letters if w.isalpha() and w.lower() == w and (w.isascii() or is_normalized("NFC", w)) else other).append(i)
        for at in range(0, len(letters), 200):
            some = letters[at:at + 200]
            got = np.array(self.plain.encode_batch_fast([" ".join([new[i] for i in some])], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cuts = np.flatnonzero(self.ends[got]) + 1
            if len(cuts) != len(some):
                other += some
                continue
            starts[some] = n + np.concatenate(([0], cuts[:-1]))
            lengths[some] = np.diff(cuts, prepend=0)
            flat.append(got)
            n += len(got)
        for at in range(0, len(other), 200):
            some = other[at:at + 200]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([new[i] for i in some], add_special_tokens=False)):
                got = np.array(e.ids, dtype=np.uint32)
                starts[i], lengths[i] = n, len(got)
                flat.append(got)
                n += len(got)
        self.starts, self.lengths = np.concatenate((self.starts, starts)), np.concatenate((self.lengths, lengths))
        self.flat = np.concatenate(flat)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, the end id last."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        number, found = self.index.__getitem__, []
        for t in texts:
            t = t or ""
            if "<|" in t:
                found.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype=np.uint32))
                continue
            words = MARK.sub(r" \g<0>", lowered(t)).replace("\n", " ").split(" ")
            found.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)))
        if self.index.new:
            self.learn()
        return [np.append(f if f.dtype == np.uint32 else self.gather(f), np.uint32(END_ID)).astype("<u4", copy=False) for f in found]


def lowered(text: str) -> str:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
             keep_ids: bool = False) -> DataFrame:
    """Rows (id_col, piece, start, length, ids_crc32[, ids]), one per piece of at most ``capacity`` ids."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, WordTokenizer(tokenizer))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, x in enumerate(words.encode(b.column(1).to_pylist())):
                    for k, s in enumerate(range(0, len(x), capacity)):
                        part = x[s:s + capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if keep_ids:
                            ids.append(part.astype(np.int32))
                cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if keep_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, ["id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    return src.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def fullest(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How many of each size make the fullest sequence (bounded knapsack by reachable totals)."""
    reach = np.zeros(capacity + 1, dtype=bool)
    reach[0] = True
    steps = []  # for each unit of a size: totals first reached by it
    for g, size in enumerate(sizes):
        for _ in range(min(counts[g], capacity // size)):
            new = np.zeros_like(reach)
            new[size:] = reach[:-size]
            new &= ~reach
            if not new.any():
                break
            steps.append((g, new))
            reach |= new
    total, used = int(np.flatnonzero(reach)[-1]), [0] * len(sizes)
    for g, new in reversed(steps):
        if total and new[total]:
            used[g] += 1
            total -= sizes[g]
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that pack pieces of the given lengths."""
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, deque] = defaultdict(deque)  # room -> runs of sequences (first, count)
    n_seq = 0
    full = histogram.get(capacity, 0)
    if full:
        runs.append((capacity, 0, full, 0, 0))
        n_seq = full

    # 1. large pieces in groups of equal cardinality, longest first
    large = sorted((x for x in histogram if capacity // 8 < x < capacity), reverse=True)
    total = sum(histogram[x] for x in large)
    per = max(1, -(-total // groups))
    queues: list[deque] = []
    sizes: list[int] = []
    room = 0
    for length in large:
        rank, left = 0, histogram[length]
        while left:
            if not room:
                queues.append(deque())
                sizes.append(length)
                room = per
            n = min(left, room)
            queues[-1].append((length, rank, n))
            rank, left, room = rank + n, left - n, room - n
    counts = [sum(n for _, _, n in q) for q in queues]

    # 2. and 3. configurations of few sizes, filled with the real pieces
    while any(counts):
        live = [g for g in range(len(sizes)) if counts[g]]
        # the largest size left leads, so that it never ends up alone without need
        lead = live[0]
        rest = fullest([sizes[g] for g in live], [counts[g] - (g == lead) for g in live], capacity - sizes[lead])
        use = {g: u + (g == lead) for g, u in zip(live, rest) if u or g == lead}
        times = min(counts[g] // u for g, u in use.items())
        slots = []
        for g, u in use.items():
            counts[g] -= u * times
            for _ in range(u):
                taken, left = [], times
                while left:
                    length, rank, n = queues[g].popleft()
                    k = min(n, left)
                    taken.append((length, rank, k))
                    if k < n:
                        queues[g].appendleft((length, rank + k, n - k))
                    left -= k
                slots.append(taken)
        # cut the copies where any slot's length changes
        edges = sorted({0, times, *(e for t in slots for e in np.cumsum([k for _, _, k in t]).tolist())})
        for a, b in zip(edges, edges[1:]):
            offset = 0
            for i, t in enumerate(slots):
                length, rank, k = t[0]
                runs.append((length, rank, b - a, n_seq + a, offset))
                offset += length
                if k == b - a:
                    t.pop(0)
                else:
                    t[0] = (length, rank + b - a, k - (b - a))
            if offset < capacity:
                gaps[capacity - offset].append((n_seq + a, b - a))
        n_seq += times

    # 4. small pieces best-fit, longest first
    for length in sorted((x for x in histogram if x <= capacity // 8), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            fits = [g for g in gaps if g >= length]
            if fits:
                gap = min(fits)
                first, n = gaps[gap].popleft()
                k = min(n, left)
                if k < n:
                    gaps[gap].appendleft((first + k, n - k))
                elif not gaps[gap]:
                    del gaps[gap]
            else:
                gap, first = capacity, n_seq
                k = -(-left // (capacity // length))
                n_seq += k
            runs.append((length, rank, k, first, capacity - gap))
            if gap > length:
                gaps[gap - length].append((first, k))
            rank, left = rank + k, left - k
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, order: tuple[str, ...] = ("id", "piece", "ids_crc32")) -> DataFrame:
    """Add sequence_id and offset to stored pieces (column ``length``)."""
    spark = pieces.sparkSession
    bucket = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int")
    dealt = pieces.withColumn("bucket", bucket)
    counted = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = pd.DataFrame([tuple(r) for r in counted.collect()], columns=["length", "bucket", "n"], dtype="int64")  # at most capacity * BUCKETS rows
    counts = counts.sort_values(["length", "bucket"])
    base = counts["n"].groupby(counts["length"]).cumsum() - counts["n"]
    first = {(x, b): n for x, b, n in zip(counts["length"].tolist(), counts["bucket"].tolist(), base.tolist())}
    runs = sorted(plan({int(k): int(v) for k, v in counts.groupby("length")["n"].sum().items()}, capacity, groups))
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    known = spark.sparkContext.broadcast((first, table))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = dealt.withColumn("rank", within.cast("long"))
    names = pieces.columns
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        starts, table = known.value
        by_length = {int(x): np.flatnonzero(table[:, 0] == x) for x in np.unique(table[:, 0])}
        for b in batches:
            length, bucket, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "bucket", "rank"))
            seq, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                r = rank[at] + np.array([starts[int(x), int(k)] for k in bucket[at]], dtype=np.int64)
                rows = by_length[int(x)]
                hit = rows[np.searchsorted(table[rows, 1], r, side="right") - 1]
                seq[at] = table[hit, 3] + r - table[hit, 1]
                offset[at] = table[hit, 4]
            cols = [b.column(b.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(offset)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   groups: int = GROUPS, keep_ids: bool = False) -> DataFrame:
    """Rows (id_col, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    pieces = save(tokenize(docs, tokenizer, capacity, id_col, text_col, keep_ids), "pieces")
    return place(pieces, capacity, groups).withColumnRenamed("id", id_col)
