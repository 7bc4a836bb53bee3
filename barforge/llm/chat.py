r"""Chat formatting (operator 4), Spark expressions only.

A conversation's turns are collected as structs, sorted by turn, merged where neighbours have the same role
(array functions) and concatenated:

    ### role: text</part>text</turn>
    ### role: text</turn>

``</part>`` keeps the borders of merged turns, so the original turns can be read back.  In roles and
texts a backslash becomes ``\\``, ``</`` becomes ``<\/`` and ``###`` becomes ``#\##``; a role's ``: ``
becomes ``:\ ``.  After that neither a text nor a role can hold a control string, and every backslash is
followed by one of the characters ``\ / #`` or a space, so one replacement restores the text.

The loss mask is run-length encoded over the formatted text: (n_chars, loss) pairs in order, loss set on the
texts (not the marks) of the trained role.  It needs no running sums and stays linear in the conversation.

Defined results: null text or role is empty; null turns come first; equal turns are ordered by role, then text;
repeated rows are turns of their own; rows with a null conversation id form one conversation; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, SPLIT, PART, END = "### ", ": ", "</part>", "</turn>\n"
TRAINED = "assistant"
#: characters of a piece and runs of a group when a loss mask is read back
PIECE, GROUP = 512, 64


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("</", "<\\/"), ("###", "#\\##")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\/# ])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(SPLIT), F.lit(":\\ "))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", trained: str = TRAINED) -> DataFrame:
    """One row per conversation: id_col, formatted, loss_mask (array of n_chars, loss)."""
    empty = F.lit("")
    rows = turns.select(F.col(f"`{id_col}`").alias("id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), empty).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), empty).alias("text")).alias("t"))
    chats = rows.groupBy("id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    t = F.col("turns")
    # where a new block begins, and the blocks as (role, texts)
    starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, F.greatest(i - 1, F.lit(0)))["role"]))
    chats = chats.withColumn("starts", starts)
    s = F.col("starts")
    chats = chats.withColumn("blocks", F.transform(s, lambda i, k: F.struct(
        F.get(t, i)["role"].alias("role"),
        F.transform(F.slice(t, i + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - i), lambda x: escape(x["text"])).alias("texts"))))
    blocks = F.col("blocks")

    def head(b: Column) -> Column:
        return F.concat(F.lit(HEAD), escape_role(b["role"]), F.lit(SPLIT))

    formatted = F.array_join(F.transform(blocks, lambda b: F.concat(head(b), F.array_join(b["texts"], PART), F.lit(END))), "")

    def run(n: Column, loss: Column) -> Column:
        return F.struct(n.cast("int").alias("n_chars"), loss.alias("loss"))

    no = F.lit(False)
    mask = F.flatten(F.transform(blocks, lambda b: F.concat(
        F.array(run(F.length(head(b)), no)),
        F.flatten(F.transform(b["texts"], lambda x, j: F.array(
            run(F.length(x), b["role"] == trained),
            run(F.when(j == F.size(b["texts"]) - 1, len(END)).otherwise(len(PART)), no)))))))
    return chats.select(F.col("id").alias(id_col), formatted.alias("formatted"), mask.alias("loss_mask"))


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), merged turns apart again."""
    blocks = F.array_remove(F.split(formatted, END), "")

    def turns(block: Column) -> Column:
        at = F.instr(block, SPLIT)
        role = unescape(F.substring(block, F.lit(len(HEAD) + 1), at - 1 - len(HEAD)))
        texts = F.split(F.substring(block, at + len(SPLIT), F.length(block)), PART)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value worked out once, also where ``body`` uses it inside of lambda functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_starts(mask: Column) -> Column:
    """Offset of every run of a mask: running sums over groups of runs, then inside each group."""
    def members(g: Column) -> Column:
        return F.transform(F.slice(mask, g * GROUP + 1, F.lit(GROUP)), lambda m: m["n_chars"])

    def running(sizes: Column, base: Column) -> Column:
        sums = F.aggregate(sizes, F.array(base), lambda x, n: F.array_append(x, F.element_at(x, -1) + n))
        return bound(sums, lambda x: F.slice(x, F.lit(1), F.size(x) - 1))

    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(mask) / GROUP).cast("int") - 1, F.lit(0)))
    totals = F.transform(numbers, lambda g: F.aggregate(members(g), F.lit(0), lambda x, n: x + n))
    return bound(running(totals, F.lit(0)), lambda bases: F.flatten(F.transform(bases, lambda base, g: running(members(g), base))))


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The stretches of a formatted conversation under its loss mask, unescaped, in order.

    The text is cut into pieces of ``PIECE`` characters once, so a stretch is found by its offset without reading the
    text from its start: time grows with the conversation, not with its square.
    """
    runs = F.filter(F.arrays_zip(run_starts(mask).alias("start"), mask.alias("run")), lambda z: F.coalesce(z["run"]["loss"], F.lit(False)))

    def stretch(pieces: Column, z: Column) -> Column:
        start, n = z["start"], z["run"]["n_chars"]
        first = F.floor(start / PIECE).cast("int")
        count = F.floor((start + n) / PIECE).cast("int") - first + 1
        return F.substring(F.array_join(F.slice(pieces, first + 1, count), ""), start - first * PIECE + 1, n)

    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return bound(pieces, lambda ps: F.transform(runs, lambda z: unescape(stretch(ps, z))))
