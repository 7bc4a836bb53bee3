"""Conversation structure repair (operator 11): cheapest edits that give the role grammar ``(s?(ua)+)?``.

Every row of a conversation becomes one symbol: the initial of its role, marked if its text breaks off, or ``x``
if it must go (blank, or said before in the conversation).  A conversation's symbols, read from the end, are its
signature.  Conversations with a common ending share it: the automaton's nodes are the distinct endings, a
node being a symbol in front of another node.  For each node and grammar state the cost-to-go, the first edit
of the best audit and where it leads are computed once, from those of the node behind.

The signatures are range-partitioned and sorted, so that endings that are shared lie side by side: a task walks the
automaton depth first and holds only the path of the current signature.  Conversations of one signature may be
dealt to many tasks (the sort goes on by id), each of which builds that path once; so a signature that a third of
all conversations have needs no join and no hot task.

Edits: K keeps a row, R gives it the role user or assistant (1), D deletes it (2), I inserts an empty turn (5);
a row that breaks off costs 5 more unless deleted.  Of equally cheap audits the least in ASCII order wins; as
every state has at most one edit of each letter, comparing first letters is enough.

Defined results: a null role or text is one space; rows are ordered by turn (null first), then role and text;
repeated rows are turns of their own (and duplicates); rows of a null conversation id are one conversation;
a conversation whose rows are all marked absent is kept with zeros and an empty audit; an empty table gives an
empty result; other columns are ignored.  The rows of one conversation meet in one task, as their order requires.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import save

SPACE = " \t\n\v\f\r"
DELETE, REROLE, INSERT, BROKEN = 2, 1, 5, 5
NEVER = 1 << 60
#: grammar states: nothing yet, after system, after user, after assistant; only the first and the last may end
START, SYSTEM, USER, ASSISTANT = range(4)
#: the state that a user or assistant turn leads to: the only one allowed in each state
TURN = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {USER: "u", ASSISTANT: "a"}
LEGAL = {"su", "ua", "au"}

Move = tuple[str, int]
Node = tuple[list[int], list[Move]]


def _with_inserts(best: list[tuple[int, str, int]]) -> Node:
    """A node from each state's best edit that consumes the row: inserts in front of it added.

    Two inserts in a row from user or assistant lead back to the same state, so one round settles all costs.
    """
    cost = [b[0] for b in best]
    low = list(cost)
    for state in (USER, ASSISTANT, START, SYSTEM):
        low[state] = min(cost[state], INSERT + (low if state in (START, SYSTEM) else cost)[TURN[state]])
    moves = []
    for state, (own, letter, to) in enumerate(best):
        inserted = INSERT + low[TURN[state]]
        use = inserted < own or (inserted == own and "I" < letter)
        moves.append(("I", TURN[state]) if use else (letter, to))
    return low, moves


def end_node() -> Node:
    return _with_inserts([(0, "", START), (NEVER, "~", SYSTEM), (NEVER, "~", USER), (0, "", ASSISTANT)])


def node_before(symbol: str, after: Node) -> Node:
    """The node of a row in front of an ending."""
    cost = after[0]
    best = []
    for state in range(4):
        options = [(DELETE + cost[state], "D", state)]
        if symbol != "x":
            extra = BROKEN if symbol.isupper() else 0
            initial, turn = symbol.lower(), TURN[state]
            if initial == INITIAL[turn]:
                options.append((extra + cost[turn], "K", turn))
            elif initial == "s" and state == START:
                options.append((extra + cost[SYSTEM], "K", SYSTEM))
            options.append((REROLE + extra + cost[turn], "R", turn))
        best.append(min(options))
    return _with_inserts(best)


class Endings:
    """The path of the current signature in the automaton; signatures come sorted, so shared endings are still there."""

    def __init__(self) -> None:
        self.signature = ""
        self.path = [end_node()]

    def solve(self, signature: str) -> tuple[int, str, list[tuple[int, int]]]:
        """(cost, audit, turns): turns are (row from the conversation's end or -1 if inserted, grammar state after it)."""
        old, same = self.signature, 0
        if signature != old:
            top = min(len(old), len(signature))
            while same < top and old[same] == signature[same]:
                same += 1
            del self.path[same + 1:]
            for symbol in signature[same:]:
                self.path.append(node_before(symbol, self.path[-1]))
            self.signature = signature
        at, state, audit, turns = len(signature), START, [], []
        while True:
            letter, to = self.path[at][1][state]
            if not letter:
                return self.path[-1][0][START], "".join(audit), turns
            audit.append(letter)
            if letter != "I":
                at -= 1
            if letter != "D":
                turns.append((-1 if letter == "I" else at, to))
            state = to


class _Chat:
    """Rows of one conversation, in order."""

    def __init__(self, key) -> None:
        self.key, self.turns, self.low, self.high = key, set(), None, None
        self.roles, self.texts, self.symbols, self.seen = [], [], [], set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            self.turns.add(turn)
            self.low, self.high = min(turn, turn if self.low is None else self.low), max(turn, turn if self.high is None else self.high)
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        said, symbol = text.rstrip(SPACE), role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not said:
            self.blank += 1
            symbol = "x"
        elif (role, text) in self.seen:
            self.duplicate += 1
            symbol = "x"
        elif said[-1] not in ".!?":
            self.truncated += 1
            symbol = symbol.upper()
        self.seen.add((role, text))
        self.roles.append(role)
        self.texts.append(text)
        self.symbols.append(symbol)

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - len(self.turns) if self.turns else 0
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, "".join(reversed(self.symbols)), self.roles, self.texts)


def _label(schema: pa.Schema, size: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat, done, held = None, [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)

        for b in batches:
            for key, turn, role, text, present in zip(*(c.to_pylist() for c in b.columns)):
                if chat is None or key != chat.key:
                    if chat is not None:
                        done.append(chat.row())
                        if held > size:
                            yield batch()
                            done, held = [], 0
                    chat = _Chat(key)
                if present:
                    chat.add(turn, role, text)
                    held += len(role) + len(text)
        if chat is not None:
            done.append(chat.row())
            yield batch()

    return run


FAULTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    endings = Endings()
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for b in batches:
        costs, audits, repaired = [], [], []
        for signature, roles, texts in zip(*(b.column(c).to_pylist() for c in ("signature", "roles", "texts"))):
            cost, audit, turns = endings.solve(signature)
            costs.append(cost)
            audits.append(audit)
            out, last = [], len(roles) - 1
            for at, state in turns:
                role = "" if at < 0 else roles[last - at]
                fits = role[:1] == ("s" if state == SYSTEM else INITIAL[state])
                out.append({"role": role if fits else ROLE[state], "text": "" if at < 0 else texts[last - at]})
            repaired.append(out)
        yield pa.RecordBatch.from_arrays([b.column("id"), *(b.column(f) for f in FAULTS), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(repaired, turn)],
                                         ["id", *FAULTS, "cost", "audit", "repaired"])


def repair_chats(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 present: Column | None = None) -> DataFrame:
    """One row per conversation: id_col, the faults found, cost, audit and repaired (array of role, text).

    ``present`` marks rows that count; a conversation all of whose rows are absent is there with zeros.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    space = F.lit(" ")
    ordered = rows.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), space).alias("text"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))
    ordered = ordered.repartition("id").sortWithinPartitions("id", F.asc_nulls_first("turn"), "role", "text")
    text = pa.list_(pa.string())
    schema = pa.schema([("id", _arrow_type(ordered, "id")), *((f, pa.int64()) for f in FAULTS), ("signature", pa.string()), ("roles", text), ("texts", text)])
    faults = ", ".join(f"{f} long" for f in FAULTS)
    labelled = save(ordered.mapInArrow(_label(schema), f"id {kind}, {faults}, signature string, roles array<string>, texts array<string>"), "signatures")
    dealt = labelled.repartitionByRange("signature", "id").sortWithinPartitions("signature", "id")
    out = dealt.mapInArrow(_repair, f"id {kind}, {faults}, cost long, audit string, repaired array<struct<role:string,text:string>>")
    return out.withColumnRenamed("id", id_col)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
