"""Operators 11 to 13 against brute force: nulls, blanks, ties, copies, long texts, clashing columns, empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from barforge.llm import chat_repair, exact, filter_audit, queries
from tests.llm.test_operators import DOC, WORD, corpus
from tests.oracle_check import compare

COLLIDING = lambda text: len(text) % 3


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC).repartition(3).cache()


def by_key(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("kw", [{}, {"bucket_bytes": 300, "table_bytes": 100}, {"hashed": COLLIDING},
                                {"hashed": COLLIDING, "bucket_bytes": 500, "table_bytes": 0}])
def test_exact(spark, docs, kw):
    rows = [r[:2] for r in corpus()] + [(100 + i, "hot copy of a text") for i in range(60)] + [(7, "hot copy of a text")] * 2
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, rep string, n long").repartition(6)
    got = exact.deduplicate(table, **kw).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = [(i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows]
    assert by_key((r[0], r[1], r[2], r[4]) for r in got) == by_key(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept) and sum(r.kept for r in got) == len(groups)


def test_exact_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact.deduplicate(none).count() == 0
    rows = [(None, "a"), (None, "a"), ("x", "A"), ("y", "a "), ("z", None), ("w", "")]
    got = exact.deduplicate(spark.createDataFrame(rows, "name string, body string"), "name", "body", normalise=lambda c: F.lower(F.trim(c))).collect()
    assert by_key((r.name, r.keep_id, r.group_size, r.kept) for r in got if r.name) == by_key([("x", "y", 4, False), ("y", "y", 4, True), ("z", "z", 2, True), ("w", "z", 2, False)])
    only = exact.deduplicate(spark.createDataFrame(rows[:2], "doc_id string, text string")).collect()
    assert sorted(r.kept for r in only) == [False, True] and {r.keep_id for r in only} == {None}


def test_content_table_compares_whole_contents():
    table, texts = exact.ContentTable(), [bytes([i % 50]) * (i % 7) for i in range(1000)]
    numbers = {}
    for t in texts:
        k, new = table.place(5, t)
        assert new == (t not in numbers) and numbers.setdefault(t, k) == k


def brute_audit(roles, texts):
    """All edit sequences of a short conversation with up to two inserts in each gap."""
    faults, seen = [], set()
    for r, t in zip(roles, texts):
        s = t.rstrip(" \t\n\v\f\r")
        faults.append("x" if not s or (r, t) in seen else "T" if s[-1] not in ".!?" else "")
        seen.add((r, t))
    gaps = [tuple(("I", 5, (x, "")) for x in c) for n in range(3) for c in itertools.product(("user", "assistant"), repeat=n)]
    steps = []
    for r, t, f in zip(roles, texts, faults):
        more = 5 if f == "T" else 0
        steps.append([(("D", 2, None),)] + ([] if f == "x" else [(("K", more, (r, t)),), (("R", 1 + more, ("user", t)),), (("R", 1 + more, ("assistant", t)),)]))
    options = [gaps]
    for s in steps:
        options += [s, gaps]
    best = None
    for pick in itertools.product(*options):
        edits = [e for part in pick for e in part]
        if re.fullmatch("(s?(ua)+)?", "".join(e[2][0][:1] for e in edits if e[2])):
            key = (sum(e[1] for e in edits), "".join(e[0] for e in edits))
            if best is None or key < best[0]:
                best = (key, [e[2] for e in edits if e[2]])
    return best


def faults_of(rows):
    """gaps, blank, duplicate, truncated, illegal of rows (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    count, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, set()
    for _, r, t in rows:
        said = re.sub(r"[\x20\x09-\x0D]+$", "", t)
        fault = "blank" if not said else "duplicate" if (r, t) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((r, t))
        if fault:
            count[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), illegal)


def test_audit_of_all_short_conversations():
    """Every conversation of up to two rows, all sorted as a task sees them, against all edit sequences."""
    cases = []
    for n in range(3):
        for kinds in itertools.product(itertools.product(("system", "user", "assistant", "tool"), ("ok.", "cut", " ")), repeat=n):
            roles, texts = [k[0] for k in kinds], [k[1] if k[1] != "ok." else f"ok {i}." for i, k in enumerate(kinds)]
            chat = chat_repair._Chat(0)
            for i, (r, t) in enumerate(zip(roles, texts)):
                chat.add(i, r, t)
            cases.append((chat.row()[6], roles, texts))
    endings = chat_repair.Endings()
    for signature, roles, texts in sorted(cases):
        (cost, audit), _ = brute_audit(roles, texts)
        assert endings.solve(signature)[:2] == (cost, audit), (roles, texts)


def forward(signature):
    """Cheapest audit of a signature in reading order, by a search over (row, state, inserts in a row)."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def go(i, state, inserts):
        found = [(0, "")] if i == len(signature) and state in ("", "a") else []
        if inserts < 3:
            for to in follow[state]:
                if to != "s":
                    c, a = go(i, to, inserts + 1)
                    found.append((5 + c, "I" + a))
        if i < len(signature):
            c, a = go(i + 1, state, 0)
            found.append((2 + c, "D" + a))
            x = signature[i]
            if x != "x":
                for to in follow[state]:
                    more = 5 * x.isupper()
                    c, a = go(i + 1, to, 0)
                    if x.lower() == to:
                        found.append((more + c, "K" + a))
                    if to != "s":
                        found.append((1 + more + c, "R" + a))
        return min(found, default=(10 ** 9, ""))

    return go(0, "", 0)


def test_audit_of_longer_conversations():
    rng = random.Random(3)
    cases = ["".join(rng.choice("xsuaoSUAO" + "uaua" * 2) for _ in range(rng.randint(3, 14))) for _ in range(600)]
    endings = chat_repair.Endings()
    for x in sorted(c[::-1] for c in cases):
        assert endings.solve(x)[:2] == forward(x[::-1]), x[::-1]


CHAT = "conv_id long, turn long, role string, text string, id int, cost string, repaired string, present string"


def damage(rows):
    for c, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out = (c, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
        yield from ((*out, k != 0),) * (2 if k == 3 else 1)


def test_repair(spark):
    rng = random.Random(5)
    rows = [(c, None if rng.random() < .05 else t, rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
             rng.choice(["Yes.", "no", " ", None, "Why?\n", "long " * 2000, f"turn {t}!"])) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(None, 1, "user", "hi."), (None, 2, "assistant", "ho."), *[(c, t, r, f"{r}.") for c in range(900, 960) for t, r in enumerate(["user", "assistant"])]]
    table = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], CHAT).repartition(4)
    got = {r.conv_id: r for r in chat_repair.repair_chats(queries.damaged(table.drop("present")), present=F.col("present")).collect()}
    want = {}
    for r in damage(rows):
        want.setdefault(r[0], []).extend([r[1:4]] if r[4] else [])
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        chat = chat_repair._Chat(c)
        for r in turns:
            chat.add(*r)
        cost, audit = forward(chat.row()[6][::-1])
        found = got[c]
        assert (found.gaps, found.blank, found.duplicate, found.truncated, found.illegal, found.cost, found.audit) == (*faults_of(turns), cost, audit), (c, turns)
        # the audit, replayed, gives the repaired turns
        at, out = 0, []
        for e in audit:
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if e == "K":
                out.append(turns[at][1:])
            elif e == "R":
                out.append((role, turns[at][2]))
            elif e == "I":
                out.append((role, ""))
            at += e != "I"
        assert [tuple(t) for t in found.repaired] == out and at == len(turns)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))


def test_repair_edges(spark):
    none = spark.createDataFrame([], CHAT)
    assert chat_repair.repair_chats(none).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "a", False), (2, 0, "user", "Same.", True), (2, 0, "user", "Same.", True)], "conv_id long, turn long, role string, text string, present boolean")
    got = {r.conv_id: tuple(r)[1:] for r in chat_repair.repair_chats(gone, present=F.col("present")).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", []) and got[2][:7] == (0, 0, 1, 0, 1, 4, "DD")


def test_long_conversation():
    chat, endings = chat_repair._Chat(1), chat_repair.Endings()
    for i in range(100_000):
        chat.add(i, ("user", "assistant")[i % 2], f"turn {i}.")
    assert endings.solve(chat.row()[6])[:2] == (0, "K" * 100_000)


def brute_removal(rows, names, weights):
    """rows: (part, set of failing filters, weights)."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = dict.fromkeys(names, 0)
        for order in itertools.permutations(names):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine),
                                                   *(sum(r[2][w] for r in gone) for w in range(weights)), f]
        for k, v in out.items():
            if k[0] == part and isinstance(v[-1], str):
                v[-1] = total[v[-1]]
    return out


def test_interaction_audit(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["p", "q", None]), *[rng.choice([True, False, False, None]) for _ in range(3)], rng.choice([0, 1, 5, None])) for _ in range(300)]
    table = spark.createDataFrame(rows, "part string, x boolean, y boolean, z boolean, n int").repartition(3)
    got = filter_audit.interaction_audit(table, {c: F.col(c) for c in "xyz"}, F.col("part"), {"w": F.col("n")}).collect()
    want = brute_removal([(r[0] or "", {c for c, v in zip("xyz", r[1:4]) if v}, [r[4] or 0]) for r in rows], "xyz", 1)
    assert {tuple(r)[:3]: list(r)[3:] for r in got} == want and len(got) == len(want)
    assert filter_audit.interaction_audit(table.limit(0), {"x": F.col("x")}, F.col("part")).count() == 0
    with pytest.raises(ValueError):
        filter_audit.interaction_audit(table, {}, F.col("part"))


def test_audit_texts(spark, docs):
    marks = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 24, 2)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (4, None, None)]
    labels = spark.createDataFrame([(*m, "clash") for m in marks], "doc_id long, quality int, toxic int, lang string")
    good, toxic = ({i for i, *v in marks if i is not None and v[k] == 1} for k in (0, 1))
    rows = []
    for i, text, lang, *_ in corpus():
        t = text or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in corpus())}
        rows.append((lang or "", {f for f, v in fails.items() if v}, [int(i in good), int(i in toxic)]))
    got = filter_audit.audit_texts(docs, labels).collect()
    assert {tuple(r)[:3]: list(r)[3:] for r in got} == brute_removal(rows, "ABCDE", 2)
    assert filter_audit.audit_texts(docs.limit(0), labels).count() == 0 and filter_audit.audit_texts(docs, labels.limit(0)).count() == len(got)


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_exact_dedup", "op13_filter_interaction_audit"])
def test_query_matches_sql(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), queries.ORACLE[name], sf)


def test_repair_query(spark, sf):
    got = queries.QUERIES["op11_conversation_repair"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {}
    for r in damage(rows):
        want.setdefault(r[0], []).extend([r[1:4]] if r[4] else [])
    found = {r.conv_id: r for r in got.collect()}
    assert set(found) == set(want)
    for c, turns in want.items():
        turns.sort(key=lambda r: r[0])
        chat = chat_repair._Chat(c)
        for r in turns:
            chat.add(*r)
        r = found[c]
        assert tuple(r)[1:8] == (*faults_of(turns), *forward(chat.row()[6][::-1]))
        if r.audit == "K" * len(turns):
            assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{x}:{t}" for _, x, t in turns).encode()).hexdigest()
