"""The label model and the whole pipeline against plain Python, SQL and the tokenizer itself."""

import math
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex

from barforge.llm import quality, queries
from barforge.llm.secret_scan import redact, scan
from tests.llm.test_operators import WORD, brute_components, brute_fp, brute_quality

SPACE = " \t\n\v\f\r"


def brute_votes(text):
    """The ten rules' votes by their definition."""
    n, chars, symbols, dup, repeat = brute_quality(text)
    t = text or ""
    lines = [x for x in t.split("\n") if WORD.search(x)]
    upper, digits, shouts = (sum(c in s for c in t) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!?"))
    odd = len(regex.sub(r"[\p{L}\p{N}\x20\x09-\x0D.,]+", "", t))
    ended = sum(x.rstrip(SPACE)[-1] in ".!?:;\"')]" for x in lines)
    pairs = [(n < 50, n >= 80), (symbols > .1 * n, symbols <= .01 * n), (chars < 2.5 * n or chars > 10 * n, 3 * n <= chars <= 8 * n),
             (dup > .3 * len(lines), len(lines) > 2 and dup == 0), (repeat > .3 * n, repeat <= .1 * n), (upper > .3 * chars, upper <= .1 * chars),
             (shouts > .1 * n, shouts <= .02 * n), (odd > .04 * chars, odd <= .01 * chars), (ended < .3 * len(lines), ended >= .8 * len(lines)),
             (digits > .2 * chars, digits <= .05 * chars)]
    return tuple(-1 if bad else 1 if good else 0 for bad, good in pairs), n < 50 or 100 * repeat > 50 * n


def brute_em(votes):
    """Posterior of every document, by expectation-maximisation over documents (not over vote vectors)."""
    v = np.array(votes) + 1
    n, k = v.shape
    prior, good, bad = quality.START_PRIOR, np.tile(quality.START_GOOD, (k, 1)), np.tile(quality.START_BAD, (k, 1))

    def posterior():
        ratio = np.log(good / bad)[np.arange(k), v].sum(axis=1) + math.log(prior / (1 - prior))
        return 1 / (1 + np.exp(-ratio))

    for _ in range(quality.ROUNDS):
        q, few = posterior(), quality.SMOOTH * n
        seen = np.stack([(v == x) for x in range(3)], axis=2)
        good = ((seen * q[:, None, None]).sum(axis=0) + few * np.array(quality.START_GOOD)) / (q.sum() + few)
        bad = ((seen * (1 - q)[:, None, None]).sum(axis=0) + few * np.array(quality.START_BAD)) / (n - q.sum() + few)
        before, prior = prior, min(max(q.mean(), quality.PRIOR_RANGE[0]), quality.PRIOR_RANGE[1])
        if abs(prior - before) < 1e-5:
            break
    return posterior()


def test_label_model(spark, sf):
    got = {r.doc_id: r for r in quality.assess(spark.read.parquet(f"{sf}/documents.parquet")).select("row.doc_id", "row.text", "votes", "probability", "kept").collect()}
    votes = {i: brute_votes(r.text) for i, r in got.items()}
    assert all(tuple(r.votes) == votes[i][0] for i, r in got.items())
    want = dict(zip(got, brute_em([votes[i][0] for i in got])))
    assert all(r.probability == pytest.approx(want[i], abs=1e-9) and r.kept == (not votes[i][1] and want[i] >= quality.THRESHOLD) for i, r in got.items())


def test_pipeline_equals_brute_force(spark, sf):
    import corpus_pipeline as P
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    votes = [brute_votes(d["text"]) for d in docs]
    docs = [d for d, p, (_, failed) in zip(docs, brute_em([v for v, _ in votes]), votes) if not failed and p >= quality.THRESHOLD]
    fps = [brute_fp(d["text"]) for d in docs]
    root = brute_components(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    docs = [d for d, r in zip(docs, root) if d["doc_id"] == min(e["doc_id"] for e, s in zip(docs, root) if s == r)]
    for d in docs:
        d["text"] = redact(d["text"], scan(d["text"]))
    documents = pa.table({c: [d[c] for d in docs] for c in ("doc_id", "text", "lang", "source")})  # read by the SQL by its name
    con = duckdb.connect()
    con.register("documents", documents)
    mixed = [r[0] for r in con.sql(f"SELECT doc_id FROM ({queries.ORACLE['op2_source_mixing']})").fetchall()]
    text = {d["doc_id"]: d["text"] for d in docs}
    model = Tokenizer.from_file(str(public_tokenizers.path(queries.TOKENIZER)))
    want = []
    for i in mixed:
        ids = [*model.encode(text[i], add_special_tokens=False).ids, 1]
        want += [(i, p, p * 4096, len(ids[p * 4096:(p + 1) * 4096]), zlib.crc32(np.array(ids[p * 4096:(p + 1) * 4096], dtype="<u4").tobytes())) for p in range(-(-len(ids) // 4096))]
    got = P.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(p)]).tolist()]
        assert [o for o, _ in sorted(p)] == ends[:-1] and ends[-1] <= 4096
    assert len(places) <= -(-sum(w[3] for w in want) // 4096) + 2
