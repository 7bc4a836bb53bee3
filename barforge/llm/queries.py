"""The numbered queries: QUERIES[name](spark, sf_dir) -> DataFrame and ORACLE[name] (DuckDB SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import (chat, chat_repair, embed_dedup, exact, filter_audit, license_scan, mixing, packing, quality, secret_scan,
                          simhash, suffix, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: the file of the tokenizer that op9 and the pipeline use
TOKENIZER = "word_bpe_49k.json"

def domain() -> Column:
    """Domain of a row of the given tables: one of four, by the source's number."""
    number = F.regexp_extract(F.col("source"), "([0-9]+)$", 1).try_cast("bigint")
    return F.concat(F.lit("domain"), F.pmod(F.coalesce(number, F.lit(0)), F.lit(4)))


#: target weights in whole parts: nine tenths of all tokens, no document more than twice
TARGETS = mixing.Targets(domains={"domain0": 30, "domain1": 25, "domain2": 25, "domain3": 20},
                         languages={"en": 55, "de": 15, "fr": 15, "es": 15}, sources={"src0": 2}, default=1,
                         budget=(9, 10), epochs=2, seed=42)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and class: 3-word shingles, 2 bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = secret_scan.scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def joined(kinds=None):
        kept = F.filter("spans", lambda x: x["kind"].isin(*kinds)) if kinds else F.col("spans")
        return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(("assign", "access", "hex")), 256).alias("base_sha256"), joined().alias("spans"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base test and verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.assess(docs).select("row.doc_id", *quality.MEASURES, "base_failed", "kept")


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and epoch that the mixture takes."""
    return mixing.select_mixture(read(spark, sf_dir, "documents"), TARGETS, domain(), keep=["doc_id"]).select(
        "row.doc_id", "domain", "lang", "source", "epoch", "n_tokens")


def _split_sql(parent: str, source: str, name: str, weights: dict[str, int], default: int) -> str:
    """Children of ``source`` (columns cap, b) with their budgets: the closed form of capped proportional shares."""
    w = "CASE " + " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END" if weights else str(default)
    return f"""(SELECT *, CASE WHEN is_full THEN cap WHEN w > 0 THEN least(cap, (greatest(b - used, 0)::HUGEINT * w) // greatest(open_w, 1)) ELSE 0 END::BIGINT AS budget FROM (
        SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY {parent}) AS used,
               sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY {parent}) AS open_w FROM (
        SELECT *, w > 0 AND cap::HUGEINT * rest <= greatest(b - caps, 0)::HUGEINT * w AS is_full FROM (
        SELECT *, coalesce(sum(cap) OVER o, 0) AS caps, sum(w) OVER (PARTITION BY {parent}) - coalesce(sum(w) OVER o, 0) AS rest
        FROM (SELECT *, {w} AS w FROM {source})
        WINDOW o AS (PARTITION BY {parent} ORDER BY CASE WHEN w > 0 THEN cap::DOUBLE / w ELSE 'inf'::DOUBLE END, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))))"""


def _mixing_sql(t: mixing.Targets) -> str:
    num, den = t.budget
    return f"""
    WITH d AS (SELECT doc_id, 'domain' || (coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT), 0) % 4) AS domain,
                      coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
                      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {t.epochs} AS cap FROM d GROUP BY ALL),
    langs AS (SELECT domain, lang, sum(cap) AS cap FROM leaves GROUP BY ALL),
    top AS {_split_sql("1::INT", f"(SELECT domain, sum(cap) AS cap, (SELECT sum(tokens)::HUGEINT * {num} // {den} FROM leaves) AS b FROM langs GROUP BY domain)", "domain", t.domains, t.default)},
    mid AS {_split_sql("domain", "(SELECT langs.*, top.budget AS b FROM langs JOIN top USING (domain))", "lang", t.languages, t.default)},
    low AS {_split_sql("domain, lang", "(SELECT leaves.*, mid.budget AS b FROM leaves JOIN mid USING (domain, lang))", "source", t.sources, t.default)},
    placed AS (SELECT d.*, e.epoch, low.budget - e.epoch * low.tokens AS room,
                      sum(d.n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source, e.epoch
                          ORDER BY md5('{t.seed}:' || e.epoch || ':' || coalesce(d.doc_id::VARCHAR, '')), d.n_tokens ROWS UNBOUNDED PRECEDING) AS upto
               FROM d JOIN low USING (domain, lang, source) JOIN (SELECT unnest(range({t.epochs}))::INT AS epoch) e
                 ON (e.epoch = 0 OR low.tokens > 0) WHERE low.budget > 0 OR low.tokens = 0)
    SELECT doc_id, domain, lang, source, epoch, n_tokens FROM placed WHERE upto <= room"""


ORACLE["op2_source_mixing"] = _mixing_sql(TARGETS)


def pack(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack(read(spark, sf_dir, "documents"))


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and conversation -7, formatted and read back from the output."""
    hard = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text"))
    chats = chat.format_chats(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own))
    back = chats.select("conv_id", "formatted", chat.parse_chat(F.col("formatted")).alias("turns"),
                        F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss_mask")), "").alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE["op4_chat_formatting"] = """
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
    e AS (SELECT *, replace(replace(replace(text, '\\', '\\\\'), '</', '<\\/'), '###', '#\\##') AS safe,
                 replace(replace(replace(replace(role, '\\', '\\\\'), '</', '<\\/'), '###', '#\\##'), ': ', ':\\ ') AS safe_role,
                 lag(role) OVER o AS before FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length(safe) + CASE WHEN role IS NOT DISTINCT FROM before THEN 7 ELSE length(safe_role) + 6 + 8 END)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archive; revisits take size and digest from what they refer to."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = warc.resolve_revisits(warc.archive(pages))
    revisit = F.col("type") == "revisit"
    return found.select("page_id", F.when(revisit, F.col("target_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                        F.when(revisit, F.col("target_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
                        F.col("type").alias("record_type"), F.when(revisit, F.col("target_page")).alias("refers_to"))


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of a label at cosine 0.98."""
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


ORACLE["op1_embedding_near_dedup"] = """
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
    u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND list_max(list_transform(e, lambda x: abs(x))) > 0),
    links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach(id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
    roots AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
    SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
    FROM v JOIN roots ON roots.id = v.vec_id"""


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 or more words that another document has too, in every document that has it."""
    return suffix.repeated_passages(read(spark, sf_dir, "documents"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document that states a licence."""
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def damaged(chats: DataFrame) -> DataFrame:
    """Conversations with planted faults: crc32 of id and turn, by 20, drops a row (present false), empties it, takes its
    ends of sentences, repeats it or gives it role user; nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, text = F.pmod(F.crc32(key.cast("binary")), F.lit(20)), F.coalesce("text", space)
    rows = chats.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                        (kind != 0).alias("present"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and repaired digest of every conversation after the planted damage."""
    found = chat_repair.repair_chats(damaged(read(spark, sf_dir, "conversations")), present=F.col("present"))
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return found.select("conv_id", *chat_repair.FAULTS, "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))


# CRC-32 from its polynomial, the damage, then costs from each conversation's end and the cheapest audit from its start.
# A state's best edit is a whole number, 4 * cost + letter (D, I, K, R), so the least number is the cheapest and then the least letter.
ORACLE["op11_conversation_repair"] = r"""
    WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
    src AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(key) + 1), lambda p: unicode(substr(key, p, 1))::BIGINT),
                              lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
            FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key,
                         dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g FROM conversations), crc),
    damaged AS (SELECT g, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                       CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                FROM src, (SELECT unnest([0, 1]) AS copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS ini,
                      rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM damaged),
    seen AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again, lag(ini) OVER (PARTITION BY g ORDER BY i) AS before,
                    count(*) OVER (PARTITION BY g) AS n FROM placed),
    rows AS MATERIALIZED (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
    faults AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                      count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM rows GROUP BY g),
    togo(g, i, b0, b1, b2, b3) AS (
        SELECT g, n + 1, 0::BIGINT, 41::BIGINT, 21::BIGINT, 0::BIGINT FROM faults
        UNION ALL
        SELECT g, i, least(e0, (5 + least(e2, (5 + e3 // 4) * 4 + 1) // 4) * 4 + 1), least(e1, (5 + least(e2, (5 + e3 // 4) * 4 + 1) // 4) * 4 + 1),
               least(e2, (5 + e3 // 4) * 4 + 1), least(e3, (5 + e2 // 4) * 4 + 1) FROM (
            SELECT t.g, r.i,
                   least((2 + b0 // 4) * 4, CASE WHEN stays AND ini = 's' THEN (more + b1 // 4) * 4 + 2 WHEN stays AND ini = 'u' THEN (more + b2 // 4) * 4 + 2 END, CASE WHEN stays THEN (1 + more + b2 // 4) * 4 + 3 END) AS e0,
                   least((2 + b1 // 4) * 4, CASE WHEN stays AND ini = 'u' THEN (more + b2 // 4) * 4 + 2 END, CASE WHEN stays THEN (1 + more + b2 // 4) * 4 + 3 END) AS e1,
                   least((2 + b2 // 4) * 4, CASE WHEN stays AND ini = 'a' THEN (more + b3 // 4) * 4 + 2 END, CASE WHEN stays THEN (1 + more + b3 // 4) * 4 + 3 END) AS e2,
                   least((2 + b3 // 4) * 4, CASE WHEN stays AND ini = 'u' THEN (more + b2 // 4) * 4 + 2 END, CASE WHEN stays THEN (1 + more + b2 // 4) * 4 + 3 END) AS e3
            FROM togo t JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM rows) r
              ON r.g = t.g AND r.i = t.i - 1)),
    best AS MATERIALIZED (SELECT g, i, unnest([0, 1, 2, 3]) AS state, unnest([b0, b1, b2, b3]) AS b FROM togo),
    walk(g, i, state, audit, said) AS (
        SELECT g, 1::BIGINT, 0, '', '' FROM faults
        UNION ALL
        SELECT w.g, CASE WHEN edit = 1 THEN w.i ELSE w.i + 1 END, CASE WHEN edit = 0 THEN w.state WHEN edit = 2 AND w.state = 0 AND r.ini = 's' THEN 1 WHEN w.state = 2 THEN 3 ELSE 2 END,
               audit || substr('DIKR', edit + 1, 1),
               CASE WHEN edit = 0 THEN w.said ELSE w.said || CASE WHEN w.said = '' THEN '' ELSE chr(10) END
                 || CASE WHEN edit = 2 THEN r.role WHEN w.state = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN edit = 1 THEN '' ELSE r.text END END
        FROM (SELECT w.*, (b % 4)::INT AS edit FROM walk w JOIN best USING (g, i, state) JOIN faults USING (g) WHERE w.i <= n OR state IN (1, 2)) w
        LEFT JOIN rows r ON r.g = w.g AND r.i = w.i),
    done AS (SELECT g, audit, said FROM walk JOIN faults USING (g) WHERE i = n + 1 AND state IN (0, 3))
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce((SELECT b // 4 FROM best WHERE best.g = c.g AND best.i = 1 AND state = 0), 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, g FROM src) c LEFT JOIN faults USING (g) LEFT JOIN done USING (g)"""


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts; the row of the largest id stays."""
    return exact.deduplicate(read(spark, sf_dir, "documents")).withColumnRenamed("sha256", "text_sha256")


ORACLE["op12_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


@query
def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each of their 120 orders, by language."""
    return filter_audit.audit_texts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLE["op13_filter_interaction_audit"] = r"""
    WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    d AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS later FROM t),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    m AS (SELECT part, (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
                 || (CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END)
                 || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN later THEN 'E' ELSE '' END) AS fails,
                 coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM d LEFT JOIN l USING (doc_id)),
    c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
    f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT c.*, filter_order, step, substr(filter_order, step, 1) AS filter, contains(fails, substr(filter_order, step, 1)) AS failing,
                 len(translate(substr(filter_order, 1, step - 1), fails, '')) < step - 1 AS gone_before
          FROM c, o, (SELECT unnest(range(1, 6))::INT AS step) g),
    r AS (SELECT part, filter_order, step, filter, sum(CASE WHEN NOT gone_before AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN failing AND NOT gone_before THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN failing AND gone_before THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN fails = filter THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN failing AND NOT gone_before THEN good ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN failing AND NOT gone_before THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
          FROM s GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r"""
