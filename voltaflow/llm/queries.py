"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.llm import (bpe, chat, decontaminate, licences, neighbours, packing, pii, repair, sharding, simhash,
                           toxicity, trie, warc)
from voltaflow.sources.tables import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def archived_pages(pages: DataFrame) -> DataFrame:
    manifest, folder = warc.archive(pages)
    return warc.read(manifest, folder).select(
        warc.key_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.key_of("refers_to").alias("refers_to"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(read_table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                         toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    model = bpe.serialise(bpe.read_ranks(ranks_path))
    coded = docs.select("doc_id", bpe.encode(F.col("text"), model, pattern).alias("ids"))
    both = coded.withColumn("raw", bpe.decode(F.col("ids"), model))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("raw"), 256).alias("decoded_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(chat.from_turns(read_table(spark, sf_dir, "conversations")), chat.TOOLS)


def private_spans(docs: DataFrame) -> DataFrame:
    found = docs.select("doc_id", pii.find(F.col("text")).alias("found"))
    s = F.col("found")
    return found.select(
        "doc_id", *[pii.count(s, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.joined(F.filter(s, lambda x: x["base"])), 256).alias("base_sha256"),
        pii.joined(s).alias("spans"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", licences.scan(F.col("text"), licences.train(docs)).alias("found"))
    return found.select("doc_id", F.size("found").alias("n_found"),
                        F.array_join(F.sort_array(F.array_distinct(F.col("found.family"))), ",").alias("families"),
                        F.array_max("found.probability").alias("probability"),
                        F.col("found.start").alias("starts"), F.col("found.end").alias("ends"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.summary(repair.damage(read_table(spark, sf_dir, "conversations")))


def packed(docs: DataFrame, vocabulary_path: str, pattern: str, capacity: int = packing.CAPACITY) -> DataFrame:
    with open(vocabulary_path, encoding="utf-8") as f:
        return packing.pack(packing.pieces(docs, f.read(), pattern, capacity), capacity)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(trie.turns(read_table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_neighbours": op2_neighbours,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_bpe": op6_bpe,
    "op7_chat": op7_chat,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_licences": op10_licences,
    "op11_repair": op11_repair,
    "op12_packing": op12_packing,
    "op13_trie": op13_trie,
}


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, bit by bit (DuckDB has no function for it)."""
    return f"""xor(list_reduce([4294967295::BIGINT] || [ord(x)::BIGINT FOR x IN string_split({text}, '')],
            lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT FOR _ IN range(8)],
                lambda v, _: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""


#: DuckDB SQL of the queries that SQL can express.
ORACLE = {
    "op3_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        q AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
        FROM q""",
    # keys of documents are unique, so no overflow shards arise
    "op5_sharding": f"""
        WITH d AS (
            SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
                   ('0x' || substr(md5(coalesce('=' || doc_id, 'null')), 1, 15))::BIGINT AS h
            FROM documents),
        p AS (
            SELECT doc_id, bytes, k::INT AS depth, h >> (60 - k)::INT AS prefix, sum(bytes) OVER (
                PARTITION BY k, h >> (60 - k)::INT) AS total
            FROM d, generate_series(0, 60) AS g(k)),
        f AS (
            SELECT doc_id, bytes, depth, prefix, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS nth
            FROM p WHERE total <= {sharding.SHARD_BYTES} OR depth = 60)
        SELECT doc_id, bytes, depth, bytes > {sharding.SHARD_BYTES} AS oversize,
               CASE WHEN depth = 0 THEN '*' ELSE right(lpad(bin(prefix), 64, '0'), depth) END
               || CASE WHEN bytes > {sharding.SHARD_BYTES} THEN '+' ELSE '' END AS shard
        FROM f WHERE nth = 1""",
    "op11_repair": f"""
        WITH RECURSIVE d AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
            FROM conversations),
        e AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM d, generate_series(1, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
        o AS (
            SELECT *, row_number() OVER w AS i,
                   lag(left(role, 1)) OVER w AS before, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
            FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
        r AS (
            SELECT conv_id, turn, i, role, text, left(role, 1) AS initial, before || left(role, 1) AS pair,
                   CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM o),
        f AS (
            SELECT conv_id, max(i) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM r GROUP BY conv_id),
        ins(q, p, cost, audit, body) AS (  -- inserted turns that lead from state to state (0, s: 1, u: 2, a: 3)
            VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
                   (0, 2, 2, 'I', '\nuser:'), (1, 2, 2, 'I', '\nuser:'), (3, 2, 2, 'I', '\nuser:'), (2, 3, 2, 'I', '\nassistant:'),
                   (0, 3, 4, 'II', '\nuser:\nassistant:'), (1, 3, 4, 'II', '\nuser:\nassistant:'),
                   (3, 3, 4, 'II', '\nuser:\nassistant:'), (2, 2, 4, 'II', '\nassistant:\nuser:')),
        best(conv_id, i, q, cost, audit, body) AS (
            SELECT DISTINCT conv_id, 0::BIGINT, 0, 0::BIGINT, '', '' FROM conversations
            UNION ALL
            SELECT conv_id, i, q, cost, audit, body FROM (
                SELECT b.conv_id, r.i, x.to_ AS q, b.cost + ins.cost + x.cost AS cost, b.audit || ins.audit || x.edit AS audit,
                       b.body || ins.body || x.line AS body
                FROM best AS b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN ins ON ins.q = b.q,
                LATERAL (
                    SELECT 'D' AS edit, 3 AS cost, ins.p AS to_, '' AS line
                    UNION ALL
                    SELECT 'K', (r.fault = 'truncated')::INT, CASE r.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END,
                           '\n' || r.role || ':' || r.text
                    WHERE r.fault NOT IN ('blank', 'duplicate') AND ((r.initial = 's' AND ins.p = 0)
                        OR (r.initial = 'u' AND ins.p <> 2) OR (r.initial = 'a' AND ins.p = 2))
                    UNION ALL
                    SELECT 'R', 2 + (r.fault = 'truncated')::INT, CASE ins.p WHEN 2 THEN 3 ELSE 2 END,
                           CASE ins.p WHEN 2 THEN '\nassistant:' ELSE '\nuser:' END || r.text
                    WHERE r.fault NOT IN ('blank', 'duplicate')) AS x)
            QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
        z AS (
            SELECT b.conv_id, b.cost + ins.cost AS cost, b.audit || ins.audit AS audit, b.body || ins.body AS body
            FROM best AS b LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id JOIN ins ON ins.q = b.q
            WHERE b.i = coalesce(f.size, 0) AND ins.p IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + ins.cost, b.audit || ins.audit) = 1)
        SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit, sha256(substr(body, 2)) AS repaired_sha256
        FROM z LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM z.conv_id""",
    "op13_trie": f"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (
            SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("conv_id::VARCHAR")} % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
        r AS (
            SELECT c.conv_id, 0 AS part, p, role, text FROM c JOIN t ON t.conv_id = c.base AND p <= h
            UNION ALL
            SELECT c.conv_id, 1, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
        d AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth,
                   len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
                   md5(strlen(role) || ':' || role || ':' || text) AS token
            FROM r),
        m AS (  -- every beginning of every conversation
            SELECT conv_id, depth, words, sha256(string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix FROM d
            UNION ALL SELECT conv_id, 0, 0, '' FROM c),
        n AS (
            SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = size), '') AS ends
            FROM m JOIN (SELECT conv_id, max(depth) AS size FROM m GROUP BY conv_id) USING (conv_id) GROUP BY depth, prefix),
        p AS (  -- with the node above
            SELECT n.*, up.prefix AS above FROM n LEFT JOIN m AS up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1),
        k AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY ALL),
        s AS (  -- sums over subtrees: each node counts for all nodes above it
            SELECT up.depth, up.prefix, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
            FROM n LEFT JOIN k USING (depth, prefix) JOIN m AS up ON up.conv_id = n.conv_id AND up.depth <= n.depth
            GROUP BY up.depth, up.prefix)
        SELECT p.conv_id, p.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, p.n_convs::BIGINT AS n_convs,
               coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
               sha256(p.ends) AS ends_sha256
        FROM p LEFT JOIN k USING (depth, prefix) JOIN s USING (depth, prefix)
        LEFT JOIN n AS o ON o.depth = p.depth - 1 AND o.prefix = p.above""",
}
