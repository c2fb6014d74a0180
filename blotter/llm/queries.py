"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (ann, bm25, conversations, langid, mixing, mixture_packing, packing, prefix_counts,
               resampling, sharding, simhash, token_files, warc)
from .common import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1: mixing sources to target weights ------------------------------------------
OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce('0' || source, '1') AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS h, text
  FROM documents),
src AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY 1),
ranked AS (SELECT *, (row_number() OVER (ORDER BY skey) - 1) % 3 AS k FROM src),
w AS (SELECT *, CASE k WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             CASE k WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.5::DOUBLE END AS slope,
             source_size * 2.0::DOUBLE AS cap,
             CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM ranked),
c AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS capped,
             sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open
      FROM w WINDOW b AS (ORDER BY cap / weight, skey
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, (budget - capped) / open AS rate FROM c),
rate AS (SELECT (budget - capped) / open AS level FROM r WHERE rate * weight <= cap
         ORDER BY capped, rate LIMIT 1),
t AS (SELECT skey, source_size, weight, weight * (1 + slope) AS w0, weight * (1 - slope) AS w1,
             least(cap, coalesce((SELECT level FROM rate) * weight, cap)) AS target FROM r),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.weight, t.w0, t.w1,
             coalesce(sum(d.size) OVER (PARTITION BY d.skey ORDER BY d.h, d.doc_id, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM docs d JOIN t USING (skey)),
taken AS (SELECT *, greatest(least(floor(target) - start, size), 0) AS t0,
                 greatest(least(floor(target) - (start + source_size), size), 0) AS t1,
                 CAST(start AS DOUBLE) / nullif(target, 0) * weight AS y FROM o)
SELECT doc_id, size, source_size, target, CAST(t0 + t1 AS BIGINT) AS taken,
       CASE WHEN t0 > 0 THEN round(CASE WHEN y >= (w0 + w1) / 2 THEN 1
            WHEN y > 0 THEN 2 * y / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * y)) ELSE 0 END, 9)
       END AS position
FROM taken
"""


@register("op1_mix_curriculum", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_mix(mixing.plan_mix(table(spark, sf_dir, "documents"), carry=["doc_id"]))


# --- 2: sharding --------------------------------------------------------------------
@register("op2_shard_differencing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return s.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


# --- 3: approximate nearest neighbours ------------------------------------------------
@register("op3_learned_partitions")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % ann.QUERY_EVERY == 0)


# --- 4: WARC derivatives ------------------------------------------------------------
@register("op4_warc_derivatives")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.derivatives(warc.responses_of_pages(table(spark, sf_dir, "pages"))), path)
    h = F.col("headers")
    source = F.coalesce(h["WARC-Source-Payload-Digest"],
                        F.regexp_extract("block", r"source-payload-digest: (\S+)", 1))
    return warc.read_warc(spark, path).select(
        h["WARC-Type"].alias("record_type"), h["WARC-Record-ID"].alias("record_id"),
        h["WARC-Refers-To"].alias("refers_to"), h["WARC-Concurrent-To"].alias("concurrent_to"),
        h["WARC-Target-URI"].alias("target_uri"), h["WARC-Date"].alias("date"),
        h["Content-Type"].alias("content_type"), h["WARC-Block-Digest"].alias("block_digest"),
        h["Content-Length"].cast("long").alias("content_length"),
        source.alias("source_payload_digest"), F.md5(F.col("block").cast("binary")).alias("block_md5"))


# --- 5: token-id files --------------------------------------------------------------
VOCABULARY = "byte_bpe_50k.json"


@register("op5_token_parquet")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(VOCABULARY), path)
    return token_files.checksums(token_files.read_token_files(spark, path))


# --- 6: exact top-k search ------------------------------------------------------------
@register("op6_block_max_wand")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0)


# --- 7: best-fit packing ------------------------------------------------------------
@register("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.numbered_bins(packing.pack(table(spark, sf_dir, "documents")))


# --- 8: token counts ----------------------------------------------------------------
@register("op8_prefix_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.budgets(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path(VOCABULARY))


# --- 9: language ID -----------------------------------------------------------------
@register("op9_hyperdimensional_langid")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


# --- 10: SimHash near-dedup ---------------------------------------------------------
@register("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return g.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                    "component_id")


# --- 11: importance resampling ------------------------------------------------------
OP11_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS crc),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
goal AS (
  SELECT unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
seen AS (SELECT r, unnest(words) AS w FROM docs),
vocabulary AS (
  SELECT w, xor(list_reduce(list_transform(range(strlen(w)), lambda i:
              16 * (instr('0123456789ABCDEF', substr(hex(w), CAST(2 * i + 1 AS INTEGER), 1)) - 1)
              + instr('0123456789ABCDEF', substr(hex(w), CAST(2 * i + 2 AS INTEGER), 1)) - 1),
            lambda c, b: xor(c // 256, crc[1 + xor(c % 256, b)]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM seen UNION SELECT w FROM goal), tab),
s AS (SELECT bucket, count(*) AS s FROM seen JOIN vocabulary USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN vocabulary USING (w) GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM seen) + 10000.0::DOUBLE AS s_all,
             (SELECT count(*) FROM goal) + 10000.0::DOUBLE AS t_all),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all
                                 / ((s + 1)::DOUBLE * t_all))) AS g
  FROM s LEFT JOIN t USING (bucket), n),
weight AS (SELECT r, count(*) AS n, floor(sum(g) / count(*)) AS weight
           FROM seen JOIN vocabulary USING (w) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(list_transform(range(1, 9),
           lambda i: instr('0123456789abcdef', substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')),
                           CAST(i AS INTEGER), 1)) - 1), lambda a, d: a * 16 + d) + 0.5::DOUBLE)
           / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weight USING (r)),
drawn AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
            PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC)
          END AS place FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20)
            THEN place END AS rank
FROM drawn
"""


@register("op11_importance_resampling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


# --- 12: conversation repair --------------------------------------------------------
OP12_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS crc),
keyed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS conv, conv_id, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
fated AS (
  SELECT *, xor(list_reduce(list_transform(range(1, strlen(key) + 1), lambda i:
                  ascii(substr(key, CAST(i AS INTEGER), 1))),
                lambda c, b: xor(c // 256, crc[1 + xor(c % 256, b)]), 4294967295), 4294967295) % 20 AS fate
  FROM keyed, tab),
damaged AS (
  SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, fate,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM damaged),
marked AS (
  SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS letter,
         CASE WHEN last = '' THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
              WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE 'f' END AS mark FROM placed),
neighbours AS (SELECT *, lag(letter) OVER (PARTITION BY conv ORDER BY i) || letter AS pair FROM marked),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (mark = 'b') AS blank, count(*) FILTER (mark = 'd') AS duplicate,
         count(*) FILTER (mark = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM neighbours GROUP BY 1),
inserts(p, j, q, said) AS (VALUES
  (0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
  (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
  (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
  (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])),
edits(q, s, edit, letter, cost) AS (VALUES
  (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0), (3, 2, 'K', 'u', 0),
  (0, 2, 'R', NULL, 1), (1, 2, 'R', NULL, 1), (2, 3, 'R', NULL, 1), (3, 2, 'R', NULL, 1),
  (0, 0, 'D', NULL, 2), (1, 1, 'D', NULL, 2), (2, 2, 'D', NULL, 2), (3, 3, 'D', NULL, 2)),
walk AS (
  SELECT conv, CAST(0 AS BIGINT) AS i, 0 AS state,
         struct_pack(cost := CAST(0 AS BIGINT), audit := '', said := CAST([] AS VARCHAR[])) AS best
  FROM (SELECT DISTINCT conv FROM damaged)
  UNION ALL
  SELECT w.conv, w.i + 1, e.s, min(struct_pack(
           cost := CAST(w.best.cost + 5 * n.j + e.cost
                        + CASE WHEN m.mark = 't' AND e.edit <> 'D' THEN 5 ELSE 0 END AS BIGINT),
           audit := w.best.audit || repeat('I', n.j) || e.edit,
           said := w.best.said || n.said || CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [m.role || ':' || m.text]
             ELSE [CASE e.s WHEN 2 THEN 'user:' ELSE 'assistant:' END || m.text] END))
  FROM walk w JOIN marked m ON m.conv = w.conv AND m.i = w.i + 1 JOIN inserts n ON n.p = w.state
       JOIN edits e ON e.q = n.q AND (e.letter IS NULL OR e.letter = m.letter)
            AND (m.mark NOT IN ('b', 'd') OR e.edit = 'D')
  GROUP BY ALL),
ended AS (
  SELECT w.conv, min(struct_pack(
           cost := w.best.cost + CASE w.state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
           audit := w.best.audit || CASE w.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
           said := w.best.said || CASE w.state WHEN 1 THEN ['user:', 'assistant:']
                                  WHEN 2 THEN ['assistant:'] ELSE [] END)) AS best
  FROM walk w WHERE w.i = (SELECT max(m.i) FROM marked m WHERE m.conv = w.conv) GROUP BY 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM keyed) LEFT JOIN counts USING (conv) LEFT JOIN ended USING (conv)
"""


@register("op12_conversation_repair", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.with_digests(*conversations.repair(rows, copies))


# --- 13: mixture-controlled packing -------------------------------------------------
WORD_VOCABULARY = "word_bpe_49k.json"


@register("op13_mixture_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY),
                                checksums=True)
