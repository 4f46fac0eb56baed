"""The registered queries of the corpus operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html, licences, merkle, packing, radix, simhash, spelling, token_counts, token_files, toxicity, windows
from .common import table
from .tokens import vocabulary_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(), window=1024, end_id=0)


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_file_folder(spark)
    shards = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary_path(), end_id=2)
    return token_files.read_token_files(shards, folder).select(
        "doc_id", F.col("before").alias("start"), "n_tokens", "ids_crc32"
    )


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2)


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(k) AS text_sha256
FROM d WINDOW w AS (PARTITION BY k ORDER BY length(t) DESC, doc_id)
"""


@query("op7_exact_dedup", OP7_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.copies(table(spark, sf_dir, "documents"))


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_licences", licences.licence_sql())
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS place
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'
), shown AS (
  SELECT t.conv_id, s.speaker, (place - 1) // 256 AS part, place, role = speaker AS own,
         CASE WHEN role = speaker THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user|>' || role || chr(10) END AS head, text || '<|end|>' AS said
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, length(head) + sum(length(head) + length(said) + 1) OVER (
    PARTITION BY conv_id, speaker, part ORDER BY place) - length(head) - length(said) - 1 AS ahead FROM shown
)
SELECT conv_id, speaker, part, string_agg(head || said || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CASE WHEN own THEN ahead || '-' || (ahead + length(said)) END, ',' ORDER BY place), '') AS mask,
       count(*) AS n_turns, count(*) FILTER (own) AS n_learnt
FROM placed GROUP BY ALL
"""


@query("op3_chat_perspectives", OP3_SQL)
def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


@query("op4_main_text")
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


@query("op5_repeated_passages")
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.repeated_passages(table(spark, sf_dir, "documents"))


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path(), limit=1024)


# crc32 of the decimal id by its table, then every level of both trees, the runs on each row's way, and the fold.
OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t FROM range(256) r(i)
), f AS (
  SELECT doc_id, source, text,
         concat_ws('', coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) AS head,
         xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, crc
), d AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS forged
  FROM f
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS rid FROM d
), up AS (
  SELECT 0 AS level, source, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT level + 1, source, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY level, source, pos // 16
), subroots AS (
  SELECT source, digest, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, place AS pos, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY level, pos // 16
), way AS (
  SELECT l.rid, u.level, u.pos, u.digest, l.pos // power(16, u.level)::bigint AS own
  FROM leaves l JOIN up u ON l.source IS NOT DISTINCT FROM u.source AND u.n > 1
   AND u.pos // 16 = l.pos // power(16, u.level + 1)::bigint
  UNION ALL
  SELECT l.rid, s.height + t.level, t.pos, t.digest, s.place // power(16, t.level)::bigint
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
  JOIN top t ON t.n > 1 AND t.pos // 16 = s.place // power(16, t.level + 1)::bigint
), steps AS (
  SELECT rid, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < own), '') AS ahead,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > own), '') AS behind
  FROM way GROUP BY rid, level
), fold AS (
  SELECT rid, 0 AS level, coalesce(forged, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.rid, f.level + 1, sha256(s.ahead || f.node || s.behind) FROM fold f JOIN steps s ON f.rid = s.rid AND f.level = s.level
), folded AS (
  SELECT rid, max_by(node, level) AS folded_root FROM fold GROUP BY rid
), proofs AS (
  SELECT rid, sha256(string_agg(ahead || behind, '' ORDER BY level)) AS proof FROM steps GROUP BY rid
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root,
       coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = (SELECT digest FROM top WHERE n = 1) AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN folded USING (rid) LEFT JOIN proofs USING (rid)
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_proofs(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
