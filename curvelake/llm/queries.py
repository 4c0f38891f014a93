"""The registered queries of this package: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.llm import chat, classifier, decontam, langid, lines, lm, mining, mixing, outliers, simhash, template, tokens, whitening
from curvelake.llm.common import map_slices, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.schedule(mixing.copies(table(spark, folder, "documents")))


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.formatted(table(spark, folder, "conversations"))


def _digest(piece: pa.RecordBatch) -> dict:
    kept = [lines.kept_lines(t, k) for t, k in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True)]
    return {"doc_id": piece.column(0), "n_lines": [k[0] for k in kept], "n_dropped": [k[1] for k in kept],
            "kept_sha256": [hashlib.sha256((k[2] or "").encode()).hexdigest() for k in kept]}


def digest_of_lines(docs: DataFrame) -> DataFrame:
    marked = lines.with_bitmaps(docs.select("doc_id", "text"), lines.keep_bitmaps(docs))
    return map_slices(marked.selectExpr("cast(doc_id as bigint) doc_id", "text", "__own_keep"), _digest,
                      "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digest_of_lines(table(spark, folder, "documents"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"), VOCABULARY)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.rules(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(table(spark, folder, "documents"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return template.main_text(table(spark, folder, "pages"))


OP1_SQL = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce(source, '') AS source,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1)::BIGINT AS n_tokens FROM documents),
per AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM counted GROUP BY source),
shares AS (SELECT source, tokens, tokens::DOUBLE / (SELECT sum(tokens) FROM per)::DOUBLE AS share FROM per),
bounds AS (SELECT min(share) AS low, max(share) AS high FROM shares),
search(lo, hi) AS (
  SELECT (-1)::BIGINT, 1073741824::BIGINT
  UNION ALL
  SELECT CASE WHEN fits THEN lo ELSE mid END, CASE WHEN fits THEN mid ELSE hi END FROM (
    SELECT lo, hi, (lo + hi) // 2 AS mid,
           exp((1 - ((lo + hi) // 2)::DOUBLE / 1073741824::DOUBLE) * (ln(high) - ln(low))) <= 4 * (1 + 1e-12) AS fits
    FROM search, bounds WHERE hi - lo > 1)),
best AS (SELECT min(hi)::DOUBLE / 1073741824::DOUBLE AS exponent FROM search),
powers AS (SELECT source, tokens, pow(share, exponent) AS power FROM shares, best),
weighed AS (SELECT source, tokens, floor(power / (SELECT sum(power) FROM powers) * 1e9 + 0.5) / 1e9 AS weight FROM powers),
top AS (SELECT ceil(tokens / weight) AS total FROM weighed ORDER BY tokens DESC, source DESC LIMIT 1),
budgets AS (SELECT source, tokens, weight, greatest(tokens, floor(total * weight)::BIGINT) AS budget FROM weighed, top),
split AS (SELECT source, weight, budget // tokens AS epochs, budget % tokens AS rest, ceil(tokens / 1048576.0)::BIGINT AS blocks FROM budgets),
placed AS (SELECT c.*, s.weight, s.epochs, s.rest, ('0x' || substr(md5('mix:' || c.doc_id), 1, 8))::BIGINT % s.blocks AS block
           FROM counted c JOIN split s USING (source)),
sizes AS (SELECT source, block, epochs, rest, sum(n_tokens)::BIGINT AS size FROM placed GROUP BY ALL),
room AS (SELECT source, block, size, rest - coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY md5('mix:' || source || ':' || epochs || ':' || block), block
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM sizes),
laid AS (SELECT p.*, r.size, r.room, sum(n_tokens) OVER (
           PARTITION BY p.source, p.block ORDER BY md5('mix:' || epochs || ':' || doc_id), doc_id, n_tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed p JOIN room r ON p.source = r.source AND p.block = r.block),
taken AS (SELECT *, epochs + CASE WHEN room >= size OR upto <= room THEN 1 ELSE 0 END AS copies FROM laid),
reads AS (SELECT doc_id, source, n_tokens, weight, block, unnest(range(copies)) AS epoch FROM taken),
ranked AS (SELECT source, epoch, block, row_number() OVER (
             PARTITION BY source, epoch ORDER BY md5('mix:' || source || ':' || epoch || ':' || block), block) AS block_rank
           FROM (SELECT DISTINCT source, epoch, block FROM reads))
SELECT doc_id, source, n_tokens, weight, epoch, block, block_rank, row_number() OVER (
         PARTITION BY source, epoch, block ORDER BY md5('mix:' || epoch || ':' || doc_id), doc_id, n_tokens) AS doc_rank
FROM reads JOIN ranked USING (source, epoch, block)
"""

OP2_SQL = r"""
WITH RECURSIVE messages AS (
  SELECT DISTINCT coalesce(conv_id::VARCHAR, '-') AS conv, conv_id, coalesce(turn, 2305843009213693952)::BIGINT AS turn,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
numbered AS (SELECT *, row_number() OVER (ORDER BY conv, turn, role, text) AS id FROM messages),
lines AS (SELECT id, conv, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM numbered),
leveled AS (SELECT id, conv, turn, pos, length(regexp_replace(regexp_extract(line, '^([ \t]*>)+'), '[^>]', '', 'g')) AS level,
                   regexp_replace(line, '^([ \t]*>)+', '') AS line FROM lines),
changes AS (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY id ORDER BY pos) THEN 1 ELSE 0 END AS starts FROM leveled),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY id ORDER BY pos) AS place FROM changes),
normal AS (SELECT *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS words FROM runs),
blocks AS (SELECT id, conv, turn, place, level, trim(regexp_replace(lower(string_agg(line, chr(10) ORDER BY pos)), '[\x20\x09-\x0D]+', ' ', 'g')) AS words
           FROM runs GROUP BY id, conv, turn, place, level),
bodies AS (SELECT id, conv, turn, trim(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), ' ' || chr(9) || chr(10) || chr(13)) AS body
           FROM runs GROUP BY id, conv, turn),
originals AS (
  SELECT conv, turn, words FROM blocks WHERE level = 0 AND words <> '' UNION
  SELECT conv, turn, words FROM normal WHERE level = 0 AND words <> '' UNION
  SELECT conv, turn, trim(regexp_replace(lower(coalesce(body, '')), '[\x20\x09-\x0D]+', ' ', 'g')) FROM bodies),
asked AS (
  SELECT id, conv, turn, place, level, 0 AS rank, words FROM blocks WHERE level > 0 AND words <> '' UNION
  SELECT id, conv, turn, place, level, 1, words FROM normal WHERE level > 0 AND words <> ''),
met AS (SELECT a.id, a.conv, a.turn, a.place, a.level, a.rank, o.turn AS original
        FROM asked a LEFT JOIN originals o ON a.conv = o.conv AND a.words = o.words AND o.turn < a.turn),
passages AS (SELECT id, conv, turn, place, level, arg_max(original, (-rank, original)) FILTER (original IS NOT NULL) AS original
             FROM met GROUP BY id, conv, turn, place, level),
answers AS (SELECT conv, turn, arg_max(original, (-level, original)) AS up FROM passages WHERE original IS NOT NULL GROUP BY conv, turn),
chains(conv, turn, up) AS (
  SELECT conv, turn, up FROM answers
  UNION ALL
  SELECT c.conv, c.turn, a.up FROM chains c JOIN answers a ON c.conv = a.conv AND c.up = a.turn),
starts AS (SELECT conv, turn, min(up) AS thread FROM chains GROUP BY conv, turn),
counted AS (SELECT id, count(*) AS quoted, count(original) AS linked FROM passages GROUP BY id),
placed AS (
  SELECT n.conv, n.conv_id, n.turn, n.role, coalesce(b.body, '') AS body, coalesce(c.quoted, 0) AS quoted, coalesce(c.linked, 0) AS linked,
         row_number() OVER (PARTITION BY n.conv ORDER BY coalesce(s.thread, n.turn), n.turn, n.role, n.text) - 1 AS position
  FROM numbered n JOIN bodies b ON n.id = b.id LEFT JOIN counted c ON n.id = c.id LEFT JOIN starts s ON n.conv = s.conv AND n.turn = s.turn)
SELECT max(conv_id)::BIGINT AS conv_id, position // 64 AS part, count(*) AS n_messages, sum(quoted)::BIGINT AS n_quotes, sum(linked)::BIGINT AS n_linked,
       string_agg(CASE WHEN turn = 2305843009213693952 THEN '-' ELSE turn::VARCHAR END, ' ' ORDER BY position) AS turns,
       string_agg('<|' || role || '|>' || chr(10) || body || chr(10), '' ORDER BY position) AS content
FROM placed GROUP BY conv, position // 64
"""

OP3_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP11_SQL = """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
  FROM clean a JOIN clean r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_source_mixing, op2_chat_formatting, op3_line_dedup, op4_token_counts, op5_quality_rules, op6_decontamination, op7_simhash, op8_quality, op9_language_model,
    op10_language_id, op11_hard_negatives, op12_whitening, op13_main_text)}
ORACLES: dict[str, str] = {"op1_source_mixing": OP1_SQL, "op2_chat_formatting": OP2_SQL, "op3_line_dedup": OP3_SQL, "op11_hard_negatives": OP11_SQL}
