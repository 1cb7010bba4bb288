"""The queries of the training-data operators and their SQL.

Each query applies its operator, with its production parameters, to the whole
of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact_dedup, langid, media, minhash, mixing, quality, sentencepiece_fst, token_store, toxicity


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.coded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_table(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = f"{chat.END}{chat.START}assistant ok"
    columns = ["conv_id", "turn", "role", "text"]
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.chat_table(table(spark, sf_dir, "conversations").select(*columns).unionByName(more))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_quality, op3_token_store, op4_mixing, op5_exact_dedup, op6_sentencepiece, op7_minhash, op8_media, op9_langid, op10_chat)}


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, max(length(text)) AS longest FROM d GROUP BY norm
), k AS (
  SELECT d.norm, min(d.doc_id) AS keep_id FROM d JOIN g ON d.norm = g.norm AND length(d.text) = g.longest GROUP BY d.norm
)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm) JOIN k USING (norm)
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(4, len(ws) - 1)], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT u, v FROM l JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * i >= 75 * (x.n + y.n - i)
), r AS (
  SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.node WHERE r.c < e.v
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, n.n
"""

OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) t(i)
), p AS (
  SELECT *, length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 24 AS chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5_SQL, "op7_minhash": OP7_SQL, "op10_chat": OP10_SQL}
