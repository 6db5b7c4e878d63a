"""The thin queries opN_<name> over the whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, embedding_dedup, filter_audit, fingerprints, line_dedup, mixing, ngram_join, permutation_index,
               quality, secrets_scan, sentencepiece_bpe, suffix_dedup, token_records)
from ._common import documents


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.round_trip(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(documents(spark, sf_dir).select("doc_id", "source", "text"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = token_records.encode_corpus(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(documents(spark, sf_dir).select("doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality.score(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(documents(spark, sf_dir))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets_scan.digests(secrets_scan.scan(docs, secrets_scan.train(docs)))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.report(conversation_repair.repair(rows))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_join, op2_line_dedup, op3_sentencepiece, op4_mixing, op5_quality, op6_fingerprints,
                            op7_embedding_dedup, op8_secrets, op9_suffix_dedup, op10_token_records, op11_conversation_repair,
                            op12_filter_audit, op13_permutation_index, pipeline)
}

ORACLES: dict[str, str] = {
    "op12_filter_audit": filter_audit.ORACLE,
    "op2_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.pos, k.line, h.last IS NOT NULL AND k.doc_id < h.last AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
}
