"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import line_dedup, mixing, ngram_join, quality, sentencepiece_bpe
from strata.llm._common import documents, write_table
from strata.llm.queries import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents hold stay in the last of them."""
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; five-word shingles, similarity 0.8 or more."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix reads them: a row per document and pass."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    coded = sentencepiece_bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "exact", "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram jaccard join", near_duplicates),
    ("mixing sources", mix_sources),
    ("sentencepiece coding", encode_texts),
]

#: A trained classifier and hashed draws have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
