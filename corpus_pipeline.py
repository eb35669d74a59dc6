"""The corpus pipeline: documents in, packed sequences out, one operator a stage.

Every stage reads what the one before it wrote and keeps the columns of documents; the
last returns the packing. Clean documents stay in the filtering stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import langid, line_runs, mixture, packing, queries, shingle_join
from wardflow.llm.common import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SURE = 0.5  # a language less likely than this is no language


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; it replaces the given one."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    told = langid.identify(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SURE))
    return told.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, and documents that were nothing else."""
    clean = line_runs.dedup_lines(docs)
    left = clean.where((F.col("n_removed") == 0) | line_runs.has_word(F.coalesce("text", F.lit(""))))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return shingle_join.one_of_each(docs, size=5, percent=80).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, shared out by target weights, each document once at most."""
    chosen = mixture.mix(docs, queries.domain(), queries.WEIGHTS, share=0.9, max_epochs=1)
    return mixture.mixed_rows(docs, queries.domain(), chosen).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("near copies", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

#: SQL has no tokenizer, language model or suffix array; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents at ``sf_dir``, each written and read again."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.option("compression", "zstd").parquet(f"{folder}/{k}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{k}")
    return docs
