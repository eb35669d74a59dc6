"""The registered queries of the operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bit_mixing, langid, line_runs, merkle, mixture, packing, phrases, prefix_trie, quality, reply_trees, revisits, shingle_join, winnowing
from wardflow.llm.common import remainder

#: Target weights of the mixture; what is not named weighs 1.
WEIGHTS = {"domain": {"web": 3.0, "forum": 2.0, "books": 2.0, "code": 1.0}, "language": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}}
DOMAINS = ("web", "forum", "books", "code")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain() -> Column:
    """The domain of a source: by the number at the end of its name (web if it has none)."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT)")
    return F.coalesce(F.element_at(F.array(*map(F.lit, DOMAINS)), number % len(DOMAINS) + 1), F.lit(DOMAINS[0]))


def op1_bit_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = bit_mixing.score_texts(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) != 1)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits", "n_bytes", "bits_per_byte")


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    solved = revisits.resolve(revisits.captures(table(spark, sf_dir, "pages")))
    return solved.select("record_id", "url", "time", "status", "response_id", revisits.header_lines(F.col("headers")).alias("headers"))


def op3_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_sets(table(spark, sf_dir, "documents"), size=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"), domain(), WEIGHTS, share=0.5, max_epochs=2)


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    made = reply_trees.conversations(reply_trees.as_chains(rows))
    read = made.select(F.when(F.col("tree") != "\0", F.col("tree")).cast("long").alias("conv_id"), "formatted", reply_trees.turns(F.col("formatted")).alias("turns"), reply_trees.learned_text(F.col("formatted"), F.col("mask")).alias("learned"))
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, id_ = table(spark, sf_dir, "documents"), F.col("doc_id")
    model = langid.fit(docs.where(~langid.held_out(id_)))
    return langid.identify(docs, model, ["doc_id"]).select("doc_id", langid.held_out(id_).alias("held_out"), "lang_pred", "score")


def op10_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_check(table(spark, sf_dir, "documents"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = winnowing.shared_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    told = told.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return told.withColumn("contaminated", F.col("n_hit") > 0)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, id_ = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), F.col("conv_id")
    ids = rows.where("conv_id IS NOT NULL").select(id_.cast("long").alias("conv_id")).distinct()
    heads = F.crc32(id_.cast("string").cast("binary")) % 6
    return prefix_trie.trie(prefix_trie.spliced(prefix_trie.numbered(rows), ids, id_ - id_ % 100, heads, most=5), ids)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_bit_mixing, op2_revisits, op3_shingle_join, op4_quality, op5_mixture, op6_reply_trees, op7_line_runs, op8_packing, op9_langid, op10_merkle, op11_winnowing, op12_phrases, op13_prefix_trie)
    }
