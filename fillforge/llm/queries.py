"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillforge.llm import sql
from fillforge.llm.bpe import bpe
from fillforge.llm.chat import chat_report
from fillforge.llm.crossalign import cross_alignment
from fillforge.llm.embeddings import embedding_duplicates
from fillforge.llm.language import document_languages, fit_text, page_languages
from fillforge.llm.licenses import license_scan
from fillforge.llm.minhash import near_duplicates
from fillforge.llm.mixing import mix_report
from fillforge.llm.negatives import hard_negatives
from fillforge.llm.passages import passage_report
from fillforge.llm.quality import quality_report
from fillforge.llm.tokenfiles import token_file_report
from fillforge.llm.weaklabels import quality_scores


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir))


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), digest=True)


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op5_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(documents(spark, sf_dir))


def op6_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all pages; the text likelihoods come from a sample per language."""
    docs = documents(spark, sf_dir)
    raw = spark.read.parquet(f"{sf_dir}/pages.parquet")
    langs, table = fit_text(docs, "doc_id", "text", "lang", pages=raw)
    pages = page_languages(raw, langs, table)
    none = F.lit(None).cast("long")
    return document_languages(docs, langs, table).withColumn("page_id", none).unionByName(pages.withColumn("doc_id", none))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_report(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir))


def op9_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir))


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)


def op11_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, lambda i: i % 100 == 0)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_report(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").union(more))


def op13_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_weak_labels, op2_bpe_tree, op3_multi_index, op4_license_index, op5_chained_passages, op6_language_fusion, op7_token_files, op8_mix_sources, op9_host_quality, op10_superminhash, op11_hilbert_negatives, op12_chat_format, op13_text_alignment)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_mix_sources": sql.MIX, "op9_host_quality": sql.QUALITY, "op11_hilbert_negatives": sql.NEGATIVES, "op12_chat_format": sql.CHAT}
