"""Documents to training data: quality rules, near duplicates, repeated passages, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs, in the columns of the documents table; the last
one returns tokens. run() applies them to the documents of sf_dir, each written and read again before the next. All stages
take whole texts of any length, keep columns that they do not know, whatever their names, and give an empty table for an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fillforge.llm.bpe import bpe
from fillforge.llm.common import staged
from fillforge.llm.minhash import drop_near_duplicates
from fillforge.llm.mixing import mix
from fillforge.llm.passages import drop_repeats
from fillforge.llm.quality import quality_filter
from fillforge.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those with fewer than 50 words, so also null and empty texts, and those that repeat themselves
    or break rules in a bad host. Rows that repeat an id are judged each; a null source is a host like any other."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id: five-word shingles, similarity of 0.8 or more. Texts
    without words are in no group and stay. Of several equal rows of the kept id one stays; a row without id stays only
    where no row of its group has one."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document of a smaller id holds, small edits allowed, are cut; n_chars follows. A
    document left without words goes; null and empty texts and rows without id stay as they are. Rows of one id are one
    document and cut nothing from each other."""
    return drop_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target asks: floor(rate) times, and once more by a draw from the hash of
    their id, so that equal rows of one id come alike. Null sources are one source; texts without words are
    never taken."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document and copy. Null texts count as empty: no tokens."""
    return bpe(docs, tokenizer_file("word_bpe_49k.json"), digest=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Near duplicates by signatures and passages by chains have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
