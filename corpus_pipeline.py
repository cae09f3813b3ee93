"""The corpus pipeline: quality, near duplicates, decontamination, mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents, whatever their names and others beside them. Defined cases that all stages share: an empty table gives an empty result; texts are read
whole, however long; ids may be null or repeated, and rows may be equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import decontaminate, mixing, ngram_join, quality, token_store
from marlstone.llm.queries import vocabulary
from marlstone.llm.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the fertility bands accept. Null, empty and short texts go; a null or unknown lang is judged by script; equal rows go or stay together."""
    return quality.keep_quality(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of documents whose 5-word sets are similar to 0.8 or more: that with the smallest id, and of rows with that id and equal texts one. Texts without words, null ones too, are no copies and stay."""
    return ngram_join.one_of_each(docs, Workspace(spark, "pipeline-near"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a 10-word window of a benchmark item, or the whole of a shorter one. Null and empty texts stay; an empty benchmark leaves all; equal rows go or stay together."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them, whole. Texts without words are taken never; the null source is a source, weighed last; rows with equal ids go by size and text, so a rerun takes the same."""
    return mixing.mixed_documents(docs, Workspace(spark, "pipeline-mix"))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token files, and from these the place, length and checksum of each. A null text is the end id alone; null ids come first; rows with equal ids lie together, in the order of their texts."""
    root = Workspace(spark, "pipeline-tokens").path("tokens")
    token_store.write_tokens(docs, root, vocabulary("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, root)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_files", token_files),
]

#: Tokenisers and bands aren't SQL; tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next."""
    docs, ws = spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
