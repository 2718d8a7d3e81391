"""The corpus pipeline: filter by quality, join near duplicates, decontaminate, mix, write token files.

Each stage takes all rows that the one before kept and returns the columns of
``documents``; the last one returns the token files' rows.  Between stages the
rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowstat.llm import decontam, mixing, ngram_join, quality, token_files
from flowstat.llm.common import materialize, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers
    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good_documents), ("near_duplicates", one_of_each_group), ("decontaminate", without_benchmark),
          ("mix", mixed), ("token_ids", token_ids)]

ORACLE_SQL = None  # learned weights, hashes and token ids are not expressible


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
