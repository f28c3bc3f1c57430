"""A corpus from raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept. Between stages the rows are written to the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbsync.llm import decontaminate, mixing, quality_rules, token_store
from ebbsync.llm.order_minhash import NearDuplicates
from ebbsync.session import configure, work_dir, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    configure(spark)
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    configure(spark)
    return NearDuplicates(docs).keep_one()


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    configure(spark)
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample and repeat documents towards the sources' target weights."""
    configure(spark)
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the ids of all rows as a token store, and return its index as read back."""
    configure(spark)
    path = work_dir(spark, "corpus-tokens")
    token_store.write_store(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_index(spark, path)


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources", mix_sources),
    ("token ids", write_token_ids),
]

# The last stage calls a tokenizer, which SQL cannot. tests/llm has no brute-force version of run(): it checks which
# ids may be stored.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, str(sf_dir))
        if number < len(STAGES) - 1:
            docs = written(docs, work_dir(spark, f"stage-{number}"))
    return docs
