"""A corpus through five operators: each stage reads what the one before it wrote.

Rules, near-dedup and decontamination drop documents, substring dedup shortens them, and
the last stage returns the ids of the text and the text decoded from them.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from plumbline.llm import bpe, decontaminate, near_dups, quality, repeats  # noqa: E402
from plumbline.llm.common import share_code  # noqa: E402
from plumbline.llm.queries import tokenizer_file  # noqa: E402
from plumbline.session import materialize  # noqa: E402

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
# Stages on shingles of five words link from a similarity of 0.8; op8 has its own 85.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_first(docs, percent=NEAR_PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = tokenizer_file(TOKENIZER)
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path, into="ids"), "ids", path, into="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]

# Encoding is a fold over ranked merges, which SQL cannot say: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = share_code(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
