"""One query per operator over its whole table, with production parameters, and the
equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bpe, decontaminate, licenses, near_dups, negatives, prefix_trie, quality, repeats, shards, simhash, suffixes, token_files, warc
from plumbline.llm.common import share_code

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(partial(_table, share_code(spark), sf_dir))
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_karmarkar_karp_shards")
def _(table):
    return shards.report(table("documents"))


@query("op2_winnowing_decontamination")
def _(table):
    return decontaminate.report(table("documents"), table("benchmark"))


@query("op3_external_induced_sorting")
def _(table):
    return suffixes.report(table("documents"))


@query("op4_quality_rules")
def _(table):
    return quality.report(table("documents"))


@query("op5_dictionary_warc")
def _(table):
    return warc.report(table("pages"))


@query("op6_re_pair_token_files")
def _(table):
    return token_files.report(table("documents"), tokenizer_file("word_bpe_49k.json"))


@query("op7_license_scan")
def _(table):
    return licenses.report(table("documents"))


@query("op8_near_duplicates")
def _(table):
    return near_dups.report(table("documents"))


@query("op9_byte_bpe")
def _(table):
    return bpe.report(table("documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))


@query("op10_substring_dedup")
def _(table):
    return repeats.report(table("documents"))


@query("op11_prefix_trie")
def _(table):
    return prefix_trie.report(table("conversations"))


@query("op12_simhash_blocks")
def _(table):
    return simhash.report(table("documents"))


@query("op13_hard_negatives")
def _(table):
    return negatives.report(table("embeddings"))
