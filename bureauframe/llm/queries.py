"""The registered query of each operator: production parameters, the whole table, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bureauframe.llm import (
    balltree,
    binpack,
    bpe,
    extract,
    langid,
    mixing,
    repair,
    routing,
    simhash,
    simple8b,
    spelling,
    substring,
    suffixes,
)
from bureauframe.llm.common import scratch, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_learned_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return routing.search(table(spark, sf, "embeddings"))


def op2_vector_bin_packing(spark: SparkSession, sf: str) -> DataFrame:
    return binpack.shard(table(spark, sf, "documents"))


def op3_simple8b_ids(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "simple8b")
    simple8b.write_ids(table(spark, sf, "documents"), path, TOKENIZER)
    return simple8b.checksums(simple8b.read_ids(spark, path))


def op4_language_filters(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return langid.identify(docs, langid.learn(docs))


def op5_simhash_variants(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op6_subset_sum_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_tree_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return bpe.encode_documents(docs, TOKENIZER, bpe.digests, bpe.DIGESTS)


def op8_host_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract(table(spark, sf, "pages"))


def op9_ball_trees(spark: SparkSession, sf: str) -> DataFrame:
    return balltree.search_all(table(spark, sf, "embeddings"))


def op10_collinear_chains(spark: SparkSession, sf: str) -> DataFrame:
    return substring.repeats(table(spark, sf, "documents"))


def op11_grammar_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair(table(spark, sf, "conversations"))


def op12_two_stage_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf, "documents"))


def op13_sorted_list_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_learned_partitions,
        op2_vector_bin_packing,
        op3_simple8b_ids,
        op4_language_filters,
        op5_simhash_variants,
        op6_subset_sum_mix,
        op7_tree_bpe,
        op8_host_suffix_array,
        op9_ball_trees,
        op10_collinear_chains,
        op11_grammar_repair,
        op12_two_stage_suffixes,
        op13_sorted_list_spelling,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    """Only exact search can be said in SQL; the others have brute-force tests."""
    return {"op9_ball_trees": balltree.ORACLE}
