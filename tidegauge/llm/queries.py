"""The operators as registered queries, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import crossparse, factorisation, mixing, packing, part_codes, prefix_hash, quotes, records, rules, shard_tree, simhash, warc, zfast
from tidegauge.llm.common import table, vocabulary
from tidegauge.llm.oracles import LLM_ORACLES as LLM_ORACLES
from tidegauge.session import scratch_path


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", mixed["group_size"].alias("source_size"), "target", "copies", "taken")


def op2_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return records.drop("record_id", "archive")


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op6_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.compare_with_next(table(spark, sf_dir, "documents"))


def op7_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossparse.identify(table(spark, sf_dir, "documents"))


def op9_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.assign(table(spark, sf_dir, "documents"), shards=24)


def op11_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.with_label_error(*part_codes.compress(table(spark, sf_dir, "embeddings")))


def op12_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), scratch_path(spark, "records"))


def op13_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zfast.prefixes(table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_pack_nnls": op2_pack_nnls,
    "op3_warc_chunks": op3_warc_chunks,
    "op4_weak_supervision": op4_weak_supervision,
    "op5_quotation_links": op5_quotation_links,
    "op6_prefix_hashes": op6_prefix_hashes,
    "op7_factorisation_machine": op7_factorisation_machine,
    "op8_simhash_gray": op8_simhash_gray,
    "op9_shard_tree": op9_shard_tree,
    "op10_cross_parsing": op10_cross_parsing,
    "op11_part_codes": op11_part_codes,
    "op12_binary_records": op12_binary_records,
    "op13_zfast_trie": op13_zfast_trie,
}
