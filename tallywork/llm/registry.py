"""The corpus queries: each operator applied to its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallywork.llm import (
    best_fit_packing,
    chat_format,
    compression_bands,
    exact_dedup,
    noisy_channel,
    phrase_mining,
    piece_transducer,
    prefix_free_dedup,
    seed_extend_dedup,
    simhash_dedup,
    simplex_clustering,
    source_mix,
    warc_index,
)
from tallywork.llm.text import table

Run = Callable[[SparkSession, str], DataFrame]


def op1_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression_bands.compression_bands(table(spark, folder, "documents"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    history = warc_index.archive_and_index(table(spark, folder, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_noisy_channel(spark: SparkSession, folder: str) -> DataFrame:
    return noisy_channel.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("hits")


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mix_sources(table(spark, folder, "documents")).drop("passes")


def op6_piece_transducer(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = piece_transducer.read_vocabulary()
    return piece_transducer.encode_and_decode(table(spark, folder, "documents"), vocabulary, with_ids=False)


def op7_prefix_free_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_free_dedup.remove_repeated_bytes(table(spark, folder, "documents"), with_kept=False)


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = chat_format.with_probe(table(spark, folder, "conversations"), spark)
    return chat_format.digests(chat_format.format_chats(turns))


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, folder, "documents"))


def op10_seed_extend_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = seed_extend_dedup.remove_repeated_words(table(spark, folder, "documents"), with_kept=False)
    return found.drop("repeats")


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing.pack_documents(table(spark, folder, "documents"), with_ids=False)


def op12_simplex_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return simplex_clustering.cluster_vectors(table(spark, folder, "embeddings")).drop("compared")


def op13_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_mining.mine_phrases(table(spark, folder, "documents"))


def queries() -> dict[str, Run]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_compression_bands": op1_compression_bands,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_warc_index": op3_warc_index,
        "op4_noisy_channel": op4_noisy_channel,
        "op5_source_mix": op5_source_mix,
        "op6_piece_transducer": op6_piece_transducer,
        "op7_prefix_free_dedup": op7_prefix_free_dedup,
        "op8_chat_format": op8_chat_format,
        "op9_simhash_dedup": op9_simhash_dedup,
        "op10_seed_extend_dedup": op10_seed_extend_dedup,
        "op11_best_fit_packing": op11_best_fit_packing,
        "op12_simplex_clustering": op12_simplex_clustering,
        "op13_phrase_mining": op13_phrase_mining,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": exact_dedup.SQL,
        "op3_warc_index": warc_index.SQL,
        "op8_chat_format": chat_format.SQL,
        "op12_simplex_clustering": simplex_clustering.SQL,
        "op13_phrase_mining": phrase_mining.SQL,
    }
