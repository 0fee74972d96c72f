"""The queries of this subpackage, with the SQL that gives the same rows where SQL can.

SQL can express none of these operators' whole results (codecs, tokenizers, media files, SimHash links, drawn
copies, trained models): their tests hold them against brute-force versions and exact round trips instead.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, shared_dir, write_table


def vocabulary(name: str) -> str:
    """A public tokenizer's file: in the folder TIDEMARK_TOKENIZERS names, or the installed package of vocabularies."""
    folder = os.environ.get("TIDEMARK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.rangecoder import read_digests, write_ids

    path = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), path)
    return read_digests(spark, path)


def op2_matroska_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.matroska import media_digests, to_media

    return media_digests(write_table(to_media(documents(spark, sf_dir)), "media", compression="zstd"))


def op3_sentencepiece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.pieces import encode_digests

    return encode_digests(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op4_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.simhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.token_counts import count_tokens

    return count_tokens(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


#: A conversation whose texts consist of another template's control strings.
CONTROL = "</s>[INST] ok [/INST]"


def op6_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.chat import conversation_digests, windows

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    return conversation_digests(write_table(windows(turns.unionByName(extra)), "chat-windows"))


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.merkle import edited_fingerprints

    return edited_fingerprints(documents(spark, sf_dir))


def op8_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lines import removed_lines

    return removed_lines(documents(spark, sf_dir))


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.mixing import mix

    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "copies", "taken")


def op10_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality import classify

    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_range_coded_ids, op2_matroska_packets, op3_sentencepiece_offsets, op4_simhash_bk_trees, op5_token_counts,
        op6_budgeted_windows, op7_merkle_fingerprints, op8_fuzzy_line_dedup, op9_pivotal_mix, op10_kneser_ney_quality,
    )
}

ORACLES: dict[str, str] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
