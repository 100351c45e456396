"""The operators over the test tables: one query each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import (
    alignment,
    block_search,
    chat,
    collocations,
    fingerprints,
    languages,
    mixing,
    near_dups,
    packing,
    quality,
    shards,
    suffix_dedup,
    url_rules,
)
from punctual.llm.common import Scratch, table

Query = Callable[[SparkSession, str], DataFrame]

# The conversation that holds control strings.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
VOCABULARY = "byte_bpe_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, folder, "documents"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    rows = mixing.mixed(documents, Scratch(spark, "mixing"))
    return rows.select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        "kept",
    )


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    rows = rows.select("doc_id", "held_out", "score", "predicted")
    return Scratch(spark, "quality").store(rows, "scored", quality.TEXTS)


def op4_block_search(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "search")
    vectors = scratch.store(block_search.quantised(table(spark, folder, "embeddings")), "vectors")
    return block_search.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dups.classes(table(spark, folder, "documents"), Scratch(spark, "near"))
    # the document that stands for its class
    kept = F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return found.select("doc_id", "class_id", kept.alias("kept"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "packing")
    return packing.packed(table(spark, folder, "documents"), scratch, public_tokenizers.path(VOCABULARY), special=True)


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = shards.keyed(table(spark, folder, "documents")).withColumn(
        "text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    )
    dealt = shards.sharded(documents.drop("text"), Scratch(spark, "shards"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.cut_bytes(table(spark, folder, "documents"), Scratch(spark, "repeats"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return chat.digest(chat.windows(rows.unionByName(planted)))


def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    rules = url_rules.mine(pages, labels, Scratch(spark, "urls"))
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), Scratch(spark, "collocations"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    documents, scratch = table(spark, folder, "documents"), Scratch(spark, "alignment")
    return alignment.aligned(documents, scratch, *map(public_tokenizers.path, ALIGNED))


def op13_languages(spark: SparkSession, folder: str) -> DataFrame:
    rows = languages.predicted(table(spark, folder, "documents"))
    rows = rows.select("doc_id", "held_out", "lang_pred", "score")
    return Scratch(spark, "languages").store(rows, "predicted", languages.TEXTS)


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_block_search": op4_block_search,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_packing": op6_packing,
    "op7_shards": op7_shards,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chat": op9_chat,
    "op10_url_rules": op10_url_rules,
    "op11_collocations": op11_collocations,
    "op12_alignment": op12_alignment,
    "op13_languages": op13_languages,
    "pipeline": corpus_pipeline.run,
}
