"""From raw documents to packed training sequences: five stages, each a stored table.

Every stage but the last returns the columns of `documents`; what it drops is gone for the
stages behind it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from punctual.llm import mixing, near_dups, packing, quality, suffix_dedup
from punctual.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "byte_bpe_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    judged = quality.judged(docs, table(spark, sf_dir, "labels"))
    kept = judged.where("predicted = 1").select(*docs.columns)
    return Scratch(spark, "quality").store(kept, "kept", quality.TEXTS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dups.deduplicated(docs, Scratch(spark, "near"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that stand earlier in the corpus."""
    return suffix_dedup.without_repeats(docs, Scratch(spark, "repeats"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target marginals of source, language and topic."""
    mixed = mixing.mixed(docs, Scratch(spark, "mixing"))
    return mixed.where("kept").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    return packing.packed(docs, Scratch(spark, "packing"), public_tokenizers.path(VOCABULARY), special=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the stages; tests/llm check what each of them keeps and packs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return docs
