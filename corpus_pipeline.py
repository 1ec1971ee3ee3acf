"""The corpus pipeline: from documents to token ids, in five stages.

Each stage works on all that its predecessor kept. The first four return the columns of
documents: fewer rows, or shorter texts, or rows repeated by the mix; the last returns
the ids of every text with their digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import bpe, jaccard, langid, lineedit, mixing
from lectern.llm.common import prepare, settle

#: A document stays when its language is known at least this surely; unknown ones go.
LEAST_LANGUAGE_SCORE = 0.3
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or text go, and those that look surely like no learned language: other scripts, letters in no order."""
    return langid.keep_known(docs, langid.fit(docs, with_background=True), LEAST_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines, short ones too, that an earlier line of the corpus equals but for the edits their length allows go from the texts."""
    return lineedit.clean(docs, least=1)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes as often as its target weight asks."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, decoded again for the digest."""
    return bpe.token_digests(docs, RANKS, with_ids=True)


STAGES = [
    ("language", language), ("line_dedup", line_dedup), ("near_copies", near_copies), ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Language scores and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between two stages the rows are written to the shared folder."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs)
    return docs
