"""Corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input.

Toxic documents go, then all but one copy of equal texts, then all but one of near duplicates; what is left is mixed to the source weights
(documents enter as often as they are taken) and encoded to token ids.  Every stage works on all rows the one before kept.  Null
texts count as empty; empty tables pass through; further columns are carried along up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import exact_dedup, mixing, near_dedup, toxicity
from roadlens.llm.common import free_names, read_table, shared_folder
from roadlens.llm.queries import codec_digests, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models score below one half."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    (score,) = free_names(docs, "toxicity")
    return toxicity.scored(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exact_dedup.keep_one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    return near_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text, one row per row of the mix."""
    return codec_digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Trained scores, sketches and hashed draws: not expressible in SQL.  tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
