"""The training-text pipeline: five stages over documents, each reading what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlog.llm import decontaminate, near_dedup, packing, substring_dedup, toxicity
from shardlog.llm._common import Scratch, table
from shardlog.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs, n=5, percent=75)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 20 words or more that occur earlier."""
    return substring_dedup.strip(docs, n=20)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words of a benchmark item occur."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), n=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("substring_dedup", drop_repeats), ("decontamination", drop_contaminated), ("packing", pack)]

#: A trained classifier decides in the first stage, which SQL can't express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])  # it was read for the last time
    return STAGES[-1][1](spark, docs, sf_dir)
