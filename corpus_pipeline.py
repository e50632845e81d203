"""A corpus made ready for training: five operators one after the other, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm import decontaminate, langid, minhash, mixing, recompress
from ridelake.llm.steps import Scratch, documents


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with the language they are in; the others go."""
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, sets of five-word shingles that are alike by 0.8 or more."""
    return minhash.one_of_each(docs, similarity=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start in an earlier document too."""
    return recompress.deduplicated(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words taken of each and its place in the mix."""
    return mixing.mixed(docs)


STAGES = [
    ("language ID", known_language),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("mixing", mixture),
]

#: The language model, and the shuffle by a hash, have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the stored documents; each result is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES):
        docs = scratch.freeze(stage(spark, docs, sf_dir), f"stage-{place}")
        if place:
            scratch.drop(f"stage-{place - 1}")
    return docs
