"""The corpus pipeline: five of the operators, one after another, over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared scratch folder and rereads it as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import line_dedup, ordinal_quality, packing, simhash, suffix_dedup
from strata.llm.common import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier keeps; the rest go."""
    return ordinal_quality.select_good(docs, read(spark, sf_dir, "labels"),
                                       ordinal_quality.graded_labels())


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are similar to an earlier one; short ones: equal."""
    return line_dedup.drop_lines(docs, short_copies=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.first_rows(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without word sequences that an earlier one has."""
    return suffix_dedup.drop_repeats(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into sequences: one row per piece."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("repeats", repeats), ("packing", pieces)]

#: SQL has no way to express the fitted classifier, MinHash, XXH64 or the tokenizer;
#: tests/llm/test_pipeline.py holds the stages of ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
