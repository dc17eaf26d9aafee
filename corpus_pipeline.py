"""A training corpus from the documents table, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as
the next one's documents. Stages keep rows, not values: all but the last return the columns of
documents, and rows that stay are unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.llm import decontam, exact_dedup, language, ngram_join, pieces, viterbi
from cadenza.llm.common import read_table
from cadenza.llm.queries import model_path
from cadenza.session import remove_scratch, write_and_read

#: A document whose best language has a lower mean probability is rejected. At 0 only those without a letter are:
#: low scores are those of short and mixed texts.
LEAST_LANGUAGE_SCORE = 0.0
#: Names of the written copies of rows, the pipeline's own, so that no other caller's copies are removed with them.
DISTINCT_ROWS, SIMILAR_ROWS = (f"{name}_{uuid.uuid4().hex}" for name in ("pipeline_distinct", "pipeline_similar"))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language, which null texts and those without a letter have not.

    Where no row is labelled, there is nothing to learn from, and all documents with a letter stay.
    """
    network = language.fit(docs)
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return language.keep_identified(docs, network, LEAST_LANGUAGE_SCORE)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs, scratch=DISTINCT_ROWS)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    # the last stage's result is written, so its copy of the rows is no longer read
    remove_scratch(spark, DISTINCT_ROWS)
    return ngram_join.drop_near_duplicates(docs, scratch=SIMILAR_ROWS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    remove_scratch(spark, SIMILAR_ROWS)
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left; one row each."""
    return viterbi.round_trip(docs, pieces.load(spark, model_path()))


STAGES = [
    ("language identification", identified),
    ("exact deduplication", distinct),
    ("near-duplicate removal", dissimilar),
    ("benchmark decontamination", uncontaminated),
    ("tokenisation", tokenised),
]

#: A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), "pipeline")
    return docs
