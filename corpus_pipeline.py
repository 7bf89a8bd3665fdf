"""From raw documents to token ids: quality filter, line dedup, near-dedup, source mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the docs of the next; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotewell.llm.bpe import bpe_stage
from quotewell.llm.common import read, saved
from quotewell.llm.jaccard import jaccard_stage
from quotewell.llm.lines import line_dedup_stage
from quotewell.llm.mixing import mixing_stage
from quotewell.llm.quality import quality_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_stage(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go from every text."""
    return line_dedup_stage(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_stage(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat so that every source has the same expected size; the whole is shuffled."""
    return mixing_stage(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids; round_trip tells whether decoding gives the text back."""
    return bpe_stage(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", encoding),
]

# The quality model, the Jaccard join and the encoder are beyond SQL: tests/llm
# holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
