"""From raw documents to token ids: quality rules, line and near-duplicate removal, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads again as
the next stage's input. A stage works on every row that its predecessor kept; all but the last return the columns
of the documents. A document whose text changed keeps its other columns; ``n_chars`` is counted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, lines, mixing, near, quality
from tributary.llm.common import stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules accept."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier line; documents left without a word go."""
    left = lines.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near.keep_first(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes for each row of the mix."""
    return bpe.token_digests(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: Expectation-maximisation, the cube method and byte-pair merging are not SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for label, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
