"""Corpus pipeline: documents to clean, deduplicated, encoded training text.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; its result is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.

Rows that repeat an id: a decision about an id and text holds for all rows
with both; after exact and near-duplicate removal one row of each group is
left.  Documents with a NULL id have no label and go through every stage like
others.  No documents give no rows at any stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridplace.llm.bpe_codec import bpe_encode
from gridplace.llm.common import materialize, table
from gridplace.llm.decontaminate import keep_clean
from gridplace.llm.exact_dedup import keep_one_of_each
from gridplace.llm.quality import fit_quality, keep_good
from gridplace.llm.queries import vocab_path
from gridplace.llm.simhash import keep_one_of_each_component

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Here the workers share their executors with what earlier stages left in memory.
ENCODING_STATES = 100_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts, the row with the largest id."""
    return keep_one_of_each(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (three-word shingles, three bits), the row
    with the smallest id."""
    return keep_one_of_each_component(docs, words_per_shingle=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digests of the round trip."""
    return bpe_encode(docs, vocab_path(), with_decoded=False, max_states=ENCODING_STATES)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]

#: SQL can express neither the classifier nor the encoding; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{i}-{name.split()[0].lower()}")
    return docs
