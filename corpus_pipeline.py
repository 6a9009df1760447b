"""Corpus pipeline over ``documents``: toxicity, quality classifier, SimHash near
duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row the stage
before kept; all but the last return the rows they keep, with the columns of
documents as they came. Rows are decided on one by one, so null or repeated
ids and extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import packing, quality, simhash, toxicity
from stratum.llm.common import staged, table, unused

#: no SQL for run(): two stages train models and one packs greedily
ORACLE_SQL = None


def _kept(docs: DataFrame, score: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """Rows of ``docs`` whose text is scored so that ``keep`` holds. The whole row
    goes through the scorer in place of its id, so nothing is joined."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text")
    return score(rows).where(keep).select("doc_id.*")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity machine predicts as toxic."""
    machine = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels"), "toxic"))
    return _kept(docs, lambda rows: toxicity.score_texts(rows, machine), F.col("predicted") == 0)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the weak-label classifier scores as junk."""
    scorer = quality.train(docs.select("doc_id", "text"))
    return _kept(docs, lambda rows: quality.score_texts(rows, scorer), F.col("keep") == 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id, of equal
    ids the first row."""
    row = unused(docs, "row")
    # written once: numbered anew at each reading, rows could get other numbers
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    groups = simhash.simhash_groups(numbered.select(F.struct("doc_id", row).alias("doc_id"), "text"))
    stay = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col(f"doc_id.{row}").alias(row))
    return numbered.join(stay, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document."""
    import public_tokenizers

    return packing.pack_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
