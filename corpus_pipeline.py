"""The corpus pipeline: drop toxic and poor documents and near duplicates, then pack what is left."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ratewell.llm import ngram_join, packing, quality, toxicity  # noqa: E402
from ratewell.llm.common import remainder, saved, table  # noqa: E402
from ratewell.llm.queries import QUALITY_FROM, TOXIC_FROM, tokenizer_file  # noqa: E402


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject, learned as in ``op3``; each row by its own text."""
    labels = table(spark, sf_dir, "labels")
    model, _ = toxicity.fit_and_margins(docs, labels, remainder("doc_id", 5) != 0)
    limit = TOXIC_FROM
    return model.rows_where(docs, lambda score: score < limit)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learned as in ``op1`` from those that are left; each row by its own text."""
    labels = table(spark, sf_dir, "labels")
    model, _ = quality.fit_and_margins(docs, labels, remainder("doc_id", 4) != 2)
    limit = QUALITY_FROM
    return model.rows_where(docs, lambda score: score >= limit)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of ``packing.SEQUENCE`` tokens, with their ids."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"), digest=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", duplicates_stage),
    ("packing", packing_stage),
]

#: The classifiers are trained, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
