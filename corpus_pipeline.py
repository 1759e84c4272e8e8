"""A training-corpus pipeline: five stages over ``documents``, each an operator of the llm subpackage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a
stage returns as Parquet into the shared checkpoint folder and reads it back as the
next stage's docs; then what the stages before have left there is removed.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumivox.llm import common, decontamination, mixing, ngram_join, quality, secrets

#: Weight of the documents of the least quality in the mix, against 1 for the best.
LEAST_WEIGHT = 0.01


def _scored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with the line model's ``__score`` and ``__good``; it learns from labelled rows that aren't held out."""
    model = quality.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, score="__score", predicted="__good")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model accepts."""
    return _scored(spark, docs, sf_dir).filter("__good = 1").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest doc_id, of each near-duplicate component."""
    return ngram_join.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark windows: contaminated ones go, lesser hits are cut out."""
    return decontamination.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how many of their words it takes (repeats counted).

    A document's weight is its quality score; the text of a document may have changed
    since the quality stage, so it is scored as it is now.
    """
    scored = _scored(spark, docs, sf_dir)
    weight = F.greatest(F.round("__score", 6), F.lit(LEAST_WEIGHT))
    return mixing.mix_sources(scored, weight=weight).drop("__score", "__good").filter("taken > 0")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]

#: The quality model is trained, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages; what a stage leaves in the shared folder goes when the next is written."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        with common.checkpoints_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            common.remove(spark, f"{folder}/{before}")
        before = name
    return docs
