"""Documents to token ids: quality, near-duplicates, decontamination, mixing, token output.

Every stage is a function of (spark, docs, sf_dir); ``run`` writes each stage's rows as Parquet
to the shared folder and hands them, read again, to the next one. Stages are run after they return, so
those with Python steps bound the session's Arrow batches (``spark.sql.execution.arrow.maxBytesPerBatch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgrain.llm import decontam, mixing, neardup, quality, tokens
from roadgrain.llm.common import bound_batches, free_name, staged, table

#: Shares of the mix. Clean text keeps all its tokens, the others are thinned down to theirs.
WEIGHTS = {"clean": 0.98, "poor": 0.01, "toxic": 0.01}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    bound_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "quality_score")
    return quality.scored(docs, model, name).where(F.col(name) >= quality.THRESHOLD).drop(name)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    bound_batches(spark)
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat benchmark items."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned to the target mix; rates are at most 1, so nothing is repeated."""
    bound_batches(spark)
    labelled = mixing.domains(table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, WEIGHTS, anchor="clean", most=1.0)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as files, described per document from what was written."""
    bound_batches(spark)
    return tokens.tokenize(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: Classifiers, components and tokenizers have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = staged(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
