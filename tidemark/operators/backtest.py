"""Scores that were published before the outcome was known, held against what came of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M


def first_scores(scores: DataFrame, id: str, version: str, at: str, score: str) -> DataFrame:
    """Of each subject and version the score that came first; of several at that time the lowest."""
    first = F.min(F.struct(at, score))
    return scores.groupBy(id, version).agg(first.alias("s_")).select(id, version, *[F.col(f"s_.{c}").alias(c) for c in (at, score)])


def prospective(scores: DataFrame, outcomes: DataFrame, id: str, version: str, at: str, score: str, label: str) -> DataFrame:
    """Per version: how many of its first scores have an outcome by now, how many of those ended, and how well they rank.

    Subjects without an outcome are left out; a version whose subjects all ended alike has no AUC and says so in ``note``.
    """
    known = first_scores(scores, id, version, at, score).join(outcomes.where(F.col(label).isNotNull()).select(id, label), id)
    gap = F.col(score) - F.col(label).cast("double")
    rest = known.groupBy(version).agg(F.min(at).alias("first_scored"), F.avg(score).alias("mean_score"), F.avg(gap * gap).alias("brier"))
    found = M.auc(known, score, label, [version]).join(rest, version)
    return found.withColumn("note", F.when(F.col("auc").isNull(), "one class only"))
