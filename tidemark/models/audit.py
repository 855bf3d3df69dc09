"""What a model owes to inputs that were edited later: its metrics on the latest and on point-in-time inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators.registry import overlay


def paired(model, latest: DataFrame, archived: DataFrame, id: str, label: str, columns: list[str]) -> DataFrame:
    """Each labeled row in both: its score on the latest inputs and, with ``columns`` as archived, the score on those."""
    rows = latest.where(F.col(label).isNotNull())
    then = model.score(overlay(rows, archived, id, columns)).select(id, F.col("risk_score").alias("archived_score"))
    return model.score(rows).select(id, label, F.col("risk_score").alias("latest_score")).join(then, id)


def both_ways(pairs: DataFrame, label: str, id: str, resamples: int = 200) -> dict:
    """AUC, average precision and Brier score on either inputs, and the interval of the drop in AUC over paired resamples."""
    out = {}
    for side in ("latest", "archived"):
        out[side] = M.summary(pairs, f"{side}_score", label, id).first().asDict()
    ends = M.bootstrap_auc(pairs, "latest_score", label, resamples, other="archived_score").first()
    drop = None if None in (out["latest"]["auc"], out["archived"]["auc"]) else out["latest"]["auc"] - out["archived"]["auc"]
    return out | {"drop": drop, "drop_low": ends.low, "drop_high": ends.high}


def swap_each(model, latest: DataFrame, archived: DataFrame, id: str, label: str, columns: list[str]) -> list[dict]:
    """The drop in AUC when one column alone is as archived, the largest first: which edits the model leans on."""
    out = []
    for c in columns:
        pairs = paired(model, latest, archived, id, label, [c])
        before, after = (M.auc(pairs, s, label).first().auc for s in ("latest_score", "archived_score"))
        out.append({"column": c, "drop": None if None in (before, after) else before - after})
    return sorted(out, key=lambda x: (x["drop"] is None, -(x["drop"] or 0.0), x["column"]))


def close_enough(seen: DataFrame, days: int) -> DataFrame:
    """The strict cohort: rows whose archived record lies within ``days`` of the start, on either side."""
    return seen.where(F.abs("lag_days") <= days)
