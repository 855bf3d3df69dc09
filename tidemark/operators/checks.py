"""Named data-quality checks: a check is a query that returns the rows that break a rule."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.gates import DataGateError


def statements(text: str) -> list[str]:
    """Statements end with a semicolon at the end of a line; those of comments alone are left out."""
    out = []
    for part in re.split(r";[ \t]*(?:\n|\Z)", text):
        lines = [x for x in part.splitlines() if x.strip()]
        if any(not x.lstrip().startswith("--") for x in lines):
            out.append("\n".join(lines))
    return out


def named(text: str) -> list[tuple[str, str]]:
    found = []
    for s in statements(text):
        name = re.search(r"--\s*check:\s*(.+)", s)
        if not name:
            raise ValueError("a check has no '-- check: <name>' line: " + s[:80])
        found.append((name[1].strip(), s))
    return found


def counted(spark: SparkSession, text: str) -> DataFrame:
    """name and failures of every check, in one plan."""
    parts = [spark.sql(s).agg(F.count("*").alias("failures")).select(F.lit(name).alias("name"), "failures") for name, s in named(text)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def failed(spark: SparkSession, text: str, shown: int = 3) -> list[str]:
    """A line for each check that fails, with its number of rows and the first ones."""
    out = []
    for name, s in named(text):
        rows = spark.sql(s)
        first = rows.limit(shown).collect()
        if first:
            out.append(f"{name}: {rows.count()} rows, e.g. {[tuple(r) for r in first]}")
    return out


def gate(spark: SparkSession, text: str) -> None:
    lines = failed(spark, text)
    if lines:
        raise DataGateError("; ".join(lines))


def gate_built(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each table after a build; an error that names those without any."""
    found = {name: df.count() for name, df in tables.items()}
    empty = [name for name, n in found.items() if not n]
    if empty:
        raise DataGateError(f"no rows in {', '.join(empty)}")
    return found


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` whose key ``other`` does not have; a null key is never missing, and a null in ``other`` hides all, as NOT IN has it."""
    hides = other.agg(F.coalesce(F.bool_or(F.col(other_key).isNull()), F.lit(False)).alias("hides_"))  # one row
    found = df.where(F.col(key).isNotNull()).join(other.select(F.col(other_key).alias("other_")), F.col(key) == F.col("other_"), "left_anti")
    return found.crossJoin(F.broadcast(hides)).where("not hides_").drop("hides_")


def training_breaks(df: DataFrame, label: str, split: str, reasons: list[str]) -> DataFrame:
    """``df`` with broken, a row for each rule that a row breaks: unlabeled outside the score split, or finished with a reason."""
    rules = [F.when((F.col(split) != "score") & F.col(label).isNull(), F.lit("no label outside the score split"))]
    rules += [F.when((F.col(label) == 0) & (F.col(r) != 0), F.lit(f"{r} is set for a finished trial")) for r in reasons]
    return df.withColumn("broken", F.explode(F.array_compact(F.array(*rules))))


def training_gate(df: DataFrame, label: str, split: str, reasons: list[str]) -> None:
    """Training stops on any of ``training_breaks``."""
    found = training_breaks(df, label, split, reasons).select("broken").distinct().orderBy("broken").collect()
    if found:
        raise DataGateError("; ".join(r.broken for r in found))


def leakage_alarm(auc: float, most: float = 0.85) -> None:
    if auc > most:
        raise DataGateError(f"an AUC of {auc:.3f} is too good to be true: look for leakage")


def ratio_check(counts: DataFrame, key: str, ours: str, theirs: str, low: float, high: float) -> DataFrame:
    """Keys whose count is not within bounds of an outside source's; no row there counts as 0."""
    return counts.withColumn("ratio", F.col(ours) / F.nullif(F.coalesce(F.col(theirs), F.lit(0)), F.lit(0))).where(F.col("ratio").isNull() | ~F.col("ratio").between(low, high)).select(key, ours, theirs, "ratio")
