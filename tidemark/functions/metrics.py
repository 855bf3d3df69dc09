"""Ranking, calibration and agreement metrics as DataFrame aggregates.

Ranks need an order over all rows. Instead of one window over them, rows are first summed by distinct score; running sums
over the distinct scores then give ranks, precision and recall. Window functions without a partition see one row per distinct
score (scores are rounded by callers who need that number bounded), never one per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import rounded
from tidemark.staging import pinned


def _by(groups: list[str]) -> list[str]:
    return list(groups or [])


def auc(df: DataFrame, score: str, label: str, groups: list[str] | None = None) -> DataFrame:
    """ROC AUC with average ranks for ties, per group: n, positives, auc (null if one class is missing)."""
    g = _by(groups)
    tied = df.groupBy(*g, score).agg(F.count("*").alias("m"), F.sum(F.col(label).cast("long")).alias("p"))
    below = Window.partitionBy(*g).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = tied.withColumn("rank_", F.coalesce(F.sum("m").over(below), F.lit(0)) + (F.col("m") + 1) / 2)
    total = ranked.groupBy(*g).agg(F.sum("m").alias("n"), F.sum("p").alias("positives"), F.sum(F.col("rank_") * F.col("p")).alias("r_"))
    pos, neg = F.col("positives").cast("double"), (F.col("n") - F.col("positives")).cast("double")
    return total.select(*g, "n", "positives", F.when((pos > 0) & (neg > 0), (F.col("r_") - pos * (pos + 1) / 2) / (pos * neg)).alias("auc"))


def average_precision(df: DataFrame, score: str, label: str, groups: list[str] | None = None) -> DataFrame:
    """Sum over distinct thresholds, highest first, of the gain in recall times the precision."""
    g = _by(groups)
    tied = df.groupBy(*g, score).agg(F.count("*").alias("m"), F.sum(F.col(label).cast("long")).alias("p"))
    upto = Window.partitionBy(*g).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    run = tied.select(*g, "p", F.sum("m").over(upto).alias("m_"), F.sum("p").over(upto).alias("p_"))
    part = F.sum(F.col("p") * (F.col("p_").cast("double") / F.col("m_")))
    return run.groupBy(*g).agg((part / F.nullif(F.sum("p"), F.lit(0))).alias("average_precision"))


def brier(df: DataFrame, score: str, label: str, groups: list[str] | None = None) -> DataFrame:
    miss = F.col(score) - F.col(label).cast("double")
    return df.groupBy(*_by(groups)).agg(F.count("*").alias("n"), F.avg(miss * miss).alias("brier"))


def top_fraction_precision(df: DataFrame, score: str, label: str, key: str, fraction: float = 0.1) -> DataFrame:
    """Share of positives among the k = max(1, round(n * fraction)) highest scores, ties to the smaller key."""
    n = df.count()
    k = max(1, round(n * fraction))
    top = df.orderBy(F.desc(score), key).limit(k)
    return top.agg(F.count("*").alias("k"), F.avg(F.col(label).cast("double")).alias("precision"))


def decile(place: Column, n: Column, bins: int = 10) -> Column:
    """Bin of the 1-based place among n by quantile edges, right-closed, the lowest included."""
    return F.greatest(F.lit(1), F.ceil((place - 1) * bins / F.greatest(n - 1, F.lit(1)))).cast("int")


def with_place(df: DataFrame, order: list, name: str = "place", total: str | None = None) -> DataFrame:
    """1-based place of each row in a total order, and the number of rows as ``total`` if that is named.

    Rows are sorted by range over all tasks and kept once in the shared folder; then each takes the offset of its task, from
    one row per task, and its place within it. No task sees all rows.
    """
    ordered = pinned(df.orderBy(*order))
    part = ordered.withColumn("task_", F.spark_partition_id()).withColumn("id_", F.monotonically_increasing_id())
    sizes = part.groupBy("task_").agg(F.count("*").alias("m_"), F.min("id_").alias("first_"))
    before = Window.orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("task_", "first_", F.coalesce(F.sum("m_").over(before), F.lit(0)).alias("before_"), F.sum("m_").over(Window.partitionBy()).alias("all_"))
    joined = part.join(F.broadcast(offsets), "task_")
    placed = joined.withColumn(name, F.col("before_") + F.col("id_") - F.col("first_") + 1)
    placed = placed if total is None else placed.withColumn(total, F.col("all_"))
    return placed.drop("task_", "id_", "first_", "before_", "all_")


def equal_bin(place: Column, n: Column, bins: int) -> Column:
    """Bin of the 1-based place among n when bins differ by one row at most, the larger ones first (as ntile has it)."""
    size, longer = F.floor(n / bins), n % bins
    edge = longer * (size + 1)
    late = longer + F.ceil((place - edge) / F.greatest(size, F.lit(1)))
    return F.when(place <= edge, F.ceil(place / (size + 1))).otherwise(late).cast("int")


def calibration(df: DataFrame, score: str, label: str, key: str, bins: int = 10) -> DataFrame:
    """Mean score and share of positives in each quantile bin."""
    placed = with_place(df.select(score, label, key), [score, key], "place_", "n_")
    return placed.groupBy(decile(F.col("place_"), F.col("n_"), bins).alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("predicted"), F.avg(F.col(label).cast("double")).alias("observed"))


def percentile_against(df: DataFrame, reference: DataFrame, score: str, ref_score: str) -> DataFrame:
    """``df`` with percentile: 100 times the share of reference scores strictly below, to one digit."""
    levels = reference.where(F.col(ref_score).isNotNull()).groupBy(F.col(ref_score).alias("s_")).agg(F.count("*").alias("m"))
    asked = df.select(F.col(score).alias("s_")).where("s_ is not null").distinct().withColumn("m", F.lit(0).cast("long"))
    both = levels.unionByName(asked).groupBy("s_").agg(F.sum("m").alias("m"))
    below = Window.orderBy("s_").rowsBetween(Window.unboundedPreceding, -1)
    run = both.select("s_", F.coalesce(F.sum("m").over(below), F.lit(0)).alias("below_"), F.sum("m").over(Window.partitionBy()).alias("all_"))
    share = rounded(100.0 * F.col("below_") / F.col("all_"), 1)
    return df.join(run, F.col(score) == F.col("s_"), "left").withColumn("percentile", share).drop("s_", "below_", "all_")


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with the average rank of ``value``."""
    levels = df.groupBy(F.col(value).alias("v_")).agg(F.count("*").alias("m_"))
    below = Window.orderBy("v_").rowsBetween(Window.unboundedPreceding, -1)
    ranks = levels.select("v_", (F.coalesce(F.sum("m_").over(below), F.lit(0)) + (F.col("m_") + 1) / 2).alias(name))
    return df.join(ranks, F.col(value) == F.col("v_")).drop("v_")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    ranked = average_rank(average_rank(df.select(a, b), a, "ra_"), b, "rb_")
    return ranked.agg(F.count("*").alias("n"), F.corr("ra_", "rb_").alias("spearman"))


def refit_agreement(df: DataFrame, a: str, b: str, reference: DataFrame, ref: str) -> DataFrame:
    """How far two scores of the same rows agree: Spearman, differences of scores and of percentiles."""
    both = percentile_against(df.select(a, b), reference, a, ref).withColumnRenamed("percentile", "pa_")
    both = percentile_against(both, reference, b, ref).withColumnRenamed("percentile", "pb_")
    gap, move = F.abs(F.col(a) - F.col(b)), F.abs(F.col("pa_") - F.col("pb_"))
    rest = both.agg(
        F.percentile(gap, F.lit(0.5)).alias("median_difference"),
        F.percentile(gap, F.lit(0.95)).alias("p95_difference"),
        F.percentile(move, F.lit(0.5)).alias("median_percentile_move"),
        F.avg((move > 5).cast("double")).alias("share_over_5"),
        F.avg((move > 10).cast("double")).alias("share_over_10"),
    )
    return spearman(df, a, b).crossJoin(rest)  # one row each


def subgroup_auc(df: DataFrame, score: str, label: str, group: str, least: int) -> DataFrame:
    """AUC of the groups with ``least`` rows and both classes."""
    return auc(df.where(F.col(group).isNotNull()), score, label, [group]).where((F.col("n") >= least) & F.col("auc").isNotNull())


def summary(df: DataFrame, score: str, label: str, key: str) -> DataFrame:
    """n, positives, base rate, ROC AUC, average precision, top-10% precision and Brier score, in one row."""
    one = auc(df, score, label).withColumn("base_rate", F.col("positives") / F.col("n"))
    # each side is one row
    return one.crossJoin(average_precision(df, score, label)).crossJoin(brier(df, score, label).select("brier")).crossJoin(top_fraction_precision(df, score, label, key).select(F.col("precision").alias("precision_top10")))


def bootstrap_auc(df: DataFrame, score: str, label: str, resamples: int = 200, seed: int = 0, other: str | None = None) -> DataFrame:
    """2.5 and 97.5 percentiles of the AUC, or of the difference to ``other``'s, over Poisson resamples.

    A resample gives each row a Poisson(1) weight drawn from a hash of (row key, resample): deterministic, no shuffle of rows
    beyond the sums by score.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("b_"), F.col(score), F.col("key_")), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    steps = [0.36787944, 0.73575888, 0.9196986, 0.98101184, 0.99634015, 0.99940582, 0.99991676]
    weight = sum((u > s).cast("long") for s in steps)
    rows = df.withColumn("key_", F.monotonically_increasing_id()).withColumn("b_", F.explode(F.sequence(F.lit(1), F.lit(resamples)))).withColumn("w_", weight).where("w_ > 0")

    def weighted(s: str) -> DataFrame:
        tied = rows.groupBy("b_", s).agg(F.sum("w_").alias("m"), F.sum(F.col("w_") * F.col(label).cast("long")).alias("p"))
        below = Window.partitionBy("b_").orderBy(s).rowsBetween(Window.unboundedPreceding, -1)
        ranked = tied.withColumn("r_", F.coalesce(F.sum("m").over(below), F.lit(0)) + (F.col("m") + 1) / 2)
        t = ranked.groupBy("b_").agg(F.sum("m").alias("n"), F.sum("p").alias("p"), F.sum(F.col("r_") * F.col("p")).alias("r"))
        return t.where("p > 0 and n > p").select("b_", ((F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * (F.col("n") - F.col("p")))).alias("auc"))

    drawn = weighted(score)
    if other:
        drawn = drawn.join(weighted(other).withColumnRenamed("auc", "auc2"), "b_").select("b_", (F.col("auc") - F.col("auc2")).alias("auc"))
    ends = F.percentile("auc", F.array(F.lit(0.025), F.lit(0.975)))
    return drawn.agg(F.count("*").alias("resamples"), ends[0].alias("low"), ends[1].alias("high"))
