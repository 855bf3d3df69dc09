"""Exact interpolated percentiles of groups of any size.

Groups of up to ``few`` values take Spark's ``percentile``, which holds a group's distinct values in one buffer. Beyond, nested
histograms: each round counts the values of each range that holds a wanted rank in ``BINS`` bins, in tasks first, and goes on with
the bins that hold the ranks, until such a bin has one distinct value. Then no group's values come together anywhere.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.staging import pinned, unpin

BINS = 4096
#: Values of a group that one buffer may hold, unless ``few`` says otherwise; ranges that are broadcast.
FEW, RANGES_SENT = 1_000_000, 100_000
_MOST_ROUNDS = 400


def _binned(value, low, high, logarithmic: bool):
    """A bin that doesn't fall as the value rises; ``logarithmic`` parts values of different size, the other values of like size."""

    def scaled(x):
        if logarithmic:  # 750 is above the logarithm of any double, whatever its sign
            return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + 750))
        return x / 2  # so that no difference overflows

    low, high, value = scaled(low), scaled(high), scaled(value)
    share = (value - low) / F.nullif(high - low, F.lit(0.0))
    return F.coalesce(F.least(F.greatest(F.floor(share * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int"), F.lit(0))


def exact_percentiles(df: DataFrame, groups: Sequence[str], value: str, shares: dict[str, float], few: int = FEW) -> DataFrame:
    """One row per group with the percentiles of ``shares`` (name: share), as ``percentile`` gives them: between two ranks by proportion.

    Nulls and values that are no finite numbers don't count; a group without others has nulls.
    """
    g = list(groups)
    x = F.col(value).cast("double")
    x = F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)
    most = df.where(x.isNotNull()).groupBy(*g).count().agg(F.max("count")).first()[0]
    if (most or 0) <= few:
        all_of = F.percentile(x, F.array(*map(F.lit, map(float, shares.values()))))
        return df.groupBy(*g).agg(all_of.alias("p_")).select(*g, *[F.col("p_")[k].alias(n) for k, n in enumerate(shares)])
    return _nested(df, g, x, shares)


def _nested(df: DataFrame, g: list[str], x: Column, shares: dict[str, float]) -> DataFrame:
    keys = [f"g{k}_" for k in range(len(g))]
    named = [F.col(c).alias(k) for c, k in zip(g, keys)]
    rows = df.select(*named, x.alias("x_")).where("x_ is not null")

    def beside(left: DataFrame, right: DataFrame, extra: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
        """Rows of equal groups, null ones too, and equal ``extra``; the columns of ``right`` besides these are added."""
        other = right.select(*[F.col(c).alias(f"{c}r_") for c in (*keys, *extra)], *[c for c in right.columns if c not in (*keys, *extra)])
        on = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}r_")) for c in (*keys, *extra)], F.lit(True))
        return left.join(other, on, how).drop(*[f"{c}r_" for c in (*keys, *extra)])

    sizes = pinned(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("x_").alias("low"), F.max("x_").alias("high")).where("n > 0"))
    spots = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in shares.values()])
    asked = sizes.select(*keys, "low", "high", F.explode(spots).alias("at"))
    # a range: its ends, how many values lie below it, and a rank in it that is wanted of the whole group
    ranges = asked.select(*keys, "low", "high", F.lit(0).cast("long").alias("below"), F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    ranges = pinned(ranges)
    done, read = [], []
    for n in range(_MOST_ROUNDS):
        done.append(ranges.where("low = high").select(*keys, "rank", F.col("low").alias("x_")))
        open_ = ranges.where("low < high")
        if not open_.limit(1).count():
            break
        spans = open_.select(*keys, "low", "high", "below").distinct()
        spans = F.broadcast(spans) if spans.count() <= RANGES_SENT else spans
        inside = beside(rows, spans).where((F.col("x_") >= F.col("low")) & (F.col("x_") <= F.col("high")))
        bins = inside.withColumn("bin", _binned(F.col("x_"), F.col("low"), F.col("high"), n % 2 == 0))
        counts = bins.groupBy(*keys, "low", "high", "below", "bin").agg(F.count("*").alias("c"), F.min("x_").alias("from"), F.max("x_").alias("to"))
        upto = Window.partitionBy(*keys, "low", "high", "below").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # at most BINS rows
        run = counts.withColumn("upto", F.col("below") + F.sum("c").over(upto)).drop("bin")
        hit = beside(open_, run, ("low", "high", "below")).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
        read.append(ranges)
        ranges = pinned(hit.select(*keys, F.col("from").alias("low"), F.col("to").alias("high"), (F.col("upto") - F.col("c")).alias("below"), "rank"))
    else:
        raise RuntimeError("percentiles did not settle")
    found = functools.reduce(DataFrame.unionAll, done)
    known = beside(found, sizes.select(*keys, "n"))
    at = {m: F.lit(float(p)) * (F.col("n") - 1) for m, p in shares.items()}
    pick = lambda where: F.max(F.when(F.col("rank") == where, F.col("x_")))
    ends = known.groupBy(*keys, "n").agg(*[pick(f(at[m])).alias(f"{side}{k}_") for k, m in enumerate(shares) for side, f in (("a", F.floor), ("b", F.ceil))])
    made = {}
    for k, m in enumerate(shares):
        a, b, over = F.col(f"a{k}_"), F.col(f"b{k}_"), at[m] - F.floor(at[m])
        made[m] = F.when(over == 0, a).otherwise((1 - over) * a + over * b)
    told = pinned(ends.select(*keys, *[e.alias(m) for m, e in made.items()]))  # a row for each group
    unpin(sizes, ranges, *read)
    everyone = df.select(*named).distinct() if g else df.sparkSession.range(1).select()
    return beside(everyone, told, how="left").select(*[F.col(k).alias(c) for k, c in zip(keys, g)], *shares)
