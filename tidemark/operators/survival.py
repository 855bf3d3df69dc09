"""Competing-risks survival statistics. event: 0 censored, 1 the cause, 2 another end.

Rows are summed by distinct time first; products over times are windows over one row per distinct time and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import metrics as M

WIDTH, PERIODS = 0.5, 16


def durations(df: DataFrame, start: str, end: str, label: str, snapshot: str) -> DataFrame:
    """``df`` with time in years and event: label 1 is the cause, 0 another end, null runs until the snapshot.

    Ended rows without an end date are left out; times are not below 0.
    """
    last = F.coalesce(F.when(F.col(label).isNotNull(), F.col(end)), F.lit(snapshot).cast("date"))
    kept = df.where(F.col(label).isNull() | F.col(end).isNotNull())
    event = F.when(F.col(label) == 1, 1).when(F.col(label) == 0, 2).otherwise(0)
    return kept.withColumn("time", F.greatest(F.datediff(last, F.col(start)) / F.lit(365.25), F.lit(0.0))).withColumn("event", event)


def person_periods(df: DataFrame, width: float = WIDTH, periods: int = PERIODS) -> DataFrame:
    """One row per subject and period at risk; y is 0 but in the last period of an ended subject. Later periods are cut."""
    k = F.floor(F.col("time") / width).cast("int")
    late = k >= periods
    event = F.when(late, 0).otherwise(F.col("event"))
    count = F.least(k, F.lit(periods)) + (event > 0).cast("int")
    rows = df.withColumn("event_", event).withColumn("count_", count.cast("int")).where("count_ > 0")
    rows = rows.withColumn("period", F.explode(F.sequence(F.lit(0), F.col("count_") - 1)))
    y = F.when((F.col("period") == F.col("count_") - 1) & (F.col("event_") > 0), F.col("event_")).otherwise(0)
    return rows.withColumn("y", y).drop("event_", "count_")


def tally(df: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Per distinct time: ends by the cause, by another, censored, and the number at risk."""
    g = list(groups or [])
    d = df.groupBy(*g, "time").agg(F.count_if(F.col("event") == 1).alias("d1"), F.count_if(F.col("event") == 2).alias("d2"), F.count_if(F.col("event") == 0).alias("c"), F.count("*").alias("m"))
    later = Window.partitionBy(*g).orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("at_risk", F.sum("m").over(later)).drop("m")


def _product(factor: Column, window) -> Column:
    """Running product of factors in [0, 1]; 0 once a factor is 0."""
    zero = F.max((factor <= 0).cast("int")).over(window)
    return F.when(zero == 1, 0.0).otherwise(F.exp(F.sum(F.log(F.when(factor > 0, factor))).over(window)))


def censoring_survival(df: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Kaplan-Meier curve of not being censored: time and g after it; ends at the same time come first."""
    g = list(groups or [])
    t = tally(df, g).where("c > 0")
    factor = 1 - F.col("c") / (F.col("at_risk") - F.col("d1") - F.col("d2"))
    upto = Window.partitionBy(*g).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    return t.select(*g, "time", _product(factor, upto).alias("g"))


def aalen_johansen(df: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Cumulative incidence of the cause by distinct end time: time, incidence."""
    g = list(groups or [])
    t = tally(df, g).where("d1 + d2 > 0")
    factor = 1 - (F.col("d1") + F.col("d2")) / F.col("at_risk")
    earlier = Window.partitionBy(*g).orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*g).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    step = t.withColumn("s_", F.coalesce(_product(factor, earlier), F.lit(1.0)) * F.col("d1") / F.col("at_risk"))
    return step.select(*g, "time", F.sum("s_").over(upto).alias("incidence"))


def incidence_at(df: DataFrame, at: list[float], groups: list[str] | None = None) -> DataFrame:
    """Incidence at given times; 0 before the first end."""
    g = list(groups or [])
    curve = aalen_johansen(df, g)
    return curve.groupBy(*g).agg(*[F.coalesce(F.max(F.when(F.col("time") <= x, F.col("incidence"))), F.lit(0.0)).alias(f"at_{x:g}".replace(".", "_")) for x in at])


def ipcw(df: DataFrame, at: float) -> DataFrame:
    """``df`` with case_ (the cause by ``at``), control_ and the inverse-probability-of-censoring weight w_.

    Ended by ``at``: 1 / G just before its time; later: 1 / G(at); censored before: 0. The curve joins by distinct time.
    """
    curve = censoring_survival(df)
    points = df.select("time").distinct().withColumn("g", F.lit(None).cast("double")).unionByName(curve)
    marks = points.groupBy("time").agg(F.max("g").alias("g"))
    earlier = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    before = marks.select("time", F.coalesce(F.last("g", ignorenulls=True).over(earlier), F.lit(1.0)).alias("before_"))
    final = curve.where(F.col("time") <= at).agg(F.coalesce(F.min("g"), F.lit(1.0)).alias("final_"))
    floor = lambda c: F.greatest(c, F.lit(1e-12))
    ended = (F.col("time") <= at) & (F.col("event") > 0)
    w = F.when(ended, 1 / floor(F.col("before_"))).when(F.col("time") > at, 1 / floor(F.col("final_"))).otherwise(0.0)
    case = (F.col("time") <= at) & (F.col("event") == 1)
    control = (F.col("time") > at) | ((F.col("time") <= at) & (F.col("event") == 2))
    joined = df.join(before, "time").crossJoin(final)  # one row
    return joined.withColumn("w_", w).withColumn("case_", case).withColumn("control_", control).drop("before_", "final_")


def time_auc(df: DataFrame, risk: str, at: float) -> DataFrame:
    """Share of weighted case-control pairs in which the case has the higher risk, ties half."""
    tied = ipcw(df, at).groupBy(risk).agg(F.sum(F.when(F.col("case_"), F.col("w_")).otherwise(0.0)).alias("a"), F.sum(F.when(F.col("control_"), F.col("w_")).otherwise(0.0)).alias("b"))
    below = Window.orderBy(risk).rowsBetween(Window.unboundedPreceding, -1)
    run = tied.withColumn("low_", F.coalesce(F.sum("b").over(below), F.lit(0.0)))
    return run.agg((F.sum(F.col("a") * (F.col("low_") + F.col("b") / 2)) / F.nullif(F.sum("a") * F.sum("b"), F.lit(0.0))).alias("auc"))


def ipcw_brier(df: DataFrame, cif: str, at: float) -> DataFrame:
    miss = F.col("case_").cast("double") - F.col(cif)
    return ipcw(df, at).agg(F.count("*").alias("n"), F.avg(F.col("w_") * miss * miss).alias("brier"))


def cumulative_incidence(hazards: DataFrame, id: str) -> DataFrame:
    """Running states of long hazards (id, period, p_run, p_term): surviving_before, incidence, cif."""
    earlier = Window.partitionBy(id).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(id).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    s = hazards.withColumn("surviving_before", F.coalesce(_product(F.col("p_run"), earlier), F.lit(1.0)))
    s = s.withColumn("incidence", F.col("surviving_before") * F.col("p_term"))
    return s.withColumn("cif", F.sum("incidence").over(upto))


def conditional_cif(hazards: DataFrame, id: str, elapsed: str, years: float, width: float = WIDTH, periods: int = PERIODS) -> DataFrame:
    """id and risk: incidence in the next ``years`` given that the subject still runs after ``elapsed`` years."""
    m = F.least(F.greatest(F.floor(F.col(elapsed) / width), F.lit(0)), F.lit(periods - 1))
    last = F.least(m + round(years / width), F.lit(periods))
    s = cumulative_incidence(hazards, id).withColumn("m_", m).withColumn("last_", last)
    inside = F.sum(F.when((F.col("period") >= F.col("m_")) & (F.col("period") < F.col("last_")), F.col("incidence")).otherwise(0.0))
    alive = F.max(F.when(F.col("period") == F.col("m_"), F.col("surviving_before")))
    return s.groupBy(id).agg((inside / F.nullif(alive, F.lit(0.0))).alias("risk"))


def recalibrated(hazards: DataFrame, params: tuple[float, float, float, float]) -> DataFrame:
    """Hazards with a1 + b1 ln(p1 / p0) and a2 + b2 ln(p2 / p0) put through a softmax; (0, 1, 0, 1) changes nothing."""
    a1, b1, a2, b2 = params
    if (a1, b1, a2, b2) == (0.0, 1.0, 0.0, 1.0):
        return hazards
    log = lambda c: F.log(F.greatest(F.col(c), F.lit(1e-12)))
    one, two = F.exp(a1 + b1 * (log("p_term") - log("p_run"))), F.exp(a2 + b2 * (log("p_comp") - log("p_run")))
    h = hazards.withColumn("e1_", one).withColumn("e2_", two)
    z = 1 + F.col("e1_") + F.col("e2_")
    return h.withColumn("p_run", 1 / z).withColumn("p_term", F.col("e1_") / z).withColumn("p_comp", F.col("e2_") / z).drop("e1_", "e2_")


def at_landmark(df: DataFrame, start: str, date: str, longest: float = 6.0) -> DataFrame:
    """Subjects still running at ``date``, at most ``longest`` years after their start; time counts from there."""
    elapsed = F.datediff(F.lit(date).cast("date"), F.col(start)) / F.lit(365.25)
    kept = df.withColumn("elapsed", elapsed).where((F.col("elapsed") > 0) & (F.col("time") > F.col("elapsed")) & (F.col("elapsed") <= longest))
    return kept.withColumn("time", F.col("time") - F.col("elapsed"))


def observed_expected(periods: DataFrame, start: str, expected: str, width: float = WIDTH) -> DataFrame:
    """Per calendar year of the period's middle: observed and expected ends by the cause, and their ratio."""
    middle = F.date_add(F.col(start), F.round((F.col("period") + 0.5) * width * 365.25).cast("int"))
    years = periods.groupBy(F.year(middle).alias("year")).agg(F.count_if(F.col("y") == 1).alias("observed"), F.sum(expected).alias("expected"))
    return years.withColumn("ratio", F.col("observed") / F.nullif(F.col("expected"), F.lit(0.0)))


def calibration_by_bin(df: DataFrame, cif: str, key: str, at: float, bins: int = 10) -> DataFrame:
    """Mean predicted and Aalen-Johansen incidence at ``at`` in equal bins of the prediction."""
    placed = M.with_place(df, [cif, key], "place_", "n_")
    binned = placed.withColumn("bin", M.equal_bin(F.col("place_"), F.col("n_"), bins)).drop("place_", "n_")
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.avg(cif).alias("predicted")).join(incidence_at(binned, [at], ["bin"]).withColumnRenamed(f"at_{at:g}".replace(".", "_"), "observed"), "bin", "left")
