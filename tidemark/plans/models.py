"""Fitted models over the sample tables; their results have no SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.models.features import TextComponents
from tidemark.models.attribution import Explainer, Node, Split
from tidemark.models.risk import LinearRisk, RiskModel, calibration_fit, contributed, reasons, top_drivers
from tidemark.models.survival import BoostedHazards, SurvivalModel, fit_recalibration
from tidemark.operators import survival as V
from tidemark.plans import base as B
from tidemark.plans.features import features
from tidemark.plans.statistics import ends, scored
from tidemark.staging import pinned

COLUMNS = ["priority", "price", "sponsor_prior_trials", "sponsor_prior_termination_rate", "faers_reports", "faers_serious_share"]


def tfidf_svd(spark: SparkSession, d: str) -> DataFrame:
    """64 components of up to 50,000 terms of all documents."""
    docs = B.table(spark, d, "documents").select("doc_id", "text")
    return TextComponents().fit(docs).transform(docs).drop("text")


def risk_model_scores(spark: SparkSession, d: str) -> DataFrame:
    f = pinned(features(spark, d))
    m = RiskModel(COLUMNS, (0, 1), maxIter=5, maxDepth=3).fit(f.where("split = 'train'"), "label")
    return m.score(f.where("split <> 'train'")).select("trial_id", "split", F.round("risk_score", 6).alias("risk_score"))


def linear_drivers(spark: SparkSession, d: str) -> DataFrame:
    f = pinned(features(spark, d))
    m = LinearRisk(COLUMNS).fit(f.where("split = 'train'"), "label")
    return m.contributions(f.where("split = 'score'")).select("trial_id", top_drivers(F.col("contributions")).alias("drivers"))


def tree_contributions(spark: SparkSession, d: str) -> DataFrame:
    """What price and month of the order add to the share of stopped trials that a tree of three splits gives.

    The tree's covers and values are counted over all orders; its contributions are exact, so SQL can work them out from the four
    sets of known inputs.
    """
    rows = B.trials(spark, d).select("trial_id", F.col("price").cast("double").alias("price"), F.month("start_date").cast("double").alias("month"), (F.coalesce("label", F.lit(0)) == 1).cast("double").alias("y"))
    dear = (F.col("price") > 150000).cast("int").alias("dear")
    late = F.when(F.col("price") > 150000, F.col("month") > 9).otherwise(F.col("month") > 6).cast("int").alias("late")
    parts = {(r.dear, r.late): (float(r.n), float(r.y)) for r in rows.groupBy(dear, late).agg(F.count("*").alias("n"), F.avg("y").alias("y")).collect()}  # four rows at most
    leaf = lambda a, b: Node(*parts.get((a, b), (0.0, 0.0)))

    def branch(a: int, cut: float) -> Node:
        left, right = leaf(a, 0), leaf(a, 1)
        return Node(left.cover + right.cover, 0.0, Split(1, cut), left, right)

    cheap, dear_ = branch(0, 6.0), branch(1, 9.0)
    told = contributed(rows.withColumn("x", F.array("price", "month")), "x", Explainer([Node(cheap.cover + dear_.cover, 0.0, Split(0, 150000.0), cheap, dear_)], [1.0], [0, 1]))
    return told.select("trial_id", *[F.round(F.col("contributions")[k], 6).alias(n) for k, n in enumerate(("by_price", "by_month"))])


def tree_drivers(spark: SparkSession, d: str) -> DataFrame:
    """The strongest reasons for each score of a fitted ensemble, up and down."""
    f = pinned(features(spark, d))
    m = RiskModel(COLUMNS, (0,), maxIter=5, maxDepth=3).fit(f.where("split = 'train'"), "label")
    return m.contributions(f.where("split <> 'train'")).select("trial_id", reasons(F.col("contributions")).alias("reasons"))


def boosted_hazards(spark: SparkSession, d: str) -> DataFrame:
    """Hazards of each trial and half-year by boosted trees of three outcomes: three members of all the operator's rounds."""
    e = pinned(ends(spark, d).withColumn("x", (F.col("trial_id") % 3).cast("double")))
    return BoostedHazards(["x"], (0, 1, 2)).fit(e).hazards(e, "trial_id", digits=6)


def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    return M.bootstrap_auc(scored(spark, d), "score", "y", 100)


def recalibration_fit(spark: SparkSession, d: str) -> DataFrame:
    e = pinned(ends(spark, d).select("trial_id", "time", "event", (F.col("trial_id") % 3).alias("x")))
    m = SurvivalModel(["x"]).fit(e)
    rows = m.hazards_of(V.person_periods(e), ["y"])
    return spark.createDataFrame([fit_recalibration(rows)], "a1 double, b1 double, a2 double, b2 double")


def calibration_line(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([tuple(calibration_fit(scored(spark, d), "score", "y").values())], "intercept double, joint_intercept double, slope double")


QUERIES = {f.__name__: f for f in (tfidf_svd, risk_model_scores, linear_drivers, tree_contributions, tree_drivers, boosted_hazards, bootstrap_ci, recalibration_fit, calibration_line)}
SQL: dict = {
    "tree_contributions": f"""WITH {B.TRIALS_SQL}, r AS (
        SELECT trial_id, price > 150000 AS dear, CASE WHEN price > 150000 THEN month(start_date) > 9 ELSE month(start_date) > 6 END AS late, month(start_date) AS m,
          (coalesce(label, 0) = 1)::INT::DOUBLE AS y FROM trials),
      leaf AS (SELECT dear, late, count(*) AS n, avg(y) AS v FROM r GROUP BY 1, 2),
      side AS (SELECT dear, sum(n) AS n, sum(n * v) / sum(n) AS mean FROM leaf GROUP BY 1),
      none AS (SELECT sum(n * mean) / sum(n) AS v0, sum(n) AS n FROM side),
      of_month AS (  -- only the month is known: both sides by their share, each with the leaf that the month leads to
        SELECT m, sum(side.n * leaf.v) / any_value(none.n) AS v FROM (SELECT DISTINCT m FROM r), side, none, leaf
        WHERE leaf.dear = side.dear AND leaf.late = (m > CASE WHEN side.dear THEN 9 ELSE 6 END) GROUP BY m)
      SELECT trial_id, round(((side.mean - v0) + (leaf.v - of_month.v)) / 2, 6) AS by_price, round(((of_month.v - v0) + (leaf.v - side.mean)) / 2, 6) AS by_month
      FROM r JOIN leaf USING (dear, late) JOIN side USING (dear) JOIN of_month USING (m), none""",
}
