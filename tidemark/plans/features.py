"""Point-in-time features over the sample tables, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import AREAS, rounded
from tidemark.operators import point_in_time as P
from tidemark.plans import base as B
from tidemark.plans import registry

ATTRIBUTES = ["n_countries", "us_only", "min_age_years", "max_age_years", "healthy_volunteers", "sex", "criteria_count", "criteria_chars", "responsible_party", "n_collaborators", "n_keywords", *[f"area_{k}" for k in AREAS]]


def monthly(spark: SparkSession, d: str) -> DataFrame:
    return P.monthly_rollup(B.reports(spark, d), "substance", "received", {"serious_reports": F.col("serious"), "death_reports": F.col("death")})


def history(spark: SparkSession, d: str) -> DataFrame:
    t = B.trials(spark, d)
    ended = t.where("label is not null").select("trial_id", "sponsor", F.col("start_date").alias("ended"), "label")
    return P.prior_history(t.select("trial_id", "sponsor", "start_date"), ended, "trial_id", "sponsor", "start_date", "ended", "label")


def recent(spark: SparkSession, d: str) -> DataFrame:
    t = B.trials(spark, d).select("trial_id", "sponsor", "start_date")
    return P.starts_within(t, t, "trial_id", "sponsor", "start_date", 24)


def safety(spark: SparkSession, d: str) -> DataFrame:
    return P.event_history(B.trials(spark, d).select("trial_id", "start_date"), B.uses(spark, d), monthly(spark, d), "trial_id", "substance", "start_date", ["serious_reports", "death_reports"])


def features(spark: SparkSession, d: str) -> DataFrame:
    f = P.feature_row(B.trials(spark, d), None, history(spark, d), recent(spark, d), safety(spark, d), None, "trial_id", B.ENDS)
    for c in ("sponsor_prior_termination_rate", "faers_serious_share", "faers_death_share"):
        f = f.withColumn(c, rounded(F.col(c), 6))
    return f


def trial_features_whole(spark: SparkSession, d: str) -> DataFrame:
    """All feature groups of the trials that the snapshot has as eligible: history, events, attributes and the text."""
    number = F.substring("nct_id", 2, 20).cast("long").alias("trial_id")
    attributes = registry.trial_attributes(spark, d).select(number, *[c for c in ATTRIBUTES])
    text = registry.trial_texts(spark, d).select(number, "text")
    f = P.feature_row(B.trials(spark, d).join(attributes.select("trial_id"), "trial_id", "left_semi"), attributes, history(spark, d), recent(spark, d), safety(spark, d), text, "trial_id", B.ENDS)
    return f.withColumns({c: rounded(F.col(c), 6) for c in ("sponsor_prior_termination_rate", "faers_serious_share", "faers_death_share")})


def sponsor_history(spark: SparkSession, d: str) -> DataFrame:
    return history(spark, d).withColumn("prior_rate", rounded(F.col("prior_rate"), 6))


def split_summary(spark: SparkSession, d: str) -> DataFrame:
    t = B.trials(spark, d)
    split = P.split_of(F.col("label"), F.col("start_date"), *B.ENDS).alias("split")
    return t.groupBy(split).agg(F.count("*").alias("trials"), F.round(F.avg(F.col("label").cast("double")), 6).alias("rate")).orderBy("split")


def reason_targets(spark: SparkSession, d: str) -> DataFrame:
    t = B.trials(spark, d)
    return t.select("trial_id", *[P.reason_target(F.col("label"), F.col("stop_reason"), r).alias(f"label_{r}") for r in ("enrollment", "safety")])


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Left rows stay; the condition on the label is part of the join."""
    t = B.trials(spark, d)
    o = B.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.max(F.to_date("l_shipdate")).alias("end_date"))
    return t.join(o, (F.col("order_id") == F.col("trial_id")) & F.col("label").isNotNull(), "left").select("trial_id", "label", "start_date", "end_date")


def nearest(spark: SparkSession, d: str) -> DataFrame:
    """The customer's order nearest to the supplier-like anchor date, before it if there is one."""
    seen = B.trials(spark, d).groupBy("sponsor", F.col("start_date").alias("archive_date")).agg(F.max("price").alias("price"))
    starts = B.table(spark, d, "customer").select(F.col("c_custkey").alias("sponsor"), F.when(F.col("c_custkey") % 7 != 0, F.date_add(F.lit("1995-06-01").cast("date"), (F.col("c_custkey") * 37 % 2000).cast("int"))).alias("start_date"))
    return P.nearest_record(seen, starts, "sponsor", "archive_date", "start_date")


QUERIES = {
    "monthly_rollup": monthly,
    "drug_safety_asof": safety,
    "sponsor_history": sponsor_history,
    "sponsor_starts_24m": recent,
    "trial_features": features,
    "trial_features_whole": trial_features_whole,
    "split_summary": split_summary,
    "reason_targets": reason_targets,
    "outcomes_on_clause": outcomes,
    "nearest_asof": nearest,
}
SQL = {
    "monthly_rollup": f"WITH {B.MONTHLY_SQL} SELECT * FROM monthly",
    "drug_safety_asof": f"WITH {B.TRIALS_SQL}, {B.MONTHLY_SQL}, {B.USES_SQL}, {B.SAFETY_SQL} SELECT trial_id, n_keys, reports::BIGINT AS reports, serious_reports::BIGINT AS serious_reports, death_reports::BIGINT AS death_reports, reports_recent::BIGINT AS reports_recent FROM safety",
    "sponsor_history": f"WITH {B.TRIALS_SQL}, {B.HISTORY_SQL} SELECT trial_id, prior_n, round(prior_rate, 6) AS prior_rate FROM history",
    "sponsor_starts_24m": f"WITH {B.TRIALS_SQL}, {B.RECENT_SQL} SELECT * FROM recent",
    "trial_features": f"WITH {B.TRIALS_SQL}, {B.MONTHLY_SQL}, {B.USES_SQL}, {B.SAFETY_SQL}, {B.HISTORY_SQL}, {B.RECENT_SQL}, {B.FEATURES_SQL} SELECT * FROM features",
    "trial_features_whole": f"WITH {B.TRIALS_SQL}, {B.MONTHLY_SQL}, {B.USES_SQL}, {B.SAFETY_SQL}, {B.HISTORY_SQL}, {B.RECENT_SQL}, {B.FEATURES_SQL} SELECT f.*, a.* EXCLUDE (nct_id), x.text FROM features f JOIN ({registry.SQL['trial_attributes']}) a ON a.nct_id = concat('T', trial_id) JOIN ({registry.SQL['trial_texts']}) x ON x.nct_id = a.nct_id",
    "split_summary": f"WITH {B.TRIALS_SQL} SELECT {B.SPLIT_SQL} AS split, count(*) AS trials, round(avg(label::DOUBLE), 6) AS rate FROM trials GROUP BY 1 ORDER BY 1",
    "reason_targets": f"WITH {B.TRIALS_SQL} SELECT trial_id, CASE WHEN label = 0 THEN 0 WHEN stop_reason = 'enrollment' THEN 1 END AS label_enrollment, CASE WHEN label = 0 THEN 0 WHEN stop_reason = 'safety' THEN 1 END AS label_safety FROM trials",
    "outcomes_on_clause": f"WITH {B.TRIALS_SQL}, o AS (SELECT l_orderkey, max(l_shipdate::DATE) AS end_date FROM lineitem GROUP BY 1) SELECT trial_id, label, start_date, end_date FROM trials LEFT JOIN o ON l_orderkey = trial_id AND label IS NOT NULL",
    "nearest_asof": f"""WITH {B.TRIALS_SQL}, seen AS (SELECT sponsor, start_date AS archive_date, max(price) AS price FROM trials GROUP BY 1, 2),
      starts AS (SELECT c_custkey AS sponsor, CASE WHEN c_custkey % 7 <> 0 THEN DATE '1995-06-01' + (c_custkey * 37 % 2000)::INT END AS anchor FROM customer),
      r AS (SELECT seen.*, (archive_date - anchor)::INT AS lag_days, row_number() OVER (PARTITION BY sponsor ORDER BY (archive_date - anchor > 0), abs(archive_date - anchor), archive_date) AS place
        FROM seen JOIN starts USING (sponsor) WHERE anchor IS NOT NULL)
      SELECT sponsor, archive_date, price, lag_days FROM r WHERE place = 1""",
}
