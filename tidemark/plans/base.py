"""The sample tables seen as the concepts that the operators work on.

orders are trials (F: stopped, O: finished, P: still running) whose sponsor is the customer; lineitem rows are reports on a
substance (the part) and, distinct, the map from trials to substances.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENDS = ("1998-01-01", "1999-01-01", "2000-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    label = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    reason = F.when(label == 1, F.when(F.col("o_orderpriority").startswith("1"), "safety").when(F.col("o_orderpriority").startswith("2"), "enrollment").otherwise("other"))
    return o.select(
        F.col("o_orderkey").alias("trial_id"),
        F.col("o_custkey").alias("sponsor"),
        F.to_date("o_orderdate").alias("start_date"),
        label.alias("label"),
        reason.alias("stop_reason"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("substance"), F.to_date("l_shipdate").alias("received"), (F.col("l_returnflag") == "R").alias("serious"), (F.col("l_linestatus") == "F").alias("death"))


def uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trial_id"), F.col("l_partkey").alias("substance")).distinct()


TRIALS_SQL = """trials AS (
  SELECT o_orderkey AS trial_id, o_custkey AS sponsor, o_orderdate::DATE AS start_date,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label,
    CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority LIKE '1%' THEN 'safety' WHEN o_orderpriority LIKE '2%' THEN 'enrollment' ELSE 'other' END END AS stop_reason,
    o_orderpriority AS priority, o_totalprice AS price
  FROM orders
)"""
MONTHLY_SQL = """monthly AS (
  SELECT l_partkey AS substance, date_trunc('month', l_shipdate)::DATE AS month, count(*) AS reports,
    count_if(l_returnflag = 'R')::BIGINT AS serious_reports, count_if(l_linestatus = 'F')::BIGINT AS death_reports
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2
)"""
USES_SQL = "uses AS (SELECT DISTINCT l_orderkey AS trial_id, l_partkey AS substance FROM lineitem)"
SAFETY_SQL = """safety AS (
  SELECT t.trial_id, count(DISTINCT m.substance) AS n_keys, coalesce(sum(m.reports), 0) AS reports,
    coalesce(sum(m.serious_reports), 0) AS serious_reports, coalesce(sum(m.death_reports), 0) AS death_reports,
    coalesce(sum(CASE WHEN m.month >= date_trunc('month', t.start_date) - INTERVAL 12 MONTH THEN m.reports END), 0) AS reports_recent
  FROM trials t JOIN uses u ON u.trial_id = t.trial_id
  LEFT JOIN monthly m ON m.substance = u.substance AND m.month < date_trunc('month', t.start_date)
  GROUP BY t.trial_id
)"""
HISTORY_SQL = """history AS (
  SELECT t.trial_id, count(s.trial_id) AS prior_n, avg(s.label::DOUBLE) AS prior_rate
  FROM trials t LEFT JOIN trials s ON s.sponsor = t.sponsor AND s.label IS NOT NULL AND s.start_date < t.start_date AND s.trial_id <> t.trial_id
  GROUP BY t.trial_id
)"""
RECENT_SQL = """recent AS (
  SELECT t.trial_id, count(s.trial_id) AS recent_n
  FROM trials t LEFT JOIN trials s ON s.sponsor = t.sponsor AND s.trial_id <> t.trial_id
    AND s.start_date >= t.start_date - INTERVAL 24 MONTH AND s.start_date < t.start_date
  GROUP BY t.trial_id
)"""
SPLIT_SQL = "CASE WHEN label IS NULL THEN 'score' WHEN start_date < DATE '1998-01-01' THEN 'train' WHEN start_date < DATE '1999-01-01' THEN 'test' WHEN start_date < DATE '2000-01-01' THEN 'recent' ELSE 'later' END"
FEATURES_SQL = f"""features AS (
  SELECT t.trial_id, t.label, {SPLIT_SQL} AS split,
    CASE WHEN t.label = 0 THEN 0 WHEN t.stop_reason = 'enrollment' THEN 1 END AS label_enrollment,
    CASE WHEN t.label = 0 THEN 0 WHEN t.stop_reason = 'safety' THEN 1 END AS label_safety,
    t.sponsor, t.start_date, t.priority, t.price,
    coalesce(h.prior_n, 0)::BIGINT AS sponsor_prior_trials, round(h.prior_rate, 6) AS sponsor_prior_termination_rate,
    coalesce(r.recent_n, 0)::BIGINT AS sponsor_trials_started_2y, coalesce(s.n_keys, 0)::BIGINT AS n_substances,
    coalesce(s.reports, 0)::BIGINT AS faers_reports, coalesce(s.reports_recent, 0)::BIGINT AS faers_reports_12m,
    round(s.serious_reports::DOUBLE / nullif(s.reports, 0), 6) AS faers_serious_share,
    round(s.death_reports::DOUBLE / nullif(s.reports, 0), 6) AS faers_death_share,
    coalesce(s.reports, 0) > 0 AS has_faers_history
  FROM trials t LEFT JOIN history h ON h.trial_id = t.trial_id LEFT JOIN recent r ON r.trial_id = t.trial_id LEFT JOIN safety s ON s.trial_id = t.trial_id
)"""
