"""Views, checks and relational shapes over the sample tables, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions import scalars as S
from tidemark.functions.percentiles import exact_percentiles as percentiles
from tidemark.models import audit
from tidemark.models.risk import reasons, score_type, top_drivers
from tidemark.operators import backtest, checks
from tidemark.operators import point_in_time as P
from tidemark.operators import registry as R
from tidemark.plans import base as B
from tidemark.plans.features import features, monthly
from tidemark.staging import pinned


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def latest_score(spark: SparkSession, d: str) -> DataFrame:
    e = B.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return R.latest_by(e, "user_id", [F.desc("ts"), F.desc("event_id")])


def latest_numeric_version(spark: SparkSession, d: str) -> DataFrame:
    """v10 is newer than v4."""
    e = B.table(spark, d, "events").select("user_id", "event_id", F.concat(F.lit("v"), _k()).alias("model_version"))
    return R.latest_by(e, "user_id", [S.version_number(F.col("model_version")).desc(), F.desc("event_id")])


def area_case_summary(spark: SparkSession, d: str) -> DataFrame:
    p = B.table(spark, d, "part")
    area = S.disease_area({"neoplasms": F.col("p_size") % 2 == 0, "cardiovascular": F.col("p_size") % 3 == 0, "mental": F.col("p_size") % 5 == 0, "blood": F.col("p_size") % 7 == 0})
    return p.groupBy(area.alias("disease_area")).agg(F.count("*").alias("trials"), F.round(F.avg("p_retailprice"), 4).alias("avg_risk"), F.count_if(F.col("p_size") >= 45).alias("top_decile_trials"))


def unresolved_not_in(spark: SparkSession, d: str) -> DataFrame:
    """Customers without a dear order, counted twice: once a null among the orders' customers hides them all."""
    c, o = B.table(spark, d, "customer"), B.table(spark, d, "orders").where("o_totalprice > 300000").select("o_custkey")
    null = o.limit(1).select(F.lit(None).cast("long").alias("o_custkey"))
    cases = {"known": o.where("o_custkey is not null"), "with a null": o.unionAll(null)}
    parts = [checks.missing(c, "c_custkey", side, "o_custkey").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys")).withColumn("case", F.lit(name)) for name, side in cases.items()]
    return parts[0].unionAll(parts[1])


def checks_union_having(spark: SparkSession, d: str) -> DataFrame:
    """Named checks over landing tables and the features built from them: one row per check with its number of failures."""
    for t in ("orders", "customer", "lineitem", "part"):
        B.table(spark, d, t).createOrReplaceTempView(f"check_{t}")
    B.trials(spark, d).createOrReplaceTempView("check_trials")
    pinned(features(spark, d)).createOrReplaceTempView("check_features")  # worked out once for all checks
    return checks.counted(spark, CHECKS)


CHECKS = """
-- check: no table is empty
SELECT 'orders' AS t FROM check_orders HAVING count(*) = 0 UNION ALL SELECT 'customer' AS t FROM check_customer HAVING count(*) = 0
UNION ALL SELECT 'lineitem' AS t FROM check_lineitem HAVING count(*) = 0 UNION ALL SELECT 'part' AS t FROM check_part HAVING count(*) = 0;

-- check: one row per order
SELECT o_orderkey FROM check_orders GROUP BY o_orderkey HAVING count(*) > 1;

-- check: every trial has features
SELECT trial_id FROM check_trials WHERE trial_id NOT IN (SELECT trial_id FROM check_features);

-- check: trials have a label if and only if they are not to be scored
SELECT trial_id FROM check_features WHERE (label IS NULL) <> (split = 'score');

-- check: there are trials to test on
SELECT 'test' AS t FROM check_features WHERE split = 'test' HAVING count(*) = 0;

-- check: shares are proportions
SELECT trial_id FROM check_features WHERE faers_serious_share NOT BETWEEN 0 AND 1 OR faers_death_share NOT BETWEEN 0 AND 1 OR sponsor_prior_termination_rate NOT BETWEEN 0 AND 1;

-- check: one row per report and substance
SELECT l_orderkey FROM check_lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1;

-- check: reason targets agree with the label
SELECT trial_id FROM check_features WHERE (label = 0 AND (label_safety <> 0 OR label_enrollment <> 0)) OR (coalesce(label, -1) <> 1 AND (label_safety = 1 OR label_enrollment = 1));

-- check: every order's customer is known
SELECT o_orderkey FROM check_orders WHERE o_custkey NOT IN (SELECT c_custkey FROM check_customer);

-- check: large orders are few
SELECT o_orderkey FROM check_orders WHERE o_totalprice > 400000;
"""


class _ByPrice:
    """A score that SQL can give, too: what the audit asks of a model."""

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("risk_score", F.round(F.least(F.col("price") / 500000 + F.col("month") / 100, F.lit(1.0)), 3))


def _edited(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Labeled orders, and what an earlier snapshot had of those with an even key: dearer if stopped, by a month off if finished."""
    latest = B.trials(spark, d).select("trial_id", "label", F.col("price").cast("double").alias("price"), F.month("start_date").alias("month"))
    earlier = latest.where("trial_id % 2 = 0").select("trial_id", (F.col("price") * F.when(F.col("label") == 1, 0.5).otherwise(1.0)).alias("price"), F.when(F.col("label") == 0, (F.col("month") % 12 + 1).cast("int")).otherwise(F.col("month")).alias("month"))
    return latest, earlier


def audit_pairs(spark: SparkSession, d: str) -> DataFrame:
    """AUC of one score on the latest and on the archived inputs."""
    pairs = audit.paired(_ByPrice(), *_edited(spark, d), "trial_id", "label", ["price", "month"])
    both = [M.auc(pairs, f"{side}_score", "label").select(F.lit(side).alias("inputs"), "n", "positives", F.round("auc", 6).alias("auc")) for side in ("latest", "archived")]
    return both[0].unionAll(both[1])


def audit_swaps(spark: SparkSession, d: str) -> DataFrame:
    """The drop in AUC when one input alone is as archived."""
    found = audit.swap_each(_ByPrice(), *_edited(spark, d), "trial_id", "label", ["price", "month"])
    return spark.createDataFrame([(x["column"], None if x["drop"] is None else round(x["drop"], 6)) for x in found], "column string, drop double")


def training_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Rows that would stop a training: unlabeled outside the score split, or finished with a reason."""
    f = features(spark, d).select("trial_id", F.when(F.col("trial_id") % 97 != 0, F.col("label")).alias("label"), "split", F.when(F.col("trial_id") % 89 == 0, 1).otherwise(F.col("label_safety")).alias("label_safety"))
    return checks.training_breaks(f, "label", "split", ["label_safety"]).groupBy("broken").agg(F.count("*").alias("n"), F.sum("trial_id").alias("keys"))


def dup_keys_having(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicates(B.table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


def semi_join_names(spark: SparkSession, d: str) -> DataFrame:
    o = B.table(spark, d, "orders").where("o_orderstatus = 'F'")
    return B.table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


def union_distinct_names(spark: SparkSession, d: str) -> DataFrame:
    a = B.table(spark, d, "nation").select(F.col("n_name").alias("name"))
    b = B.table(spark, d, "region").select(F.col("r_name").alias("name"))
    c = B.table(spark, d, "part").select(F.col("p_name").alias("name"))
    return a.unionByName(b).unionByName(c).distinct()


def set_difference(spark: SparkSession, d: str) -> DataFrame:
    """Parts that were never returned after the middle of 2000."""
    back = B.table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_shipdate >= '2000-07-01'").select("l_partkey")
    return B.table(spark, d, "part").select("p_partkey").join(back, F.col("p_partkey") == F.col("l_partkey"), "left_anti").distinct()


def latest_version_window(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a report's latest version; ties stay."""
    e = B.table(spark, d, "events").withColumn("version", _k())
    latest = F.max("version").over(Window.partitionBy("user_id", "event_type"))
    return e.withColumn("latest", latest).where("version = latest").select("event_id", "user_id", "event_type", "version")


def bool_or_pivot(spark: SparkSession, d: str) -> DataFrame:
    e = B.table(spark, d, "events")
    return e.groupBy("user_id").agg(*[F.bool_or(F.col("event_type") == t).alias(f"has_{t}") for t in ("view", "click", "purchase", "signup", "error")])


def bool_and_flag(spark: SparkSession, d: str) -> DataFrame:
    li = B.table(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.count_distinct("l_returnflag").alias("n_flags"), F.bool_and(F.col("l_returnflag") == "N").alias("none_returned"))


def sorted_string_agg(spark: SparkSession, d: str) -> DataFrame:
    n = B.table(spark, d, "nation")
    return n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ", ").alias("names"))


def exact_percentiles(spark: SparkSession, d: str) -> DataFrame:
    found = percentiles(B.table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return found.select("l_returnflag", *[F.round(n, 4).alias(n) for n in ("p10", "p50", "p90")])


def nested_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """The same by nested histograms, as for groups that no buffer holds."""
    rows = B.table(spark, d, "lineitem").withColumn("discounted", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4))
    found = percentiles(rows, ["l_linestatus", "l_returnflag"], "discounted", {"p05": 0.05, "p50": 0.5, "p99": 0.99}, few=0)
    return found.select("l_linestatus", "l_returnflag", *[F.round(n, 3).alias(n) for n in ("p05", "p50", "p99")])


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    e = B.table(spark, d, "events")
    e = e.select("event_type", F.nullif(_k(), F.lit(1)).alias("k"), F.when(F.col("value") > 10, F.col("value")).alias("v"))
    return R.null_profile(e, "event_type", ["k", "v"])


def change_rates(spark: SparkSession, d: str) -> DataFrame:
    f = B.trials(spark, d).where("label is not null").select("trial_id", "label", "priority", "price")
    a = f.select("trial_id", F.when(F.col("trial_id") % 5 == 0, "other").otherwise(F.col("priority")).alias("priority"), F.when(F.col("trial_id") % 7 != 0, F.col("price")).alias("price"))
    out = R.change_rates(f, a, "trial_id", "label", ["priority", "price"])
    return out.select("column", *[F.round(c, 6).alias(c) for c in ("changed_1", "changed_0", "gap")])


def unseen_levels(spark: SparkSession, d: str) -> DataFrame:
    p = B.table(spark, d, "part")
    out = R.unseen_levels(p.where("p_size > 20"), p.where("p_size <= 3"), "p_name")
    return out.select("unseen", "n", F.round("share", 6).alias("share"))


def overlay_fill(spark: SparkSession, d: str) -> DataFrame:
    """Archived values where there are any, in the latest's column order; nulls filled from the latest."""
    c = B.table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    a = c.where("c_custkey % 4 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.upper("c_mktsegment")).alias("c_mktsegment"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return R.fill_missing(R.overlay(c, a, "c_custkey", ["c_mktsegment", "c_acctbal"]), c, "c_custkey", ["c_mktsegment"]).withColumn("c_acctbal", F.round("c_acctbal", 4))


def topn_global(spark: SparkSession, d: str) -> DataFrame:
    """A top list is a limit by nature."""
    return B.trials(spark, d).select("trial_id", "price").orderBy(F.desc("price"), "trial_id").limit(400)


def topk_per_row(spark: SparkSession, d: str) -> DataFrame:
    """The three largest positive components of each embedding as drivers, and the reasons: those, then the two lowest."""
    parts = F.transform("embedding", lambda x, i: F.struct(F.format_string("f%02d", i).alias("feature"), x.cast("double").alias("contribution")))
    names = lambda c: F.array_join(F.transform(c, lambda s: s["feature"]), ",")
    return B.table(spark, d, "embeddings").select("vec_id", names(top_drivers(parts)).alias("drivers"), names(reasons(parts)).alias("reasons"))


def _published(spark: SparkSession, d: str) -> DataFrame:
    """Scores of trials, one version per line number, each published twice."""
    li = B.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trial_id"), F.concat(F.lit("v"), F.col("l_linenumber")).alias("model_version"), F.to_date("l_shipdate").alias("scored_at"), F.round(F.col("l_discount") * 10, 4).alias("risk_score"))
    again = li.withColumn("scored_at", F.date_add("scored_at", (F.col("trial_id") % 5 - 2).cast("int"))).withColumn("risk_score", F.round(F.col("risk_score") / 2, 4))
    return li.unionAll(again)


def first_scores(spark: SparkSession, d: str) -> DataFrame:
    return backtest.first_scores(_published(spark, d), "trial_id", "model_version", "scored_at", "risk_score")


def prospective_backtest(spark: SparkSession, d: str) -> DataFrame:
    out = backtest.prospective(_published(spark, d), B.trials(spark, d), "trial_id", "model_version", "scored_at", "risk_score", "label")
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def score_type_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many scores of each kind there are: of open trials, of held-out ones, of those trained on."""
    return features(spark, d).groupBy(score_type(F.col("split")).alias("score_type")).agg(F.count("*").alias("n"))


def serving_view(spark: SparkSession, d: str) -> DataFrame:
    """Latest score of each open trial with what a reviewer needs."""
    # open trials are few: what is read of lines is theirs, and history is worked out for them alone
    t = B.trials(spark, d).where("label is null").select("trial_id", "priority", "start_date")
    line = B.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trial_id"), F.col("l_partkey").alias("substance"), "l_linenumber", "l_shipdate", "l_discount").join(t.select("trial_id"), "trial_id", "left_semi")
    events = P.event_history(t, line.select("trial_id", "substance").distinct(), monthly(spark, d), "trial_id", "substance", "start_date", [])
    f = t.join(events, "trial_id", "left").withColumn("faers_reports", F.coalesce("reports", F.lit(0)).cast("long"))
    score = line.select("trial_id", "l_linenumber", F.col("l_shipdate").alias("scored_at"), F.round(F.col("l_discount") * 10, 4).alias("risk_score"))
    latest = score.groupBy("trial_id").agg(F.max(F.struct("scored_at", "l_linenumber", "risk_score")).alias("s")).select("trial_id", "s.risk_score")
    return latest.join(f, "trial_id").select("trial_id", "priority", "start_date", "faers_reports", "risk_score")


QUERIES = {f.__name__: f for f in (
    latest_score, latest_numeric_version, area_case_summary, unresolved_not_in, checks_union_having, dup_keys_having, semi_join_names, union_distinct_names, set_difference,
    latest_version_window, bool_or_pivot, bool_and_flag, sorted_string_agg, exact_percentiles, nested_percentiles, audit_pairs, audit_swaps, training_breaks, null_profile, change_rates, unseen_levels, overlay_fill, topn_global, topk_per_row, serving_view, first_scores, prospective_backtest, score_type_counts,
)}
K = "json_extract_string(props, '$.k')::INT"
_PUBLISHED = """p AS (SELECT l_orderkey AS trial_id, 'v' || l_linenumber AS model_version, l_shipdate::DATE AS scored_at, round(l_discount * 10, 4) AS risk_score FROM lineitem),
  q AS (SELECT * FROM p UNION ALL SELECT trial_id, model_version, scored_at + (trial_id % 5 - 2)::INT, round(risk_score / 2, 4) FROM p),
  f AS (SELECT trial_id, model_version, scored_at, risk_score FROM (SELECT *, row_number() OVER (PARTITION BY trial_id, model_version ORDER BY scored_at NULLS FIRST, risk_score) AS n FROM q) WHERE n = 1)"""
#: Share of pairs of a stopped and a finished order in which the stopped one scores higher, ties half, by ranks.
_AUC = "round((SELECT sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0 FROM (SELECT label, rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS r FROM pairs)) / (sum(label) * sum(1 - label)), 6)"
_SCORE = "round(least({price} / 500000 + {month} / 100, 1.0), 3)"
_AUDIT = f"""WITH {B.TRIALS_SQL}, latest AS (SELECT trial_id, label, price::DOUBLE AS price, month(start_date) AS month FROM trials),
      e AS (SELECT trial_id, price * CASE WHEN label = 1 THEN 0.5 ELSE 1 END AS price, CASE WHEN label = 0 THEN month % 12 + 1 ELSE month END AS month FROM latest WHERE trial_id % 2 = 0),
      pairs AS (SELECT t.trial_id, label, {_SCORE.format(price='t.price', month='t.month')} AS a, {_SCORE.format(price='e.price', month='e.month')} AS b, {_SCORE.format(price='e.price', month='t.month')} AS p, {_SCORE.format(price='t.price', month='e.month')} AS m FROM latest t JOIN e USING (trial_id) WHERE label IS NOT NULL)"""
SQL = {
    "latest_score": "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
    "latest_numeric_version": f"SELECT user_id, event_id, model_version FROM (SELECT user_id, event_id, 'v' || {K} AS model_version, row_number() OVER (PARTITION BY user_id ORDER BY {K} DESC, event_id DESC) AS n FROM events) WHERE n = 1",
    "area_case_summary": "SELECT CASE WHEN p_size % 2 = 0 THEN 'Oncology' WHEN p_size % 3 = 0 THEN 'Cardiovascular' WHEN p_size % 5 = 0 THEN 'Psychiatry' WHEN p_size % 7 = 0 THEN 'Hematology' ELSE 'Other' END AS disease_area, count(*) AS trials, round(avg(p_retailprice), 4) AS avg_risk, count_if(p_size >= 45)::BIGINT AS top_decile_trials FROM part GROUP BY 1",
    "unresolved_not_in": """WITH o AS (SELECT o_custkey FROM orders WHERE o_totalprice > 300000), x AS (SELECT o_custkey FROM o UNION ALL SELECT NULL)
      SELECT 'known' AS "case", count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM o WHERE o_custkey IS NOT NULL)
      UNION ALL SELECT 'with a null', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM x)""",
    "checks_union_having": f"""WITH {B.TRIALS_SQL}, {B.MONTHLY_SQL}, {B.USES_SQL}, {B.SAFETY_SQL}, {B.HISTORY_SQL}, {B.RECENT_SQL}, {B.FEATURES_SQL}
      SELECT 'no table is empty' AS name, (SELECT count(*) FROM (SELECT count(*) AS n FROM orders UNION ALL SELECT count(*) FROM customer UNION ALL SELECT count(*) FROM lineitem UNION ALL SELECT count(*) FROM part) WHERE n = 0) AS failures
      UNION ALL SELECT 'one row per order', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'every trial has features', (SELECT count(*) FROM trials WHERE trial_id NOT IN (SELECT trial_id FROM features))
      UNION ALL SELECT 'trials have a label if and only if they are not to be scored', (SELECT count(*) FROM features WHERE (label IS NULL) <> (split = 'score'))
      UNION ALL SELECT 'there are trials to test on', (SELECT (count(*) = 0)::INT FROM features WHERE split = 'test')
      UNION ALL SELECT 'shares are proportions', (SELECT count(*) FROM features WHERE faers_serious_share NOT BETWEEN 0 AND 1 OR faers_death_share NOT BETWEEN 0 AND 1 OR sponsor_prior_termination_rate NOT BETWEEN 0 AND 1)
      UNION ALL SELECT 'one row per report and substance', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1))
      UNION ALL SELECT 'reason targets agree with the label', (SELECT count(*) FROM features WHERE (label = 0 AND (label_safety <> 0 OR label_enrollment <> 0)) OR (coalesce(label, -1) <> 1 AND (label_safety = 1 OR label_enrollment = 1)))
      UNION ALL SELECT 'every order''s customer is known', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
      UNION ALL SELECT 'large orders are few', (SELECT count(*) FROM orders WHERE o_totalprice > 400000)""",
    "dup_keys_having": "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "semi_join_names": "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')",
    "union_distinct_names": "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT p_name FROM part",
    "set_difference": "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= '2000-07-01'",
    "latest_version_window": f"SELECT event_id, user_id, event_type, version FROM (SELECT *, {K} AS version, max({K}) OVER (PARTITION BY user_id, event_type) AS latest FROM events) WHERE version = latest",
    "bool_or_pivot": "SELECT user_id, " + ", ".join(f"bool_or(event_type = '{t}') AS has_{t}" for t in ("view", "click", "purchase", "signup", "error")) + " FROM events GROUP BY 1",
    "bool_and_flag": "SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_flags, bool_and(l_returnflag = 'N') AS none_returned FROM lineitem GROUP BY 1",
    "sorted_string_agg": "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names FROM nation GROUP BY 1",
    "audit_pairs": f"{_AUDIT} SELECT 'latest' AS inputs, n, positives, auc FROM (SELECT count(*) AS n, sum(label)::BIGINT AS positives, {_AUC.format(x='a')} AS auc FROM pairs) UNION ALL SELECT 'archived', n, positives, auc FROM (SELECT count(*) AS n, sum(label)::BIGINT AS positives, {_AUC.format(x='b')} AS auc FROM pairs)",
    "audit_swaps": f"{_AUDIT} SELECT 'price' AS column, round(a - p, 6) AS drop FROM (SELECT {_AUC.format(x='a')} AS a, {_AUC.format(x='p')} AS p FROM pairs) UNION ALL SELECT 'month', round(a - m, 6) FROM (SELECT {_AUC.format(x='a')} AS a, {_AUC.format(x='m')} AS m FROM pairs)",
    "training_breaks": f"""WITH {B.TRIALS_SQL}, f AS (SELECT trial_id, {B.SPLIT_SQL} AS split, CASE WHEN trial_id % 97 <> 0 THEN label END AS label, CASE WHEN trial_id % 89 = 0 THEN 1 WHEN label = 0 THEN 0 WHEN stop_reason = 'safety' THEN 1 END AS label_safety FROM trials),
      b AS (SELECT trial_id, 'no label outside the score split' AS broken FROM f WHERE split <> 'score' AND label IS NULL UNION ALL SELECT trial_id, 'label_safety is set for a finished trial' FROM f WHERE label = 0 AND label_safety <> 0)
      SELECT broken, count(*) AS n, sum(trial_id)::BIGINT AS keys FROM b GROUP BY 1""",
    "nested_percentiles": "SELECT l_linestatus, l_returnflag, " + ", ".join(f"round(quantile_cont(round(l_extendedprice * (1 - l_discount), 4), {q}), 3) AS {n}" for q, n in ((0.05, "p05"), (0.5, "p50"), (0.99, "p99"))) + " FROM lineitem GROUP BY ALL",
    "exact_percentiles": "SELECT l_returnflag, " + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 4) AS {n}" for q, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90"))) + " FROM lineitem GROUP BY 1",
    "null_profile": f"SELECT event_type, count(*) AS n, round(avg((nullif({K}, 1) IS NULL)::INT), 3) AS k, round(avg((value <= 10 OR value IS NULL)::INT), 3) AS v FROM events GROUP BY 1",
    "change_rates": f"""WITH {B.TRIALS_SQL}, x AS (SELECT label, (trial_id % 5 = 0)::INT::DOUBLE AS p, (trial_id % 7 = 0)::INT::DOUBLE AS q FROM trials WHERE label IS NOT NULL),
      y AS (SELECT 'priority' AS "column", avg(CASE WHEN label = 1 THEN p END) AS a, avg(CASE WHEN label = 0 THEN p END) AS b FROM x UNION ALL SELECT 'price', avg(CASE WHEN label = 1 THEN q END), avg(CASE WHEN label = 0 THEN q END) FROM x)
      SELECT "column", round(a, 6) AS changed_1, round(b, 6) AS changed_0, round(a - b, 6) AS gap FROM y""",
    "unseen_levels": "WITH a AS (SELECT p_name FROM part WHERE p_size > 20 AND p_name IS NOT NULL), k AS (SELECT DISTINCT p_name FROM part WHERE p_size <= 3), u AS (SELECT (SELECT count(*) FROM a WHERE p_name NOT IN (SELECT p_name FROM k)) AS unseen, (SELECT count(*) FROM a) AS n) SELECT unseen, n, round(unseen / nullif(n, 0), 6) AS share FROM u",
    "overlay_fill": "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN upper(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment, round(c_acctbal + 1, 4) AS c_acctbal, c_nationkey FROM customer WHERE c_custkey % 4 <> 0",
    "topn_global": "SELECT o_orderkey AS trial_id, o_totalprice AS price FROM orders ORDER BY price DESC, trial_id LIMIT 400",
    "topk_per_row": """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, printf('f%02d', generate_subscripts(embedding, 1) - 1) AS f FROM embeddings),
      u AS (SELECT vec_id, f, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, f DESC) AS n FROM e WHERE x > 0), v AS (SELECT vec_id, f, row_number() OVER (PARTITION BY vec_id ORDER BY x, f) AS n FROM e WHERE x < 0),
      a AS (SELECT vec_id, string_agg(f, ',' ORDER BY n) AS up FROM u WHERE n <= 3 GROUP BY 1), b AS (SELECT vec_id, string_agg(f, ',' ORDER BY n) AS down FROM v WHERE n <= 2 GROUP BY 1)
      SELECT vec_id, coalesce(up, '') AS drivers, concat_ws(',', up, down) AS reasons FROM embeddings LEFT JOIN a USING (vec_id) LEFT JOIN b USING (vec_id)""",
    "first_scores": f"WITH {_PUBLISHED} SELECT trial_id, model_version, scored_at, risk_score FROM f",
    "prospective_backtest": f"""WITH {B.TRIALS_SQL}, {_PUBLISHED}, k AS (SELECT f.*, label FROM f JOIN trials USING (trial_id) WHERE label IS NOT NULL),
      r AS (SELECT *, rank() OVER (PARTITION BY model_version ORDER BY risk_score) + (count(*) OVER (PARTITION BY model_version, risk_score) - 1) / 2.0::DOUBLE AS rk FROM k),
      g AS (SELECT model_version, count(*) AS n, sum(label)::BIGINT AS positives, sum(rk * label) AS s, min(scored_at) AS first_scored, round(avg(risk_score), 6) AS mean_score, round(avg((risk_score - label) * (risk_score - label)), 6) AS brier FROM r GROUP BY 1)
      SELECT model_version, n, positives, round((s - positives * (positives + 1) / 2.0::DOUBLE) / nullif(positives * (n - positives), 0)::DOUBLE, 6) AS auc, first_scored, mean_score, brier, CASE WHEN positives IN (0, n) THEN 'one class only' END AS note FROM g""",
    "score_type_counts": f"WITH {B.TRIALS_SQL} SELECT CASE {B.SPLIT_SQL} WHEN 'score' THEN 'forward' WHEN 'train' THEN 'out_of_fold' ELSE 'held_out' END AS score_type, count(*) AS n FROM trials GROUP BY 1",
    "serving_view": f"""WITH {B.TRIALS_SQL}, {B.MONTHLY_SQL}, {B.USES_SQL}, {B.SAFETY_SQL}, s AS (SELECT l_orderkey AS trial_id, round(l_discount * 10, 4) AS risk_score, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_discount DESC) AS n FROM lineitem)
      SELECT s.trial_id, priority, start_date, coalesce(reports, 0)::BIGINT AS faers_reports, risk_score FROM s JOIN trials t ON t.trial_id = s.trial_id AND label IS NULL LEFT JOIN safety f ON f.trial_id = s.trial_id WHERE n = 1""",
}
