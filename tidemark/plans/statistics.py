"""Metrics and survival statistics over the sample tables, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions.scalars import rounded
from tidemark.models.features import pooled
from tidemark.operators import survival as V
from tidemark.plans import base as B


def scored(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, a rounded score with ties, the label and the language."""
    doc = B.table(spark, d, "documents").select("doc_id", "lang", rounded(F.least(F.col("n_chars") / F.lit(20000.0), F.lit(1.0)), 3).alias("score"))
    return doc.join(B.table(spark, d, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def top_fraction_precision(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.top_fraction_precision(scored(spark, d), "score", "y", "doc_id")).select(F.col("k").cast("long").alias("k"), "precision")


def auc_rank_sum(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.auc(scored(spark, d), "score", "y"))


def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.average_precision(scored(spark, d), "score", "y"))


def brier(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.brier(scored(spark, d), "score", "y"))


def calibration_deciles(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.calibration(scored(spark, d), "score", "y", "doc_id"))


def subgroup_auc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.subgroup_auc(scored(spark, d), "score", "y", "lang", 5))


def percentile_vs_reference(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    return M.percentile_against(s.select("doc_id", "score"), s.where("y = 1").select(F.col("score").alias("ref")), "score", "ref")


def spearman(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d).withColumn("other", F.pmod(F.col("doc_id") * 7, F.lit(100)) + F.col("score") * 50)
    return _rounded(M.spearman(s, "score", "other"))


def score_deciles(spark: SparkSession, d: str) -> DataFrame:
    s = M.with_place(scored(spark, d).select("doc_id", "score"), ["score", "doc_id"], total="n")
    return s.select("doc_id", M.decile(F.col("place"), F.col("n")).alias("decile"))


def equal_bins(spark: SparkSession, d: str) -> DataFrame:
    p = M.with_place(B.table(spark, d, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], "place", "n")
    return p.select("p_partkey", M.equal_bin(F.col("place"), F.col("n"), 10).alias("bin"))


def calibration_by_bin(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(V.calibration_by_bin(risked(spark, d), "risk", "trial_id", 2.0))


def pooled_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of a label pooled as the windows of one text, weighted by a length; one row per component."""
    e = B.table(spark, d, "embeddings").select("label", F.transform("embedding", lambda x: x.cast("double")).alias("v"), (F.col("vec_id") % 7 + 1).alias("tokens"))
    out = pooled(e, "label", "v", "tokens").select("label", F.posexplode("embedding").alias("i", "x"))
    return out.select("label", "i", F.round("x", 6).alias("x"))


def ends(spark: SparkSession, d: str) -> DataFrame:
    """Years from a customer's orders' dates to their last shipment; ends by status, open ones run until the snapshot."""
    li = B.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("trial_id")).agg(F.max(F.to_date("l_shipdate")).alias("shipped"))
    t = B.trials(spark, d).join(li, "trial_id", "left").withColumn("end_date", F.greatest("shipped", F.date_add("start_date", (F.col("trial_id") % 1500).cast("int"))))
    out = V.durations(t, "start_date", "end_date", "label", "2001-12-01")
    return out.select("trial_id", "start_date", "label", F.round("time", 3).alias("time"), F.col("event").cast("int").alias("event"))


def durations(spark: SparkSession, d: str) -> DataFrame:
    return ends(spark, d)


def person_period(spark: SparkSession, d: str) -> DataFrame:
    return V.person_periods(ends(spark, d)).groupBy("period", "y").agg(F.count("*").alias("n"))


def km_censoring(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(V.censoring_survival(ends(spark, d)))


def aalen_johansen(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(V.aalen_johansen(ends(spark, d)))


def aj_by_cohort(spark: SparkSession, d: str) -> DataFrame:
    e = ends(spark, d).withColumn("cohort", F.year("start_date"))
    return _rounded(V.incidence_at(e, [1.0, 2.0, 5.0], ["cohort"]))


def risked(spark: SparkSession, d: str) -> DataFrame:
    return ends(spark, d).withColumn("risk", F.round(F.pmod(F.col("trial_id") * 37, F.lit(1000)) / F.lit(1000.0), 3))


def ipcw_auc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(V.time_auc(risked(spark, d), "risk", 2.0))


def ipcw_brier(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(V.ipcw_brier(risked(spark, d), "risk", 2.0))


def observed_expected_by_year(spark: SparkSession, d: str) -> DataFrame:
    p = V.person_periods(ends(spark, d)).withColumn("expected", F.lit(0.02) + F.col("period") * F.lit(0.001))
    out = V.observed_expected(p, "start_date", "expected")
    return out.select("year", "observed", F.round("expected", 4).alias("expected"), F.round("ratio", 4).alias("ratio"))


def hazards(spark: SparkSession, d: str) -> DataFrame:
    s = B.table(spark, d, "supplier").select("s_suppkey", F.round(F.col("s_suppkey") % 9 * 0.45, 2).alias("elapsed"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("period"))
    term, comp = F.lit(0.01) + F.col("s_suppkey") % 5 * F.lit(0.004), F.lit(0.02) + F.col("period") * F.lit(0.002)
    return s.withColumn("p_term", term).withColumn("p_comp", comp).withColumn("p_run", 1 - term - comp)


def conditional_cif(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(V.conditional_cif(hazards(spark, d), "s_suppkey", "elapsed", 2.0))


def cumulative_incidence(spark: SparkSession, d: str) -> DataFrame:
    h = V.cumulative_incidence(V.recalibrated(hazards(spark, d), (0.1, 0.9, -0.1, 1.1)), "s_suppkey")
    return h.select("s_suppkey", "period", *[F.round(c, 6).alias(c) for c in ("p_term", "surviving_before", "cif")])


def landmark_set(spark: SparkSession, d: str) -> DataFrame:
    out = V.at_landmark(ends(spark, d), "start_date", "1999-01-01")
    return out.select("trial_id", F.round("elapsed", 3).alias("elapsed"), F.round("time", 3).alias("time"), "event")


QUERIES = {f.__name__: f for f in (
    top_fraction_precision, auc_rank_sum, average_precision, brier, calibration_deciles, subgroup_auc, percentile_vs_reference, spearman, score_deciles, equal_bins, pooled_embeddings, calibration_by_bin, durations, person_period,
    km_censoring, aalen_johansen, aj_by_cohort, ipcw_auc, ipcw_brier, observed_expected_by_year, conditional_cif, cumulative_incidence, landmark_set,
)}
_S = "s AS (SELECT doc_id, lang, round(least(n_chars / 20000.0::DOUBLE, 1.0::DOUBLE), 3) AS score, quality AS y FROM documents JOIN labels USING (doc_id))"
_R = "r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM s)"
_E = f"""{B.TRIALS_SQL}, li AS (SELECT l_orderkey AS trial_id, max(l_shipdate::DATE) AS shipped FROM lineitem GROUP BY 1),
  t0 AS (SELECT t.*, greatest(shipped, start_date + (t.trial_id % 1500)::INT) AS end_date FROM trials t LEFT JOIN li USING (trial_id)),
  e AS (SELECT trial_id, start_date, label, round(greatest(((CASE WHEN label IS NOT NULL THEN end_date ELSE DATE '2001-12-01' END) - start_date) / 365.25::DOUBLE, 0), 3) AS time, CASE label WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 0 END AS event
    FROM t0 WHERE label IS NULL OR end_date IS NOT NULL),
  tally AS (SELECT time, count(*) FILTER (event = 1) AS d1, count(*) FILTER (event = 2) AS d2, count(*) FILTER (event = 0) AS c, sum(count(*)) OVER (ORDER BY time DESC) AS at_risk FROM e GROUP BY time)"""
_G = "g AS (SELECT time, CASE WHEN max((1 - c / (at_risk - d1 - d2)::DOUBLE <= 0)::INT) OVER w = 1 THEN 0.0::DOUBLE ELSE exp(sum(ln(CASE WHEN 1 - c / (at_risk - d1 - d2)::DOUBLE > 0 THEN 1 - c / (at_risk - d1 - d2)::DOUBLE END)) OVER w) END AS g FROM tally WHERE c > 0 WINDOW w AS (ORDER BY time))"
_W = f"""{_E}, {_G}, k AS (SELECT *, round((trial_id * 37 % 1000) / 1000.0::DOUBLE, 3) AS risk FROM e),
  q AS (SELECT k.*, coalesce(g.g, 1.0::DOUBLE) AS before, (SELECT coalesce(min(g), 1.0::DOUBLE) FROM g WHERE time <= 2) AS last FROM k ASOF LEFT JOIN g ON k.time > g.time),
  w AS (SELECT *, CASE WHEN time <= 2 AND event > 0 THEN 1 / greatest(before, 1e-12::DOUBLE) WHEN time > 2 THEN 1 / greatest(last, 1e-12::DOUBLE) ELSE 0.0::DOUBLE END AS w, time <= 2 AND event = 1 AS is_case, time > 2 OR event = 2 AS is_control FROM q)"""
_P = "p AS (SELECT e.*, floor(time / 0.5::DOUBLE)::INT AS k FROM e), pc AS (SELECT *, CASE WHEN k >= 16 THEN 0 ELSE event END AS ev, least(k, 16) + (CASE WHEN k >= 16 THEN 0 ELSE event END > 0)::INT AS cnt FROM p), pp AS (SELECT *, unnest(range(cnt))::INT AS period FROM pc), py AS (SELECT *, CASE WHEN period = cnt - 1 AND ev > 0 THEN ev ELSE 0 END AS y FROM pp)"
_H = "h AS (SELECT s_suppkey, round(s_suppkey % 9 * 0.45::DOUBLE, 2) AS elapsed, unnest(range(16))::INT AS period FROM supplier), hz AS (SELECT *, 0.01::DOUBLE + s_suppkey % 5 * 0.004::DOUBLE AS p_term, 0.02::DOUBLE + period * 0.002::DOUBLE AS p_comp FROM h), hr AS (SELECT *, 1 - p_term - p_comp AS p_run FROM hz)"
SQL = {
    "top_fraction_precision": f"WITH {_S}, o AS (SELECT y, row_number() OVER (ORDER BY score DESC, doc_id) AS n, greatest(1, round_even(count(*) OVER () * 0.1, 0))::BIGINT AS k FROM s) SELECT max(k) AS k, round(avg(y::DOUBLE), 6) AS precision FROM o WHERE n <= k",
    "auc_rank_sum": f"WITH {_S}, {_R} SELECT count(*) AS n, sum(y)::BIGINT AS positives, round((sum(rk * y) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y) * (count(*) - sum(y)))::DOUBLE, 6) AS auc FROM r",
    "average_precision": f"WITH {_S}, t AS (SELECT score, count(*) AS m, sum(y) AS p FROM s GROUP BY 1), u AS (SELECT p, sum(m) OVER (ORDER BY score DESC) AS m_, sum(p) OVER (ORDER BY score DESC) AS p_ FROM t) SELECT round(sum(p * (p_::DOUBLE / m_)) / nullif(sum(p), 0)::DOUBLE, 6) AS average_precision FROM u",
    "brier": f"WITH {_S} SELECT count(*) AS n, round(avg((score - y) * (score - y)), 6) AS brier FROM s",
    "calibration_deciles": f"WITH {_S}, o AS (SELECT *, row_number() OVER (ORDER BY score, doc_id) AS rn, count(*) OVER () AS n FROM s) SELECT greatest(1, ceil((rn - 1) * 10 / greatest(n - 1, 1)::DOUBLE))::INT AS bin, count(*) AS n, round(avg(score), 6) AS predicted, round(avg(y::DOUBLE), 6) AS observed FROM o GROUP BY 1",
    "subgroup_auc": f"WITH {_S}, r AS (SELECT *, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2.0::DOUBLE AS rk FROM s) SELECT lang, count(*) AS n, sum(y)::BIGINT AS positives, round((sum(rk * y) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y) * (count(*) - sum(y)))::DOUBLE, 6) AS auc FROM r GROUP BY lang HAVING count(*) >= 5 AND sum(y) > 0 AND sum(y) < count(*)",
    "percentile_vs_reference": f"WITH {_S} SELECT doc_id, score, round(100.0::DOUBLE * (SELECT count(*) FROM s r WHERE r.y = 1 AND r.score < s.score) / (SELECT count(*) FROM s r WHERE r.y = 1), 1) AS percentile FROM s",
    "spearman": f"WITH {_S}, o AS (SELECT score, (doc_id * 7 % 100) + score * 50 AS other FROM s), k AS (SELECT rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY other) + (count(*) OVER (PARTITION BY other) - 1) / 2.0::DOUBLE AS b FROM o) SELECT count(*) AS n, round(corr(a, b), 6) AS spearman FROM k",
    "score_deciles": f"WITH {_S} SELECT doc_id, greatest(1, ceil((row_number() OVER (ORDER BY score, doc_id) - 1) * 10 / greatest(count(*) OVER () - 1, 1)::DOUBLE))::INT AS decile FROM s",
    "equal_bins": "SELECT p_partkey, ntile(10) OVER (ORDER BY p_retailprice, p_partkey)::INT AS bin FROM part",
    "pooled_embeddings": """WITH e AS (SELECT label, vec_id % 7 + 1 AS n, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), m AS (SELECT label, i, sum(x * n) / sum(n) AS x FROM e GROUP BY 1, 2)
      SELECT label, i::INT AS i, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) AS x FROM m""",
    "durations": f"WITH {_E} SELECT * FROM e",
    "person_period": f"WITH {_E}, {_P} SELECT period, y, count(*) AS n FROM py GROUP BY 1, 2",
    "km_censoring": f"WITH {_E}, {_G} SELECT time, round(g, 6) AS g FROM g",
    "aalen_johansen": f"WITH {_E}, a AS (SELECT time, d1, at_risk, coalesce(exp(sum(ln(CASE WHEN d1 + d2 < at_risk THEN 1 - (d1 + d2) / at_risk::DOUBLE END)) OVER (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS s FROM tally WHERE d1 + d2 > 0) SELECT time, round(sum(s * d1 / at_risk::DOUBLE) OVER (ORDER BY time), 6) AS incidence FROM a",
    "aj_by_cohort": f"""WITH {_E}, tc AS (SELECT year(start_date)::INT AS cohort, time, count(*) FILTER (event = 1) AS d1, count(*) FILTER (event = 2) AS d2, sum(count(*)) OVER (PARTITION BY year(start_date) ORDER BY time DESC) AS at_risk FROM e GROUP BY 1, year(start_date), time),
      a AS (SELECT cohort, time, d1, at_risk, coalesce(exp(sum(ln(CASE WHEN d1 + d2 < at_risk THEN 1 - (d1 + d2) / at_risk::DOUBLE END)) OVER (PARTITION BY cohort ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS s FROM tc WHERE d1 + d2 > 0),
      b AS (SELECT cohort, time, sum(s * d1 / at_risk::DOUBLE) OVER (PARTITION BY cohort ORDER BY time) AS i FROM a)
      SELECT cohort, """ + ", ".join(f"round(coalesce(max(CASE WHEN time <= {x} THEN i END), 0), 6) AS at_{x}" for x in (1, 2, 5)) + " FROM b GROUP BY 1",
    "calibration_by_bin": f"""WITH {_E}, k AS (SELECT *, round((trial_id * 37 % 1000) / 1000.0::DOUBLE, 3) AS risk FROM e), b AS (SELECT *, ntile(10) OVER (ORDER BY risk, trial_id)::INT AS bin FROM k),
      tb AS (SELECT bin, time, count(*) FILTER (event = 1) AS d1, count(*) FILTER (event = 2) AS d2, sum(count(*)) OVER (PARTITION BY bin ORDER BY time DESC) AS at_risk FROM b GROUP BY bin, time),
      a AS (SELECT bin, time, d1, at_risk, coalesce(exp(sum(ln(CASE WHEN d1 + d2 < at_risk THEN 1 - (d1 + d2) / at_risk::DOUBLE END)) OVER (PARTITION BY bin ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS s FROM tb WHERE d1 + d2 > 0),
      o AS (SELECT bin, sum(CASE WHEN time <= 2 THEN s * d1 / at_risk::DOUBLE ELSE 0 END) AS observed FROM a GROUP BY bin)
      SELECT b.bin, count(*) AS n, round(avg(risk), 6) AS predicted, round(max(observed), 6) AS observed FROM b LEFT JOIN o USING (bin) GROUP BY 1""",
    "ipcw_auc": f"WITH {_W}, t AS (SELECT risk, sum(CASE WHEN is_case THEN w ELSE 0 END) AS a, sum(CASE WHEN is_control THEN w ELSE 0 END) AS b FROM w GROUP BY 1), u AS (SELECT *, coalesce(sum(b) OVER (ORDER BY risk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM t) SELECT round(sum(a * (low + b / 2)) / (sum(a) * sum(b)), 6) AS auc FROM u",
    "ipcw_brier": f"WITH {_W} SELECT count(*) AS n, round(avg(w * (is_case::INT - risk) * (is_case::INT - risk)), 6) AS brier FROM w",
    "observed_expected_by_year": f"WITH {_E}, {_P}, o AS (SELECT year(start_date + round((period + 0.5::DOUBLE) * 0.5::DOUBLE * 365.25::DOUBLE)::INT)::INT AS year, y, 0.02::DOUBLE + period * 0.001::DOUBLE AS x FROM py) SELECT year, count(*) FILTER (y = 1) AS observed, round(sum(x), 4) AS expected, round(count(*) FILTER (y = 1) / sum(x), 4) AS ratio FROM o GROUP BY 1",
    "conditional_cif": f"""WITH {_H}, c AS (SELECT *, coalesce(exp(sum(ln(p_run)) OVER (PARTITION BY s_suppkey ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS s, least(greatest(floor(elapsed / 0.5::DOUBLE), 0), 15)::INT AS m FROM hr)
      SELECT s_suppkey, round(sum(CASE WHEN period >= m AND period < least(m + 4, 16) THEN s * p_term ELSE 0 END) / max(CASE WHEN period = m THEN s END), 6) AS risk FROM c GROUP BY 1""",
    "cumulative_incidence": f"""WITH {_H}, x AS (SELECT s_suppkey, period, exp(0.1::DOUBLE + 0.9::DOUBLE * (ln(p_term) - ln(p_run))) AS a, exp(-0.1::DOUBLE + 1.1::DOUBLE * (ln(p_comp) - ln(p_run))) AS b FROM hr), z AS (SELECT s_suppkey, period, 1 / (1 + a + b) AS p_run, a / (1 + a + b) AS p_term FROM x),
      c AS (SELECT *, coalesce(exp(sum(ln(p_run)) OVER (PARTITION BY s_suppkey ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS s FROM z)
      SELECT s_suppkey, period, round(p_term, 6) AS p_term, round(s, 6) AS surviving_before, round(sum(s * p_term) OVER (PARTITION BY s_suppkey ORDER BY period), 6) AS cif FROM c""",
    "landmark_set": f"WITH {_E}, x AS (SELECT *, (DATE '1999-01-01' - start_date) / 365.25::DOUBLE AS el FROM e) SELECT trial_id, round(el, 3) AS elapsed, round(time - el, 3) AS time, event FROM x WHERE el > 0 AND time > el AND el <= 6",
}
