import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.gates import DataGateError
from tidemark.models import audit, features, report
from tidemark.models.risk import RiskModel, calibration_fit, refit_stability, score_all, tune
from tidemark.models.survival import fit_recalibration
from tidemark.operators import checks
from tidemark.operators import survival as V


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (2, 0.4, 0), (3, 0.4, 1), (4, 0.8, 1)], "k int, s double, y int")
    assert M.auc(df, "s", "y").first().auc == pytest.approx(3.5 / 4)
    assert M.average_precision(df, "s", "y").first().average_precision == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert M.summary(df, "s", "y", "k").first().precision_top10 == 1.0
    assert M.auc(df.where("y = 1"), "s", "y").first().auc is None
    assert sorted(r.place for r in M.with_place(df, ["s", "k"]).collect()) == [1, 2, 3, 4]


def test_scores_and_ratios_are_rounded_as_the_sql_has_them(spark):
    import duckdb

    from tidemark.functions.scalars import rounded

    asked = [(10110 / 20000, 3), (10010 / 20000, 3), (41 / 640, 6), (323 / 640, 6), (333 / 640, 6), (-2.5, 0), (0.15, 1)]
    df = spark.createDataFrame([tuple(x for x, _ in asked)], ", ".join(f"x{k} double" for k in range(len(asked))))
    got = tuple(df.select(*[rounded(F.col(f"x{k}"), n) for k, (_, n) in enumerate(asked)]).first())
    assert got == duckdb.sql("SELECT " + ", ".join(f"round({x!r}::DOUBLE, {n})" for x, n in asked)).fetchall()[0]
    assert got[0] == 0.505


def test_scores_are_those_of_the_sql(spark, tmp_path):
    import duckdb

    from tidemark.plans import statistics

    docs = [(k, 10 * k) for k in range(1, 2001)]
    spark.createDataFrame([(k, n, "x") for k, n in docs], "doc_id long, n_chars long, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, k % 2) for k, _ in docs], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = sorted(tuple(r) for r in statistics.percentile_vs_reference(spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(statistics.SQL["percentile_vs_reference"]).fetchall())


def test_kaplan_meier_by_hand(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (2.0, 0), (3.0, 2), (4.0, 0)], "time double, event int")
    got = {r.time: r.g for r in V.censoring_survival(df).collect()}
    assert got[1.0] == pytest.approx(4 / 5) and got[2.0] == pytest.approx(4 / 5 * 2 / 3) and got[4.0] == 0.0


def test_person_periods_by_hand(spark):
    df = spark.createDataFrame([("a", 1.2, 1), ("b", 1.2, 0), ("c", 9.0, 2), ("d", 0.3, 0)], "id string, time double, event int")
    rows = V.person_periods(df)
    assert {r.id: r["count"] for r in rows.groupBy("id").count().collect()} == {"a": 3, "b": 2, "c": 16}
    assert sorted((r.id, r.period, r.y) for r in rows.where("y > 0").collect()) == [("a", 2, 1)]


def test_ipcw_recovers_the_uncensored_share(spark):
    random.seed(1)
    rows = []
    for k in range(4000):
        t, e, c = random.expovariate(0.4), 1 if random.random() < 0.6 else 2, random.uniform(0, 6)
        rows.append((k, min(t, c), e if t <= c else 0))
    df = spark.createDataFrame(rows, "id int, time double, event int")
    true = 0.6 * (1 - math.exp(-0.8))
    assert V.incidence_at(df, [2.0]).first().at_2 == pytest.approx(true, abs=0.03)
    w = V.ipcw(df, 2.0).agg((F.sum(F.when(F.col("case_"), F.col("w_"))) / F.count("*")).alias("x")).first().x
    assert w == pytest.approx(true, abs=0.03)


def test_recalibration_recovers_a_known_distortion(spark):
    random.seed(2)
    rows = []
    for _ in range(8000):
        p1, p2 = random.uniform(0.02, 0.3), random.uniform(0.05, 0.3)
        p0 = 1 - p1 - p2
        e1, e2 = math.exp(0.5 + 0.8 * math.log(p1 / p0)), math.exp(-0.3 + 1.2 * math.log(p2 / p0))
        z, u = 1 + e1 + e2, random.random()
        rows.append((p0, p1, p2, 1 if u < e1 / z else 2 if u < (e1 + e2) / z else 0))
    got = fit_recalibration(spark.createDataFrame(rows, "p_run double, p_term double, p_comp double, y int"))
    assert got == pytest.approx((0.5, 0.8, -0.3, 1.2), abs=0.25)


def test_models_learn_and_reports_escape(spark):
    random.seed(3)
    rows = [(k, random.choice("ab"), random.random()) for k in range(400)]
    rows = [(k, w, x, int(x + (0.4 if w == "a" else 0) + random.gauss(0, 0.15) > 0.8)) for k, w, x in rows]
    df = spark.createDataFrame([*rows, (401, None, None, 0), (402, "new", 0.1, None)], "id int, w string, x double, label int")
    m = RiskModel(["w", "x"], (0, 1), maxIter=8).fit(df, "label")
    scored = m.score(df)
    assert M.auc(scored.where("label is not null"), "risk_score", "label").first().auc > 0.85 and scored.count() == 402
    assert all(r.risk_score == round(r.risk_score, 6) for r in scored.collect())
    line = calibration_fit(scored.where("label is not null"), "risk_score", "label")
    assert line["slope"] > 0.5
    assert "<\\/script>" in report.render({"x": "</script>"}, "t & u") and "t &amp; u" in report.render({}, "t & u")
    assert report.estimate_usd(3, 60) == pytest.approx(0.96)


def test_calibration_line_recovers_a_known_distortion(spark):
    random.seed(5)
    rows = []
    for _ in range(6000):
        z = random.gauss(-1, 1.2)
        rows.append((1 / (1 + math.exp(-z)), int(random.random() < 1 / (1 + math.exp(-(0.4 + 0.7 * z))))))
    got = calibration_fit(spark.createDataFrame(rows, "p double, y int"), "p", "y")
    assert got["joint_intercept"] == pytest.approx(0.4, abs=0.15) and got["slope"] == pytest.approx(0.7, abs=0.1)
    total = sum(1 / (1 + math.exp(-(math.log(p / (1 - p)) + got["intercept"]))) for p, _ in rows)
    assert total == pytest.approx(sum(y for _, y in rows), abs=0.01)


def test_tuning_stops_early_and_refits_agree(spark):
    random.seed(8)
    rows = [(k, f"{2008 + k % 8}-05-01", x := random.random(), int(x + random.gauss(0, 0.1) > 0.5)) for k in range(400)]
    df = spark.createDataFrame(rows, "id int, day string, x double, label int").withColumn("day", F.to_date("day"))
    best, tried = tune(df, "label", "day", "2013-01-01", ["x"], [{"maxIter": 30, "maxDepth": 4, "stepSize": 1.0}], least_trees=2)
    assert 2 <= best["maxIter"] < 30 and best["maxDepth"] == 4 and tried[0]["auc"] > 0.85
    (agreed,) = refit_stability(df, "label", df, ["x"], (0, 1), maxIter=3)
    assert agreed["seed"] == 1 and agreed["spearman"] > 0.7 and 0 <= agreed["share_over_10"] <= agreed["share_over_5"] <= 1


def test_cards_and_gates(spark):
    text = report.survival_card("S", [{"years": 1, "incidence": 0.1}], [], [{"year": 2020, "ratio": 0.9}], ["note"])
    assert text.startswith("# S") and "## Incidence" in text and "Calibration" not in text and "| 2020 | 0.9 |" in text and text.endswith("- note\n")
    assert checks.gate_built({"a": spark.range(2)}) == {"a": 2}
    with pytest.raises(DataGateError, match="no rows in b"):
        checks.gate_built({"a": spark.range(2), "b": spark.range(0)})


class Leaning:
    """A model whose score is its input x."""

    def score(self, df):
        return df.withColumn("risk_score", F.col("x"))


def test_audit_finds_the_column_that_was_edited(spark):
    random.seed(6)
    rows = [(k, k % 2, (k % 2) * 0.5 + random.random() / 2, random.random()) for k in range(300)]
    latest = spark.createDataFrame([*rows, (900, None, 0.5, 0.5)], "id int, label int, x double, z double")
    archived = latest.select("id", F.rand(1).alias("x"), "z").where("id < 250")
    pairs = audit.paired(Leaning(), latest, archived, "id", "label", ["x", "z"])
    assert pairs.count() == 250
    found = audit.both_ways(pairs, "label", "id", 50)
    assert found["latest"]["auc"] > 0.99 and found["archived"]["auc"] < 0.7 and found["drop_low"] <= found["drop"] <= found["drop_high"]
    swapped = audit.swap_each(Leaning(), latest, archived, "id", "label", ["z", "x"])
    assert [s["column"] for s in swapped] == ["x", "z"] and swapped[1]["drop"] == 0
    lags = spark.createDataFrame([(1, -40), (2, 10), (3, 30)], "id int, lag_days int")
    assert sorted(r.id for r in audit.close_enough(lags, 30).collect()) == [2, 3]


def test_every_row_gets_a_score_and_its_kind(spark):
    random.seed(7)
    rows = [(k, ("train", "test", "score")[k % 3], f"{2010 + k % 2}-05-01", random.random()) for k in range(240)]
    df = spark.createDataFrame([(k, s, d, x, None if s == "score" else int(x > 0.5)) for k, s, d, x in rows], "id int, split string, day string, x double, label int").withColumn("day", F.to_date("day"))
    out = score_all(df, "label", "split", "day", ["x"], seeds=(0,), maxIter=3)
    assert {(r.split, r.score_type): r["count"] for r in out.groupBy("split", "score_type").count().collect()} == {("train", "out_of_fold"): 80, ("test", "held_out"): 80, ("score", "forward"): 80}


def test_too_many_levels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(features, "MOST_LEVELS", 2)
    with pytest.raises(ValueError, match="w"):
        features.learned_levels(spark.createDataFrame([("a",), ("b",), ("c",)], "w string"), ["w"])


def test_published_rows_take_the_status_of_the_registry(spark):
    scores = spark.createDataFrame([("a", 0.2, "old"), ("b", 0.4, "old"), ("c", 0.9, None)], "nct_id string, risk_score double, status string")
    trials = spark.createDataFrame([("a", "NOT_YET_RECRUITING"), ("c", "RECRUITING"), ("c", "RECRUITING"), ("d", "x")], "nct_id string, status string")
    assert {r.nct_id: r.status for r in report.with_status(scores, trials).collect()} == {"a": "NOT_YET_RECRUITING", "b": None, "c": "RECRUITING"}
    full = scores.selectExpr("*", "'forward' AS score_type", "date'2020-01-01' AS start_date", "array('r') AS reasons", "0.1D AS next_2y_risk", "date'2021-01-01' AS snapshot")
    got = {r.nct_id: r for r in report.lookup_rows(full, scores, "v1", trials).collect()}
    assert got["a"].years_running == 0.0 and got["c"].years_running == 1.0 and got["c"].risk_percentile == 66.7


def test_reasons_read_plainly(spark):
    rows = [
        ("phase", "PHASE2", 0.3, "Phase: 2 (raises risk)"),
        ("has_dmc", "false", -0.2, "Has a data monitoring committee: No (lowers risk)"),
        ("has_dmc", "true", 0.2, "Has a data monitoring committee: Yes (raises risk)"),
        ("sponsor_class", "OTHER", 0.1, "Sponsor type: academic or other (raises risk)"),
        ("sponsor_class", "NETWORK", 0.1, "Sponsor type: network (raises risk)"),
        ("faers_serious_share", "0.25", 0.1, "Drug's FAERS reports marked serious: 25% (raises risk)"),
        ("faers_serious_share", "0.123", 0.1, "Drug's FAERS reports marked serious: 12.3% (raises risk)"),
        ("faers_serious_share", None, 0.1, "Drug's FAERS reports marked serious: no FAERS history (raises risk)"),
        ("number_of_arms", "2.0", 0.1, "Number of arms: 2 (raises risk)"),
        ("min_age_years", "0.5", 0.1, "Minimum age: 0.5 (raises risk)"),
        ("faers_reports", "1234567", 0.1, "Drug's FAERS reports before start: 1.23457e+06 (raises risk)"),
        ("allocation", "missing", 0.1, "Allocation: not given (raises risk)"),
        ("masking", "DOUBLE_BLIND", -0.1, "Blinding: double blind (lowers risk)"),
        ("area_mental", "1", -0.1, "Disease area, psychiatry: Yes (lowers risk)"),
        ("registration_text", None, 0.4, "Wording of the registration (title, summary, criteria) (raises risk)"),
        ("some_new_input", "A_B", 0.4, "Some new input: a b (raises risk)"),
    ]
    df = spark.createDataFrame([(k, f, v, c) for k, (f, v, c, _) in enumerate(rows)], "k int, feature string, value string, contribution double")
    assert {r.k: r.text for r in report.reason_texts(df).collect()} == {k: r[3] for k, r in enumerate(rows)}
    told = df.select("k", report.described(F.col("feature"), F.col("value")).alias("t")).collect()
    assert {r.k: r.t for r in told if r.k in (1, 8, 7, 10, 14)} == {1: "has_dmc=No", 8: "number_of_arms=2", 7: "faers_serious_share=missing", 10: "faers_reports=1.23457e+06", 14: "registration_text (net of all text components)"}


def test_recalibration_takes_hazards_of_the_periods_themselves(spark):
    from tidemark.models import survival
    from tidemark.models.survival import SurvivalModel, recalibrate

    rng = random.Random(3)
    df = spark.createDataFrame([(k, f"{2010 + k % 6}-01-01", rng.uniform(0, 6), rng.randrange(3), k % 3) for k in range(600)], "id int, start string, time double, event int, x int").withColumn("start", F.to_date("start"))
    m = SurvivalModel(["x"]).fit(df)
    joined = survival.window_rows(V.person_periods(df), "start", "2014-04-20").select("id", "period", "y").join(m.hazards(df, "id"), ["id", "period"])
    assert recalibrate(m, df, "id", "start", "2016-01-01") == pytest.approx(fit_recalibration(joined), abs=1e-6)
    assert "Join" not in m.hazards_of(V.person_periods(df), ["y"])._jdf.queryExecution().executedPlan().toString()
