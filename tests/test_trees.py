"""Contributions of trees, boosted hazards, fits that don't depend on the order of rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.models.attribution import Explainer, Node, Split, predicted
from tidemark.models.risk import RiskModel, importance, reasons, top_drivers
from tidemark.models import survival
from tidemark.models.survival import BoostedHazards, train_survival, tune_hazards
from tidemark.operators import survival as V


def grown(rng, depth, slots, cover):
    """A tree of random splits, inputs repeated along paths, some by levels."""
    if depth == 0 or rng.random() < 0.15:
        return Node(cover, rng.uniform(-2, 2))
    share = rng.uniform(0.1, 0.9)
    slot = rng.randrange(slots)
    split = Split(slot, left=(0.0, 2.0)) if slot == 0 else Split(slot, rng.uniform(0.5, 2.5))
    return Node(cover, 0.0, split, grown(rng, depth - 1, slots, cover * share), grown(rng, depth - 1, slots, cover * (1 - share)))


def worth(node, row, known, owners):
    """The mean of a tree over what isn't known."""
    if node.split is None:
        return node.value
    left, right = (worth(n, row, known, owners) for n in (node.left, node.right))
    if owners[node.split.slot] in known:
        return left if node.split.goes_left(row[None])[0] else right
    return (left * node.left.cover + right * node.right.cover) / node.cover


def shapley(trees, weights, row, owners):
    players = sorted(set(owners))
    total = lambda s: sum(w * worth(t, row, s, owners) for t, w in zip(trees, weights))
    out = []
    for p in players:
        rest = [q for q in players if q != p]
        value = 0.0
        for k in range(len(rest) + 1):
            for s in itertools.combinations(rest, k):
                weight = math.factorial(k) * math.factorial(len(rest) - k) / math.factorial(len(players))
                value += weight * (total({*s, p}) - total(set(s)))
        out.append(value)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_contributions_are_the_shapley_values_over_all_subsets(seed):
    rng = random.Random(seed)
    owners = [0, 1, 2, 3, 1, 2]  # inputs 1 and 2 have two slots each
    trees, weights = [grown(rng, 4, len(owners), 100.0) for _ in range(3)], [0.5, 1.0, -0.3]
    rows = np.array([[rng.randrange(4) for _ in owners] for _ in range(25)], float)
    e = Explainer(trees, weights, owners)
    got = e.contributions(rows)
    for row, own in zip(rows, got):
        assert own == pytest.approx(shapley(trees, weights, row, owners), abs=1e-12)
    assert e.base + got.sum(1) == pytest.approx(sum(w * predicted(t, rows) for t, w in zip(trees, weights)), abs=1e-12)


@pytest.fixture(scope="module")
def risky(spark):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        x, z, kind = rng.gauss(0, 1), rng.gauss(0, 1) if rng.random() < 0.8 else None, rng.choice(["a", "b", None, "c"])
        p = 1 / (1 + math.exp(-(1.5 * x + (1.0 if kind == "b" else 0.0) + (0.7 if z is None else 0.0))))
        rows.append((k, x, z, kind, int(rng.random() < p)))
    return spark.createDataFrame(rows, "id int, x double, z double, kind string, label int")


def test_contributions_of_a_fitted_model_sum_to_its_log_odds(risky):
    m = RiskModel(["x", "z", "kind"], (0, 1), maxIter=6, maxDepth=3).fit(risky.where("id < 500"), "label")
    unseen = risky.where("id >= 400").withColumn("kind", F.when(F.col("id") % 9 == 0, "new").otherwise(F.col("kind"))).withColumn("contributions_", F.lit(1))
    out = m.contributions(m.log_odds(unseen)).collect()
    assert len(out) == 200
    for r in out:
        assert m.base + sum(c.contribution for c in r.contributions) == pytest.approx(r.log_odds, abs=1e-9)
        assert [c.feature for c in r.contributions] == ["x", "z", "kind"]
    told = importance(m.contributions(risky)).collect()
    assert told[0].feature == "x" and all(r.weight > 0 for r in told)
    r = m.contributions(risky).select(reasons(F.col("contributions"), 2, 1).alias("r"), top_drivers(F.col("contributions"), 1).alias("d"), "contributions").first()
    up = sorted((c for c in r.contributions if c.contribution > 0), key=lambda c: -c.contribution)
    down = sorted((c for c in r.contributions if c.contribution < 0), key=lambda c: c.contribution)
    assert [c.feature for c in r.r] == [c.feature for c in up[:2] + down[:1]] and [c.feature for c in r.d] == [c.feature for c in up[:1]]
    assert m.contributions(risky.limit(0)).count() == 0


def test_a_fit_does_not_depend_on_the_order_of_rows(risky):
    one = RiskModel(["x", "z", "kind"], (3,), maxIter=5, maxDepth=3).fit(risky, "label")
    two = RiskModel(["x", "z", "kind"], (3,), maxIter=5, maxDepth=3).fit(risky.orderBy(F.desc("z")).repartition(7), "label")
    pair = one.score(two.score(risky, "b"), "a").collect()
    assert all(r.a == pytest.approx(r.b, abs=1e-6) for r in pair)


@pytest.fixture(scope="module")
def ending(spark):
    """Two kinds of subjects with known hazards per half year; censored at random."""
    rng = random.Random(6)
    rows = []
    for k in range(4000):
        fast = k % 2
        p1, p2 = (0.25, 0.05) if fast else (0.04, 0.15)
        event, period = 0, 0
        while not event and period < 16:
            u = rng.random()
            event = 1 if u < p1 else 2 if u < p1 + p2 else 0
            period += 1
        time = (period - 1 + rng.random() * 0.99) * 0.5 if event else 8.0
        limit = rng.uniform(0.5, 9)
        if limit < time:
            time, event = limit, 0
        rows.append((k, f"{2008 + k % 8}-03-01", "fast" if fast else "slow", rng.random(), time, event, "train" if event else "score"))
    return spark.createDataFrame(rows, "id int, start string, kind string, noise double, time double, event int, split string").withColumn("start", F.to_date("start"))


def test_boosted_hazards_recover_a_known_world(ending):
    m = BoostedHazards(["kind", "noise"], (0, 1), trees=12, depth=2, rate=0.3).fit(ending)
    asked = ending.sparkSession.createDataFrame([(1, "fast", 0.5), (2, "slow", 0.5), (3, None, None)], "id int, kind string, noise double")
    got = m.hazards(asked, "id").collect()
    assert len(got) == 48 and all(r.p_run + r.p_term + r.p_comp == pytest.approx(1, abs=1e-12) for r in got)
    early = {i: np.mean([[r.p_term, r.p_comp] for r in got if r.id == i and r.period < 6], axis=0) for i in (1, 2)}
    assert early[1] == pytest.approx([0.25, 0.05], abs=0.05) and early[2] == pytest.approx([0.04, 0.15], abs=0.05)


def test_hazards_send_a_subject_once(spark):
    df = spark.createDataFrame([(k, k % 2 * 1.0, float(k % 9), k % 3) for k in range(300)], "id int, x double, time double, event int")
    m = BoostedHazards(["x"], trees=2, depth=1, least_rows=5).fit(df)
    out = m.hazards(df, "id", 4)
    assert out.count() == 1200 and out.select("id", "period").distinct().count() == 1200
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()


def test_hazards_of_counted_rows_are_those_of_all_rows(ending, monkeypatch):
    """Different rows with their numbers give the trees that Spark gives for all rows, if each round takes them all; also watched ones."""
    df = ending.withColumn("x", F.when(F.col("id") % 10 > 0, (F.col("id") % 4).cast("double")))
    asked = df.sparkSession.createDataFrame([(1, "fast", 0.0), (2, "slow", 3.0), (3, None, None)], "id int, kind string, x double")
    got = []
    for most in (survival.CELL_VALUES, 0):
        monkeypatch.setattr(survival, "CELL_VALUES", most)
        m = BoostedHazards(["kind", "x"], (0,), trees=4, depth=3, rate=0.3, share=1.0).fit(df, F.col("id") % 5 == 0)
        got.append(([tuple(r)[2:] for r in m.hazards(asked, "id").orderBy("id", "period").collect()], m.deviances[0], m.start))
    for a, b in zip(*got):
        assert np.array(a) == pytest.approx(np.array(b), abs=1e-9)


def test_time_of_hazards_does_not_grow_with_equal_rows(spark):
    """As many Spark jobs for one round as for 200, and parts of rows drawn: about the same hazards as without drawing."""
    df = spark.range(3000).selectExpr("id", "double(id % 3) AS x", "double(id % 17) / 2 AS time", "int(id % 5 % 3) AS event")
    jobs = []
    for k, trees in enumerate((1, 200)):
        spark.sparkContext.setJobGroup(f"hazards {k}", "")
        m = BoostedHazards(["x"], trees=trees).fit(df)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"hazards {k}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and len(m.members[0]) == 200
    whole = BoostedHazards(["x"], trees=200, share=1.0).fit(df)
    a, b = (np.array([tuple(r)[2:] for r in x.hazards(df.where("id < 3"), "id").orderBy("id", "period").collect()]) for x in (m, whole))
    assert 0 < np.abs(a - b).max() < 0.1 and np.abs(a - b).mean() < 0.01


def test_query_of_hazards_runs_all_rounds(spark, monkeypatch):
    from tidemark.plans import models

    fitted, fit = [], BoostedHazards.fit
    monkeypatch.setattr(BoostedHazards, "fit", lambda self, *more: fitted.append(fit(self, *more)) or fitted[-1])
    out = models.boosted_hazards(spark, "/root/testdata/sf0.001")
    assert out.columns == ["trial_id", "period", "p_run", "p_term", "p_comp"] and out.count() == 16 * spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert [len(m) for m in fitted[0].members] == [200] * 3 and fitted[0].depth == 4 and fitted[0].rate == 0.05


def test_tuning_takes_the_best_of_the_grid(ending):
    grid = [{"depth": 1, "rate": 0.02}, {"depth": 2, "rate": 0.4}]
    chosen, tried = tune_hazards(ending, "start", "2014-01-01", ["kind"], grid, trees=5, patience=2)
    assert len(tried) == 2 and chosen["depth"] == min(tried, key=lambda t: t["deviance"])["depth"] == 2
    early, late = ending.where("start < '2014-01-01'"), ending.where("start >= '2014-01-01'")
    for t in tried:  # each setting again, with its number of rounds, and the deviance worked out from the hazards
        m = BoostedHazards(["kind"], (0,), depth=t["depth"], rate=t["rate"], trees=t["trees"]).fit(early)
        p = V.person_periods(late).select("id", "period", "y").join(m.hazards(late, "id"), ["id", "period"])
        worked = p.agg(F.avg(-F.log(F.when(F.col("y") == 0, F.col("p_run")).when(F.col("y") == 1, F.col("p_term")).otherwise(F.col("p_comp"))))).first()[0]
        assert worked == pytest.approx(t["deviance"], rel=1e-3)


def test_training_reports_each_cohort(ending):
    model, report = train_survival(ending, "id", "start", "split", ["kind"], [{"depth": 1, "rate": 0.4}], "2014-01-01", "2012-01-01", {"later": ("2014-01-01", "2016-01-01"), "none": ("1990-01-01", "1991-01-01")}, (1.0, 2.0), (0,), trees=6)
    fit, later = report["fit"], report["cohorts"]["later"]
    assert fit["n"] == fit["terminated"] + fit["completed"] + fit["censored"] == 3000
    assert later["n"] == 1000 and report["cohorts"]["none"] == {"n": 0}
    for h in ("1y", "2y"):
        assert later[h]["auc"] > 0.6 and later[h]["brier"] < later[h]["brier_null"] and later[h]["predicted"] == pytest.approx(later[h]["observed"], abs=0.08)
