"""Discrete-time competing-risks model, its recalibration on recent periods, and backtests at landmarks."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemark.models.attribution import Node, Split, nodes_of, predicted
from tidemark.models.risk import Inputs, ordered
from tidemark.operators import survival as V
from tidemark.session import ship_package
from tidemark.sources.store import point_to, pointed_at
from tidemark.staging import pinned, unpin


class SurvivalModel:
    """Three-way hazards per half-year period (still running, the cause, another end) by multinomial regression."""

    def __init__(self, columns: list[str], penalty: float = 0.01):
        self.columns, self.penalty = columns, penalty

    def _rows(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            df = df.withColumn(c, F.col(c).cast("double"))
        return df.withColumn("p1_", F.col("period").cast("double")).withColumn("p2_", F.log1p(F.col("period").cast("double")))

    def fit(self, df: DataFrame) -> SurvivalModel:
        rows = self._rows(V.person_periods(df)).withColumn("y", F.col("y").cast("double"))
        filled = [f"{c}_f" for c in self.columns]
        stages = [Imputer(inputCols=self.columns, outputCols=filled)] if self.columns else []
        stages += [VectorAssembler(inputCols=[*filled, "p1_", "p2_"], outputCol="features"), LogisticRegression(labelCol="y", family="multinomial", regParam=self.penalty)]
        self.model = Pipeline(stages=stages).fit(rows)
        return self

    def hazards(self, df: DataFrame, id: str, periods: int = V.PERIODS) -> DataFrame:
        """id, period, p_run, p_term, p_comp for every period of every row."""
        rows = df.withColumn("period", F.explode(F.sequence(F.lit(0), F.lit(periods - 1))))
        return self.hazards_of(rows, [id, "period"])

    def hazards_of(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, p_run, p_term, p_comp of rows that have a period: a projection, nothing is joined."""
        p = vector_to_array("probability")
        out = self.model.transform(self._rows(rows))
        at = lambda k: F.coalesce(F.get(p, F.lit(k)), F.lit(0.0))
        return out.select(*keep, at(0).alias("p_run"), at(1).alias("p_term"), at(2).alias("p_comp"))


CLASSES = 3
#: Rounds after which the scores so far are written to the shared folder, so that a lost executor costs no more of them.
STAGE_ROUNDS = 10
#: Rows whose periods are scored at a time; as many different ones are remembered in a task.
SCORED, REMEMBERED = 1000, 10_000
#: Different rows times slots of their vectors up to which they are fitted in the driver, with their numbers.
CELL_VALUES = 1 << 20
#: Equal rows are written out in runs of at most so many.
RUN = 50_000


def _softmax(scores: Column) -> Column:
    """Probabilities of an array of scores."""
    most = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - most))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


class Bins:
    """Different rows cut into bins, for regression trees as those of ``pyspark.ml``: the same splits, gains and limits.

    A number of few values is split between any two of them, one of more at ``most`` - 1 places of about equal numbers of rows;
    levels are split in the order of their means.
    """

    def __init__(self, x: np.ndarray, n: np.ndarray, most: int, levels: Iterable[int]):
        self.levels, self.cuts, self.bins = set(levels), [], np.empty(x.shape, np.int64)
        for slot in range(x.shape[1]):
            values, at = np.unique(x[:, slot], return_inverse=True)
            between = (values[1:] + values[:-1]) / 2
            if slot not in self.levels and len(between) >= most:
                upto = np.cumsum(np.bincount(at, n))
                stride, kept, goal = upto[-1] / most, [], upto[-1] / most
                for k in range(1, len(values)):
                    if abs(upto[k - 1] - goal) < abs(upto[k] - goal):
                        kept.append(k - 1)
                        goal += stride
                between = between[kept]
            self.cuts.append(values if slot in self.levels else between)
            self.bins[:, slot] = at if slot in self.levels else np.searchsorted(between, x[:, slot])

    def tree(self, drawn: np.ndarray, weight: np.ndarray, goal: np.ndarray, depth: int, least_rows: int) -> Node:
        """Fitted to ``goal`` by the squared error: each row counts ``drawn`` times and weighs ``weight`` each time."""
        w = drawn * weight
        wg = w * goal

        def grow(rows: np.ndarray, left: int) -> Node:
            total, sum_ = w[rows].sum(), wg[rows].sum()
            node = Node(float(total), float(sum_ / total) if total else 0.0)
            best = (1e-12 * max(total, 1.0) * max(node.value**2, 1e-9), None) if left else None
            for slot, cuts in enumerate(self.cuts) if left else ():
                levels = slot in self.levels
                size = len(cuts) + (not levels)
                if size < 2:
                    continue
                at = self.bins[rows, slot]
                c, a, b = (np.bincount(at, v[rows], size) for v in (drawn, w, wg))
                order = np.argsort(np.where(a > 0, b / np.where(a > 0, a, 1), np.inf), kind="stable") if levels else np.arange(size)
                c, a, b = (np.cumsum(v[order])[:-1] for v in (c, a, b))
                good = (c >= least_rows) & (drawn[rows].sum() - c >= least_rows) & (a > 0) & (total - a > 0)
                if good.any():
                    rest = np.where(good, total - a, 1)
                    gain = np.where(good, b**2 / np.where(good, a, 1) + (sum_ - b) ** 2 / rest - sum_**2 / total, -np.inf)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        split = Split(slot, 0.0, tuple(float(v) for v in cuts[order[: k + 1]])) if levels else Split(slot, float(cuts[k]))
                        best = (gain[k], split, np.isin(at, order[: k + 1]))
            if best and best[1]:
                node.split, side = best[1:]
                node.left, node.right = grow(rows[side], left - 1), grow(rows[~side], left - 1)
            return node

        return grow(np.arange(len(w)), depth)


class BoostedHazards:
    """Three-way hazards per half-year period by boosted trees: one sum of trees for each outcome, put through a softmax.

    Each round fits a regression tree for each outcome to the Newton step of the multinomial loss: the residual over its
    curvature, weighted by the curvature. Members differ in their seed, which decides the rows of each round, and are averaged as
    log-odds. A fit doesn't depend on the order that rows come in.

    Rows that are equal in inputs, period and outcome get the same steps, so they are counted first. Where few are different, the
    fit is over those with their numbers, of which each round draws from a binomial, so its time doesn't grow with the rows; else
    rows are numbered in an order of what they hold and Spark fits the trees.
    """

    def __init__(self, columns: list[str], seeds: tuple[int, ...] = (0,), trees: int = 200, depth: int = 4, rate: float = 0.05, share: float = 0.8, least_rows: int = 20, patience: int = 50):
        self.columns, self.seeds = columns, seeds
        self.trees, self.depth, self.rate, self.share, self.least_rows, self.patience = trees, depth, rate, share, least_rows, patience

    def fit(self, df: DataFrame, held: Column | None = None) -> BoostedHazards:
        """``df``: time, event and the columns. Rows for which ``held`` is true are only watched: a member keeps the rounds up to
        its least deviance there and stops ``patience`` rounds after it."""
        held = F.lit(False) if held is None else F.coalesce(held, F.lit(False))
        slim = df.select("time", "event", *self.columns, held.alias("held_"))
        cells = pinned(self._cells(slim))
        slots = 2 * (1 + len(self.columns))
        few = cells.count() * slots <= CELL_VALUES
        if few:
            names = ["held_", "y", "period", *self.columns]
            runs = cells.withColumn("run_", F.explode(F.sequence(F.lit(0), F.expr(f"(n_ - 1) div {RUN}"))))
            runs = runs.repartition(df.sparkSession.sparkContext.defaultParallelism, F.xxhash64("run_", *names)).sortWithinPartitions("run_", *names)
            rows = runs.withColumn("each_", F.explode(F.sequence(F.lit(1), F.least(F.lit(RUN), F.col("n_") - F.col("run_") * RUN).cast("int")))).drop("each_", "run_", "n_")
        else:
            rows = V.person_periods(slim).select(*self.columns, "period", "held_", F.col("y").cast("int").alias("y"))
            rows = ordered(rows, ["held_", "y", "period", *self.columns])
        self.inputs = Inputs([*self.columns, "period"]).fit(rows, rows.where("not held_"))
        if few:
            ready = self.inputs.transform(cells).select(vector_to_array("features").alias("x"), "y", "held_", "n_").toPandas()
            n = {k: int(ready.n_[~ready.held_ & (ready.y == k)].sum()) for k in range(CLASSES)}
        else:
            ready = self.inputs.transform(rows).select("features", "y", "held_", F.monotonically_increasing_id().alias("key_"))
            ready = pinned(ready)
            n = {r.y: r["count"] for r in ready.where("not held_").groupBy("y").count().collect()}
            watched = ready.where("held_").limit(1).count() > 0
        total = sum(n.values())
        self.start = [math.log(max(n.get(k, 0) / total, 1e-9)) for k in range(CLASSES)]
        self.members, self.deviances = [], []
        for seed in self.seeds:
            grown, seen = self._counted_member(ready, seed) if few else self._member(ready, seed, watched)
            self.members.append(grown)
            self.deviances.append(seen)
        unpin(cells, *([] if few else [ready]))
        return self

    def _cells(self, slim: DataFrame) -> DataFrame:
        """The different rows of columns, period, held_ and y, and their number n_; subjects are counted before they have periods."""
        k = F.least(F.floor(F.col("time") / V.WIDTH).cast("int"), F.lit(V.PERIODS))
        alike = slim.select(*self.columns, "held_", (k * V.WIDTH).alias("time"), "event").groupBy(*self.columns, "held_", "time", "event").agg(F.count("*").alias("n_"))
        rows = V.person_periods(alike).select(*self.columns, "period", "held_", F.col("y").cast("int").alias("y"), "n_")
        return rows.groupBy(*self.columns, "period", "held_", "y").agg(F.sum("n_").alias("n_"))

    def _counted_member(self, cells: pd.DataFrame, seed: int) -> tuple[list, list[float]]:
        """``_member`` over different rows (x, y, held_) and their number n_."""
        x, y, held, n = np.stack(cells.x), cells.y.to_numpy(), cells.held_.to_numpy(bool), cells.n_.to_numpy(np.int64)
        order = np.lexsort([*x.T, y, held])
        x, y, held, n = x[order], y[order], held[order], n[order]
        learn = np.flatnonzero(~held)
        bins = Bins(x[learn], n[learn], self.inputs.bins, range(2 * len(self.inputs.numbers), x.shape[1]))
        share = min(max(int(self.share * (1 << 20)) / (1 << 20), 0.0), 1.0)
        f = np.tile(np.array(self.start), (len(x), 1))
        rounds, seen = [], []

        def watch(p: np.ndarray) -> None:
            seen.append(float(np.average(-np.log(np.maximum(p[held, y[held]], 1e-15)), weights=n[held])))

        for at in range(self.trees):
            p = softmax(f)
            if held.any():
                watch(p)
                if at - int(np.argmin(seen)) >= self.patience:
                    break
            drawn = np.random.default_rng([seed & 0xFFFFFFFFFFFFFFFF, at]).binomial(n[learn], share)
            grown = []
            for k in range(CLASSES):
                own = p[learn, k]
                curve = np.maximum(own * (1 - own), 1e-6) * CLASSES / (CLASSES - 1)
                grown.append(bins.tree(drawn, curve, ((y[learn] == k) - own) / curve, self.depth, self.least_rows))
            rounds.append(grown)
            for k, tree in enumerate(grown):
                f[:, k] += self.rate * predicted(tree, x)
        else:
            if held.any():
                watch(softmax(f))
        return (rounds[: int(np.argmin(seen))] if held.any() else rounds), seen

    def _member(self, ready: DataFrame, seed: int, watched: bool) -> tuple[list, list[float]]:
        state = ready.withColumn("f_", F.array(*map(F.lit, self.start)))
        rounds, seen, held, staged = [], [], None, []
        for n in range(self.trees):
            if n % STAGE_ROUNDS == 0 and n:
                state = pinned(state)
                staged.append(state)
            now = state.withColumn("p_", _softmax(F.col("f_"))).cache()
            now.count()  # before what it is made of goes
            if held is not None:
                held.unpersist()
            held = now
            if watched:
                seen.append(now.where("held_").agg(F.avg(-F.log(F.greatest(F.get("p_", F.col("y")), F.lit(1e-15))))).first()[0])
                if n - int(np.argmin(seen)) >= self.patience:
                    break
            drawn = now.where(~F.col("held_") & (F.pmod(F.xxhash64("key_", F.lit(seed), F.lit(n)), F.lit(1 << 20)) < int(self.share * (1 << 20))))
            fitted = []
            for k in range(CLASSES):
                p = F.get("p_", F.lit(k))
                curve = F.greatest(p * (1 - p), F.lit(1e-6)) * CLASSES / (CLASSES - 1)
                goal = drawn.select("features", ((F.col("y") == k).cast("double") - p).alias("r_"), curve.alias("h_")).select("features", (F.col("r_") / F.col("h_")).alias("g_"), "h_")
                tree = DecisionTreeRegressor(labelCol="g_", weightCol="h_", predictionCol=f"t{k}_", maxDepth=self.depth, maxBins=self.inputs.bins, minInstancesPerNode=self.least_rows, seed=seed)
                fitted.append(tree.fit(goal))
            rounds.append([nodes_of(t) for t in fitted])
            state = now.drop("p_")
            for t in fitted:
                state = t.transform(state)
            state = state.select("features", "y", "held_", "key_", F.array(*[F.get("f_", F.lit(k)) + self.rate * F.col(f"t{k}_") for k in range(CLASSES)]).alias("f_"))
        else:
            if watched:
                last = state.where("held_").select(F.get(_softmax(F.col("f_")), F.col("y")).alias("p"))
                seen.append(last.agg(F.avg(-F.log(F.greatest("p", F.lit(1e-15))))).first()[0])
        if held is not None:
            held.unpersist()
        unpin(*staged)
        return (rounds[: int(np.argmin(seen))] if watched else rounds), seen

    def save_to(self, spark: SparkSession, folder: str) -> None:
        """The fitted model in a folder that ``load_from`` reads."""
        self.inputs.save_to(spark, f"{folder}/inputs")
        members = [[[t.document() for t in trees] for trees in rounds] for rounds in self.members]
        point_to(spark, f"{folder}/model.json", {"columns": self.columns, "seeds": list(self.seeds), "rate": self.rate, "start": self.start, "members": members, "deviances": self.deviances})

    @classmethod
    def load_from(cls, spark: SparkSession, folder: str) -> BoostedHazards:
        told = pointed_at(spark, f"{folder}/model.json")
        out = cls(told["columns"], tuple(told["seeds"]), rate=told["rate"])
        out.inputs, out.start, out.deviances = Inputs.load_from(spark, f"{folder}/inputs"), told["start"], told["deviances"]
        out.members = [[[Node.of(t) for t in trees] for trees in rounds] for rounds in told["members"]]
        return out

    @property
    def deviance(self) -> float:
        """The least mean deviance of the watched rows, over the members."""
        return sum(min(seen) for seen in self.deviances) / len(self.deviances)

    def hazards(self, df: DataFrame, id: str, periods: int = V.PERIODS, digits: int | None = None) -> DataFrame:
        """id, period, p_run, p_term, p_comp for every period of every row, rounded to ``digits``.

        A row is sent to Python once, and its periods are made there: arrays in, arrays out. Rows of equal inputs are scored once.
        """
        sent = ship_package(df.sparkSession).sparkContext.broadcast((self.members, self.start, self.rate))
        spot = self.inputs.numbers.index("period")
        rows = df.select(id, *[c for c in self.columns if c != id]).withColumn("period", F.lit(0))
        ready = self.inputs.transform(rows).select(id, vector_to_array("features").alias("x_"))
        schema = StructType([ready.schema[0], StructField("period", IntegerType()), *[StructField(c, DoubleType()) for c in ("p_run", "p_term", "p_comp")]])

        def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            members, start, rate = sent.value
            known: dict[bytes, np.ndarray] = {}

            def score(rows: np.ndarray) -> np.ndarray:
                x = np.repeat(rows, periods, axis=0)
                x[:, spot] = np.tile(np.arange(periods), len(rows))
                total = np.tile(np.array(start), (len(x), 1))
                for rounds in members:
                    for trees in rounds:
                        for k, tree in enumerate(trees):
                            total[:, k] += rate * predicted(tree, x) / len(members)
                p = softmax(total)
                return (p if digits is None else np.round(p, digits)).reshape(len(rows), periods, CLASSES)

            for whole in batches:
                for a in range(0, whole.num_rows, SCORED):
                    batch = whole.slice(a, SCORED)
                    n = batch.num_rows
                    x = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1))
                    alike, at = np.unique(x.view(f"V{8 * x.shape[1]}").ravel(), return_inverse=True)
                    rows = alike.view(np.float64).reshape(len(alike), -1)
                    keys = [r.tobytes() for r in rows]
                    new = [k for k, key in enumerate(keys) if key not in known]
                    if len(known) + len(new) > REMEMBERED:
                        known, new = {}, list(range(len(keys)))
                    if new:
                        known |= zip((keys[k] for k in new), score(rows[new]))
                    p = np.stack([known[key] for key in keys])[at.ravel()].reshape(-1, CLASSES)
                    own = batch.column(0).take(pa.array(np.repeat(np.arange(n), periods)))
                    period = pa.array(np.tile(np.arange(periods, dtype=np.int32), n))
                    yield pa.RecordBatch.from_arrays([own, period, *[pa.array(np.ascontiguousarray(p[:, k])) for k in range(CLASSES)]], schema.names)

        return ready.mapInArrow(scored, schema)


def tune_hazards(df: DataFrame, date: str, cut: str, columns: list[str], grid: list[dict], least_trees: int = 1, **params) -> tuple[dict, list[dict]]:
    """The setting of ``grid`` with the least person-period deviance after ``cut`` when fitted before it, and what each gave.

    The later rows also tell when to stop: the setting that is returned carries that number of rounds.
    """
    late = F.col(date) >= F.lit(cut).cast("date")
    tried = []
    for setting in grid:
        m = BoostedHazards(columns, (0,), **(params | setting)).fit(df, late)
        tried.append(setting | {"trees": max(least_trees, len(m.members[0])), "deviance": m.deviance})
    best = min(tried, key=lambda t: t["deviance"])
    return params | {k: v for k, v in best.items() if k != "deviance"}, tried


def population(df: DataFrame, start: str, split: str, fit_end: str) -> DataFrame:
    """Rows that hazards may learn from: begun before ``fit_end``, and either trained on or still running at the snapshot."""
    return df.where((F.col(start) < F.lit(fit_end).cast("date")) & ((F.col(split) == "train") | (F.col("event") == 0)))


def train_survival(df: DataFrame, id: str, start: str, split: str, columns: list[str], grid: list[dict], fit_end: str, cut: str, cohorts: dict[str, tuple[str, str]], horizons: tuple[float, ...] = (1.0, 2.0, 3.0, 5.0), seeds: tuple[int, ...] = (0, 1, 2), **params) -> tuple[BoostedHazards, dict]:
    """Tuned and fitted hazards and their report: the grid, what was learned from, and each cohort at each horizon.

    ``df`` has time and event. A cohort: observed (censoring-adjusted) and mean predicted incidence, time-AUC, Brier score, and the
    Brier score of one risk for all.
    """
    fit = pinned(population(df, start, split, fit_end).select(id, start, "time", "event", *columns))
    chosen, tried = tune_hazards(fit, start, cut, columns, grid, **params)
    model = BoostedHazards(columns, seeds, **chosen).fit(fit)
    kinds_ = {r.event: r["count"] for r in fit.groupBy("event").count().collect()}
    report = {"params": chosen, "grid": tried, "fit": {"n": sum(kinds_.values()), "terminated": kinds_.get(1, 0), "completed": kinds_.get(2, 0), "censored": kinds_.get(0, 0)}, "cohorts": {}}
    names = [f"at_{x:g}".replace(".", "_") for x in horizons]
    everyone = V.incidence_at(fit, list(horizons)).first()
    for name, (low, high) in cohorts.items():
        rows = df.where((F.col(start) >= F.lit(low).cast("date")) & (F.col(start) < F.lit(high).cast("date")))
        upto = V.cumulative_incidence(model.hazards(rows, id), id)
        cif = upto.groupBy(id).agg(*[F.max(F.when((F.col("period") + 1) * V.WIDTH <= x + 1e-9, F.col("cif"))).alias(n) for x, n in zip(horizons, names)])
        seen = pinned(rows.select(id, "time", "event").join(cif, id))
        told = {"n": seen.count()}
        if told["n"]:
            observed, mean = V.incidence_at(seen, list(horizons)).first(), seen.agg(*[F.avg(n).alias(n) for n in names]).first()
            for x, n in zip(horizons, names):
                alike = seen.withColumn("one_", F.lit(everyone[n]))
                told[f"{x:g}y"] = {"observed": observed[n], "predicted": mean[n], "auc": V.time_auc(seen, n, x).first().auc, "brier": V.ipcw_brier(seen, n, x).first().brier, "brier_null": V.ipcw_brier(alike, "one_", x).first().brier}
        report["cohorts"][name] = told
        unpin(seen)
    unpin(fit)
    return model, report


def fit_recalibration(rows: DataFrame, rounds: int = 30) -> tuple[float, float, float, float]:
    """a1, b1, a2, b2 of the softmax of recalibrated hazards by Newton steps; each is one aggregate over all rows.

    ``rows``: p_run, p_term, p_comp and the outcome y (0, 1, 2) of each person and period.
    """
    log = lambda c: F.log(F.greatest(F.col(c), F.lit(1e-12)))
    x = rows.select((log("p_term") - log("p_run")).alias("x1"), (log("p_comp") - log("p_run")).alias("x2"), "y").cache()
    b = np.array([0.0, 1.0, 0.0, 1.0])

    def state(b):
        e1, e2 = F.exp(F.lit(float(b[0])) + F.lit(float(b[1])) * F.col("x1")), F.exp(F.lit(float(b[2])) + F.lit(float(b[3])) * F.col("x2"))
        z = 1 + e1 + e2
        p, d = (e1 / z, e2 / z), ((F.col("y") == 1).cast("double"), (F.col("y") == 2).cast("double"))
        design = ((F.lit(1.0), F.col("x1")), (F.lit(1.0), F.col("x2")))
        cols = [F.sum(F.log(z) - d[0] * F.log(e1) - d[1] * F.log(e2))]
        cols += [F.sum((d[k] - p[k]) * v) for k in (0, 1) for v in design[k]]
        cols += [F.sum((p[k] * (1.0 if k == m else 0.0) - p[k] * p[m]) * v * w) for k in (0, 1) for v in design[k] for m in (0, 1) for w in design[m]]
        return np.array([float(c or 0.0) for c in x.agg(*cols).first()])

    s = state(b)
    for _ in range(rounds):
        step = np.linalg.solve(s[5:].reshape(4, 4) + 1e-6 * np.eye(4), s[1:5])
        scale, new = 1.0, state(b + step)
        while not new[0] <= s[0] + 1e-9 and scale > 1e-4:
            scale /= 2
            new = state(b + scale * step)
        b, s = b + scale * step, new
        if np.abs(scale * step).max() < 1e-7:
            break
    x.unpersist()
    return tuple(float(v) for v in b)


def window_rows(periods: DataFrame, start: str, end: str, years: float = 3.0, width: float = V.WIDTH) -> DataFrame:
    """Person-periods whose middle lies in the ``years`` before ``end``."""
    middle = F.date_add(F.col(start), F.round((F.col("period") + 0.5) * width * 365.25).cast("int"))
    last = F.lit(end).cast("date")
    return periods.where((middle >= F.date_sub(last, int(round(years * 365.25)))) & (middle < last))


def recalibrate(model: SurvivalModel, df: DataFrame, id: str, start: str, date: str, lag_years: float = 1.7) -> tuple[float, float, float, float]:
    """Fit on the periods that had been reported by ``date``: they end ``lag_years`` before it."""
    import datetime

    end = (datetime.date.fromisoformat(date) - datetime.timedelta(days=round(lag_years * 365.25))).isoformat()
    return fit_recalibration(model.hazards_of(window_rows(V.person_periods(df), start, end), ["y"]))


def landmark_backtest(model: SurvivalModel, df: DataFrame, id: str, start: str, dates: list[str], horizon: float = 2.0) -> list[dict]:
    """At each date, time-AUC and Brier score of the running subjects' risk over the next ``horizon`` years."""
    out = []
    for d in dates:
        at = V.at_landmark(df, start, d)
        h = model.hazards(at, id).join(at.select(id, "elapsed"), id)
        risk = V.conditional_cif(h, id, "elapsed", horizon)
        rows = at.join(risk, id)
        out.append({"date": d, "n": rows.count(), "auc": V.time_auc(rows, "risk", horizon).first().auc, "brier": V.ipcw_brier(rows, "risk", horizon).first().brier})
    return out
