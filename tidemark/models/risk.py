"""Risk models: an ensemble of boosted trees, a logistic baseline, tuning by time, cross-fitting, exact contributions."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions.percentiles import exact_percentiles
from tidemark.functions.scalars import logit, sigmoid
from tidemark.models.attribution import Explainer, nodes_of
from tidemark.models.features import kinds, learned_levels, leveled
from tidemark.session import ship_package
from tidemark.sources.store import point_to, pointed_at


def _prepared(df: DataFrame, numbers: list[str], levels: dict[str, list[str]]) -> DataFrame:
    out = leveled(df, levels)
    for c in numbers:
        out = out.withColumn(c, F.col(c).cast("double")).withColumn(f"{c}_null", F.col(c).isNull().cast("double"))
    for c in levels:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit("other")))
    return out


#: Rows of a partition in a fit; their number decides how many there are.
FIT_ROWS = 50_000


def ordered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt by a hash of ``columns`` and sorted by them: equal tables give equal partitions, so a seeded fit can be repeated."""
    return rows.repartition(1 + rows.count() // FIT_ROWS, F.xxhash64(*columns)).sortWithinPartitions(*columns)


class Inputs:
    """Numbers (nulls filled with the median, and told) and levels as one vector; a level that was not learned is one of its own."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def fit(self, rows: DataFrame, learn: DataFrame) -> Inputs:
        """``learn``: the rows of ``rows`` that levels and medians come from."""
        self.numbers, words = kinds(rows, self.columns)
        self.levels = learned_levels(learn, words)
        # a column without any value can't be imputed
        full = rows.agg(*[F.count(c).alias(c) for c in self.numbers]).first() if self.numbers else {}
        self.numbers = [c for c in self.numbers if full[c]]
        self.prepare = Pipeline(stages=self._stages()).fit(_prepared(learn, self.numbers, self.levels))
        return self

    def _stages(self) -> list:
        index = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in self.levels]
        own = [f"{c}_f" for c in self.numbers] + [f"{c}_null" for c in self.numbers] + [f"{c}_i" for c in self.levels]
        fill = [Imputer(inputCols=self.numbers, outputCols=[f"{c}_f" for c in self.numbers], strategy="median")] if self.numbers else []
        return [*fill, *index, VectorAssembler(inputCols=own, outputCol="features", handleInvalid="keep")]

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.prepare.transform(_prepared(rows, self.numbers, self.levels))

    def save_to(self, spark: SparkSession, folder: str) -> None:
        self.prepare.write().save(f"{folder}/prepare")
        point_to(spark, f"{folder}/inputs.json", {"columns": self.columns, "numbers": self.numbers, "levels": self.levels})

    @classmethod
    def load_from(cls, spark: SparkSession, folder: str) -> Inputs:
        told = pointed_at(spark, f"{folder}/inputs.json")
        out = cls(told["columns"])
        # the order of the levels' columns is that of the vector
        out.numbers, out.levels, out.prepare = told["numbers"], {c: told["levels"][c] for c in told["columns"] if c in told["levels"]}, PipelineModel.load(f"{folder}/prepare")
        return out

    @property
    def bins(self) -> int:
        return max([32, *[len(v) + 2 for v in self.levels.values()]])

    @property
    def players(self) -> list[str]:
        return [*self.numbers, *self.levels]

    @property
    def owners(self) -> list[int]:
        """The input of each slot of the vector: a number's value and its null flag are one input."""
        n = len(self.numbers)
        return [*range(n), *range(n), *range(n, n + len(self.levels))]


def contributed(df: DataFrame, rows: str, explainer: Explainer, name: str = "contributions") -> DataFrame:
    """``df`` with an array of what each player adds, for the slots in the array column ``rows``, in batches."""
    sent = ship_package(df.sparkSession).sparkContext.broadcast(explainer)

    @F.pandas_udf("array<double>")
    def explained(slots: pd.Series) -> pd.Series:
        return pd.Series(list(sent.value.contributions(np.stack(slots))) if len(slots) else [])

    return df.withColumn(name, explained(rows))


class RiskModel:
    """Boosted trees, one per seed; the score is the sigmoid of the members' mean log-odds.

    Two fits on the same rows agree, whatever order and partitions the rows come in.
    """

    def __init__(self, columns: list[str], seeds: tuple[int, ...] = (0, 1, 2), **params):
        self.columns, self.seeds, self.params = columns, seeds, {"maxIter": 40, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8} | params

    def fit(self, df: DataFrame, label: str, held: Column | None = None) -> RiskModel:
        """Fitted on the rows with a label. Rows for which ``held`` is true are only watched: trees stop when they gain nothing there."""
        held = F.lit(False) if held is None else F.coalesce(held, F.lit(False))
        known = df.where(F.col(label).isNotNull()).withColumn("held_", held).withColumn(label, F.col(label).cast("double"))
        known = ordered(known.select(*self.columns, label, "held_"), [label, "held_", *self.columns])
        self.inputs = Inputs(self.columns).fit(known, known.where("not held_"))
        ready = self.inputs.transform(known).select("features", label, "held_").cache()
        watched = {"validationIndicatorCol": "held_", "validationTol": 0.001} if ready.where("held_").limit(1).count() else {}
        self.members = [GBTClassifier(labelCol=label, featuresCol="features", seed=s, maxBins=self.inputs.bins, **watched, **self.params).fit(ready) for s in self.seeds]
        self.trees = [m.getNumTrees for m in self.members]
        ready.unpersist()
        return self

    def log_odds(self, df: DataFrame, name: str = "log_odds") -> DataFrame:
        out = self.inputs.transform(df)
        for s, m in zip(self.seeds, self.members):
            out = m.transform(out).withColumnRenamed("rawPrediction", f"raw_{s}").drop("prediction", "probability")
        # the trees' margin is half the log-odds
        total = sum((2 * vector_to_array(F.col(f"raw_{s}"))[1] for s in self.seeds), F.lit(0.0))
        return out.withColumn(name, total / len(self.seeds)).select(*df.columns, name)

    def score(self, df: DataFrame, name: str = "risk_score") -> DataFrame:
        """The score to six digits, so that metrics, which sum by distinct score, see a million rows at most."""
        return self.log_odds(df, "lo_").withColumn(name, F.round(sigmoid(F.col("lo_")), 6)).drop("lo_")

    def save_to(self, spark: SparkSession, folder: str) -> None:
        """The fitted model in a folder that ``load_from`` reads."""
        self.inputs.save_to(spark, f"{folder}/inputs")
        for k, m in enumerate(self.members):
            m.write().save(f"{folder}/member-{k}")
        point_to(spark, f"{folder}/model.json", {"columns": self.columns, "seeds": list(self.seeds), "params": self.params, "trees": self.trees})

    @classmethod
    def load_from(cls, spark: SparkSession, folder: str) -> RiskModel:
        told = pointed_at(spark, f"{folder}/model.json")
        out = cls(told["columns"], tuple(told["seeds"]), **told["params"])
        out.inputs, out.trees = Inputs.load_from(spark, f"{folder}/inputs"), told["trees"]
        out.members = [GBTClassificationModel.load(f"{folder}/member-{k}") for k in range(len(out.seeds))]
        return out

    @property
    def explainer(self) -> Explainer:
        """The members' trees with their weights; read from the fitted models once."""
        if getattr(self, "_explainer", None) is None:
            trees = [(nodes_of(t), 2 * w / len(self.members)) for m in self.members for t, w in zip(m.trees, m.treeWeights)]
            self._explainer = Explainer([t for t, _ in trees], [w for _, w in trees], self.inputs.owners)
        return self._explainer

    @property
    def base(self) -> float:
        """What a row without any known input would score, in log-odds."""
        return self.explainer.base

    def contributions(self, df: DataFrame) -> DataFrame:
        """``df`` with contributions: array of (feature, contribution), one for each input; with ``base`` they sum to the log-odds."""
        made = [F.struct(F.lit(p).alias("feature"), F.col("c_")[k].alias("contribution")) for k, p in enumerate(self.inputs.players)]
        out = contributed(self.inputs.transform(df).withColumn("x_", vector_to_array("features")), "x_", self.explainer, "c_")
        return out.withColumn("contributions", F.array(*made)).select(*df.columns, "contributions")


class LinearRisk:
    """Logistic regression on imputed, scaled and one-hot inputs; contributions are exact, weight times centred input."""

    def __init__(self, columns: list[str], penalty: float = 0.01):
        self.columns, self.penalty = columns, penalty

    def fit(self, df: DataFrame, label: str) -> LinearRisk:
        self.numbers, words = kinds(df, self.columns)
        self.levels = learned_levels(df, words)
        rows = _prepared(df.where(F.col(label).isNotNull()), self.numbers, self.levels)
        full = rows.agg(*[F.count(c).alias(c) for c in self.numbers]).first() if self.numbers else {}
        self.numbers = [c for c in self.numbers if full[c]]
        index = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in self.levels]
        hot = [OneHotEncoder(inputCols=[f"{c}_i" for c in self.levels], outputCols=[f"{c}_h" for c in self.levels], handleInvalid="keep")] if self.levels else []
        own = [f"{c}_f" for c in self.numbers] + [f"{c}_null" for c in self.numbers] + [f"{c}_h" for c in self.levels]
        fill = [Imputer(inputCols=self.numbers, outputCols=[f"{c}_f" for c in self.numbers], strategy="median")] if self.numbers else []
        scale = [VectorAssembler(inputCols=own, outputCol="raw_features"), StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)]
        self.model = Pipeline(stages=[*fill, *index, *hot, *scale, LogisticRegression(labelCol=label, regParam=self.penalty)]).fit(rows.withColumn(label, F.col(label).cast("double")))
        self.owners = [f["name"] for f in _slots(self.model.transform(rows.limit(1)))]
        return self

    def score(self, df: DataFrame, name: str = "risk_score") -> DataFrame:
        out = self.model.transform(_prepared(df, self.numbers, self.levels))
        return out.withColumn(name, F.round(vector_to_array("probability")[1], 6)).select(*df.columns, name)

    def contributions(self, df: DataFrame) -> DataFrame:
        """``df`` with contributions: array of (feature, contribution), slots of one input summed."""
        weights = self.model.stages[-1].coefficients.toArray().tolist()
        names = [_owner(n, self.numbers, self.levels) for n in self.owners]
        out = self.model.transform(_prepared(df, self.numbers, self.levels)).withColumn("x_", vector_to_array("features"))
        made = [F.struct(F.lit(c).alias("feature"), sum((F.col("x_")[k] * w for k, (n, w) in enumerate(zip(names, weights)) if n == c), F.lit(0.0)).alias("contribution")) for c in dict.fromkeys(names)]
        return out.withColumn("contributions", F.array(*made)).select(*df.columns, "contributions")


def _slots(row: DataFrame) -> list[dict]:
    attrs = row.schema["raw_features"].metadata["ml_attr"]["attrs"]
    return sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])


def _owner(slot: str, numbers: list[str], levels: dict) -> str:
    for c in numbers:
        if slot in (f"{c}_f", f"{c}_null"):
            return c
    return next((c for c in levels if slot.startswith(f"{c}_h")), slot)


def top_drivers(contributions: Column, k: int = 3) -> Column:
    """The k largest positive contributions, largest first."""
    flipped = F.transform(F.filter(contributions, lambda s: s["contribution"] > 0), lambda s: F.struct(s["contribution"].alias("contribution"), s["feature"].alias("feature")))
    return F.slice(F.sort_array(flipped, False), 1, k)


def reasons(contributions: Column, up: int = 3, down: int = 2) -> Column:
    """The strongest contributions up, then down."""
    flip = lambda a: F.transform(a, lambda s: F.struct(s["contribution"].alias("contribution"), s["feature"].alias("feature")))
    rising = F.slice(F.sort_array(flip(F.filter(contributions, lambda s: s["contribution"] > 0)), False), 1, up)
    falling = F.slice(F.sort_array(flip(F.filter(contributions, lambda s: s["contribution"] < 0)), True), 1, down)
    return F.concat(rising, falling)


def collapse_text(contributions: Column) -> Column:
    """Text and embedding components summed into registration_text, last."""
    is_text = lambda s: s["feature"].startswith("txt_") | s["feature"].startswith("emb_")
    total = F.aggregate(F.filter(contributions, is_text), F.lit(0.0), lambda a, s: a + s["contribution"])
    rest = F.filter(contributions, lambda s: ~is_text(s))
    return F.concat(rest, F.array(F.struct(F.lit("registration_text").alias("feature"), total.alias("contribution"))))


def importance(df: DataFrame, contributions: str = "contributions", most: int = 15) -> DataFrame:
    return df.select(F.explode(contributions).alias("s")).groupBy("s.feature").agg(F.avg(F.abs("s.contribution")).alias("weight")).orderBy(F.desc("weight"), "feature").limit(most)


def driver_directions(df: DataFrame, feature: str, contributions: str = "contributions") -> DataFrame:
    """Mean contribution of a feature in the low and the high third of its values, or at each level."""
    own = df.select(F.col(feature).alias("value"), F.filter(contributions, lambda s: s["feature"] == feature)[0]["contribution"].alias("c"))
    if dict(df.dtypes)[feature] in ("string", "boolean"):
        return own.groupBy(F.col("value").cast("string").alias("level")).agg(F.avg("c").alias("mean_contribution"))
    cut = exact_percentiles(own, [], "value", {"low_": 1 / 3, "high_": 2 / 3})
    level = F.when(F.col("value") <= F.col("low_"), "low third").when(F.col("value") >= F.col("high_"), "high third")
    return own.crossJoin(cut).withColumn("level", level).where("level is not null").groupBy("level").agg(F.avg("c").alias("mean_contribution"))  # one row of cuts


def tune(df: DataFrame, label: str, date: str, cut: str, columns: list[str], grid: list[dict], seed: int = 0, least_trees: int = 50) -> tuple[dict, list[dict]]:
    """The parameters with the best AUC after ``cut`` when fitted before it, and what each of ``grid`` gave.

    The rows after the cut also tell when to stop adding trees; the best parameters carry that number, at least ``least_trees``.
    """
    late = F.col(date) >= F.lit(cut).cast("date")
    tried = []
    for params in grid:
        m = RiskModel(columns, (seed,), **params).fit(df, label, late)
        auc = M.auc(m.score(df.where(late & F.col(label).isNotNull())), "risk_score", label).first().auc
        tried.append({**params, "maxIter": max(least_trees, m.trees[0]), "auc": auc})
    best = max(tried, key=lambda t: (t["auc"] is not None, t["auc"] or 0))
    return {k: v for k, v in best.items() if k != "auc"}, tried


def refit_stability(df: DataFrame, label: str, test: DataFrame, columns: list[str], seeds: tuple[int, ...] = (0, 1, 2), **params) -> list[dict]:
    """How far the scores of ``test`` agree between the model of the first seed and that of each other one."""
    rows, out = test, []
    for s in seeds:
        rows = RiskModel(columns, (s,), **params).fit(df, label).score(rows, f"score_{s}")
    for s in seeds[1:]:
        out.append({"seed": s} | M.refit_agreement(rows, f"score_{seeds[0]}", f"score_{s}", rows, f"score_{seeds[0]}").first().asDict())
    return out


def rolling_origin(df: DataFrame, label: str, date: str, columns: list[str], years: list[int], **params) -> list[dict]:
    """Fit before each year, tested on it and the next."""
    out = []
    for y in years:
        test = df.where((F.year(date) >= y) & (F.year(date) <= y + 1) & F.col(label).isNotNull())
        m = RiskModel(columns, (0,), **params).fit(df.where(F.year(date) < y), label)
        row = M.auc(m.score(test), "risk_score", label).first()
        out.append({"year": y, "n": row.n, "positives": row.positives, "auc": row.auc})
    return out


def cross_fit(df: DataFrame, label: str, date: str, columns: list[str], **params) -> DataFrame:
    """Scores of each calendar year by a model that never saw that year; year by year, whole rows each."""
    years = sorted(r.y for r in df.select(F.year(date).alias("y")).distinct().collect())
    scored = [RiskModel(columns, **({"seeds": (0,)} | params)).fit(df.where(F.year(date) != y), label).score(df.where(F.year(date) == y)) for y in years]
    return reduce(DataFrame.unionByName, scored).withColumn("score_type", F.lit("out_of_fold"))


def score_all(df: DataFrame, label: str, split: str, date: str, columns: list[str], **params) -> DataFrame:
    """A score for every row, and how it came about: ``score_type``.

    Rows that are to be scored get a model of all rows with a label (forward), those held out one of the rows trained on
    (held_out), and those trained on the score of a model that never saw their year (out_of_fold).
    """
    train, labeled = df.where(F.col(split) == "train"), df.where(F.col(label).isNotNull())
    own = RiskModel(columns, **params).fit(train, label).score(df.where(~F.col(split).isin("train", "score")))
    ahead = RiskModel(columns, **params).fit(labeled, label).score(df.where(F.col(split) == "score"))
    both = own.unionByName(ahead).withColumn("score_type", score_type(F.col(split)))
    return both.unionByName(cross_fit(train, label, date, columns, **params))


def score_type(split: Column) -> Column:
    return F.when(split == "score", "forward").when(split == "train", "out_of_fold").otherwise("held_out")


def ablations(df: DataFrame, label: str, columns: list[str], groups: dict[str, list[str]], test: DataFrame, **params) -> dict[str, float]:
    """AUC with each group of columns left out."""
    out = {}
    for name, gone in groups.items():
        m = RiskModel([c for c in columns if c not in gone], (0,), **params).fit(df, label)
        out[name] = M.auc(m.score(test), "risk_score", label).first().auc
    return out


def _logistic(rows: DataFrame, terms: list[Column], offset: Column, start: list[float], rounds: int) -> np.ndarray:
    """Coefficients of ``terms`` in a logistic regression of y with an offset; each trial is one aggregate over all rows.

    Damped Newton steps: the damping shrinks after a step that lowers the loss and grows after one that does not, which is
    then taken back.
    """
    pairs = [(i, j) for i in range(len(terms)) for j in range(i + 1)]

    def measured(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = offset + sum(F.lit(float(v)) * t for v, t in zip(b, terms))
        p = sigmoid(z)
        # log(1 + exp(z)) - y z, without overflow
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col("y") * z
        got = rows.agg(F.sum(loss), *[F.sum((F.col("y") - p) * t) for t in terms], *[F.sum(p * (1 - p) * terms[i] * terms[j]) for i, j in pairs]).first()
        curve = np.zeros((len(terms),) * 2)
        for (i, j), v in zip(pairs, got[1 + len(terms) :]):
            curve[i, j] = curve[j, i] = v
        return got[0], np.array(got[1 : 1 + len(terms)]), curve

    b, damping = np.array(start), 1e-9
    loss, slope, curve = measured(b)
    for _ in range(rounds):
        step = np.linalg.solve(curve + damping * np.diag(np.maximum(np.diag(curve), 1e-9)), slope)
        tried = measured(b + step)
        if tried[0] <= loss + 1e-12 * abs(loss):
            b, (loss, slope, curve), damping = b + step, tried, damping / 10
            if np.abs(step).max() < 1e-9:
                break
        else:
            damping = max(damping, 1e-6) * 10
    return b


def calibration_fit(df: DataFrame, score: str, label: str, rounds: int = 50) -> dict:
    """How far log-odds are off: the intercept at slope 1, and intercept and slope fitted together."""
    rows = df.select(logit(F.col(score)).alias("x"), F.col(label).cast("double").alias("y")).cache()
    one, x = F.lit(1.0), F.col("x")
    alone = _logistic(rows, [one], x, [0.0], rounds)
    both = _logistic(rows, [one, x], F.lit(0.0), [0.0, 1.0], rounds)
    rows.unpersist()
    return {"intercept": float(alone[0]), "joint_intercept": float(both[0]), "slope": float(both[1])}
