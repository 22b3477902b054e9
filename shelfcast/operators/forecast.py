"""Boosted-tree forecasts on MLlib: inputs, point forecast, P90 forecast, importances."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.metrics import pinball
from shelfcast.functions.scalars import zero_floor
from shelfcast.operators.score import with_forecast
from shelfcast.session import shared_folder

# Ids with many values become the mean target of their rows; the others are indexed.
MEAN_ENCODED = ("item_id", "store_id")
INDEXED = ("dept_id", "cat_id", "state_id")
NULLABLE = ("sell_price", "price_change_7d")
_PRIOR_ROWS = 20.0
FOLDS = 5


@dataclass(frozen=True)
class ModelInputs:
    """Fitted encoders: mean target per id value, and the MLlib feature pipeline."""

    means: dict[str, DataFrame]
    overall: float
    pipeline: PipelineModel
    columns: tuple[str, ...]

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.pipeline.transform(_encode(rows, self.means, self.overall))

    def training(self, train: DataFrame, target: str = config.TARGET) -> DataFrame:
        """The rows of the fit. A row's mean targets come from the other folds only, so its own
        target is in none of its inputs."""
        return self.pipeline.transform(_with_missing(_out_of_fold(train, target)))


def _out_of_fold(train: DataFrame, target: str) -> DataFrame:
    """Mean targets per id over the folds a row is not in. Folds are dealt by hash of series and
    day; sums per id and fold are combined before their shuffle."""
    rows = train.withColumn("_fold", F.pmod(F.xxhash64(*config.SERIES_DAY), F.lit(FOLDS)).cast("int"))
    sums = {r["_fold"]: (r["s"] or 0.0, r["n"]) for r in rows.groupBy("_fold").agg(
        F.sum(target).cast("double").alias("s"), F.count(target).alias("n")).collect()}
    total, count = (sum(x[i] for x in sums.values()) for i in (0, 1))
    prior = F.lit(0.0)
    for fold, (s, n) in sums.items():
        rest = (total - s) / (count - n) if count > n else 0.0
        prior = F.when(F.col("_fold") == fold, F.lit(rest)).otherwise(prior)
    for name in MEAN_ENCODED:
        per_fold = rows.groupBy(name, "_fold").agg(F.sum(target).cast("double").alias("_s"), F.count(target).alias("_n"))
        overall = per_fold.groupBy(name).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
        left = F.col("_ts") - F.col("_s") + _PRIOR_ROWS * prior
        others = per_fold.join(overall, name).select(
            name, "_fold", (left / (F.col("_tn") - F.col("_n") + _PRIOR_ROWS)).alias(f"{name}_mean"))
        rows = rows.join(others, [name, "_fold"], "left")
    return rows.drop("_fold")


def _encode(rows: DataFrame, means: dict[str, DataFrame], overall: float) -> DataFrame:
    for name, table in means.items():
        rows = rows.join(table, name, "left").withColumn(
            f"{name}_mean", F.coalesce(f"{name}_mean", F.lit(overall))
        )
    return _with_missing(rows)


def _with_missing(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            **{f"{c}_missing": F.col(c).isNull().cast("double") for c in NULLABLE},
            **{c: F.col(c).cast("double") for c in NULLABLE},
        }
    )


def fit_inputs(train: DataFrame, target: str = config.TARGET) -> ModelInputs:
    """Encoders from training rows only.

    The mean target per id is a grouped aggregate joined back, so the number of items is
    not limited by the driver; rare ids are drawn towards the overall mean.
    """
    overall = float(train.agg(F.avg(target)).first()[0])
    means = {}
    for name in MEAN_ENCODED:
        shrunk = (F.sum(target) + F.lit(_PRIOR_ROWS * overall)) / (F.count("*") + _PRIOR_ROWS)
        means[name] = train.groupBy(name).agg(shrunk.alias(f"{name}_mean"))
    plain = [c for c in config.FEATURE_COLUMNS if c not in (*config.HIERARCHY, *NULLABLE)]
    columns = (
        *(f"{c}_mean" for c in MEAN_ENCODED),
        *(f"{c}_index" for c in INDEXED),
        *(f"{c}_filled" for c in NULLABLE),
        *(f"{c}_missing" for c in NULLABLE),
        *plain,
    )
    stages = [
        StringIndexer(
            inputCols=list(INDEXED),
            outputCols=[f"{c}_index" for c in INDEXED],
            handleInvalid="keep",
        ),
        Imputer(
            inputCols=list(NULLABLE),
            outputCols=[f"{c}_filled" for c in NULLABLE],
            strategy="median",
        ),
        VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep"),
    ]
    encoded = _encode(train, means, overall)
    return ModelInputs(means, overall, Pipeline(stages=stages).fit(encoded), columns)


@dataclass(frozen=True)
class PointModel:
    inputs: ModelInputs
    trees: object

    def predict(self, rows: DataFrame) -> DataFrame:
        """Forecast clipped at zero and the residual."""
        return with_forecast(self.trees.transform(self.inputs.transform(rows)))

    def importances(self, top: int = 20) -> DataFrame:
        """Features by their share of the gain; one row per feature column."""
        values = self.trees.featureImportances.toArray().tolist()
        rows = [(c, float(v)) for c, v in zip(self.inputs.columns, values)]
        table = SparkSession.active().createDataFrame(rows, "feature string, gain double")
        return table.orderBy(F.desc("gain"), "feature").limit(top)


def fit_point_forecast(
    train: DataFrame,
    validation: DataFrame | None = None,
    rounds: int = 500,
    depth: int = 7,
    step: float = 0.05,
    sampling: float = 0.8,
    feature_share: float = 0.8,
    min_rows: int = 50,
    seed: int = 42,
) -> PointModel:
    """One global model for all series, squared loss.

    With validation rows, boosting stops once a round no longer improves on them.
    """
    inputs = fit_inputs(train)
    rows = inputs.training(train).select("features", config.TARGET)
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=config.TARGET,
        lossType="squared",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=sampling,
        featureSubsetStrategy=str(feature_share),
        minInstancesPerNode=min_rows,
        maxBins=64,
        seed=seed,
    )
    if validation is not None:
        held_out = inputs.transform(validation).select("features", config.TARGET)
        rows = rows.withColumn("_held_out", F.lit(False)).unionByName(
            held_out.withColumn("_held_out", F.lit(True))
        )
        trees = trees.setValidationIndicatorCol("_held_out")
    return PointModel(inputs, trees.fit(rows))


class PackedTree(NamedTuple):
    """A tree as arrays by node: feature (-1 in a leaf), threshold, children, value of a leaf.

    A split by category has no threshold (NaN); ``members`` marks the categories of its lower side.
    """

    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    members: np.ndarray

    @property
    def depth(self) -> int:
        depth = np.zeros(len(self.feature), int)
        for node in np.flatnonzero(self.feature >= 0):  # children come after their parent
            depth[self.low[node]] = depth[self.high[node]] = depth[node] + 1
        return int(depth.max(initial=0))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at, every = np.zeros(len(x), int), np.arange(len(x))
        for _ in range(self.depth):
            inner = self.feature[at] >= 0
            seen = x[every, np.maximum(self.feature[at], 0)]
            down = seen <= self.threshold[at]
            if self.members.any():
                category = np.clip(np.nan_to_num(seen, nan=-1.0), -1, self.members.shape[1]).astype(int)
                known = (category >= 0) & (category < self.members.shape[1])
                down |= known & self.members[at, np.where(known, category, 0)]
            at = np.where(inner, np.where(down, self.low[at], self.high[at]), at)
        return at


_SPLIT = re.compile(r"If \(feature (\d+) (?:<= (\S+)|in \{(\S*)\})\)")


def pack_tree(tree: DecisionTreeRegressionModel, features: Sequence[int]) -> PackedTree:
    """A fitted tree as arrays; ``features`` gives the columns its own features stand for.

    The description lists a node before its branches, the lower one first.
    """
    nodes: list[list] = []
    members: list[list[int]] = []
    open_: list[int] = []  # inner nodes whose upper branch is still to come
    for line in tree.toDebugString.splitlines():
        text, here = line.strip(), len(nodes)
        split = _SPLIT.match(text)
        if split:
            cut = float(split[2]) if split[2] else math.nan
            nodes.append([features[int(split[1])], cut, here + 1, -1, 0.0])
            members.append([int(float(c)) for c in (split[3] or "").split(",") if c])
            open_.append(here)
        elif text.startswith("Predict:"):
            nodes.append([-1, 0.0, here, here, float(text.split(":")[1])])
            members.append([])
        elif text.startswith("Else"):
            nodes[open_.pop()][3] = here
    columns = [np.array(c) for c in zip(*nodes)]
    lower = np.zeros((len(nodes), 1 + max((c for m in members for c in m), default=0)), bool)
    for node, own in enumerate(members):
        lower[node, own] = True
    return PackedTree(*(c.astype(int) if n in (0, 2, 3) else c.astype(float) for n, c in enumerate(columns)), lower)


def _evaluated(rows: DataFrame, trees: Sequence[PackedTree], leaf: bool = False) -> Column:
    """Sum of the values of all trees, or the leaf of the last one, in one pass over Arrow batches."""
    shared = rows.sparkSession.sparkContext.broadcast(list(trees))

    def evaluate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, 1))
            if leaf:
                yield pd.Series(shared.value[-1].leaves(x))
            else:
                total = np.zeros(len(x))
                for tree in shared.value:
                    total += tree.value[tree.leaves(x)]
                yield pd.Series(total)

    kind = F.pandas_udf(evaluate, "long" if leaf else "double")
    return kind(vector_to_array("features"))


@dataclass(frozen=True)
class QuantileModel:
    """Start value, and one packed tree per round whose leaves hold what is added to it."""

    inputs: ModelInputs
    start: float
    trees: list[PackedTree] = field(default_factory=list)
    losses: tuple[float, ...] = ()  # held-out loss after each round that was tried

    def predict(self, rows: DataFrame, out: str = "p90_forecast") -> DataFrame:
        scored = self.inputs.transform(rows)
        raw = F.lit(self.start)
        if self.trees:
            raw = raw + _evaluated(scored, self.trees)
        return scored.withColumn("_f", raw).withColumn(out, zero_floor("_f")).drop("_f", "features")


def fit_quantile_forecast(
    train: DataFrame,
    validation: DataFrame | None = None,
    alpha: float = config.RISK_QUANTILE,
    rounds: int = 500,
    depth: int = 7,
    step: float = 0.05,
    min_rows: int = 50,
    sampling: float = 0.8,
    feature_share: float = 0.8,
    patience: int = 30,
    seed: int = 42,
    checkpoint_every: int = 10,
) -> QuantileModel:
    """Gradient boosting for the pinball loss (Friedman 2001).

    Every round fits an MLlib tree to the loss gradient on a share of the rows and of the
    features, both drawn by seed, and then sets each leaf to the quantile of the residuals of
    all rows in it, a grouped mergeable summary. What reaches the driver per round is one number
    per leaf (at most 2^depth). The trees since the last checkpoint are evaluated in one pass, so
    the plan does not grow with the rounds.

    With validation rows the pinball loss on them is taken after each round. Boosting stops when
    it has not improved for ``patience`` rounds, and the trees up to the best round are kept.
    """
    spark = train.sparkSession
    shared_folder(spark)
    inputs = fit_inputs(train)
    target = F.col(config.TARGET).cast("double").alias("_y")
    place = F.xxhash64(*config.SERIES_DAY).alias("_place")
    rows = inputs.training(train).select("features", target, place)
    start = float(rows.agg(F.percentile_approx("_y", alpha, 10000)).first()[0])
    rows = rows.withColumn("_f", F.lit(start)).checkpoint()
    held_out = None
    if validation is not None:
        held_out = inputs.transform(validation).select("features", target).withColumn("_f", F.lit(start)).checkpoint()
    width = len(inputs.columns)
    rng = np.random.default_rng(seed)
    trees: list[PackedTree] = []
    losses: list[float] = []
    since = 0  # rounds up to the last checkpoint
    gradient = F.when(F.col("_y") > F.col("_f"), F.lit(alpha)).otherwise(F.lit(alpha - 1.0))
    for number in range(rounds):
        chosen = sorted(rng.choice(width, max(1, math.ceil(feature_share * width)), replace=False).tolist())
        drawn = F.pmod(F.xxhash64("_place", F.lit(seed + number)), F.lit(1000)) < int(1000 * sampling)
        current = rows
        if trees[since:]:
            current = rows.withColumn("_f", F.col("_f") + _evaluated(rows, trees[since:]))
        sliced = VectorSlicer(inputCol="features", outputCol="_some", indices=chosen).transform(current.where(drawn))
        fitted = DecisionTreeRegressor(
            featuresCol="_some", labelCol="_gradient", maxDepth=depth, minInstancesPerNode=min_rows,
            maxBins=64, seed=seed + number,
        ).fit(sliced.withColumn("_gradient", gradient))
        tree = pack_tree(fitted, chosen)
        refit = current.groupBy(_evaluated(current, [tree], leaf=True).alias("_leaf")).agg(
            F.percentile_approx(F.col("_y") - F.col("_f"), alpha, 1000).alias("v"))
        value = np.zeros(len(tree.value))
        for row in refit.collect():
            value[row["_leaf"]] = step * float(row["v"])
        trees.append(tree._replace(value=value))
        if held_out is not None:
            predicted = F.col("_f") + _evaluated(held_out, trees[since:])
            losses.append(float(held_out.agg(pinball(F.col("_y"), zero_floor(predicted), alpha)).first()[0] or 0.0))
            if len(losses) - 1 - int(np.argmin(losses)) >= patience:
                break
        if (number + 1) % checkpoint_every == 0:
            added = trees[since:]
            rows = rows.withColumn("_f", F.col("_f") + _evaluated(rows, added)).checkpoint()
            if held_out is not None:
                held_out = held_out.withColumn("_f", F.col("_f") + _evaluated(held_out, added)).checkpoint()
            since = number + 1
    if losses:
        trees = trees[: int(np.argmin(losses)) + 1]
    return QuantileModel(inputs, start, trees, tuple(losses))
