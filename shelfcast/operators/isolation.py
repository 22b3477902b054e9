"""Isolation forest as Spark jobs: sample, grow one tree per task, score in batches."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.operators.anomaly import ANOMALY_FEATURES

_NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, low int, high int, path double"
)


def _mean_path(n):
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype="float64")
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def draw_samples(
    rows: DataFrame, key: Sequence[str], trees: int, size: int, total: int, seed: int
) -> DataFrame:
    """About ``size`` rows for each tree, chosen by hashing the row key.

    A row is offered to as many trees as give each about 1.3 times ``size`` rows, all of them
    at most. They lie a stride apart that has no factor in common with ``trees``, so they
    differ. Hashes do not depend on partitioning, so a repeated or recomputed task draws the
    same rows. Every tree is trimmed to ``size`` rows, which bounds its group.
    """
    wanted = min(1.3 * trees * size / max(total, 1), trees)
    slots = math.ceil(wanted)
    share = wanted / slots
    strides = F.array(*[F.lit(s) for s in range(1, trees + 1) if math.gcd(s, trees) == 1])
    begin = F.pmod(F.xxhash64(F.lit(seed + 1), *key), F.lit(trees))
    stride = F.get(strides, F.pmod(F.xxhash64(F.lit(seed + 2), *key), F.size(strides)).cast("int"))
    tree = F.pmod(begin + F.col("_slot") * stride, F.lit(trees)).cast("int")
    rank = F.xxhash64(F.lit(seed), "_slot", *key)
    uniform = rank.bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))
    drawn = (
        rows.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        .where(uniform < share)
        .withColumn("tree", tree)
        .withColumn("_rank", rank)
    )
    order = Window.partitionBy("tree").orderBy("_rank", *key)
    return drawn.withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= size
    )


def _grow(tree: int, values: np.ndarray, size: int, seed: int) -> pd.DataFrame:
    """One random tree over at most ``size`` rows, as a node table."""
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(size, 2)))
    nodes: list[list] = []
    todo = [(np.arange(len(values)), 0, None)]
    while todo:
        members, depth, parent = todo.pop()
        here = len(nodes)
        nodes.append([tree, here, -1, 0.0, here, here, depth + float(_mean_path(len(members)))])
        if parent is not None:
            nodes[parent[0]][parent[1]] = here
        subset = values[members]
        spread = np.flatnonzero(subset.min(axis=0) < subset.max(axis=0)) if len(members) > 1 else []
        if depth >= limit or len(spread) == 0:
            continue
        feature = int(rng.choice(spread))
        column = subset[:, feature]
        cut = float(rng.uniform(column.min(), column.max()))
        nodes[here][2:4] = [feature, cut]
        below = column <= cut
        todo.append((members[below], depth + 1, (here, 4)))
        todo.append((members[~below], depth + 1, (here, 5)))
    return pd.DataFrame(
        nodes, columns=["tree", "node", "feature", "threshold", "low", "high", "path"]
    )


@dataclass(frozen=True)
class ForestModel:
    """Node tables of all trees (at most ``trees * 2 * size`` rows) and the score cut."""

    nodes: pd.DataFrame
    size: int
    features: tuple[str, ...]
    offset: float

    def _packed(self) -> list[tuple[np.ndarray, ...]]:
        packed = []
        for _, tree in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            packed.append(
                tuple(tree[c].to_numpy() for c in ("feature", "threshold", "low", "high", "path"))
            )
        return packed

    def with_raw_score(self, rows: DataFrame) -> DataFrame:
        """Negative anomaly measure in (-1, 0); nearer to -1 is more anomalous."""
        shared = rows.sparkSession.sparkContext.broadcast(self._packed())
        norm = float(_mean_path(self.size))
        steps = math.ceil(math.log2(max(self.size, 2)))

        @F.pandas_udf("double")
        def raw(columns: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for frame in columns:
                x = frame.fillna(0.0).to_numpy(dtype="float64")
                total = np.zeros(len(x))
                every = np.arange(len(x))
                for feature, cut, low, high, path in shared.value:
                    at = np.zeros(len(x), dtype="int64")
                    for _ in range(steps):
                        down = x[every, np.maximum(feature[at], 0)] <= cut[at]
                        at = np.where(down, low[at], high[at])
                    total += path[at]
                yield pd.Series(-np.exp2(-total / len(shared.value) / norm))

        return rows.withColumn("_raw", raw(F.struct(*self.features)))

    def transform(self, rows: DataFrame) -> DataFrame:
        scored = self.with_raw_score(rows)
        return (
            scored.withColumn("anomaly_score", F.col("_raw") - F.lit(self.offset))
            .withColumn("anomaly_flag", F.when(F.col("anomaly_score") < 0, 1).otherwise(0))
            .drop("_raw")
        )


def fit_forest(
    rows: DataFrame,
    features: Sequence[str] = ANOMALY_FEATURES,
    key: Sequence[str] = config.SERIES_DAY,
    trees: int = config.FOREST_TREES,
    size: int = config.FOREST_SAMPLE,
    contamination: float = config.CONTAMINATION,
    seed: int = 42,
) -> ForestModel:
    """Fit on a fixed-size sample per tree; the score cut comes from all rows.

    The cut is the contamination percentile of the scores, from a bounded summary. Pass
    rows that are stored or persisted: they are read once to count, once to sample and
    once for the cut.
    """
    total = rows.count()
    size = max(min(size, total), 1)
    narrow = rows.select(*key, *features)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        unique = group.drop_duplicates(list(key)).sort_values("_n")
        values = unique[list(features)].fillna(0.0).to_numpy(dtype="float64")
        return _grow(int(group["tree"].iloc[0]), values, size, seed)

    drawn = draw_samples(narrow, key, trees, size, total, seed)
    nodes = drawn.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()
    model = ForestModel(nodes, size, tuple(features), 0.0)
    cut = model.with_raw_score(narrow).agg(
        F.percentile_approx("_raw", contamination, 10000).alias("cut")
    ).first()["cut"]
    return ForestModel(nodes, size, tuple(features), float(cut))
