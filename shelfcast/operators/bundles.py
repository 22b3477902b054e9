"""Fitted models saved with all they need to score: encoders, trees and settings, by version."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import SparkSession

from shelfcast.operators.forecast import ModelInputs, PackedTree, PointModel, QuantileModel
from shelfcast.operators.isolation import ForestModel
from shelfcast.sources import versions
from shelfcast.sources.tables import read_parquet

_TREE_SCHEMA = (
    "tree int, node int, feature int, threshold double, low int, high int, value double, members array<int>"
)
_NODE_SCHEMA = "tree int, node int, feature int, threshold double, low int, high int, path double"

Model = PointModel | QuantileModel | ForestModel


def _save_inputs(inputs: ModelInputs, folder: str) -> dict:
    for name, table in inputs.means.items():
        table.write.parquet(f"{folder}/means/{name}")
    inputs.pipeline.write().save(f"{folder}/pipeline")
    return {"means": sorted(inputs.means), "overall": inputs.overall, "columns": list(inputs.columns)}


def _load_inputs(spark: SparkSession, folder: str, meta: dict) -> ModelInputs:
    means = {name: read_parquet(spark, f"{folder}/means/{name}", name) for name in meta["means"]}
    pipeline = PipelineModel.load(f"{folder}/pipeline")
    return ModelInputs(means, meta["overall"], pipeline, tuple(meta["columns"]))


def _tree_rows(trees: list[PackedTree]) -> list[tuple]:
    return [
        (n, node, int(t.feature[node]), float(t.threshold[node]), int(t.low[node]), int(t.high[node]),
         float(t.value[node]), [int(c) for c in np.flatnonzero(t.members[node])])
        for n, t in enumerate(trees) for node in range(len(t.feature))
    ]


def _packed(rows: pd.DataFrame) -> list[PackedTree]:
    trees = []
    for _, tree in rows.sort_values(["tree", "node"]).groupby("tree"):
        members = np.zeros((len(tree), 1 + max((c for own in tree["members"] for c in own), default=0)), bool)
        for node, own in enumerate(tree["members"]):
            members[node, list(own)] = True
        trees.append(PackedTree(*(tree[c].to_numpy() for c in ("feature", "threshold", "low", "high", "value")), members))
    return trees


def save_model(spark: SparkSession, model: Model, path: str, params: dict | None = None) -> versions.Version:
    """Save a point, quantile or forest model as a new version below ``path``.

    Encoders are written as tables, trees as MLlib or as one row per node. The record that
    publishes the version holds the settings and is written last, so a reader never sees half a
    model; earlier versions stay.
    """
    folder = versions.draft(path)
    if isinstance(model, PointModel):
        meta = {"kind": "point", **_save_inputs(model.inputs, folder)}
        model.trees.write().save(f"{folder}/trees")
    elif isinstance(model, QuantileModel):
        meta = {"kind": "quantile", "start": model.start, "losses": list(model.losses)}
        meta |= _save_inputs(model.inputs, folder)
        spark.createDataFrame(_tree_rows(model.trees), _TREE_SCHEMA).coalesce(1).write.parquet(f"{folder}/trees")
    else:
        meta = {"kind": "forest", "size": model.size, "features": list(model.features), "offset": model.offset}
        spark.createDataFrame(model.nodes, _NODE_SCHEMA).coalesce(1).write.parquet(f"{folder}/trees")
    return versions.publish(spark, path, folder, json.dumps(meta | {"params": params or {}}))


def load_model(spark: SparkSession, path: str) -> Model:
    """The newest version of a saved model, ready to score."""
    version = versions.open_newest(spark, path, "model")
    meta, folder = json.loads(version.note), version.folder
    if meta["kind"] == "point":
        return PointModel(_load_inputs(spark, folder, meta), GBTRegressionModel.load(f"{folder}/trees"))
    nodes = read_parquet(spark, f"{folder}/trees", "trees").toPandas()  # nodes of a bounded number of trees
    if meta["kind"] == "quantile":
        return QuantileModel(_load_inputs(spark, folder, meta), meta["start"], _packed(nodes), tuple(meta["losses"]))
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    return ForestModel(nodes, meta["size"], tuple(meta["features"]), meta["offset"])


def model_params(spark: SparkSession, path: str) -> dict:
    """The settings the newest version was fitted with."""
    return json.loads(versions.open_newest(spark, path, "model").note)["params"]
