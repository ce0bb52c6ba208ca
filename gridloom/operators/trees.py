"""Forests and boosted trees: parameters, fits, search and scoring."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.columns import ref
from gridloom.operators import forests, growing, sampler
from gridloom.operators.metrics import cv_summary, fold_metrics
from gridloom.operators.search import BOOSTED_SPACE, FOREST_SPACE, TRIALS, Param, fold_frame, trial_table
from gridloom.operators.split import FOLDS, SEED

FOREST, BOOSTED = "random_forest", "boosted"

#: Nodes of a forest that the driver may hold, as one of Spark's own models; it takes about a kilobyte for each while the model is made.
MODEL_NODES = 50_000

# Parameters of each model with their defaults, and what a training job fills in.
FOREST_DEFAULTS = {
    "n_estimators": 100,
    "max_depth": None,
    "min_samples_split": 2,
    "min_samples_leaf": 1,
    "max_features": 1.0,
    "bootstrap": True,
}
BOOSTED_DEFAULTS = {
    "n_estimators": 1000,
    "learning_rate": 0.1,
    "num_leaves": 31,
    "max_depth": -1,
    "min_child_samples": 20,
    "subsample": 1.0,
    "subsample_freq": 1,
    "colsample_bytree": 1.0,
    "reg_lambda": 0.0,
    "reg_alpha": 0.0,
}


def configure(kind: str, params: Mapping[str, Any]) -> tuple[dict, dict]:
    """The values a fit uses, and a report of the given parameters that were applied and those no model knows."""
    values = dict(FOREST_DEFAULTS if kind == FOREST else BOOSTED_DEFAULTS)
    report: dict = {"applied": {k: v for k, v in params.items() if k in values}, "dropped": sorted(k for k in params if k not in values)}
    values.update(report["applied"])
    return values, report


def known_parameters(df: DataFrame, column: str, kind: str) -> DataFrame:
    """P19 for a table of trials: the map of parameters (as text) in ``column``, restricted to those the model knows, defaults filled in."""
    defaults = FOREST_DEFAULTS if kind == FOREST else BOOSTED_DEFAULTS
    names = F.array(*[F.lit(n) for n in defaults])
    given = F.map_filter(F.coalesce(F.col(column), F.create_map().cast("map<string,string>")), lambda k, v: F.array_contains(names, k))
    missing = F.map_filter(F.create_map(*[F.lit(str(v)) for pair in defaults.items() for v in pair]), lambda k, v: ~F.map_contains_key(given, k))
    return df.withColumn(column, F.map_concat(given, missing))


def _share(value: Any, n: int) -> float:
    """The share of n features a node may use."""
    if value in (None, "auto", "all"):
        return 1.0
    count = {"sqrt": math.sqrt(n), "log2": math.log2(max(n, 2))}.get(value) if isinstance(value, str) else None
    return float(value) if isinstance(value, float) else max(1.0, int(value) if count is None else int(count)) / max(n, 1)


def fit_blocks(blocks: growing.Blocks, target: str, kind: str, params: Mapping[str, Any], seed: int = SEED, model_nodes: int = MODEL_NODES):
    """M3, M5: a model fitted on binned blocks, and the report of its parameters. A forest of more than ``model_nodes`` nodes stays a table."""
    values, report = configure(kind, params)
    spark, depth = blocks.df.sparkSession, values["max_depth"]
    depth = None if depth is None or depth < 0 or (kind == BOOSTED and depth == 0) else int(depth)
    if kind == FOREST:
        planted = growing.plant_forest(
            blocks, trees=values["n_estimators"], depth=depth, split_rows=values["min_samples_split"], leaf_rows=values["min_samples_leaf"],
            share=_share(values["max_features"], len(blocks.cuts)), bootstrap=values["bootstrap"], seed=seed,
        )
        if planted.nodes > model_nodes:
            return forests.forest_model(spark, planted, blocks.cuts, target), report
        grown = growing.grafted_trees(spark, planted)
        growing.discard(spark, planted.path)
        return growing.spark_model(spark, "forest", grown, [1.0] * len(grown), blocks.cuts, target), report
    grown = growing.boost(
        blocks, trees=values["n_estimators"], rate=values["learning_rate"], leaves=values["num_leaves"], depth=depth,
        leaf_rows=values["min_child_samples"], l1=values["reg_alpha"], l2=values["reg_lambda"], subsample=values["subsample"],
        subsample_every=values["subsample_freq"], columns_share=values["colsample_bytree"], seed=seed,
    )
    start = growing.flat(growing.Node(0, 0, blocks.rows), lambda total, rows: blocks.mean)
    weights = [1.0] + [values["learning_rate"]] * len(grown)
    return growing.spark_model(spark, "boosted", [start, *grown], weights, blocks.cuts, target), report


def fit_trees(train: DataFrame, target: str, kind: str, params: Mapping[str, Any], *, seed: int = SEED,
              features: Sequence[str] | None = None, model_nodes: int = MODEL_NODES, blocks: growing.Blocks | None = None
              ) -> tuple[PipelineModel, dict]:
    """M3, M5: fit on a numeric frame; the stored pipeline assembles its own feature vector.

    Several fits on one frame may share its ``blocks``, which are then the caller's to discard.
    """
    names = [c for c in train.columns if c != target] if features is None else list(features)
    own = blocks is None
    blocks = growing.make_blocks(train, names, target) if own else blocks
    model, report = fit_blocks(blocks, target, kind, params, seed, model_nodes)
    if own:
        growing.discard(train.sparkSession, blocks.path)
    return PipelineModel([VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error"), model]), report


def search_trees(
    train: DataFrame,
    target: str,
    kind: str,
    *,
    trials: int = TRIALS,
    folds: int = FOLDS,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    space: Sequence[Param] | None = None,
    parallelism: int = 4,
    ledger: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """M4, M6: ``(trials, fold metrics)`` of a sequential search with cross-validation.

    Each fold's training rows are binned once, for all trials. Trials follow one another, as each is drawn from those before; the
    folds of a trial run side by side. With a ``ledger`` folder a search that was cut off goes on after its last finished trial.
    """
    spark = train.sparkSession
    space = space or (FOREST_SPACE if kind == FOREST else BOOSTED_SPACE)
    frame = fold_frame(train, target, folds=folds, seed=seed, keys=keys, drop=drop)
    rows = frame.df.persist()
    blocks = {f: growing.make_blocks(rows.where(ref(frame.fold) != f), names, target) for f, names in frame.features.items()}

    @inheritable_thread_target(spark)
    def one(task: tuple[dict, int]) -> tuple:
        params, fold = task
        model, _ = fit_blocks(blocks[fold], target, kind, params, seed)
        assemble = VectorAssembler(inputCols=frame.features[fold], outputCol="features", handleInvalid="error")
        scored = model.transform(assemble.transform(rows.where(ref(frame.fold) == fold)))
        m = fold_metrics(scored, target, "prediction", []).first()
        if isinstance(model, forests.ForestModel):
            model.release(spark)
        return fold, m["mse"], m["rmse"], m["mae"], m["r2"]

    def objective(params: dict) -> list[tuple]:
        return pool.map(one, [(params, f) for f in frame.features], chunksize=1)

    try:
        with ThreadPool(max(1, min(parallelism, folds))) as pool:
            found = sampler.search(spark, space, objective, trials, seed=seed, ledger=ledger)
    finally:
        rows.unpersist()
        for b in blocks.values():
            growing.discard(spark, b.path)
    metrics = spark.createDataFrame([(t.number, *m) for t in found for m in t.folds], "trial int, fold int, mse double, rmse double, mae double, r2 double")
    table = trial_table(spark, {t.number: t.params for t in found})
    return table.join(F.broadcast(cv_summary(metrics)), "trial"), metrics  # one row per trial


def best_params(trials: DataFrame, best: dict) -> dict:
    """The parameter part of a best trial."""
    return {k: v for k, v in best.items() if k != "trial" and not k.startswith("cv_")}


def score(model: Any, df: DataFrame) -> DataFrame:
    """M8: the frame with a ``prediction`` column from a stored Spark model."""
    return model.transform(df)


def score_with(df: DataFrame, predictor: Any, features: Sequence[str], *, name: str = "prediction") -> DataFrame:
    """M8: the same for any object with ``predict(frame)``, evaluated on Arrow batches."""
    shared = df.sparkSession.sparkContext.broadcast(predictor)  # one model object
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    columns = list(features)

    def run(batches):
        model: Callable = shared.value
        for batch in batches:
            yield batch.assign(**{name: model.predict(batch[columns])})

    return df.mapInPandas(run, schema)
