"""Stored models."""

from __future__ import annotations

from dataclasses import asdict

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from gridloom.operators.attribution import tree_nodes
from gridloom.operators.clean import NumericCoder
from gridloom.operators.forests import ForestModel
from gridloom.operators.order import Sizes
from gridloom.sources.reports import exists, read_report, write_report


def save_model(model: PipelineModel, path: str) -> str:
    """Store a fitted pipeline; anything else is refused."""
    if not isinstance(model, PipelineModel):
        raise TypeError("only fitted pipelines are stored")
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """A stored pipeline; a failing load is an error."""
    return PipelineModel.load(path)


def save_coder(spark: SparkSession, coder: NumericCoder, model_path: str) -> None:
    """The numeric rules of a model, stored beside it: a report and the code table."""
    sizes = None if coder.sizes is None else asdict(coder.sizes)
    write_report(spark, {"parsed": coder.parsed, "coded": coder.coded, "unseen": coder.unseen, "sizes": sizes}, f"{_beside(model_path)}.json")
    if coder.codes is not None:
        coder.codes.write.mode("overwrite").parquet(f"{_beside(model_path)}.parquet")


def load_coder(spark: SparkSession, model_path: str) -> NumericCoder | None:
    """The rules stored beside a model, or nothing."""
    path = f"{_beside(model_path)}.json"
    if not exists(spark, path):
        return None
    rules = read_report(spark, path)
    codes = spark.read.parquet(f"{_beside(model_path)}.parquet") if rules["coded"] else None
    sizes = None if rules["sizes"] is None else Sizes(**rules["sizes"])
    return NumericCoder(tuple(rules["parsed"]), tuple(rules["coded"]), codes, sizes, rules["unseen"])


def _beside(model_path: str) -> str:
    return f"{model_path.rstrip('/')}_coder"


def final_stage(model: PipelineModel):
    return model.stages[-1]


def final_stage_path(model: PipelineModel, path: str) -> str:
    last = len(model.stages) - 1
    digits = len(str(len(model.stages)))
    return f"{path}/stages/{str(last).zfill(digits)}_{model.stages[-1].uid}"


def stored_trees(spark, model: PipelineModel, path: str):
    """Node arrays and weights of the tree model that ends a stored pipeline."""
    last = final_stage(model)
    if isinstance(last, ForestModel):
        return last.node_arrays(spark), np.full(last.getNumTrees, 1.0 / last.getNumTrees)
    return tree_nodes(spark, final_stage_path(model, path), last)
