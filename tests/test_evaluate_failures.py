"""An evaluation that fails in part says so; what could be evaluated is written first."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.operators import ridge, trees
from gridloom.plans import jobs
from gridloom.registry import job_queries
from gridloom.sources import models, splits
from gridloom.sources.reports import exists, read_report
from gridloom.sources.scratch import scratch_path

TARGET = "weight-(kg)"


@pytest.fixture(scope="module")
def stored(spark):
    base = scratch_path(spark, "failures")
    df = spark.range(60).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias(TARGET), F.when(F.col("id") < 45, "train").otherwise("test").alias("split"))
    splits.write_splits(df, f"{base}/splits")
    train = df.where("split = 'train'").drop("split")
    for kind in (trees.BOOSTED, trees.FOREST):
        models.save_model(trees.fit_trees(train, TARGET, kind, {"n_estimators": 2, "max_depth": 2})[0], f"{base}/{kind}")
    models.save_model(ridge.fit_ridge(train, TARGET, 1.0), f"{base}/ridge")
    return base, {k: f"{base}/{k}" for k in (trees.BOOSTED, trees.FOREST, "ridge")}


def test_a_failed_model_is_an_error_after_the_others(spark, stored, monkeypatch):
    base, paths = stored
    whole = jobs.evaluate_model

    def broken(*args, label="", **options):
        if label == trees.FOREST:
            raise ValueError("broken forest")
        return whole(*args, label=label, **options)

    monkeypatch.setattr(jobs, "evaluate_model", broken)
    with pytest.raises(jobs.EvaluationError, match="broken forest") as seen:
        jobs.run_evaluate(spark, f"{base}/splits", paths, f"{base}/one")
    assert set(seen.value.failed) == {trees.FOREST} and set(seen.value.reports) == {trees.BOOSTED, "ridge"}
    assert exists(spark, f"{base}/one/ridge_test_metrics.json") and not exists(spark, f"{base}/one/random_forest_test_metrics.json")


def test_failed_attributions_are_an_error_after_the_report(spark, stored, monkeypatch):
    base, paths = stored

    def broken(*_, **__):
        raise ValueError("broken attributions")

    monkeypatch.setattr(jobs, "attribution_report", broken)
    with pytest.raises(jobs.EvaluationError, match="broken attributions") as seen:
        jobs.run_evaluate(spark, f"{base}/splits", paths, f"{base}/two")
    assert set(seen.value.reports) == set(paths) and set(seen.value.failed) == {trees.BOOSTED}
    written = read_report(spark, f"{base}/two/boosted_test_metrics.json")
    assert written["shap"] is None and written["metrics"]["rmse"] >= 0 and "shap_error" not in written["metrics"]


def test_missing_models(spark, stored, monkeypatch):
    base, paths = stored
    lost = paths | {"ridge": f"{base}/none"}
    assert set(jobs.run_evaluate(spark, f"{base}/splits", lost, f"{base}/three")) == {trees.BOOSTED, trees.FOREST}
    with pytest.raises(jobs.EvaluationError, match="none"):
        jobs.run_evaluate(spark, f"{base}/splits", lost, f"{base}/three", skip_missing=False)
    with pytest.raises(FileNotFoundError):
        jobs.run_evaluate(spark, f"{base}/splits", {}, f"{base}/three")
    monkeypatch.setattr(job_queries, "_trained", lambda *_: (base, lost, {}))
    monkeypatch.setattr(job_queries.jobs, "run_baseline", lambda *_, **__: None)
    with pytest.raises(jobs.EvaluationError):
        job_queries.job_evaluate(spark, "folder")
