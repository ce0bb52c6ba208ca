"""Estimators of other libraries: fit, search, pipelines and storage."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from gridloom.operators import search
from gridloom.operators.outside import OutsideEstimator, OutsideModel, objective
from gridloom.sources.models import load_model, save_model
from gridloom.sources.scratch import scratch_path


class Line:
    """A least squares line with a penalty, as other libraries have it."""

    def __init__(self, alpha=1.0, intercept=True):
        self.alpha, self.intercept = alpha, intercept

    def get_params(self):
        return {"alpha": self.alpha, "intercept": self.intercept}

    def set_params(self, **params):
        self.__dict__.update(params)
        return self

    def fit(self, frame, y):
        x = frame.to_numpy()
        self.middle = (x.mean(0), y.mean()) if self.intercept else (0 * x.mean(0), 0.0)
        z = x - self.middle[0]
        self.slope = np.linalg.solve(z.T @ z + self.alpha * np.eye(z.shape[1]), z.T @ (y - self.middle[1]))
        return self

    def predict(self, frame):
        return self.middle[1] + (frame.to_numpy() - self.middle[0]) @ self.slope


def frame(spark, n=240):
    r = np.random.default_rng(6)
    x = r.normal(size=(n, 2))
    y = 3 * x[:, 0] - x[:, 1] + 5 + 0.1 * r.normal(size=n)
    return spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "id int, a double, b double, y double").repartition(3), x, y


def test_one_shard_is_the_estimators_own_fit(spark):
    df, x, y = frame(spark)
    import pandas as pd

    model = OutsideEstimator(estimator=Line(2.0), inputCols=["a", "b"], labelCol="y").fit(df)
    want = Line(2.0).fit(pd.DataFrame(x), y).predict(pd.DataFrame(x))
    assert [r["prediction"] for r in model.transform(df).orderBy("id").collect()] == pytest.approx(want.tolist(), abs=1e-9)


def test_shards_are_even_whatever_the_rows(spark):
    df, _, _ = frame(spark)
    same = df.unionByName(df.where("id = 0").withColumn("id", F.explode(F.sequence(F.lit(1000), F.lit(1999)))))
    model = OutsideEstimator(estimator=Line(), inputCols=["a", "b"], labelCol="y", shardRows=200).fit(same)
    assert len(model.fitted) == 7
    with pytest.raises(ValueError, match="no rows"):
        OutsideEstimator(estimator=Line(), inputCols=["a"], labelCol="y").fit(df.where("false"))


def test_search_pipeline_and_storage(spark):
    df, _, _ = frame(spark)
    stage = OutsideEstimator(estimator=Line(), inputCols=["a", "b"], labelCol="y")
    folds = search.fold_frame(df, "y", folds=3, keys=["id"], drop=["id"])
    trials = {t: {"alpha": a, "unknown": 1} for t, a in enumerate((0.01, 1e6))}
    found = search.run_trials(folds, trials, objective(stage, "y")).groupBy("trial").agg(F.avg("mse").alias("mse")).orderBy("mse").collect()
    assert found[0]["trial"] == 0 and found[0]["mse"] < 0.05 < found[1]["mse"]

    path = scratch_path(spark, "stage")
    stage.with_params({"alpha": 3.5}).write().overwrite().save(path)
    assert OutsideEstimator.load(path).estimator().get_params() == {"alpha": 3.5, "intercept": True}
    fitted = Pipeline(stages=[SQLTransformer(statement="SELECT *, a + b AS c FROM __THIS__"), OutsideEstimator(estimator=Line(), inputCols=["a", "c"], labelCol="y")]).fit(df)
    loaded = load_model(save_model(fitted, scratch_path(spark, "outside")))
    assert isinstance(loaded, PipelineModel) and isinstance(loaded.stages[-1], OutsideModel)
    assert sorted(map(tuple, loaded.transform(df).collect())) == sorted(map(tuple, fitted.transform(df).collect()))
