"""Estimators of other libraries as ``pyspark.ml`` stages.

Any object with ``get_params``, ``set_params``, ``fit(frame, y)`` and ``predict(frame)`` (frames are pandas') can be fitted, put
into a pipeline, searched over and stored. Rows are dealt into shards of about ``shardRows``, evenly whatever their values, and
one copy is fitted per shard, each in a task of its own; a prediction is the mean of theirs. A table of one
shard gives just the estimator's own fit. The driver holds the fitted copies, never rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.columns import ref
from gridloom.operators.metrics import fold_metrics
from gridloom.sources.scratch import ship_package

#: Rows that one copy is fitted on, about.
SHARD_ROWS = 100_000


class _Shared(HasInputCols, HasLabelCol, HasPredictionCol):
    pass


class OutsideEstimator(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """§2.14: fits copies of an outside estimator. The estimator itself is a parameter, as text, so that it is stored with the stage."""

    packed = Param(Params._dummy(), "packed", "the estimator, pickled, in base64", TypeConverters.toString)
    shardRows = Param(Params._dummy(), "shardRows", "rows of a shard, about", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, estimator: Any = None, inputCols: list[str] | None = None, labelCol: str = "label", predictionCol: str = "prediction", shardRows: int = SHARD_ROWS):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", shardRows=SHARD_ROWS)
        given = {k: v for k, v in self._input_kwargs.items() if k != "estimator" and v is not None}
        self._set(**given)
        if estimator is not None:
            self._set(packed=_packed(estimator))

    def estimator(self) -> Any:
        return _unpacked(self.getOrDefault("packed"))

    def with_params(self, params: Mapping[str, Any]) -> OutsideEstimator:
        """A copy whose estimator has the parameters it knows set."""
        own = self.estimator()
        own.set_params(**{k: v for k, v in params.items() if k in own.get_params()})
        return self.copy({self.packed: _packed(own)})

    def _fit(self, df: DataFrame) -> OutsideModel:
        ship_package(df.sparkSession)
        names, packed = self.getInputCols(), self.getOrDefault("packed")
        rows = df.where(ref(self.getLabelCol()).isNotNull()).select(*[ref(c).cast("double").alias(f"f{i}") for i, c in enumerate(names)], ref(self.getLabelCol()).cast("double").alias("y"))
        shards = max(1, -(-rows.count() // self.getOrDefault("shardRows")))

        def run(batches):
            parts = [b for b in batches if len(b)]
            if parts:
                whole = pd.concat(parts, ignore_index=True)
                whole.columns = [*names, "y"]
                model = _unpacked(packed)
                model.fit(whole[names], whole["y"].to_numpy())
                yield pd.DataFrame({"model": [_packed(model)]})

        fitted = [r["model"] for r in rows.repartition(shards).mapInPandas(run, "model string").collect()]  # one a shard
        if not fitted:
            raise ValueError("no rows to fit")
        model = OutsideModel(sorted(fitted))
        return self._copyValues(model)


class OutsideModel(Model, _Shared, MLWritable):
    """The fitted copies; a prediction is their mean."""

    def __init__(self, fitted: list[str] | None = None):
        super().__init__()
        self.fitted = fitted or []

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        names, target = self.getInputCols(), self.getPredictionCol()
        shared = df.sparkSession.sparkContext.broadcast(self.fitted)
        schema = T.StructType([*df.schema.fields, T.StructField(target, T.DoubleType())])

        def run(batches):
            models = [_unpacked(m) for m in shared.value]
            for batch in batches:
                guess = np.mean([np.asarray(m.predict(batch[names].astype(float)), float) for m in models], axis=0) if len(batch) else []
                yield batch.assign(**{target: guess})

        return df.mapInPandas(run, schema)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    @classmethod
    def load(cls, path: str) -> OutsideModel:
        return cls.read().load(path)


class _Writer(MLWriter):
    def __init__(self, model: OutsideModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.sparkSession.createDataFrame([(m,) for m in self.model.fitted], "model string").write.parquet(f"{path}/models")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> OutsideModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(sorted(r["model"] for r in self.sparkSession.read.schema("model string").parquet(f"{path}/models").collect()))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _packed(value: Any) -> str:
    return base64.b64encode(cloudpickle.dumps(value)).decode()


def _unpacked(text: str) -> Any:
    return cloudpickle.loads(base64.b64decode(text))


def objective(estimator: OutsideEstimator, target: str) -> Callable[[dict, DataFrame, DataFrame, list[str]], dict]:
    """§2.14: what ``search.run_trials`` calls for a trial and a fold: a fit with the trial's parameters, measured on the held-out rows."""

    def run(params: dict, train: DataFrame, check: DataFrame, features: list[str]) -> dict:
        own = estimator.with_params(params)
        model = own.copy({own.inputCols: features, own.labelCol: target, own.predictionCol: "prediction"}).fit(train)
        return fold_metrics(model.transform(check), target, "prediction", []).first().asDict()

    return run
