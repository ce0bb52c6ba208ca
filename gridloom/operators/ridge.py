"""Ridge regression from sufficient statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import quoted, ref, string_columns
from gridloom.operators.encode import OneHot, Scaler, scale_of
from gridloom.operators.metrics import cv_summary, require_best
from gridloom.operators.search import RIDGE_SPACE, TRIALS, FoldFrame, draw, fold_frame, trial_table
from gridloom.operators.split import FOLDS, SEED

DEFAULT_ALPHA = 1.0
GENERATED_PRODUCTS = 80  # products up to which moments are generated expressions
SCORED_VALUES = 2_000_000  # predictions held at once while scoring a batch under all trials


@dataclass(frozen=True)
class Moments:
    """Row count, sums and products of ``[features..., target]`` after subtracting ``shift``."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products, self.shift)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.sums - other.sums, self.products - other.products, self.shift)

    def centred(self) -> np.ndarray:
        return self.products - np.outer(self.sums, self.sums) / self.n

    def means(self) -> np.ndarray:
        return self.shift + self.sums / self.n


def moments_by_fold(df: DataFrame, columns: Sequence[str], fold: str, *, generated_products: int = GENERATED_PRODUCTS
                    ) -> dict[int, Moments]:
    """First and second moments of the columns per fold, in one scan after a scan for the shift.

    The shift (column means) keeps the products small so that centring them later loses no digits.
    """
    size = len(columns)
    row = df.agg(
        *[F.avg(ref(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.count_if(ref(c).isNull()).alias(f"z{i}") for i, c in enumerate(columns)],
    ).first()
    holes = [c for i, c in enumerate(columns) if row[f"z{i}"]]
    if holes:
        raise ValueError(f"missing values in {', '.join(holes)}")
    shift = np.array([row[f"m{i}"] or 0.0 for i in range(size)])
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    if len(upper) <= generated_products:
        z = [ref(c) - F.lit(float(s)) for c, s in zip(columns, shift)]
        sums = [F.sum(z[i]).alias(f"s{i}") for i in range(size)]
        products = [F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in upper]
        rows = df.groupBy(ref(fold).alias("fold")).agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()
        flat = {
            r["fold"]: [float(r["n"]), *[r[f"s{i}"] for i in range(size)], *[r[f"p{i}_{j}"] for i, j in upper]]
            for r in rows
        }
    else:
        flat = _moments_by_batches(df, columns, fold, shift)
    found = {}
    for f, values in flat.items():
        products = np.zeros((size, size))
        for (i, j), v in zip(upper, values[1 + size:]):
            products[i, j] = products[j, i] = v
        found[f] = Moments(values[0], np.array(values[1 : 1 + size]), products, shift)
    return found


def _moments_by_batches(df: DataFrame, columns: Sequence[str], fold: str, shift: np.ndarray) -> dict[int, list[float]]:
    size = len(columns)
    i, j = np.triu_indices(size)

    def partial(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            z = batch.iloc[:, 1:].to_numpy(dtype=float) - shift
            folds = batch.iloc[:, 0].to_numpy()
            for f in np.unique(folds):
                part = z[folds == f]
                add = np.concatenate([[len(part)], part.sum(0), (part.T @ part)[i, j]])
                totals[int(f)] = totals.get(int(f), 0.0) + add
        for f, values in totals.items():
            yield pd.DataFrame({"fold": f, "slot": np.arange(len(values)), "value": values})

    parts = df.select(ref(fold), *[ref(c) for c in columns]).mapInPandas(partial, "fold int, slot int, value double")
    rows = parts.groupBy("fold", "slot").agg(F.sum("value").alias("value")).collect()  # columns squared per fold
    flat: dict[int, list[float]] = {}
    for r in sorted(rows, key=lambda r: (r["fold"], r["slot"])):
        flat.setdefault(r["fold"], []).append(r["value"])
    return flat


def solve(moments: Moments, alphas: Sequence[float]) -> list[tuple[np.ndarray, float]]:
    """Ridge on standardised features with a free intercept, for all penalties from one decomposition.

    Returns coefficients and intercept in the scale of the raw features.
    """
    centred, means = moments.centred(), moments.means()
    variance = np.diag(centred) / moments.n
    scale = np.array([scale_of(v, m, int(moments.n)) for v, m in zip(variance[:-1], means[:-1])])
    gram = centred[:-1, :-1] / np.outer(scale, scale)
    right = centred[:-1, -1] / scale
    values, vectors = np.linalg.eigh(gram)
    turned = vectors.T @ right
    answers = []
    for alpha in alphas:
        spread = values + alpha
        weights = np.divide(turned, spread, out=np.zeros_like(turned), where=np.abs(spread) > 1e-12)
        coefficients = (vectors @ weights) / scale
        answers.append((coefficients, float(means[-1] - coefficients @ means[:-1])))
    return answers


def _fold_errors(frame: FoldFrame, columns: Sequence[str], fitted: Mapping[int, tuple[np.ndarray, np.ndarray]],
                 sst: Mapping[int, float]) -> DataFrame:
    """Errors of every trial on every fold, from one scan: a matrix product per Arrow batch."""
    spark = frame.df.sparkSession
    shared = spark.sparkContext.broadcast(dict(fitted))  # trials x features per fold

    def errors(batches):
        models = shared.value
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(y), len(columns))  # NaN for null
            for f in np.unique(folds):
                weights, intercepts = models[int(f)]
                at = np.flatnonzero(folds == f)
                step = max(1, SCORED_VALUES // len(intercepts))
                for start in range(0, len(at), step):
                    part = at[start : start + step]
                    miss = y[part, None] - (x[part] @ weights.T + intercepts)
                    squared = np.einsum("ij,ij->j", miss, miss)
                    add = np.stack([np.full(len(intercepts), float(len(part))), squared, np.abs(miss, out=miss).sum(0)])
                    sums[int(f)] = sums.get(int(f), 0.0) + add
        for f, (n, squared, absolute) in sums.items():
            table = {"fold": np.full(len(n), f, np.int32), "trial": np.arange(len(n), dtype=np.int32), "n": n, "sse": squared, "sae": absolute}
            yield pa.RecordBatch.from_pydict(table)

    listed = F.array(*[ref(c) for c in columns]).cast("array<double>")  # one column reaches Arrow faster than many
    parts = frame.df.select(ref(frame.fold), ref(frame.target), listed.alias("x")).mapInArrow(errors, "fold int, trial int, n double, sse double, sae double")
    sums = parts.groupBy("trial", "fold").agg(*[F.sum(c).alias(c) for c in ("n", "sse", "sae")])
    spread = F.create_map(*[F.lit(v) for f, s in sst.items() for v in (int(f), float(s))])
    total = F.try_element_at(spread, F.col("fold"))
    flat = F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return sums.select(
        "trial", "fold", (F.col("sse") / F.col("n")).alias("mse"), F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (F.col("sae") / F.col("n")).alias("mae"),
        F.when(total > 0, 1.0 - F.col("sse") / total).otherwise(flat).alias("r2"),
    )


def ridge_search(
    train: DataFrame, target: str, *, trials: int = TRIALS, folds: int = FOLDS, seed: object = SEED,
    keys: Sequence[str] | None = None, drop: Sequence[str] = (), alphas: Sequence[float] | None = None,
    generated_products: int = GENERATED_PRODUCTS,
) -> tuple[DataFrame, DataFrame]:
    """M2: ``(trials, fold metrics)`` of a search for the penalty by cross-validation.

    All penalties and folds are solved from the moments of one scan: training moments of a fold are the total minus
    its own. One more scan measures every fitted model on its validation rows.
    """
    frame = fold_frame(train, target, folds=folds, seed=seed, keys=keys, drop=drop)
    columns = sorted({c for names in frame.features.values() for c in names})
    if alphas is None:
        drawn = {t: draw(RIDGE_SPACE, t, seed) for t in range(trials)}
    else:
        drawn = {t: {"alpha": float(a)} for t, a in enumerate(alphas)}
    penalties = [p["alpha"] for p in drawn.values()]
    parts = moments_by_fold(frame.df, [*columns, target], frame.fold, generated_products=generated_products)
    total = None
    for part in parts.values():
        total = part if total is None else total + part
    fitted, sst = {}, {}
    for f, own in parts.items():
        used = [columns.index(c) for c in frame.features[f]]
        rest = total - own
        at = np.array([*used, len(columns)])
        narrow = Moments(rest.n, rest.sums[at], rest.products[np.ix_(at, at)], rest.shift[at])
        weights = np.zeros((len(penalties), len(columns)))
        intercepts = np.zeros(len(penalties))
        for t, (coefficients, intercept) in enumerate(solve(narrow, penalties)):
            weights[t, used], intercepts[t] = coefficients, intercept
        fitted[f] = (weights, intercepts)
        sst[f] = float(own.centred()[-1, -1])
    metrics = _fold_errors(frame, columns, fitted, sst)
    table = trial_table(train.sparkSession, drawn)
    return table.join(F.broadcast(cv_summary(metrics)), "trial"), metrics  # one row per trial


def best_ridge(trials: DataFrame) -> tuple[dict, float, dict]:
    """Best parameters, objective and summary of a ridge search."""
    best = require_best(trials)
    summary = {k: v for k, v in best.items() if k.startswith("cv_")}
    return {"alpha": best["alpha"]}, best["cv_mse_mean"], {**summary, "cv_mse": best["cv_mse_mean"]}


def fit_ridge(train: DataFrame, target: str, alpha: float = DEFAULT_ALPHA, *, drop: Sequence[str] = ()) -> PipelineModel:
    """M1, E5: one-hot text columns, standardise everything, fit; one stored pipeline scores raw rows.

    Spark scales its penalty by the label's deviation and the row count, hence the conversion of ``alpha``.
    """
    train = train.where(ref(target).isNotNull())  # scaler, count and deviation are those of the rows that are fitted
    inputs = [c for c in train.columns if c not in {target, *drop}]
    text = string_columns(train.select(*[ref(c) for c in inputs]))
    encoder = OneHot.fit(train, text)
    numbers = [c for c in inputs if c not in text]
    pieces = [e for c in text for e in encoder.sql(c)] + [(f"CAST({quoted(c)} AS DOUBLE)", c) for c in numbers]
    plain = train.selectExpr(*[f"{e} AS {quoted(f'x{i}')}" for i, (e, _) in enumerate(pieces)],
                             f"CAST({quoted(target)} AS DOUBLE) AS `_y`")
    names = [f"x{i}" for i in range(len(pieces))]
    scaler = Scaler.fit(plain, [*names, "_y"])
    row = plain.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("_y").alias("s")).first()
    scaled = [
        f"(({e}) - {scaler.mean[n]!r}D) / {scaler.scale[n]!r}D AS `_z{i}`" for i, ((e, _), n) in enumerate(zip(pieces, names))
    ]
    prepare = SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")
    assemble = VectorAssembler(inputCols=[f"_z{i}" for i in range(len(pieces))], outputCol="features")
    ridge = LinearRegression(
        featuresCol="features", labelCol=target, predictionCol="prediction", elasticNetParam=0.0, standardization=False,
        regParam=float(alpha) / row["n"] * (row["s"] or 0.0), solver="normal",
    )
    return Pipeline(stages=[prepare, assemble, ridge]).fit(train)
