"""Regression metrics, cross-validation summaries and best-trial selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import ref, refs
from gridloom.functions.numeric import ratio_or
from gridloom.operators.quantile import DIRECT_ROWS, exact_quantiles

# Smallest denominator of a relative error (the double machine epsilon), and the reported metrics.
RELATIVE_FLOOR = 2.0**-52
METRICS = (
    "mae",
    "mse",
    "rmse",
    "r2",
    "mape",
    "median_ae",
    "explained_variance",
    "y_std",
    "pred_std",
    "residual_std",
)


def r_squared(y: Column, residual: Column) -> Column:
    """1 - SSE/SST; for a constant target 1 when the fit is exact, else 0."""
    sse, sst = F.sum(residual * residual), F.var_pop(y) * F.count(y)
    return F.lit(1.0) - ratio_or(sse, sst, 0.0, 1.0)


def regression_metrics(df: DataFrame, target: str, prediction: str = "prediction", *, direct_rows: int = DIRECT_ROWS
                       ) -> DataFrame:
    """One row with the ten test metrics; the median absolute error is exact."""
    pairs = df.select(ref(target).cast("double").alias("y"), ref(prediction).cast("double").alias("p"))
    pairs = pairs.where(F.col("y").isNotNull() & F.col("p").isNotNull())
    y, p = F.col("y"), F.col("p")
    error = y - p
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        r_squared(y, error).alias("r2"),
        F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(RELATIVE_FLOOR))).alias("mape"),
        (F.lit(1.0) - ratio_or(F.var_pop(error), F.var_pop(y), 0.0, 1.0)).alias("explained_variance"),
        F.stddev_pop(y).alias("y_std"),
        F.stddev_pop(p).alias("pred_std"),
        F.stddev_pop(error).alias("residual_std"),
    ).first()
    absolute = pairs.select(F.abs(error).alias("e"))
    median = exact_quantiles(absolute, ["e"], [0.5], counts={"e": row["n"]}, direct_rows=direct_rows)["e"][0]
    values = {**row.asDict(), "median_ae": median, "rmse": row["mse"] ** 0.5 if row["n"] else None}
    schema = ", ".join(f"{m} double" for m in METRICS)
    return df.sparkSession.createDataFrame([tuple(values[m] for m in METRICS)], schema)


def fold_metrics(df: DataFrame, target: str, prediction: str, by: Sequence[str]) -> DataFrame:
    """Metrics of each trial and fold, or any other grouping."""
    y = ref(target).cast("double")
    error = y - ref(prediction)
    return df.groupBy(*refs(by)).agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r_squared(y, error).alias("r2"),
    )


def cv_summary(folds: DataFrame, by: Sequence[str] = ("trial",)) -> DataFrame:
    """Unweighted mean of each metric over the folds of a trial."""
    return folds.groupBy(*refs(by)).agg(
        *[F.avg(m).alias(f"cv_{m}_mean") for m in ("mse", "rmse", "mae", "r2") if m in folds.columns]
    )


def best_trial(trials: DataFrame, objective: str = "cv_mse_mean") -> DataFrame:
    """The trial with the smallest objective, the earlier one on ties, with all its columns."""
    scored = trials.where(ref(objective).isNotNull() & ~F.isnan(ref(objective)))
    return scored.orderBy(ref(objective), "trial").limit(1)


def require_best(trials: DataFrame, objective: str = "cv_mse_mean") -> dict:
    row = best_trial(trials, objective).first()
    if row is None:
        raise RuntimeError(f"no trial has a value for {objective}")
    return row.asDict()
