"""Ridge by conjugate gradients against normal equations, and on many categories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import ridge_wide


def frame(spark, n=300):
    r = np.random.default_rng(2)
    c, d = r.choice(["a", "b", "c", "dé", None], size=n), r.choice(["u", "v"], size=n)
    x = r.normal(size=n) * 30 + 5
    y = x * 0.3 + np.where(c == "b", 7.0, 0.0) - np.where(d == "v", 2.0, 0.0) + r.normal(size=n)
    rows = [(i, None if a is None else str(a), str(b), float(v), 3.0, float(t)) for i, (a, b, v, t) in enumerate(zip(c, d, x, y))]
    return spark.createDataFrame(rows, "id int, c string, d string, x double, flat double, y double").repartition(4), rows


@pytest.mark.parametrize("alpha", [0.1, 25.0])
def test_equals_normal_equations(spark, alpha):
    df, rows = frame(spark)
    model = ridge_wide.fit_ridge_wide(df, "y", alpha, drop=["id"])
    from gridloom.operators.clean import MISSING_CATEGORY

    columns = {}
    for k, name in ((1, "c"), (2, "d")):
        values = [MISSING_CATEGORY if r[k] is None else r[k] for r in rows]
        for v in sorted(set(values))[1:]:
            columns[f"{name}_{v}"] = [float(u == v) for u in values]
    columns["x"], columns["flat"] = [r[3] for r in rows], [r[4] for r in rows]
    z = np.array(list(columns.values())).T
    spread = z.std(0)
    z = (z - z.mean(0)) / np.where(spread > 1e-12, spread, 1.0)
    y = np.array([r[5] for r in rows])
    w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    got = np.array([r["prediction"] for r in model.predict(df).orderBy("id").collect()])
    assert got == pytest.approx(y.mean() + z @ w, abs=1e-7) and model.rounds < 40


def test_two_hundred_thousand_categories(spark):
    df = spark.range(400_000).select(F.concat(F.lit("k"), (F.col("id") % 200_000).cast("string")).alias("k"), ((F.col("id") % 200_000) % 7).cast("double").alias("y"), F.col("id"))
    model = ridge_wide.fit_ridge_wide(df.repartition(8), "y", 1e-7, drop=["id"])
    assert model.encoder.width == 199_999 and len(model.coefficients) == 199_999
    worst = model.predict(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert worst < 0.05


def test_odd_tables(spark):
    df, _ = frame(spark, 40)
    only = ridge_wide.fit_ridge_wide(df.select("id", "x", "y"), "y", 2.0, drop=["id"])
    assert only.encoder.width == 0 and len(only.coefficients) == 1
    seen = ridge_wide.fit_ridge_wide(df.where("c <> 'b'").select("c", "y"), "y", 2.0)
    got = {r["id"]: r["prediction"] for r in seen.predict(df.select("id", "c", "y")).collect()}
    other = {r["id"]: r["prediction"] for r in seen.predict(df.select("id", F.lit("never").alias("c"), "y")).collect()}
    assert all(got[r["id"]] == pytest.approx(other[r["id"]]) for r in df.where("c = 'b'").collect())
    assert ridge_wide.fit_ridge_wide(df.where("false").drop("id"), "y").intercept == 0.0
    part = ridge_wide.fit_ridge_wide(df.withColumn("y", F.when(F.col("id") < 20, F.col("y"))), "y", 1.0, drop=["id"])
    whole = ridge_wide.fit_ridge_wide(df.where("id < 20"), "y", 1.0, drop=["id"])
    assert part.intercept == pytest.approx(whole.intercept, abs=1e-7)
    with pytest.raises(Exception, match="a feature is missing"):
        ridge_wide.fit_ridge_wide(df.withColumn("x", F.when(F.col("id") > 3, F.col("x"))), "y", drop=["id"])
    with pytest.raises(ValueError, match="positive"):
        ridge_wide.fit_ridge_wide(df, "y", 0.0)
