"""Whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import trees
from gridloom.plans import jobs, profiles
from gridloom.registry.inputs import KEY, ORDERS_SQL, orders_model, query, r, rounded, split_sql, table
from gridloom.registry.model_queries import _BOOSTED_SPACE, _FOREST_SPACE
from gridloom.sources import tables
from gridloom.sources.reports import write_report
from gridloom.sources.scratch import scratch_path


def _raw(spark, folder):
    """The order table in the shape of the raw file: spaced names, a text column, an indicator to be cleaned."""
    df = orders_model(spark, folder)
    return df.select(
        F.col("o_orderkey").alias("Order ID"),
        (50 + F.col("c_acctbal") / 200 + F.col("day") / 100.0).alias("Weight (kg)"),
        (F.col("c_acctbal") / 37).alias("BMI_calc"), F.col("c_nationkey").alias("Age"),
        F.when(F.col("day") % 3 == 0, F.lit("no")).otherwise((F.col("day") % 4 - 1).cast("string")).alias("Physical Exercice"),
        F.col("o_orderpriority").alias("Meal Type"),
    )


_RAW_SQL = f"""{ORDERS_SQL}, cleaned AS (
  SELECT o_orderkey AS "order-id", 50 + c_acctbal / 200 + day / 100.0 AS "weight-(kg)",
         CAST(format('{{:.1f}}', c_acctbal / 37) AS DOUBLE) AS "bmi-calc", c_nationkey AS age,
         CAST(CASE WHEN day % 3 = 0 THEN 0 WHEN day % 4 - 1 > 0 THEN 1 ELSE 0 END AS INTEGER) AS "physical-exercise",
         o_orderpriority AS "meal-type" FROM orders_model)"""


def _raw_csv(spark, folder):
    path = scratch_path(spark, "raw")
    tables.write_csv(_raw(spark, folder), path)
    return path


@query(f"""WITH {_RAW_SQL} SELECT "order-id", {r('"weight-(kg)"', 'weight-(kg)')}, "bmi-calc", age, "physical-exercise", "meal-type" FROM cleaned""")
def job_clean(spark, folder):
    """G1: the cleaned table."""
    target = scratch_path(spark, "clean")
    jobs.run_clean(spark, _raw_csv(spark, folder), target)
    df = tables.read_parquet(spark, f"{target}/dataset_cleaned_final.parquet")
    return df.withColumn("weight-(kg)", F.round("weight-(kg)", 6) + 0.0)


@query(f"""WITH {_RAW_SQL} SELECT "physical-exercise" AS value, CAST(count(*) AS BIGINT) AS n_rows FROM cleaned GROUP BY 1""")
def job_clean_distribution(spark, folder):
    """G1, A1."""
    return jobs.run_clean(spark, _raw_csv(spark, folder), scratch_path(spark, "clean"))


@query(f"""WITH {ORDERS_SQL}, {split_sql()} SELECT split, o_orderkey, o_totalprice, c_acctbal,
           CAST(coalesce(o_orderpriority, '__MISSING__') = '2-HIGH' AS DOUBLE) AS "o_orderpriority_2-HIGH",
           CAST(coalesce(o_orderpriority, '__MISSING__') = '3-MEDIUM' AS DOUBLE) AS "o_orderpriority_3-MEDIUM",
           CAST(coalesce(o_orderpriority, '__MISSING__') = '4-NOT SPECIFIED' AS DOUBLE) AS "o_orderpriority_4-NOT SPECIFIED",
           CAST(o_orderpriority IS NULL AS DOUBLE) AS "o_orderpriority___MISSING__" FROM marked""")
def job_prepare(spark, folder):
    """The split and encoded dataset."""
    source, target = scratch_path(spark, "source") + ".parquet", scratch_path(spark, "splits")
    orders_model(spark, folder).select("o_orderkey", "o_totalprice", "c_acctbal", "o_orderpriority").write.parquet(source)
    jobs.run_prepare(spark, source, target, text=target + ".csv", encoders_json=target + ".json",
                     encoders_csv=target + "-map.csv", target="o_totalprice", keys=KEY)
    return tables.read_parquet(spark, target)


def _prepared(spark, folder):
    """A prepared dataset in a new folder."""
    base = scratch_path(spark, "job")
    jobs.run_clean(spark, _raw_csv(spark, folder), f"{base}/data")
    jobs.run_prepare(spark, f"{base}/data/dataset_cleaned_final.parquet", f"{base}/splits", keys=["order-id"])
    return base


_SPACES = {trees.FOREST: _FOREST_SPACE, trees.BOOSTED: _BOOSTED_SPACE}


@query()
def job_search(spark, folder):
    """One row per model with its best objective and train rows."""
    base = _prepared(spark, folder)
    found = jobs.run_search(spark, f"{base}/splits", base, trials=2, folds=2, keys=["order-id"], spaces=_SPACES)
    rows = [(k, v["best_value"], v["data_summary"]["train_rows"]) for k, v in found.items()]
    return rounded(spark.createDataFrame(rows, "model string, best_value double, train_rows long"), 4)


@query()
def job_importance(spark, folder):
    """G4."""
    base = _prepared(spark, folder)
    found = jobs.run_importance(spark, f"{base}/splits", f"{base}/importance.json", repeats=3, keys=["order-id"],
                                params={"n_estimators": 5, "max_depth": 5})
    return rounded(found, 4)


def _trained(spark, folder):
    base = _prepared(spark, folder)
    params = {trees.FOREST: {"n_estimators": 5, "max_depth": 5}, trees.BOOSTED: {"n_estimators": 5, "max_depth": 3}}
    for kind, chosen in params.items():
        write_report(spark, {"best_params": chosen}, f"{base}/best_{kind}.json")
    stored = {k: f"{base}/models/{k}" for k in (*params, "ridge")}
    trained = jobs.run_train(spark, f"{base}/splits", {k: f"{base}/best_{k}.json" for k in params}, stored)
    return base, stored, trained


@query("""SELECT model, CAST(n - round_even(0.2 * n, 0) AS BIGINT) AS training_rows, applied
          FROM (SELECT count(*) AS n FROM orders), (VALUES ('boosted', 'max_depth,n_estimators'), ('random_forest', 'max_depth,n_estimators'))
          AS t(model, applied)""")
def job_train(spark, folder):
    """G5, P17, P23."""
    _, _, trained = _trained(spark, folder)
    rows = [(k, t.report["training_rows"], sorted(t.report["parameters"]["applied"])) for k, t in trained.items()]
    return spark.createDataFrame(rows, "model string, training_rows long, applied array<string>").select(
        "model", "training_rows", F.concat_ws(",", "applied").alias("applied"))


@query()
def job_baseline(spark, folder):
    """Search and fit."""
    base = _prepared(spark, folder)
    found = jobs.run_baseline(spark, f"{base}/splits", f"{base}/ridge.json", f"{base}/ridge",
                              keys=["order-id"]).report
    s = found["cv_summary"]
    return rounded(spark.createDataFrame([(found["best_params"]["alpha"], s["cv_rmse_mean"], s["cv_r2_mean"])],
                                         "alpha double, cv_rmse_mean double, cv_r2_mean double"), 4)


@query()
def job_evaluate(spark, folder):
    """Test metrics of all three models."""
    base, stored, _ = _trained(spark, folder)
    jobs.run_baseline(spark, f"{base}/splits", f"{base}/ridge.json", stored["ridge"], keys=["order-id"])
    found = jobs.run_evaluate(spark, f"{base}/splits", stored, f"{base}/eval", skip_missing=False)
    rows = [(k, v["metrics"]["rmse"], v["metrics"]["r2"], v["shap"] is not None) for k, v in found.items()]
    return rounded(spark.createDataFrame(rows, "model string, rmse double, r2 double, attributed boolean"), 4)


@query()
def job_run_all(spark, folder):
    """From the raw CSV to the evaluation reports."""
    found = jobs.run_all(spark, _raw_csv(spark, folder), scratch_path(spark, "all"), trials=1, folds=2, repeats=2,
                         keys=["order-id"], spaces=_SPACES, importance_params={"n_estimators": 4, "max_depth": 4})
    rows = [(k, v["metrics"]["rmse"], v["metrics"]["r2"]) for k, v in found.items()]
    return rounded(spark.createDataFrame(rows, "model string, rmse double, r2 double"), 4)


@query("""SELECT 'value' AS "column", CAST(count(*) FILTER (x < lo OR x > hi) AS BIGINT) AS n_outliers FROM (
            SELECT round_even(value * 100, 0) / 100 AS x FROM events), (
            SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM (
              SELECT quantile_cont(round_even(value * 100, 0) / 100, 0.25) AS q1, quantile_cont(round_even(value * 100, 0) / 100, 0.75) AS q3 FROM events))
          HAVING count(*) FILTER (x < lo OR x > hi) > 0""")
def profile_univariate(spark, folder):
    """From a CSV; the outlier report of the written, cleaned table."""
    df = table(spark, folder, "events").select(
        "event_id", F.col("value").alias("sugar_g"), F.col("user_id").alias("Age"), F.col("event_type").alias("Workout"))
    source = scratch_path(spark, "raw")
    tables.write_csv(df, source)
    reports = profiles.run_univariate(spark, source, scratch_path(spark, "cleaned"))
    return reports["top_outliers"].select(
        F.when(F.col("column") == "sugar_g", "value").otherwise(F.col("column")).alias("column"), "n_outliers")


@query(f"""WITH {ORDERS_SQL}, p AS (
             SELECT 'c_acctbal' AS feature_1, 'o_totalprice' AS feature_2, corr(c_acctbal, o_totalprice) AS c FROM orders_model
             UNION ALL SELECT 'c_nationkey', 'o_totalprice', corr(c_nationkey, o_totalprice) FROM orders_model
             UNION ALL SELECT 'c_nationkey', 'c_acctbal', corr(c_nationkey, c_acctbal) FROM orders_model
             UNION ALL SELECT 'day', 'o_totalprice', corr(day, o_totalprice) FROM orders_model
             UNION ALL SELECT 'day', 'c_acctbal', corr(day, c_acctbal) FROM orders_model
             UNION ALL SELECT 'day', 'c_nationkey', corr(day, c_nationkey) FROM orders_model)
           SELECT feature_1, feature_2, {r('c', 'correlation')} FROM p""")
def profile_bivariate(spark, folder):
    """From a CSV; the strongest pairs."""
    source = scratch_path(spark, "raw")
    tables.write_csv(orders_model(spark, folder).drop("o_orderkey"), source)
    return rounded(profiles.run_bivariate(spark, source, "o_totalprice")["top_correlations"])


