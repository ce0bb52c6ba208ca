"""Profiles with edge cases, metrics, ridge, trees, importance and attributions against brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.functions.stats import correlation_p_value
from gridloom.operators import attribution, importance, metrics, profile, ridge, search, trees
from gridloom.operators.split import fold_sizes
from gridloom.plans import jobs
from gridloom.sources import models, splits
from gridloom.sources.scratch import scratch_path


def frame(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n) * 10 + 100
    c = rng.choice(["a", "b", "c"], size=n)
    y = 3 * x1 + 0.2 * x2 + np.where(c == "b", 4.0, 0.0) + rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "c": c, "y": y})
    return spark.createDataFrame(pdf), pdf


def test_profiles_of_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None, float("nan"), 2.0), (1.0, None, 3.0, 4.0), (1.0, None, 5.0, 100.0)],
                               "same double, empty double, part double, x double")
    assert profile.extreme_outliers(df).count() == 0
    assert {r["column"] for r in profile.histograms(df).collect()} == {"part", "x"}
    matrix = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in profile.correlation_matrix(df).collect()}
    assert len(matrix) == 16 and matrix["same", "x"] is None and matrix["same", "same"] is None
    assert matrix["part", "x"] == pytest.approx(1.0) and matrix["empty", "x"] is None
    spearman = {r["feature"]: r for r in profile.spearman_with_target(df, "x").collect()}
    assert spearman["part"]["rho"] == pytest.approx(1.0) and spearman["same"]["rho"] is None and "empty" not in spearman
    one = df.limit(1)
    assert profile.extreme_outliers(one).count() == 0 and profile.histograms(one).count() == 0
    assert profile.extreme_outliers(df.limit(0)).count() == 0


def test_correlations_by_products_equal_generated(spark):
    df, pdf = frame(spark)
    df = df.withColumn("x3", F.when(F.col("id") % 3 > 0, F.col("x2") + 1e6)).drop("c", "id")
    pairs = [{(r[0], r[1]): r[2] for r in profile.correlation_pairs(df, generated_pairs=g).collect()} for g in (100, 0)]
    assert pairs[0].keys() == pairs[1].keys()
    for k, v in pairs[0].items():
        assert v == pytest.approx(pairs[1][k], abs=1e-9)


def test_one_rule_for_flat_columns(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({c: rng.normal(size=60) for c in "abc"})
    pdf["near"] = 1e6 + 1e-6 * rng.normal(size=60)  # nearly constant: its correlations count
    pdf["same"] = 0.1
    pdf["part"] = np.where(np.arange(60) < 30, 7.3, rng.normal(size=60))  # constant where the next is present
    pdf["half"] = np.where(np.arange(60) < 30, rng.normal(size=60), np.nan)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).astype(object), ", ".join(f"{c} double" for c in pdf))
    few, many = ({(r[0], r[1]): r[2] for r in profile.correlation_pairs(df, generated_pairs=n).collect()} for n in (100, 0))
    for pair, value in few.items():
        assert (value is None) == (many[pair] is None) == ("same" in pair or set(pair) == {"part", "half"}), pair
        assert value is None or value == pytest.approx(many[pair], abs=1e-3 if "near" in pair else 1e-9)


def test_spearman_paths_agree(spark):
    df, _ = frame(spark, 500)
    df = df.select("y", F.round("x1").alias("tied"), F.when(F.col("id") % 4 > 0, F.col("x2")).alias("holes"))
    a = profile.spearman_with_target(df, "y").collect()
    b = profile.spearman_with_target(df, "y", sort_rows=5, broadcast_rows=0, hot_rows=50).collect()
    for p, q in zip(a, b):
        assert p["feature"] == q["feature"] and p["n_rows"] == q["n_rows"] and p["rho"] == pytest.approx(q["rho"], abs=1e-12)
    pdf = df.toPandas()
    for r in a:
        both = pdf[["y", r["feature"]]].dropna().rank()
        assert r["rho"] == pytest.approx(both.corr().iloc[0, 1], abs=1e-12)


def test_p_values():
    # two-sided p-values of Student's t from printed tables: t(10) = 2.228, t(5) = 4.032, t(30) = 1.310
    for t, dof, p in ((2.2281388520, 10, 0.05), (4.0321429836, 5, 0.01), (1.3104150254, 30, 0.2)):
        r = t / math.sqrt(dof + t * t)
        assert correlation_p_value(r, dof + 2) == pytest.approx(p, abs=1e-9)
    assert correlation_p_value(1.0, 10) == 0.0 and correlation_p_value(0.0, 10) == pytest.approx(1.0)
    assert correlation_p_value(0.5, 2) is None and correlation_p_value(None, 9) is None


def test_histogram_equals_numpy(spark):
    df, pdf = frame(spark, 400)
    out = profile.histograms(df, ["x1"]).orderBy("bin").collect()
    counts, edges = np.histogram(pdf["x1"], bins=30)
    assert [r["n_rows"] for r in out] == counts.tolist()
    assert [r["lower_edge"] for r in out] == pytest.approx(edges[:-1].tolist())


def test_frequency_table_by_range_buckets(spark):
    df = spark.range(700).select(F.when(F.col("id") % 5 > 0, (F.col("id") % 37).cast("string")).alias("c"))
    a = profile.frequency_table(df, "c").collect()
    b = profile.frequency_table(df, "c", sort_rows=3).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_metrics_of_perfect_and_constant_targets(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(10)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["rmse"], row["r2"], row["explained_variance"], row["median_ae"]) == (0, 0, 1, 1, 0)
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first()["r2"] == 0.0
    assert metrics.regression_metrics(flat.limit(1), "y", "p").first()["r2"] == 1.0
    zero = spark.createDataFrame([(0.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(zero, "y", "p").first()["mape"] == 2.0**52
    with pytest.raises(RuntimeError):
        metrics.require_best(spark.createDataFrame([(0, None)], "trial int, cv_mse_mean double"))


def brute_ridge(train, check, alpha):
    """Standardise, solve the normal equations, predict."""
    levels = sorted(train["c"].unique())[1:]
    def matrix(d):
        return np.column_stack([d[["x1", "x2"]].to_numpy(), *[(d["c"] == v).to_numpy(float) for v in levels]])
    x = matrix(train)
    mean, std = x.mean(0), x.std(0)
    std[std == 0] = 1.0
    z = (x - mean) / std
    b = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (train["y"] - train["y"].mean()))
    return train["y"].mean() + (matrix(check) - mean) / std @ b


@pytest.mark.parametrize("generated", [0, 100])
def test_ridge_search_equals_brute_force(spark, generated):
    df, pdf = frame(spark, 103)
    pdf.loc[5, "c"] = "only once"
    df = spark.createDataFrame(pdf)
    table, folds = ridge.ridge_search(df, "y", alphas=[0.01, 5.0, 300.0], folds=4, keys=["id"], drop=["id"],
                                      generated_products=generated)
    order = sorted(range(103), key=lambda i: __import__("hashlib").md5(f"123|{i}".encode()).hexdigest())
    blocks = np.split(np.array(order), np.cumsum(fold_sizes(103, 4))[:-1])
    got = {(r["trial"], r["fold"]): r for r in folds.collect()}
    for t, alpha in enumerate([0.01, 5.0, 300.0]):
        for f, block in enumerate(blocks):
            check, train = pdf.iloc[block], pdf.drop(index=block)
            error = check["y"] - brute_ridge(train, check, alpha)
            assert got[t, f]["mse"] == pytest.approx((error**2).mean(), rel=1e-8)
            assert got[t, f]["mae"] == pytest.approx(error.abs().mean(), rel=1e-8)
            assert got[t, f]["r2"] == pytest.approx(1 - (error**2).sum() / ((check["y"] - check["y"].mean())**2).sum(), rel=1e-8)
    best, value, summary = ridge.best_ridge(table)
    assert summary["cv_mse"] == value == table.agg(F.min("cv_mse_mean")).first()[0] and best["alpha"] in (0.01, 5.0, 300.0)


def test_ridge_pipeline_equals_brute_force_and_survives_storage(spark):
    df, pdf = frame(spark, 90)
    model = ridge.fit_ridge(df, "y", 6.35, drop=["id"])
    path = models.save_model(model, scratch_path(spark, "ridge"))
    got = models.load_model(path).transform(df).orderBy("id").toPandas()["prediction"]
    assert got.to_numpy() == pytest.approx(brute_ridge(pdf, pdf, 6.35), rel=1e-8)


def test_ridge_refuses_missing_values(spark):
    df, _ = frame(spark, 30)
    with pytest.raises(ValueError, match="x1"):
        ridge.ridge_search(df.withColumn("x1", F.nullif("x1", "x1")), "y", trials=2, folds=2, keys=["id"], drop=["id"])


def test_parameters(spark):
    values, report = trees.configure(trees.FOREST, {"max_depth": 40, "min_samples_split": 3, "n_estimators": 7, "max_features": 1.0, "n_jobs": -1})
    assert values["max_depth"] == 40 and values["min_samples_split"] == 3 and values["min_samples_leaf"] == 1
    assert report == {"applied": {"max_depth": 40, "min_samples_split": 3, "n_estimators": 7, "max_features": 1.0}, "dropped": ["n_jobs"]}
    assert trees.configure(trees.BOOSTED, {})[0]["n_estimators"] == 1000
    for kind, space in ((trees.FOREST, search.FOREST_SPACE), (trees.BOOSTED, search.BOOSTED_SPACE)):
        assert trees.configure(kind, search.draw(space, 0))[1] == {"applied": search.draw(space, 0), "dropped": []}


def test_draws_stay_in_range_and_repeat():
    for space in (search.FOREST_SPACE, search.BOOSTED_SPACE, search.RIDGE_SPACE):
        for t in range(200):
            values = search.draw(space, t)
            assert values == search.draw(space, t)
            for p in space:
                assert values[p.name] in p.choices if p.kind == "choice" else p.low <= values[p.name] <= p.high


def brute_attribution(tree, x, weight):
    """Shapley values from the definition: conditional expectations over all feature subsets."""
    def value(node, known):
        if tree["leftChild"][node] < 0:
            return float(tree["prediction"][node])
        f, left, right = int(tree["feature"][node]), int(tree["leftChild"][node]), int(tree["rightChild"][node])
        if f in known:
            return value(left if x[f] <= tree["threshold"][node] else right, known)
        a, b = tree["rawCount"][left], tree["rawCount"][right]
        return (a * value(left, known) + b * value(right, known)) / (a + b)

    p, phi = len(x), np.zeros(len(x))
    for i in range(p):
        others = [j for j in range(p) if j != i]
        for size in range(p):
            for s in itertools.combinations(others, size):
                share = math.factorial(size) * math.factorial(p - size - 1) / math.factorial(p)
                phi[i] += share * (value(0, {*s, i}) - value(0, set(s)))
    return weight * phi


@pytest.mark.parametrize("kind", [trees.FOREST, trees.BOOSTED])
def test_tree_attributions_equal_definition_and_add_up(spark, kind):
    df, _ = frame(spark, 300)
    numeric = df.select("id", "x1", "x2", (F.col("c") == "b").cast("double").alias("b"), "y")
    features = ["x1", "x2", "b"]
    params = {"n_estimators": 4, "max_depth": 4, "min_child_samples": 5, "min_samples_leaf": 2, "max_features": 0.9}
    model, _ = trees.fit_trees(numeric, "y", kind, params, features=features)
    path = models.save_model(model, scratch_path(spark, kind))
    nodes, weights = models.stored_trees(spark, models.load_model(path), path)
    scored = model.transform(numeric)
    for chunk in (10, 10**6):
        values, base = attribution.tree_attributions(scored, ["id", "prediction"], features, nodes, weights, chunk_nodes=chunk)
        out = values.collect()
        assert max(abs(base + sum(r["values"]) - r["prediction"]) for r in out) < 1e-9
    rows = {r["id"]: [r["x1"], r["x2"], r["b"]] for r in numeric.collect()}
    for r in out[:10]:
        want = sum(brute_attribution(t, rows[r["id"]], w) for t, w in zip(nodes, weights))
        assert r["values"] == pytest.approx(want.tolist(), abs=1e-9)


def test_attribution_summary(spark):
    df = spark.createDataFrame([(0.4, -0.5)] * 8, "a double, b double")
    long = attribution.long_attributions(df.select(F.array("a", "b").alias("values")), [], ["a", "b"])
    top = attribution.top_attributions(attribution.attribution_summary(long), n_features=2, n_rows=8, displayed=0).collect()
    assert len(top) == 1 and top[0]["feature"] == "b" and top[0]["negative_rate"] == 1.0 and top[0]["max_intensity"] == 0.5


def test_importance_finds_the_signal(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(200), "signal": rng.normal(size=200), "noise": rng.normal(size=200)})
    pdf["y"] = 2 * pdf["signal"] + pdf["noise"] * 0.01
    df = spark.createDataFrame(pdf)
    scores = jobs.importance_scores(df.where("id < 150"), df.where("id >= 150"), "y", repeats=4, keys=["id"], drop=["id"],
                                    params={"n_estimators": 10, "max_depth": 5})
    out = importance.summarize_importance(scores).collect()
    assert [r["feature"] for r in out] == ["signal", "noise"] and out[0]["importance_mean"] > 0.5


def test_permutations_only_move_values(spark):
    df = spark.range(50).select("id", F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("y"))

    def spy(d):
        return d.withColumn("prediction", F.element_at("x", 1))

    scores = importance.permutation_scores(df, "y", ["a"], spy, repeats=6, keys=["id"]).collect()
    # any permutation of y against itself: R2 drop = SSE / SST, never negative, and not zero for a moved value
    assert len(scores) == 6 and all(r["importance"] > 0 for r in scores)


def test_evaluation_job(spark):
    df, _ = frame(spark, 120)
    numeric = df.select("x1", "x2", F.col("y").alias("weight-(kg)"), F.when(F.col("id") < 90, "train").otherwise("test").alias("split"))
    base = scratch_path(spark, "evaluation")
    splits.write_splits(numeric, f"{base}/splits")
    model, _ = trees.fit_trees(numeric.where("split = 'train'").drop("split"), "weight-(kg)", trees.BOOSTED, {"n_estimators": 3})
    models.save_model(model, f"{base}/boosted")
    found = jobs.run_evaluate(spark, f"{base}/splits", {trees.BOOSTED: f"{base}/boosted", "ridge": f"{base}/none"}, base)
    assert set(found) == {trees.BOOSTED} and set(found[trees.BOOSTED]["metrics"]) == set(metrics.METRICS)
    assert {i["feature"] for i in found[trees.BOOSTED]["shap"]["feature_impacts"]} == {"x1", "x2"}
    with pytest.raises(FileNotFoundError):
        jobs.run_evaluate(spark, f"{base}/splits", {}, base, chosen="random_forest")
    with pytest.raises(RuntimeError):
        jobs.run_train(spark, f"{base}/splits", {}, {})


def test_model_names():
    assert jobs.resolve_models("LGBM") == (trees.BOOSTED,) and jobs.resolve_models("random forest") == (trees.FOREST,)
    assert jobs.resolve_models(None) == jobs.resolve_models("what") == (trees.BOOSTED, trees.FOREST)


def test_ridge_queries_search_all_trials(spark, monkeypatch):
    from gridloom.operators import search
    from gridloom.registry import job_queries, model_queries

    class Searched(Exception):
        pass

    def watched(*_, trials=search.TRIALS, **__):
        raise Searched(trials)

    monkeypatch.setattr(model_queries.ridge, "ridge_search", watched)
    monkeypatch.setattr(job_queries.jobs, "run_baseline", watched)
    monkeypatch.setattr(model_queries, "orders_model", lambda *_: None)
    monkeypatch.setattr(job_queries, "_prepared", lambda *_: "base")
    monkeypatch.setattr(job_queries, "_trained", lambda *_: ("base", {"ridge": "ridge"}, {}))
    for run in (model_queries.ridge_search_wide, job_queries.job_baseline, job_queries.job_evaluate):
        with pytest.raises(Searched) as seen:
            run(spark, "folder")
        assert seen.value.args == (50,)
