"""Grown trees against plain versions, parameters that act, and the sequential search with its ledger."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import attribution, forests, growing, sampler, search, trees
from gridloom.sources import models
from gridloom.sources.scratch import scratch_path

FEATURES = ["a", "b", "c"]


def rows(n=400, seed=3):
    r = np.random.default_rng(seed)
    x = np.stack([r.integers(0, 30, n).astype(float), r.normal(size=n).round(1), r.integers(0, 2, n).astype(float)], 1)
    y = (x[:, 0] * 2 + 3 * np.sin(x[:, 1]) + x[:, 2] * x[:, 0] + r.normal(size=n)).round(3)
    return x, y


def table(spark, x, y, parts=5):
    return spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, y double").repartition(parts)


def predicted(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])


def shrunk(total, l1):
    return math.copysign(max(abs(total) - l1, 0), total)


def plain_splits(x, r, rows, leaf_rows, l1=0.0, l2=0.0):
    """(gain, feature, cut, left rows, right rows) of the best split by trying all."""
    def worth(s):
        return shrunk(r[s].sum(), l1) ** 2 / (len(s) + l2)

    best = None
    for f in range(x.shape[1]):
        for cut in sorted(set(x[:, f]))[:-1]:
            left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
            if min(len(left), len(right)) >= max(leaf_rows, 1):
                gain = worth(left) + worth(right) - worth(rows)
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, cut, left, right)
    return best


def plain_boost(x, y, n_estimators, learning_rate, num_leaves, max_depth, min_child_samples, reg_alpha, reg_lambda):
    guess = np.full(len(y), y.mean())
    for _ in range(n_estimators):
        r = y - guess
        judged = lambda s: plain_splits(x, r, s, min_child_samples, reg_alpha, reg_lambda)  # noqa: E731, B023
        leaves = [(np.arange(len(y)), 0, judged(np.arange(len(y))))]
        while len(leaves) < num_leaves:
            able = [i for i, (_, depth, s) in enumerate(leaves) if s and (max_depth < 0 or depth < max_depth)]
            if not able:
                break
            _, depth, (*_, left, right) = leaves.pop(max(able, key=lambda i: leaves[i][2][0]))  # noqa: B023
            leaves += [(left, depth + 1, judged(left)), (right, depth + 1, judged(right))]
        for s, _, _ in leaves:
            guess[s] += learning_rate * shrunk(r[s].sum(), reg_alpha) / (len(s) + reg_lambda)
    return guess


@pytest.mark.parametrize("params", [
    {"n_estimators": 1, "learning_rate": 1.0, "num_leaves": 2, "max_depth": -1, "min_child_samples": 5, "reg_alpha": 0.0, "reg_lambda": 0.0},
    {"n_estimators": 3, "learning_rate": 0.3, "num_leaves": 9, "max_depth": 4, "min_child_samples": 7, "reg_alpha": 5.0, "reg_lambda": 3.0},
    {"n_estimators": 5, "learning_rate": 0.2, "num_leaves": 6, "max_depth": -1, "min_child_samples": 40, "reg_alpha": 60.0, "reg_lambda": 0.0},
])
def test_boosted_trees_equal_a_plain_version(spark, monkeypatch, params):
    monkeypatch.setattr(growing, "STORED_EVERY", 2)
    x, y = rows()
    df = table(spark, x, y)
    model, report = trees.fit_trees(df, "y", trees.BOOSTED, params, features=FEATURES)
    assert report["dropped"] == [] and report["applied"] == params
    assert predicted(model, df) == pytest.approx(plain_boost(x, y, **params), abs=1e-9)


def test_each_boosted_parameter_acts(spark):
    x, y = rows(300)
    df = table(spark, x, y)
    base = {"n_estimators": 2, "num_leaves": 5, "min_child_samples": 5, "learning_rate": 0.5}
    fit = lambda more: predicted(trees.fit_trees(df, "y", trees.BOOSTED, base | more, features=FEATURES)[0], df)
    first = fit({})
    assert (fit({}) == first).all()
    for more in ({"n_estimators": 1}, {"learning_rate": 0.1}, {"num_leaves": 3}, {"max_depth": 1}, {"min_child_samples": 120}, {"subsample": 0.5},
                 {"colsample_bytree": 0.4}, {"reg_lambda": 40.0}, {"reg_alpha": 200.0}):
        assert abs(fit(more) - first).max() > 1e-6, more
    assert (fit({"subsample": 0.5, "subsample_freq": 0}) == first).all()


def plain_tree(x, y, rows, split_rows, leaf_rows, depth):
    found = plain_splits(x, y - y.mean(), rows, leaf_rows) if len(rows) >= split_rows and depth > 0 else None
    if not found:
        return [(rows, y[rows].mean())]
    return plain_tree(x, y, found[3], split_rows, leaf_rows, depth - 1) + plain_tree(x, y, found[4], split_rows, leaf_rows, depth - 1)


@pytest.mark.parametrize(("split_rows", "leaf_rows", "depth"), [(2, 1, None), (30, 4, None), (2, 3, 5)])
def test_a_tree_of_all_rows_equals_a_plain_version(spark, split_rows, leaf_rows, depth):
    x, y = rows(250)
    df = table(spark, x, y)
    params = {"n_estimators": 2, "bootstrap": False, "min_samples_split": split_rows, "min_samples_leaf": leaf_rows, "max_depth": depth}
    model, _ = trees.fit_trees(df, "y", trees.FOREST, params, features=FEATURES)
    want = np.empty(len(y))
    for leaf, value in plain_tree(x, y, np.arange(len(y)), split_rows, leaf_rows, depth or 10**6):
        want[leaf] = value
    assert predicted(model, df) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize(("share", "bootstrap"), [(1.0, True), (0.67, False)])
def test_where_a_forest_is_grown_makes_no_difference(spark, share, bootstrap):
    x, y = rows()
    blocks = growing.make_blocks(table(spark, x, y), FEATURES, "y")
    grown = [growing.grow_forest(blocks, trees=2, depth=7, split_rows=6, leaf_rows=2, share=share, bootstrap=bootstrap, seed=5, local_rows=n) for n in (50, 10**6)]
    for one, other in zip(*grown):
        assert (one.feature, one.bin, one.left, one.right, one.rows) == (other.feature, other.bin, other.left, other.right, other.rows)
        assert one.value == pytest.approx(other.value, abs=1e-9)
    assert grown[0][0].feature != grown[0][1].feature


def test_trees_deeper_than_thirty_levels_are_stored(spark):
    n = 40
    x = np.stack([np.arange(n, dtype=float), np.zeros(n), np.zeros(n)], 1)
    y = 2.5 ** np.arange(n)  # the largest value is split off again and again
    df = table(spark, x, y)
    model, report = trees.fit_trees(df, "y", trees.FOREST, {"n_estimators": 1, "bootstrap": False, "max_depth": 34}, features=FEATURES)
    loaded = models.load_model(models.save_model(model, scratch_path(spark, "deep")))
    assert loaded.stages[-1].trees[0].depth == 34 and report["applied"]["max_depth"] == 34
    assert (predicted(loaded, df) == predicted(model, df)).all()


def test_odd_tables(spark):
    x, y = rows(60)
    df = table(spark, x, y)
    for kind in (trees.FOREST, trees.BOOSTED):
        flat = df.withColumn("y", F.lit(2.5))
        model, _ = trees.fit_trees(flat, "y", kind, {"n_estimators": 3}, features=FEATURES)
        assert set(predicted(model, flat)) == {2.5}
        none = df.withColumn("y", F.when(F.col("id") < 30, F.col("y")))  # rows without a target are left out
        some, _ = trees.fit_trees(none, "y", kind, {"n_estimators": 2, "min_child_samples": 4}, features=FEATURES)
        only, _ = trees.fit_trees(none.where("id < 30").repartition(1), "y", kind, {"n_estimators": 2, "min_child_samples": 4}, features=FEATURES)
        assert len(predicted(some, df)) == len(predicted(only, df)) == 60
    for missing in (float("nan"), None):
        with pytest.raises(Exception, match="a feature is missing"):
            trees.fit_trees(df.withColumn("a", F.when(F.col("id") > 3, F.col("a")).otherwise(F.lit(missing))), "y", trees.FOREST, {}, features=FEATURES)
    single = df.where("id = 0")
    model, _ = trees.fit_trees(single, "y", trees.FOREST, {"n_estimators": 2, "bootstrap": False}, features=FEATURES)
    assert predicted(model, single).tolist() == [y[0]]


# Sequential search

SPACE = (search.Param("x", "float", -5.0, 5.0), search.Param("rate", "log", 1e-4, 1.0), search.Param("k", "int", 1, 60), search.Param("kind", "choice", choices=("p", "q", "r")))


def bowl(p):
    v = (p["x"] - 1.7) ** 2 + (math.log10(p["rate"]) + 2.2) ** 2 + ((p["k"] - 41) / 12) ** 2 + {"p": 1.5, "q": 0.0, "r": 3.0}[p["kind"]]
    return [(0, v, 0.0, 0.0, 0.0), (1, v + 0.5, 0.0, 0.0, 0.0)]


def test_sequential_draws_beat_independent_ones(spark):
    best, alone = [], []
    for seed in range(12):
        found = sampler.search(spark, SPACE, bowl, 60, seed=seed)
        assert all(isinstance(t.params["k"], int) and 1 <= t.params["k"] <= 60 and -5 <= t.params["x"] <= 5 and 1e-4 <= t.params["rate"] <= 1 for t in found)
        best.append(min(t.value for t in found))
        alone.append(min(bowl(search.draw(SPACE, i, seed))[0][1] + 0.25 for i in range(60)))
    assert np.mean(best) < 0.6 * np.mean(alone) and sum(b < a for a, b in zip(alone, best)) >= 9


def test_a_search_goes_on_after_it_was_cut_off(spark):
    whole = sampler.search(spark, SPACE, bowl, 16, seed=4)
    ledger, calls = scratch_path(spark, "ledger"), []

    def dies(p):
        calls.append(p)
        if len(calls) == 13:
            raise KeyboardInterrupt
        return bowl(p)

    with pytest.raises(KeyboardInterrupt):
        sampler.search(spark, SPACE, dies, 16, seed=4, ledger=ledger)
    assert len(sampler.finished_trials(spark, ledger)) == 12
    again = sampler.search(spark, SPACE, dies, 16, seed=4, ledger=ledger)
    assert again == whole and len(calls) == 13 + 4
    assert sampler.search(spark, SPACE, dies, 16, seed=4, ledger=ledger) == whole and len(calls) == 17


def test_trials_without_a_value_count_as_the_worst():
    done = [sampler.Trial(i, search.draw(SPACE, i), [(0, math.nan if i % 3 else float(i), 0.0, 0.0, 0.0)]) for i in range(12)]
    assert set(sampler.suggest(SPACE, done, 12)) == {"x", "rate", "k", "kind"}


def test_search_of_trees(spark):
    x, y = rows(160)
    df = table(spark, x, y)
    space = (search.Param("n_estimators", "int", 1, 3), search.Param("num_leaves", "int", 2, 6), search.Param("min_child_samples", "int", 2, 30))
    ledger = scratch_path(spark, "ledger")
    found, metrics = trees.search_trees(df, "y", trees.BOOSTED, trials=2, folds=2, keys=["id"], drop=["id"], space=space, ledger=ledger)
    again, _ = trees.search_trees(df, "y", trees.BOOSTED, trials=2, folds=2, keys=["id"], drop=["id"], space=space, ledger=ledger)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect())) and metrics.count() == 4


@pytest.mark.parametrize("local_rows", [growing.LOCAL_ROWS, 40])
def test_a_large_forest_stays_a_table_and_predicts_the_same(spark, monkeypatch, local_rows):
    x, y = rows(500)
    df = table(spark, x, y)
    monkeypatch.setattr(growing.plant_forest, "__kwdefaults__", growing.plant_forest.__kwdefaults__ | {"local_rows": local_rows})
    monkeypatch.setattr(forests, "SCORED_ROWS", 30)  # subtrees that more rows reach are copied
    params = {"n_estimators": 4, "min_samples_leaf": 2, "max_features": 0.67}
    small, _ = trees.fit_trees(df, "y", trees.FOREST, params, features=FEATURES)
    with monkeypatch.context() as m:
        m.setattr(growing, "grafted_trees", None)  # nothing below the tops comes to the driver
        m.setattr(forests, "grafted_trees", None)
        large, _ = trees.fit_trees(df, "y", trees.FOREST, params, features=FEATURES, model_nodes=10)
        loaded = models.load_model(models.save_model(large, scratch_path(spark, "large")))
        assert isinstance(large.stages[-1], forests.ForestModel) and large.stages[-1].planted.tops[0].feature.count(-1) < 60
        assert predicted(large, df) == pytest.approx(predicted(small, df), abs=1e-9)
        assert (df.count(), ["id", *FEATURES, "y", "features", "prediction"]) == (loaded.transform(df).count(), loaded.transform(df).columns)
        odd = df.union(df.limit(50)).withColumn("a", F.col("a") * 3 - 20)
        assert predicted(loaded, odd.dropDuplicates(["id"])) == pytest.approx(predicted(small, odd.dropDuplicates(["id"])), abs=1e-9)
        assert loaded.transform(odd).count() == 550 and loaded.transform(df.where("false")).count() == 0
    assert loaded.stages[-1].featureImportances.toArray() == pytest.approx(small.stages[-1].featureImportances.toArray(), abs=1e-9)
    assert loaded.stages[-1].totalNumNodes == small.stages[-1].totalNumNodes
    path = models.save_model(small, scratch_path(spark, "small"))
    for (nodes, weights), stage in ((models.stored_trees(spark, loaded, ""), loaded), (models.stored_trees(spark, small, path), small)):
        values, base = attribution.tree_attributions(stage.transform(df), ["id", "prediction"], FEATURES, nodes, weights)
        assert values.selectExpr("max(abs(aggregate(values, CAST(0 AS DOUBLE), (s, v) -> s + v) + %r - prediction)) AS gap" % base).first()["gap"] < 1e-6


def test_small_trees_grow_and_score_together(spark, monkeypatch):
    x, y = rows(60)
    df = table(spark, x, y)
    calls, grow = [], growing._grow_small
    monkeypatch.setattr(growing, "_grow_small", lambda *a: calls.append(len(a[1])) or grow(*a))
    params = {"n_estimators": 40, "min_samples_leaf": 2, "max_features": 0.7}
    alone, _ = trees.fit_trees(df, "y", trees.FOREST, params, features=FEATURES)
    assert calls == [40]  # one pass, not one for every 16 trees
    monkeypatch.setattr(growing, "TOGETHER_ROWS", 0)
    few, _ = trees.fit_trees(df, "y", trees.FOREST, params, features=FEATURES)
    large, _ = trees.fit_trees(df, "y", trees.FOREST, params, features=FEATURES, model_nodes=0)
    assert calls == [40, *[16, 16, 8] * 2] and isinstance(large.stages[-1], forests.ForestModel)
    assert predicted(alone, df).tolist() == predicted(few, df).tolist()
    assert np.allclose(predicted(alone, df), predicted(large, df))


def test_forest_query_searches_all(spark, monkeypatch):
    from gridloom.registry import model_queries

    class Searched(Exception):
        pass

    def watched(space, objective, trials, **_):
        raise Searched(tuple(space), trials)

    made = []
    monkeypatch.setattr(trees.growing, "make_blocks", lambda *a, **k: made.append(a) or growing.Blocks(None, [], 0, 0.0, scratch_path(spark, "none")))
    monkeypatch.setattr(trees.sampler, "search", lambda _, *a, **k: watched(*a, **k))
    monkeypatch.setattr(model_queries, "learnable", lambda *_: spark.range(40).select(F.col("id").alias("o_orderkey"), F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("score")))
    with pytest.raises(Searched) as seen:
        model_queries.forest_search(spark, "folder")
    assert seen.value.args == (search.FOREST_SPACE, 50) and len(made) == 5
