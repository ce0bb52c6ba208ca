"""What lets the evaluation job grow with its table: each step reads rows as few times as it can, with the same results."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import attribution, growing, guards, trees
from gridloom.plans import jobs
from gridloom.sources import splits, tables
from gridloom.sources.reports import write_report
from gridloom.sources.scratch import scratch_path


def test_csv_types_beyond_the_first_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "HEAD_ROWS", 2)
    columns = {
        "whole": ["1", " 2 ", "3", None], "late_number": ["1", "2", "2.5", None], "late_text": ["1", "2", "3", "x"], "number": ["1", ".5", "inf", "-2e3"],
        "truth": ["True", "false", None, "TRUE"], "late_truth": [None, None, "true", "False"], "truth_then_text": ["true", "false", "yes", None], "mixed": ["1", "true", None, None],
        "missing": [None, "NA", "null", None], "late_whole": [None, None, "7", "8"], "text": ["a", "1", "2", "3"], "long": ["1", "2", "1234567890123456789", None],
    }
    path = scratch_path(spark, "csv")
    tables.write_csv(spark.createDataFrame([*zip(*columns.values())], ", ".join(f"{c} string" for c in columns)).coalesce(1), path)
    seen = []
    whole = tables._readings
    monkeypatch.setattr(tables, "_readings", lambda text, left: seen.append({c: list(k) for c, k in left.items()}) or whole(text, left))
    assert dict(tables.read_csv(spark, path).dtypes) == {
        "whole": "bigint", "late_number": "double", "late_text": "string", "number": "double", "truth": "boolean", "late_truth": "boolean", "truth_then_text": "string",
        "mixed": "string", "missing": "double", "late_whole": "bigint", "text": "string", "long": "double",
    }
    assert len(seen) == 2 and seen[1]["text"] == ["string"] and seen[1]["number"] == ["double", "string"]  # ruled out by the first rows


def test_split_guard_reads_the_table_once(spark):
    path = scratch_path(spark, "marked")
    rows = [(1, "a", "train"), (2, "b", "test"), (2, "b", "val"), (3, None, "train"), (3, None, None)]
    splits.write_splits(spark.createDataFrame(rows, "id int, c string, split string"), path)
    opened = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def read(i):
        opened.add(1)
        return i

    marked = spark.read.parquet(path).withColumn("id", read.asNondeterministic()("id"))
    guards.assert_split_disjoint(marked)
    assert opened.value <= len(rows)  # twice as many, were each side read on its own
    both = spark.createDataFrame([*rows, (3, None, "test")], "id int, c string, split string")
    with pytest.raises(guards.OverlapError):
        guards.assert_split_disjoint(both)
    guards.assert_split_disjoint(both.where("c is not null or split = 'test'"))
    with pytest.raises(KeyError):
        guards.assert_split_disjoint(both, id_columns=["nope"])


def test_training_bins_the_rows_once(spark, monkeypatch):
    base, made = scratch_path(spark, "training"), []
    df = spark.range(60).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("weight-(kg)"), F.when(F.col("id") < 50, "train").otherwise("test").alias("split"))
    splits.write_splits(df, f"{base}/splits")
    params = {trees.FOREST: {"n_estimators": 2, "max_depth": 2}, trees.BOOSTED: {"n_estimators": 2, "min_child_samples": 4}}
    for kind, chosen in params.items():
        write_report(spark, {"best_params": chosen}, f"{base}/{kind}.json")
    make = growing.make_blocks
    monkeypatch.setattr(growing, "make_blocks", lambda *a, **k: made.append(make(*a, **k)) or made[-1])
    found = jobs.run_train(spark, f"{base}/splits", {k: f"{base}/{k}.json" for k in params}, {k: f"{base}/{k}" for k in params})
    assert len(made) == 1
    train = splits.part(splits.read_splits(spark, f"{base}/splits"), "train")
    for kind, chosen in params.items():
        alone, _ = trees.fit_trees(train, "weight-(kg)", kind, chosen, seed=123, features=["a"])
        score = lambda m: [r["prediction"] for r in m.transform(train).orderBy("a").collect()]
        assert score(found[kind].model) == pytest.approx(score(alone))


def test_leaves_node_by_node(monkeypatch):
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, (4, 500)).astype(np.uint8)
    for nodes in (1, 2, 9, 31):
        root = growing.Node(1, 0)
        leaves = [root]
        for _ in range(nodes - 1):
            node = leaves.pop(int(rng.integers(len(leaves))))
            node.split = growing.Split(1.0, int(rng.integers(4)), int(rng.integers(255)), 1.0, 1.0)
            leaves += growing._children(node)
        tree = growing.flat(root, lambda total, rows: 0.0).arrays()
        small = growing.leaves_of(tree, codes)
        with monkeypatch.context() as m:
            m.setattr(growing, "SMALL_NODES", 0)
            assert small.tolist() == growing.leaves_of(tree, codes).tolist()


def test_contributions_by_feature_and_by_row():
    rng = np.random.default_rng(5)
    paths = [(2.0, np.array([0, 2]), np.array([-np.inf, 0.2]), np.array([0.5, np.inf]), np.array([0.3, 0.6])), (1.0, np.array([], int), *[np.array([])] * 3)]
    x = rng.random((3, 40))
    many = attribution.contributions(x, paths)
    alone = np.concatenate([attribution.contributions(x[:, [i]], paths) for i in range(40)], axis=1)  # too few rows for tables of patterns
    assert np.allclose(many, alone) and not many[1].any()
    inside = (x[0] <= 0.5) & (x[2] > 0.2)
    assert np.allclose(many.sum(axis=0), 2.0 * inside - 2.0 * 0.3 * 0.6)
