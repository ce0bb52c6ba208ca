"""Names, cleaning, rounding, coercion, sources and sinks."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions.numeric import round_exact
from gridloom.operators import clean, project
from gridloom.operators.encode import OneHot
from gridloom.operators.order import Sizes
from gridloom.sources import models, reports, splits, tables
from gridloom.sources.scratch import scratch_path


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["  Physical Exercice ", "Meals__per day", "Water   Intake_Liters"])
    assert project.normalize_names(df).columns == ["physical-exercise", "meals-per-day", "water-intake-liters"]
    with pytest.raises(ValueError, match="collide"):
        project.normalize_names(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_binarize(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (2.0,), (-5.0,), (float("nan"),), (None,)], "`physical-exercise` double")
    assert [r[0] for r in clean.binarize(df).collect()] == [0, 1, 1, 0, 0, 0]
    text = spark.createDataFrame([("3",), (" 0.5 ",), ("12d",), ("x",), ("1e-3",)], "`physical-exercise` string")
    assert [r[0] for r in clean.binarize(text).collect()] == [1, 1, 0, 0, 1]
    with pytest.raises(KeyError):
        clean.binarize(df.toDF("other"))


def test_rounding_is_correct_decimal_rounding(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(-50, 50), rng.randint(0, 5)) for _ in range(3000)] + [2.675, 0.15, 0.25, -0.05, 1e300, 0.5, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for d in (0, 1, 2):
        assert all(r["r"] == round(r["x"], d) for r in df.withColumn("r", round_exact(F.col("x"), d)).collect())


def test_round_columns_keeps_missing_and_ignores_absent(spark):
    df = spark.createDataFrame([(1.26, "2.25", 9.99), (None, "bad", 1.0)], "a double, b string, c double")
    out = clean.round_columns(df, ["a", "b", "absent"]).collect()
    assert [tuple(r) for r in out] == [(1.3, 2.2, 9.99), (None, None, 1.0)]


def test_ensure_numeric_by_type(spark):
    day = datetime.datetime(2024, 1, 1, 0, 0, 0, 5)
    rows = [(1, 1.5, True, "1", "b", "x", day, datetime.timedelta(seconds=1.5)),
            (2, None, None, "z", None, "1", None, None), (3, 2.5, False, "3", "a", "y", day, datetime.timedelta(0))]
    df = spark.createDataFrame(rows, "i int, f double, b boolean, half string, cat string, few string, ts timestamp, d interval day to second")
    out = clean.ensure_numeric(df).orderBy("i").collect()
    assert [r["b"] for r in out] == [1, None, 0]
    assert [r["half"] for r in out] == [1.0, None, 3.0]
    assert [r["cat"] for r in out] == [2, 0, 1]  # "__MISSING__" < "a" < "b"
    assert [r["few"] for r in out] == [None, 1.0, None]  # one of three parses: max(1, 3 // 2)
    assert out[0]["ts"] == 1704067200000005000 and out[1]["ts"] is None
    assert [r["d"] for r in out] == [1500000000, None, 0]


def test_category_codes_by_join_equal_codes_by_map(spark):
    df = spark.range(500).select("id", F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("c"))
    codes, sizes = clean.category_codes(df, ["c"], sort_rows=5)
    a = clean.apply_codes(df, ["c"], codes, sizes)
    b = clean.apply_codes(df, ["c"], codes, Sizes(20_000, 41, 300), broadcast_rows=10, hot_rows=100)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    test = spark.createDataFrame([(1, "new"), (2, "hot")], "id long, c string")
    assert [r["c"] for r in clean.apply_codes(test, ["c"], codes, sizes).orderBy("id").collect()] == [-1, 40]
    by_shuffle = clean.apply_codes(test, ["c"], codes, Sizes(20_000, 41, 300), broadcast_rows=10, hot_rows=100)
    assert [r["c"] for r in by_shuffle.orderBy("id").collect()] == [-1, 40]


def test_rules_fitted_on_train_hold_for_other_rows(spark):
    train = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "t string, n string")
    test = spark.createDataFrame([("c", "x"), ("b", "7"), ("new", None)], "t string, n string")
    coder = clean.NumericCoder.fit(train)
    assert [tuple(r) for r in coder.apply(test).collect()] == [(2, None), (1, 7.0), (-1, None)]


def test_target_roles(spark):
    df = spark.createDataFrame([(1.0, 2)], ["Weight (kg)", "x"])
    assert project.infer_target(df.columns) == "Weight (kg)"
    assert project.feature_columns(df, "Weight (kg)") == ["x"]
    with pytest.raises(ValueError):
        project.feature_columns(df, "y")
    with pytest.raises(ValueError):
        project.infer_target(["a"])


def test_csv_types_and_missing_tokens(spark):
    path = scratch_path(spark, "csv")
    rows = [("1", "NA", "True", "a,b", "x"), ("2", "1.5e2", "False", 'say "hi"', "null"), ("NA", "-3", "True", "c", "")]
    tables.write_csv(spark.createDataFrame(rows, ["i", "f", "t", "s", "n"]).coalesce(1), path)
    df = tables.read_csv(spark, path)
    assert dict(df.dtypes) == {"i": "bigint", "f": "double", "t": "boolean", "s": "string", "n": "string"}
    assert sorted(tuple(r) for r in df.select("f", "s").na.fill(-1.0).collect()) == [(-3.0, "c"), (-1.0, "a,b"), (150.0, 'say "hi"')]
    assert df.where("i is null").count() == 1 and df.where("n is null").count() == 2


def test_split_dataset(spark):
    path = scratch_path(spark, "splits")
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "val"), (4, "odd")], "id int, split string")
    splits.write_splits(df, path, path + ".csv")
    read = splits.read_splits(spark, path)
    parts = splits.parts(read)
    assert {m: [r["id"] for r in p.collect()] for m, p in parts.items()} == {"train": [1], "val": [3], "test": [2]}
    assert [tuple(r) for r in splits.unknown_markers(read).collect()] == [("odd", 1)]
    assert set(splits.parts(df.where("split != 'val'"))) == {"train", "test"}
    plan = splits.part(read, "train")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(FileNotFoundError):
        splits.read_splits(spark, path + "-none")
    plain = scratch_path(spark, "plain")
    df.drop("split").write.parquet(plain)
    with pytest.raises(KeyError):
        splits.read_splits(spark, plain)


def test_reports(spark):
    path = scratch_path(spark, "r") + ".json"
    reports.write_report(spark, {"best_params": {"a": 1, "é": True}}, path)
    assert reports.read_best_params(spark, path) == {"a": 1, "é": True}
    with pytest.raises(ValueError):
        reports.write_report(spark, {}, path)
    reports.write_report(spark, {"best_params": 3}, path)
    with pytest.raises(KeyError):
        reports.read_best_params(spark, path)
    with pytest.raises(ValueError, match="importance_std"):
        reports.write_importance(spark.createDataFrame([("a", 1.0)], ["feature", "importance_mean"]), path)
    with pytest.raises(TypeError):
        models.save_model("no model", path)


def test_empty_mapping(spark):
    path = scratch_path(spark, "m")
    reports.write_mapping(spark, OneHot({}), path + ".json", path + ".csv")
    assert reports.read_report(spark, path + ".json") == {}
    assert spark.read.option("header", True).csv(path + ".csv").columns == ["column", "original_value", "encoded_value"]


def test_mapping_pairs_each_category_with_its_own_column(spark):
    path = scratch_path(spark, "m")
    encoder = OneHot.fit(spark.createDataFrame([("b",), ("a",), (None,)], "g string"))
    reports.write_mapping(spark, encoder, path + ".json", path + ".csv")
    assert reports.read_report(spark, path + ".json")["g"]["mapping"] == {"a": "g_a", "b": "g_b"}


def test_missing_forms_are_one(spark):
    out = project.clean_missing(spark.createDataFrame([(float("nan"),), (1.0,)], "x double")).collect()
    assert out[0]["x"] is None and not math.isnan(out[1]["x"])
