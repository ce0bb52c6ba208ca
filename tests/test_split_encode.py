"""Splits, guards and encoders."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import guards, split
from gridloom.operators.encode import OneHot, Scaler, encode_on_train, encode_whole, fold_vocabularies
from gridloom.plans import jobs
from gridloom.sources import splits


def people(spark, n):
    return spark.range(n).select("id", (F.col("id") * 0.5).alias("weight"), (F.col("id") % 3).cast("string").alias("g"))


def test_hold_out_sizes_and_errors(spark):
    for n, want in ((100, 20), (120, 24), (8, 2), (7, 1), (2, 0)):
        out = split.hold_out(people(spark, n), "weight", keys=["id"]).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in out}.get("test", 0) == want == round(0.2 * n)
    assert split.hold_out(people(spark, 10), "weight", 0.0, keys=["id"]).where("split = 'test'").count() == 0
    assert split.hold_out(people(spark, 10), "weight", 1.0, keys=["id"]).where("split = 'train'").count() == 0
    assert split.hold_out(people(spark, 0), "weight", keys=["id"]).count() == 0
    with pytest.raises(ValueError):
        split.hold_out(people(spark, 5), "absent")
    with pytest.raises(ValueError):
        split.hold_out(people(spark, 5), "weight", -0.1)


def test_splits_repeat_and_ignore_partitioning(spark):
    df = people(spark, 200)
    runs = [split.hold_out(d, "weight", keys=["id"], seed=s) for d, s in
            ((df, 1), (df.repartition(1), 1), (df.repartition(7), 1), (df, 2))]
    found = [sorted(r["id"] for r in x.where("split = 'test'").collect()) for x in runs]
    assert found[0] == found[1] == found[2] != found[3]


def test_shuffle_keeps_rows(spark):
    out = split.shuffled(people(spark, 100), keys=["id"]).orderBy("position").collect()
    assert sorted(r["id"] for r in out) == list(range(100)) != [r["id"] for r in out]


def test_folds_cover_and_balance(spark):
    out = split.assign_folds(people(spark, 23), 5, keys=["id"]).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in out] == [5, 5, 5, 4, 4]
    with pytest.raises(ValueError):
        split.assign_folds(people(spark, 3), 5)


def test_sample(spark):
    df = people(spark, 50)
    assert split.sample_rows(df, 7, keys=["id"]).count() == 7
    assert split.sample_rows(df, 80, keys=["id"]).count() == 50 == split.sample_rows(df, None).count()


def test_allocation_errors(spark):
    with pytest.raises(ValueError):
        split.allocate_in_groups(people(spark, 5), "g", (0, 0))


def test_validation_is_taken_from_train_only_when_absent(spark):
    marked = split.hold_out(people(spark, 100), "weight", keys=["id"])
    full = split.with_validation(marked, "weight", keys=["id"])
    sizes = {r["split"]: r["n_rows"] for r in split.split_sizes(full).collect()}
    assert sizes == {"train": 64, "val": 16, "test": 20}
    assert split.with_validation(full, "weight") is full


def test_guard(spark):
    a = spark.createDataFrame([(1, None, 2.0), (2, "x", 3.0)], "id int, g string, w double")
    b = spark.createDataFrame([(None, 2.0, 1), ("y", 3.0, 9)], "g string, w double, id int")
    with pytest.raises(guards.OverlapError, match="1 key rows"):
        guards.assert_disjoint(a, b)  # the missing value matches
    guards.assert_disjoint(a, b.where("id = 9"))
    guards.assert_disjoint(a, b.limit(0))
    guards.assert_disjoint(a.select("w"), b.select("g"))  # nothing shared
    guards.assert_disjoint(a, b.where("id = 9"), id_columns=["id"])
    with pytest.raises(guards.OverlapError):
        guards.assert_disjoint(a, b, id_columns=["id"])
    with pytest.raises(KeyError, match="nope"):
        guards.assert_disjoint(a, b, id_columns=["nope"])


def test_guard_has_no_join(spark):
    plan = guards.overlap(people(spark, 10), people(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_one_hot_on_train(spark):
    train = spark.createDataFrame([("red", "A", 1.0), ("blue", None, 2.0), (None, "B", 3.0)], "color string, city string, n double")
    val = spark.createDataFrame([("green", "A", 9.0), ("red", "Z", 8.0)], "color string, city string, n double")
    (a, b), encoder = encode_on_train(train, [val])
    assert a.columns == b.columns == ["n", "color_blue", "color_red", "city_B", "city___MISSING__"]
    assert [tuple(r) for r in b.collect()] == [(9.0, 0.0, 0.0, 0.0, 0.0), (8.0, 0.0, 1.0, 0.0, 0.0)]
    assert encoder.categories["color"] == ("__MISSING__", "blue", "red")
    assert encoder.apply(val.drop("city")).columns == ["n", "color_blue", "color_red"]
    with pytest.raises(ValueError, match="categories"):
        OneHot.fit(people(spark, 50).select(F.col("id").cast("string").alias("t")), max_categories=10)


def test_one_hot_inverse(spark):
    df = spark.createDataFrame([("x.1", 1), ("y z", 2), ("x.1", 3)], "c string, i int")
    encoded, encoder = encode_whole(df)
    assert encoded.columns == ["i", "c_x.1", "c_y z"]
    assert sorted(tuple(r) for r in encoder.invert(encoded).collect()) == [(1, "x.1"), (2, "y z"), (3, "x.1")]
    plain = df.select("i")
    assert encode_whole(plain)[0].columns == ["i"] and encode_whole(plain)[1].categories == {}


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 0.1), (3.0, 0.1), (5.0, 0.1)], "a double, b double")
    scaler = Scaler.fit(df, ["a", "b"])
    assert scaler.scale["b"] == 1.0
    assert [r["a"] for r in scaler.apply(df).collect()] == pytest.approx([-1.224744871, 0.0, 1.224744871])


def test_fold_vocabulary(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), ("b", 1), ("c", 0)], "v string, fold int")
    out = fold_vocabularies(df, ["v"], folds=2).orderBy("fold", "ordinal").collect()
    assert [(r["fold"], r["category"]) for r in out] == [(0, "a"), (0, "b"), (1, "a"), (1, "c")]


def test_prepare_raises_on_copies_across_the_split_and_keeps_keys_together(spark):
    df = people(spark, 30).unionByName(people(spark, 30))
    with pytest.raises(guards.OverlapError):
        jobs.prepare_table(df, "weight", fraction=0.25)  # 15 rows: the cut falls inside a pair
    marked = split.hold_out(df, "weight", 0.5, keys=["id"], whole_keys=True)
    guards.assert_split_disjoint(marked)


def test_numeric_frames_have_no_text(spark):
    marked = split.hold_out(people(spark, 60), "weight", keys=["id"])
    train = splits.numeric_train(marked, "weight")
    assert all(t != "string" for _, t in train.dtypes) and "g_1" in train.columns and train.count() == 48
    both = splits.numeric_train_validation(marked, "weight", keys=["id"])
    assert {r["split"] for r in both.select("split").distinct().collect()} == {"train", "val"}


def test_row_local_operators_on_a_stream(spark, tmp_path):
    source = spark.createDataFrame([("r", 0.26, 2.0), ("b", 0.34, 0.0)], ["Kind Of", "BMI_calc", "Physical exercice"])
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    encoder = OneHot({"kind-of": ("b", "r")})
    rows = encoder.apply(jobs.clean_table(stream))
    writer = rows.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "cp")).start()
    writer.processAllAvailable()
    writer.stop()
    assert sorted(tuple(r) for r in spark.table("cleaned").collect()) == [(0.3, 0, 0.0), (0.3, 1, 1.0)]
