"""Exact order under skew, copies and any partitioning, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import order, profile, quantile, split
from gridloom.operators.order import expand_copies, global_rank, label_by_position, running_total


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def skewed(spark, n=6000, hot=2500):
    """A third of the rows share one key; half of those are full copies."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i < hot, 0).otherwise(i).alias("k"), F.when(i < hot // 2, 0).otherwise(i).alias("p")
    )


@pytest.mark.parametrize("keys", [None, ["k"]])
@pytest.mark.parametrize("cuts", [[1200], [2000, 2001, 4000], [0, 6000]])
def test_labels_have_exact_sizes_and_keep_rows(spark, keys, cuts):
    df = skewed(spark)
    labels = list(range(len(cuts) + 1))
    out = label_by_position(df, "part", labels, lambda n: cuts, seed=9, keys=keys, chunk=300).collect()
    bounds = [0, *cuts, 6000]
    assert Counter(r["part"] for r in out) == Counter({i: bounds[i + 1] - bounds[i] for i in labels if bounds[i + 1] > bounds[i]})
    assert Counter((r["k"], r["p"]) for r in out) == Counter((r["k"], r["p"]) for r in df.collect())


def test_every_cut_inside_a_group_of_copies(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"))
    out = split.assign_folds(df, 4).groupBy("fold").count().collect()
    assert sorted((r["fold"], r["count"]) for r in out) == [(0, 250), (1, 250), (2, 250), (3, 250)]


@pytest.mark.parametrize("keys", [None, ["k"]])
@pytest.mark.parametrize("hot_rows", [500, 10**9])
def test_rank_is_a_permutation_in_digest_order(spark, keys, hot_rows):
    df = skewed(spark)
    out = global_rank(df, "r", seed=9, keys=keys, bucket_rows=200, hot_rows=hot_rows, chunk=300).orderBy("r").collect()
    assert [r["r"] for r in out] == list(range(1, 6001))
    assert Counter((r["k"], r["p"]) for r in out) == Counter((r["k"], r["p"]) for r in df.collect())
    if keys:
        digests = [md5(f"9|{r['k']}") for r in out]
        assert digests == sorted(digests)


@pytest.mark.parametrize("rows", [
    [(i // 20, i) for i in range(40_000)],  # 2,000 keys of 20 rows
    [(0, i) for i in range(4000)],  # one key
    [(0, 0)] * 4000,  # copies only
    [(i % 20, i % 40) for i in range(8000)],
])
def test_rank_with_many_hot_digests(spark, rows):
    df = spark.createDataFrame(rows, "k long, p long").repartition(8)
    for keys in (["k"], None):
        out = global_rank(df, "r", seed=9, keys=keys, bucket_rows=200, hot_rows=10, chunk=300).orderBy("r").collect()
        assert [r["r"] for r in out] == list(range(1, len(rows) + 1))
        assert Counter((r["k"], r["p"]) for r in out) == Counter(rows)
        if keys:
            digests = [md5(f"9|{r['k']}") for r in out]
            assert digests == sorted(digests)


def test_expanded_copies_are_spread(spark):
    counted = spark.range(20_000).withColumn("n", F.lit(1).cast("long"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in expand_copies(counted, "n", "i").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 5000


@pytest.mark.parametrize("rows", [[(i % 2, 0, i) for i in range(4000)], [(0, 0, 0)] * 3000 + [(0, i, i) for i in range(500)]])
def test_rank_in_group_with_a_repeated_key(spark, rows):
    df = spark.createDataFrame(rows, "g long, k long, p long").repartition(5)
    out = split.rank_in_group(df, "g", seed=4, keys=["k"], hot_rows=50, chunk=200).collect()
    assert Counter((r["g"], r["k"], r["p"]) for r in out) == Counter(rows)
    for g in {r[0] for r in rows}:
        mine = sorted((r["position"], md5(f"4|{r['k']}")) for r in out if r["g"] == g)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1)) and [d for _, d in mine] == sorted(d for _, d in mine)


def test_rank_does_not_depend_on_partitions_or_hot_handling(spark):
    df = skewed(spark)
    variants = [
        global_rank(df.repartition(n, "p"), "r", seed=3, keys=["k"], bucket_rows=b, hot_rows=h)
        for n, b, h in ((1, 10**6, 10**9), (7, 100, 10**9), (3, 100, 400))
    ]
    results = [sorted(tuple(r) for r in v.collect()) for v in variants]
    assert results[0] == results[1] == results[2]


def test_expand_copies(spark):
    df = spark.createDataFrame([("a", 5), ("b", 1), ("c", 23)], "v string, n long")
    out = expand_copies(df, "n", "i", chunk=4).collect()
    assert sorted((r["v"], r["i"]) for r in out) == [(v, i) for v, n in (("a", 5), ("b", 1), ("c", 23)) for i in range(n)]


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("value_type", ["double", "string"])
def test_running_total_by_range_buckets(spark, groups, value_type):
    df = spark.range(3000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 100003).cast(value_type).alias("v"), (F.col("id") % 11).alias("n"))
    direct, sizes = running_total(df, "v", "n", "t", groups)
    bucketed, _ = running_total(df, "v", "n", "t", groups, sort_rows=5)
    assert (sizes.rows, sizes.heaviest) == (3000, 10)
    assert sorted(tuple(r) for r in direct.collect()) == sorted(tuple(r) for r in bucketed.collect())


def test_average_rank_paths_agree_with_brute_force(spark):
    rng = random.Random(4)
    values = [rng.choice([0.0, 0.0, 0.0, rng.random() * 5, None]) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    present = sorted(v for v in values if v is not None)
    want = {v: present.index(v) + (present.count(v) + 1) / 2 for v in set(present)}
    for options in ({}, {"sort_rows": 5, "broadcast_rows": 0, "hot_rows": 100}):
        out = order.average_rank(df, "v", "r", **options).collect()
        assert len(out) == len(present)
        assert all(r["r"] == want[r["v"]] for r in out)


def test_quantiles_by_brackets_equal_percentile(spark):
    rng = random.Random(5)
    rows = [(rng.gauss(0, 1), 7.0 if rng.random() < 0.5 else rng.random(), None if i % 3 else float(i), 4.0) for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    names, points = ["a", "b", "c", "d"], [0.0, 0.25, 0.5, 0.9, 1.0]
    direct = quantile.exact_quantiles(df, names, points)
    other = quantile.exact_quantiles(df, names, points, direct_rows=0, sort_rows=3)
    for c in names:
        assert direct[c] == pytest.approx(other[c], rel=1e-14)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert quantile.exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}


def test_group_allocation_under_skew_and_copies(spark):
    i = F.col("id")
    df = spark.range(3001).select(
        F.when(i < 1800, "big").when(i < 2999, (i % 7).cast("string")).alias("g"), F.when(i < 900, 0).otherwise(i).alias("p"))
    sizes = Counter(r["g"] for r in df.collect())
    for options in ({}, {"broadcast_rows": 0, "hot_rows": 500}):
        for keys in (None, ["p"]):
            out = split.allocate_in_groups(df, "g", (3, 1), keys=keys, chunk=100, **options).collect()
            assert Counter((r["g"], r["p"]) for r in out) == Counter((r["g"], r["p"]) for r in df.collect())
            first = Counter(r["g"] for r in out if r["part"] == 0)
            for g, m in sizes.items():
                low = int(m * 0.75)
                assert first[g] == low + (1 if m - low - int(m * 0.25) and m * 0.75 - low >= m * 0.25 - int(m * 0.25) else 0)


def test_rank_in_group_paths_agree(spark):
    df = skewed(spark, 3000, 1500).withColumn("g", F.col("k") % 2)
    a = split.rank_in_group(df, "g", keys=["k"]).collect()
    b = split.rank_in_group(df, "g", keys=["k"], hot_rows=200, chunk=100).collect()
    assert sorted(tuple(r) for r in a) == sorted(tuple(r) for r in b)
    for g in (0, 1):
        positions = sorted(r["position"] for r in a if r["g"] == g)
        assert positions == list(range(1, len(positions) + 1))


def test_rows_are_stored_in_shuffled_order(spark):
    import pyarrow.parquet as pq

    from gridloom.operators import split
    from gridloom.sources import tables
    from gridloom.sources.scratch import scratch_path

    df = split.shuffled(spark.range(5000).withColumnRenamed("id", "k"), keys=["k"])
    want = [r["k"] for r in df.orderBy("position").collect()]
    path = scratch_path(spark, "ordered")
    tables.write_in_order(df, path, "position", files=6)
    from pathlib import Path

    files = sorted(Path(path).glob("part-*.parquet"))
    assert [v for f in files for v in pq.read_table(f)["k"].to_pylist()] == want and len(files) == 6
    spans = [pq.ParquetFile(f).metadata.row_group(0).column(1).statistics for f in files]
    assert all(a.max + 1 == b.min for a, b in zip(spans, spans[1:])) and (spans[0].min, spans[-1].max) == (1, 5000)
    ranges = tables.position_ranges(spark, path, "position").orderBy("first").collect()
    assert sum(r["n"] for r in ranges) == 5000 and [r["file"] for r in ranges] == [f.name for f in files]


def test_values_inside_brackets_are_counted_without_generated_comparisons(spark, monkeypatch):
    r = np.random.default_rng(5)
    x, y = r.normal(size=3000).round(2) - 0.0, r.integers(0, 9, 3000).astype(float)
    x[:40], y[40:90] = np.nan, -0.0
    df = spark.createDataFrame([(None if np.isnan(a) else float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(4)
    for p in [F.col("x") ** 3 + F.col("y")]:
        df = df.withColumn("p", p)
    monkeypatch.setattr(F, "explode", None)  # each bracket was a generated expression once
    got = quantile.exact_quantiles(df, ["x", "y", "p"], [0.1, 0.25, 0.75], direct_rows=10)
    for c, values in (("x", x), ("y", y), ("p", x**3 + y)):
        assert got[c] == pytest.approx(list(np.nanquantile(values, [0.1, 0.25, 0.75])), abs=1e-9)


def test_features_of_few_values_are_ranked_without_a_shuffle(spark, monkeypatch):
    r = np.random.default_rng(6)
    frame = pd.DataFrame({"y": r.normal(size=900).round(1), "few": r.integers(0, 5, 900).astype(float), "some": r.integers(0, 30, 900).astype(float), "many": r.normal(size=900)})
    frame.loc[::7, "few"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in frame.to_numpy()], "y double, few double, some double, many double").repartition(4)
    shuffled, plain = [], profile.look_up
    monkeypatch.setattr(profile, "look_up", lambda rows, *a, **b: shuffled.extend(x["f"] for x in rows.select("f").distinct().collect()) or plain(rows, *a, **b))
    for limit, wide in ((20, [1, 2]), (100, [2]), (10, [1, 2])):
        shuffled.clear()
        got = {x["feature"]: x["rho"] for x in profile.spearman_with_target(df, "y", broadcast_rows=limit, hot_rows=50).collect()}
        assert sorted(shuffled) == wide
        assert got == pytest.approx({c: frame[[c, "y"]].dropna().corr("spearman").iloc[0, 1] for c in ("few", "some", "many")}, abs=1e-9)
