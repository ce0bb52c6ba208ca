"""Per-row attributions of predictions to features, and their summary."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import ref, refs

# Features listed in a report.
DISPLAYED = 20

CHUNK_NODES = 2_000_000  # tree nodes whose paths are shipped to the workers at a time


def tree_nodes(spark: SparkSession, path: str, model: Any) -> tuple[list[dict[str, np.ndarray]], np.ndarray]:
    """Nodes of a stored forest or boosted model, one set of arrays per tree, and the tree weights.

    A tree model lives on the driver as an object already; its node table is of the same size.
    """
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
    ).toPandas()
    trees = []
    for _, part in nodes.sort_values(["treeID", "id"]).groupby("treeID"):
        trees.append({c: part[c].to_numpy() for c in
                      ("prediction", "rawCount", "leftChild", "rightChild", "feature", "threshold")})
    weights = np.asarray(model.treeWeights, dtype=float)
    if "Forest" in type(model).__name__:
        weights = weights / weights.sum()
    return trees, weights


def leaf_paths(tree: Mapping[str, np.ndarray], weight: float) -> list[tuple]:
    """``(value, features, lower, upper, share)`` per leaf: the interval of each feature that leads to the leaf, and
    the share of training rows that satisfies the feature's splits where they are met."""
    paths = []
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, seen = stack.pop()
        left, right = int(tree["leftChild"][node]), int(tree["rightChild"][node])
        if left < 0:
            names = sorted(seen)
            bounds = np.array([seen[f] for f in names]).reshape(-1, 3)
            paths.append((weight * float(tree["prediction"][node]), np.array(names, dtype=int), bounds[:, 0],
                          bounds[:, 1], bounds[:, 2]))
            continue
        f, cut = int(tree["feature"][node]), float(tree["threshold"][node])
        low, high, share = seen.get(f, (-np.inf, np.inf, 1.0))
        cover = float(tree["rawCount"][node])
        stack.append((left, {**seen, f: (low, min(high, cut), share * float(tree["rawCount"][left]) / cover)}))
        stack.append((right, {**seen, f: (max(low, cut), high, share * float(tree["rawCount"][right]) / cover)}))
    return paths


def expected_value(paths: Sequence[tuple]) -> float:
    """Mean prediction over the training rows of the trees."""
    return float(sum(value * np.prod(share) for value, _, _, _, share in paths))


@cache
def _quadrature(points: int) -> tuple[np.ndarray, np.ndarray]:
    nodes, mass = np.polynomial.legendre.leggauss(points)
    return (nodes + 1) / 2, mass / 2


def _weights(met: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of the product game of one leaf, for rows that meet (1) or miss (0) each feature's interval.

    The value of feature i is ``(met_i - share_i)`` times the integral over u in [0, 1] of the product over the other
    features of ``met_j u + share_j (1 - u)`` (multilinear extension of the game). The integrand is a polynomial of
    degree d - 1, so Gauss-Legendre quadrature with ceil(d / 2) nodes is exact.
    """
    u, mass = _quadrature((met.shape[1] + 1) // 2)
    factors = met[:, :, None] * u + share[None, :, None] * (1 - u)
    products = factors.prod(axis=1, keepdims=True)
    return (met - share) * ((products / factors) @ mass)


def contributions(columns: np.ndarray, paths: Sequence[tuple]) -> np.ndarray:
    """Features x rows matrix of contributions of all leaves, from features x rows values."""
    total = np.zeros(columns.shape)
    rows = columns.shape[1]
    for value, features, low, high, share in paths:
        size = len(features)
        if size == 0:
            continue
        met = [(columns[f] > a) & (columns[f] <= b) for f, a, b in zip(features, low, high)]
        if 2**size <= rows:
            patterns = ((np.arange(2**size)[:, None] >> np.arange(size)) & 1).astype(float)
            table = value * _weights(patterns, share).T
            place = np.zeros(rows, np.int64)
            for i, m in enumerate(met):
                place += m.astype(np.int64) << i
            for f, own in zip(features, table):
                total[f] += own[place]
        else:
            for f, own in zip(features, value * _weights(np.stack(met, axis=1).astype(float), share).T):
                total[f] += own
    return total


def tree_attributions(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], trees: Sequence[Mapping[str, np.ndarray]],
    weights: np.ndarray, *, chunk_nodes: int = CHUNK_NODES,
) -> tuple[DataFrame, float]:
    """``(keys..., values)`` with one contribution per feature, and the base value.

    Path-dependent Shapley values; they sum to the prediction minus the base value. Rows stream through Arrow
    batches. The leaf paths go out in chunks of bounded size, each adding to the values, so model size is no limit.
    """
    context = df.sparkSession.sparkContext
    listed = F.array(*[ref(c).cast("double") for c in features]).cast("array<double>")  # one column reaches Arrow faster than many
    rows = df.select(*refs(keys), listed.alias("_x"), F.array_repeat(F.lit(0.0), len(features)).alias("values"))
    schema, first, n = rows.schema, len(keys), len(features)

    def adding(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            paths = shared.value
            for batch in batches:
                if batch.num_rows:
                    x, before = (batch.column(first + i).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for i in range(2))  # NaN for null
                    values = (before + contributions(np.ascontiguousarray(x.T), paths).T).ravel()
                    ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n)
                    made = pa.ListArray.from_arrays(ends, pa.array(values))
                    batch = pa.RecordBatch.from_arrays([*batch.columns[: first + 1], made], names=batch.schema.names)
                yield batch
        return run

    base, chunks, size = 0.0, [[]], 0
    for tree, w in zip(trees, weights):
        paths = leaf_paths(tree, float(w))  # once, here: tasks get the paths
        base += expected_value(paths)
        if chunks[-1] and size + len(tree["prediction"]) > chunk_nodes:
            chunks.append([])
            size = 0
        chunks[-1].extend(paths)
        size += len(tree["prediction"])
    chunks = [c for c in chunks if c]
    for chunk in chunks:
        rows = rows.mapInArrow(adding(context.broadcast(chunk)), schema)  # at most chunk_nodes nodes
    return rows.select(*refs(keys), "values"), base


def linear_attributions(df: DataFrame, keys: Sequence[str], coefficients: Mapping[str, float],
                        means: Mapping[str, float]) -> DataFrame:
    """M11 for a linear model: coefficient times distance from the mean."""
    parts = [F.lit(float(b)) * (ref(c).cast("double") - F.lit(float(means[c]))) for c, b in coefficients.items()]
    return df.select(*refs(keys), F.array(*parts).alias("values"))


def long_attributions(values: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``(keys..., feature, value)``."""
    label = F.array(*[F.lit(c) for c in features])
    return values.select(*refs(keys), F.posexplode("values").alias("_i", "value")).select(
        *refs(keys), F.element_at(label, F.col("_i") + 1).alias("feature"), "value"
    )


def attribution_summary(long: DataFrame) -> DataFrame:
    """Per feature the share of positive and negative values, extremes, and the largest magnitude."""
    v = F.col("value")
    return long.groupBy("feature").agg(
        F.max(v).alias("max_positive"),
        F.min(v).alias("max_negative"),
        F.avg(F.when(v > 0, 1.0).otherwise(0.0)).alias("positive_rate"),
        F.avg(F.when(v < 0, 1.0).otherwise(0.0)).alias("negative_rate"),
        F.greatest(F.abs(F.max(v)), F.abs(F.min(v))).alias("max_intensity"),
    )


def top_attributions(summary: DataFrame, *, n_features: int, n_rows: int, displayed: int = DISPLAYED) -> DataFrame:
    """T5: the features of largest magnitude; never more than features, rows or the wish (which is at least 1)."""
    k = min(n_features, n_rows, max(1, displayed))
    return summary.orderBy(F.col("max_intensity").desc(), "feature").limit(k)
