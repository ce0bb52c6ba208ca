"""Permutation importance of features."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import ref
from gridloom.functions.numeric import ratio_or
from gridloom.operators.order import global_rank
from gridloom.operators.search import unit_draw
from gridloom.operators.split import SEED
from gridloom.sources.scratch import written

# Repeats of the function and of the job.
FUNCTION_REPEATS = 50
JOB_REPEATS = 10


def model_score(model: Any) -> Callable[[DataFrame], DataFrame]:
    """Scorer of a Spark regression model for frames with a feature array ``x``."""
    return lambda df: model.transform(df.withColumn(model.getFeaturesCol(), array_to_vector("x")))


#: Rounds of a permutation, the modulus of its round function (a prime), and walks after which one that has not ended is an error.
ROUNDS, MODULUS, WALKS = 4, 2**31 - 1, 64


def round_keys(seed: object, repeat: int, feature: str) -> list[int]:
    """Two numbers for each round of the permutation of one feature in one repeat."""
    return [int(unit_draw(f"{seed}|{repeat}|{feature}|{i}") * MODULUS) for i in range(2 * ROUNDS)]


def with_permuted(df: DataFrame, at: str, keys: str, n: int, name: str) -> DataFrame:
    """Adds the place of each position ``at`` in a permutation of ``0 .. n - 1`` drawn by the row's ``keys``.

    A position is a pair of a row and a column of the smallest near-square grid that holds n. In rounds, one of the two moves by
    a number made of the other, which can be undone, so no two positions meet. One that ends outside goes on from there until it is
    inside, which takes as many walks as the grid has spare places at most.
    """
    rows = math.isqrt(max(n - 1, 0)) + 1
    columns = max(1, -(-n // rows))
    k = lambda i: F.element_at(keys, i + 1)
    left, right = (lambda x: x % rows), (lambda x: F.call_function("div", x, F.lit(rows).cast("long")))

    def moved(v: Column, other: Column, i: int | Column, size: int) -> Column:
        drawn = ((other + k(2 * i)) % MODULUS) * ((other + k(2 * i + 1)) % MODULUS) % MODULUS * 48271 % MODULUS
        return (v + drawn) % size

    def again(x: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            return F.when(i % 2 == 0, F.struct(moved(s.l, s.r, i, rows).alias("l"), s.r.alias("r"))).otherwise(F.struct(s.l.alias("l"), moved(s.r, s.l, i, columns).alias("r")))

        rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        return F.aggregate(rounds, F.struct(left(x).alias("l"), right(x).alias("r")), step, lambda s: s.l + s.r * rows)

    out = df.withColumn("_left", left(F.col(at))).withColumn("_right", right(F.col(at)))
    for i in range(0, ROUNDS, 2):
        out = out.withColumn("_left", moved(F.col("_left"), F.col("_right"), i, rows)).withColumn("_right", moved(F.col("_right"), F.col("_left"), i + 1, columns))
    walks = F.sequence(F.lit(1), F.lit(min(WALKS, rows * columns - n + 1)))
    first = F.col("_left") + F.col("_right") * rows
    last = F.aggregate(walks, F.col(name), lambda x, _: F.when(x < n, x).otherwise(again(x)))
    out = out.withColumn(name, first).withColumn(name, F.when(F.col(name) < n, F.col(name)).otherwise(last)).drop("_left", "_right")
    landed = F.when(F.col(name) < n, F.col(name)).otherwise(F.raise_error(F.lit("a permutation did not end")).cast("long"))
    return out.withColumn(name, F.coalesce(landed, F.lit(-1)))  # never null, so no join adds a filter that repeats all of this


def permutation_scores(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    *,
    repeats: int = FUNCTION_REPEATS,
    seed: object = SEED,
    keys: Sequence[str] | None = None,
    unused: Sequence[str] = (),
) -> DataFrame:
    """``(feature, repeat, importance)``: the drop in R2 when one feature's values are permuted.

    Rows are put in a seeded random order once, and kept as a table. Each feature has a permutation of its own in each repeat: a
    bijection of positions, computed row by row, that says which row a value goes to. So all values of all
    repeats travel in one join on the unique position, without a sort each. The variants of a row are
    built, scored and summed without another shuffle of rows. Features in ``unused`` are known not to enter the
    model and score 0.
    """
    spark = df.sparkSession
    vector = F.array(*[ref(c).cast("double") for c in features])
    kept = list(dict.fromkeys([*(keys or []), *features, target]))
    ranked = global_rank(df.select(*[ref(c) for c in kept]), "_pos", seed=seed, keys=keys)
    ranked = ranked.select((F.col("_pos") - 1).alias("_pos"), vector.alias("x"), ref(target).cast("double").alias("y"))
    ranked = written(ranked, "ranked")
    whole = score(ranked.select("x", "y")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("y") - F.col("prediction")) * (F.col("y") - F.col("prediction"))).alias("sse"),
        (F.var_pop("y") * F.count("y")).alias("sst"),
    ).first()
    n, sst = whole["n"], whole["sst"]
    tested = [i for i, c in enumerate(features) if c not in set(unused)]
    schema = "feature string, repeat int, importance double"
    if not n:
        return spark.createDataFrame([], schema)

    draws = json.dumps([{"repeat": r, "f": i, "keys": round_keys(seed, r, features[i])} for r in range(repeats) for i in tested])
    every = F.explode(F.from_json(F.lit(draws), "array<struct<repeat:int,f:int,keys:array<bigint>>>")).alias("to")
    sent = ranked.select("_pos", "x", every).select("_pos", F.col("to.repeat").alias("repeat"), F.col("to.f").alias("f"), F.element_at("x", F.col("to.f") + 1).alias("v"), F.col("to.keys").alias("_keys"))
    sent = with_permuted(sent, "_pos", "_keys", n, "_to").select("_to", "repeat", "f", "v")
    variants = sent.join(ranked.select(F.col("_pos").alias("_to"), "x", "y"), "_to") if tested and repeats else None
    label = F.array(*[F.lit(c) for c in features])
    base = 1.0 if whole["sse"] == 0 else 0.0
    r2 = base if not sst else 1.0 - whole["sse"] / sst
    parts = []
    if variants is not None:
        swapped = F.transform("x", lambda v, i: F.when(i == F.col("f"), F.col("v")).otherwise(v))
        scored = score(variants.select("repeat", "f", "y", swapped.alias("x")))
        miss = F.col("y") - F.col("prediction")
        grouped = scored.groupBy("f", "repeat").agg(F.sum(miss * miss).alias("sse"))
        left = F.lit(1.0) - ratio_or(F.col("sse"), F.lit(float(sst or 0.0)), 0.0, 1.0)
        parts.append(grouped.select(
            F.element_at(label, F.col("f") + 1).alias("feature"), "repeat", (F.lit(r2) - left).alias("importance")
        ))
    idle = [(c, r, 0.0) for c in features if c in set(unused) for r in range(repeats)]
    if idle:
        parts.append(spark.createDataFrame(idle, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def summarize_importance(scores: DataFrame) -> DataFrame:
    """Mean and population deviation over the repeats, most important first."""
    return scores.groupBy("feature").agg(
        F.avg("importance").alias("importance_mean"), F.stddev_pop("importance").alias("importance_std")
    ).orderBy(F.col("importance_mean").desc(), "feature")


def top_importance(summary: DataFrame, rows: int | None = None) -> DataFrame:
    """The most important features, least important first."""
    kept = summary if rows is None else summary.orderBy(F.col("importance_mean").desc(), "feature").limit(rows)
    return kept.orderBy("importance_mean", "feature")
