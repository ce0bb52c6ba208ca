"""Guards against the same entity on both sides of a split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import ref, refs
from gridloom.operators.order import BROADCAST_ROWS
from gridloom.operators.split import SPLIT, TEST, TRAIN

_SAMPLE = 5


class OverlapError(ValueError):
    """Rows or entities appear on both sides of a split."""


def shared_keys(left: DataFrame, right: DataFrame, id_columns: Sequence[str] | None = None) -> list[str]:
    """Columns to compare: the given ids, which must exist on both sides, else all common names, sorted."""
    if id_columns is None:
        return sorted(set(left.columns) & set(right.columns))
    missing = sorted((set(id_columns) - set(left.columns)) | (set(id_columns) - set(right.columns)))
    if missing:
        raise KeyError(f"id columns not found: {', '.join(missing)}")
    return list(id_columns)


def _sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in left.schema.fields}
    a = left.select(*refs(keys), F.lit(1).alias("_side"))
    b = right.select(*[ref(k).cast(types[k]).alias(k) for k in keys], F.lit(2).alias("_side"))
    return a.unionByName(b)


def overlap(left: DataFrame, right: DataFrame, id_columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct key rows present in both frames; missing values match each other.

    One grouped aggregate over the tagged union instead of a join: map-side combining removes copies before the
    shuffle, so repeated rows on either side cost nothing.
    """
    keys = shared_keys(left, right, id_columns)
    both = _sides(left, right, keys).groupBy(*refs(keys)).agg(F.bit_or("_side").alias("_in"))
    return both.where(F.col("_in") == 3).select(*refs(keys))


def assert_disjoint(left: DataFrame, right: DataFrame, *, id_columns: Sequence[str] | None = None) -> None:
    """J1, J2 as a guard: raise when a key row occurs on both sides; nothing shared or an empty side passes.

    First only an 8-byte digest of each row is shuffled. Equal rows have equal digests, so no digest on both sides
    means no overlap. Otherwise the rows behind shared digests are compared in full, which the few that share one by
    chance pass.
    """
    keys = shared_keys(left, right, id_columns)
    if not keys:
        return
    _assert_apart(_sides(left, right, keys), keys)


def _assert_apart(sides: DataFrame, keys: Sequence[str]) -> None:
    digest = F.xxhash64(*refs(keys))
    hashed = sides.select(digest.alias("_h"), "_side").groupBy("_h").agg(F.bit_or("_side").alias("_in"))
    suspects = hashed.where(F.col("_in") == 3).select("_h")
    some = suspects.limit(BROADCAST_ROWS + 1).count()
    if some == 0:
        return
    rows = sides
    if some <= BROADCAST_ROWS:
        rows = rows.withColumn("_h", digest).join(F.broadcast(suspects), ["_h"], "left_semi")
    both = rows.groupBy(*refs(keys)).agg(F.bit_or("_side").alias("_in")).where(F.col("_in") == 3).select(*refs(keys))
    sample = [r.asDict() for r in both.limit(_SAMPLE).collect()]
    if sample:
        raise OverlapError(f"{both.count()} key rows occur in both frames on {keys}; for example {sample}")


def assert_split_disjoint(df: DataFrame, *, split: str = SPLIT, id_columns: Sequence[str] | None = None) -> None:
    """The guard over the train and test rows of one marked frame, which is read once for both sides."""
    plain = df.drop(split)
    keys = shared_keys(plain, plain, id_columns)
    if not keys:
        return
    side = F.when(ref(split) == TRAIN, 1).when(ref(split) == TEST, 2)
    _assert_apart(df.select(*refs(keys), side.alias("_side")).where(F.col("_side").isNotNull()), keys)
