"""Reproducible shuffles, hold-out splits, folds, group allocation and samples with exact sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import ref, refs, require_columns
from gridloom.operators.order import (
    BROADCAST_ROWS,
    COPY_CHUNK,
    HOT_ROWS,
    DigestOrder,
    Sizes,
    expand_copies,
    global_rank,
    label_by_position,
    look_up,
)
from gridloom.sources.scratch import written

# Seed, held-out share, folds and split markers.
SEED = 123
TEST_FRACTION = 0.2
FOLDS = 5
TRAIN, VALIDATION, TEST = "train", "val", "test"
SPLIT = "split"


def shuffled(df: DataFrame, *, seed: object = SEED, keys: Sequence[str] | None = None,
             name: str = "position") -> DataFrame:
    """Q1: every row with its position in a seeded shuffle."""
    return global_rank(df, name, seed=seed, keys=keys)


def hold_out(
    df: DataFrame,
    target: str,
    fraction: float = TEST_FRACTION,
    *,
    seed: object = SEED,
    keys: Sequence[str] | None = None,
    name: str = SPLIT,
    held: str = TEST,
    kept: str = TRAIN,
    whole_keys: bool = False,
) -> DataFrame:
    """Q2: mark exactly ``round(fraction * rows)`` rows (half to even) as held out, without looking at the target.

    ``whole_keys`` keeps rows of equal keys on one side, for tables in which an entity has several rows.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("the held-out fraction must lie between 0 and 1")
    if target not in df.columns and not df.isEmpty():
        raise ValueError(f"target column {target!r} not found")
    return label_by_position(df, name, [held, kept], lambda n: [round(fraction * n)], seed=seed, keys=keys,
                             whole_keys=whole_keys)


def with_validation(
    df: DataFrame, target: str, fraction: float = TEST_FRACTION, *, seed: object = SEED,
    keys: Sequence[str] | None = None, name: str = SPLIT,
) -> DataFrame:
    """Q3: the split frame, with validation rows taken from the train rows when it has none."""
    if not df.where(ref(name) == VALIDATION).isEmpty():
        return df
    train = hold_out(df.where(ref(name) == TRAIN).drop(name), target, fraction, seed=seed, keys=keys, name=name,
                     held=VALIDATION)
    return train.unionByName(df.where(~F.coalesce(ref(name) == TRAIN, F.lit(False))))  # a missing marker is no train row


def fold_sizes(rows: int, folds: int) -> list[int]:
    """The first ``rows % folds`` folds hold one row more."""
    return [rows // folds + (1 if i < rows % folds else 0) for i in range(folds)]


def assign_folds(df: DataFrame, folds: int = FOLDS, *, seed: object = SEED, keys: Sequence[str] | None = None,
                 name: str = "fold") -> DataFrame:
    """Q4: add the validation fold of every row; one frame, not ``folds`` copies."""
    if folds < 2:
        raise ValueError("at least two folds are needed")

    def ends(n: int) -> list[int]:
        if n < folds:
            raise ValueError(f"cannot cut {n} rows into {folds} folds")
        sizes = fold_sizes(n, folds)
        return [sum(sizes[: i + 1]) for i in range(folds - 1)]

    return label_by_position(df, name, list(range(folds)), ends, seed=seed, keys=keys)


def sample_rows(df: DataFrame, size: int | None, *, seed: object = SEED, keys: Sequence[str] | None = None) -> DataFrame:
    """Q6: ``size`` rows without replacement; all rows when no size is given or the frame is not larger."""
    if size is None or size <= 0:
        return df
    marked = label_by_position(df, "_in", [True, False], lambda n: [min(size, n)], seed=seed, keys=keys)
    return marked.where("_in").drop("_in")


def first_part_size(rows: Column, first: float, second: float) -> Column:
    """Size of the first of two parts: both ideals floored, a leftover row to the larger fractional part."""
    total = float(first + second)
    if total <= 0:
        raise ValueError("the proportions must sum to more than 0")
    one, two = rows * F.lit(first / total), rows * F.lit(second / total)
    left = rows - F.floor(one) - F.floor(two)
    larger = (one - F.floor(one)) >= (two - F.floor(two))
    size = F.floor(one) + F.when(left >= 2, 1).when((left == 1) & larger, 1).otherwise(0)
    return F.greatest(F.lit(0).cast("long"), F.least(size.cast("long"), rows))


def _group_key(group: str) -> Column:
    """Text form of a group value in which a missing one differs from every other."""
    return F.coalesce(F.concat(F.lit("="), ref(group).cast("string")), F.lit("-"))


def allocate_in_groups(
    df: DataFrame,
    group: str,
    proportions: tuple[float, float],
    *,
    seed: object = SEED,
    keys: Sequence[str] | None = None,
    name: str = "part",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    chunk: int = COPY_CHUNK,
) -> DataFrame:
    """Q5: split every group into parts 0 and 1 by exact proportional sizes, shuffled inside the group.

    Counts per group and digest prefix locate each group's cut; only rows of the prefix that holds it are ordered.
    Rows then compare their digest with their group's cut, so a group with most of the table is no bottleneck.
    """
    order = DigestOrder.of(df, seed, keys)
    tail = order.tail if order.tail is not None else F.lit("")
    rows = df.withColumn("_g", _group_key(group)).withColumn("_head", order.head)
    by_group = Window.partitionBy("_g")
    exclusive = (Window.unboundedPreceding, -1)

    cells = rows.groupBy("_g", F.substring("_head", 1, 4).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    cells = (
        cells.withColumn("_before", F.coalesce(F.sum("_n").over(by_group.orderBy("_cell").rowsBetween(*exclusive)), F.lit(0)))
        .withColumn("_size", F.sum("_n").over(by_group))
        .withColumn("_first", first_part_size(F.col("_size"), *proportions))
    )
    holds = (F.col("_before") < F.col("_first")) & (F.col("_before") + F.col("_n") >= F.col("_first"))
    holds = holds | ((F.col("_first") == 0) & (F.col("_before") == 0))
    edge = cells.where(holds).select("_g", "_cell", "_size", (F.col("_first") - F.col("_before")).alias("_need"))
    edge = written(edge, "edges")  # a row per group; the rows of its cell are all that is ordered
    known = edge.agg(F.count(F.lit(1)).alias("n"), F.max("_size").alias("w")).first()
    edge_sizes = Sizes(known["n"], 1, known["w"] or 0)

    digests = (
        look_up(rows.withColumn("_cell", F.substring("_head", 1, 4)), edge, ["_g", "_cell"], sizes=edge_sizes, weight="_size",
                broadcast_rows=broadcast_rows, hot_rows=hot_rows)
        .withColumn("_tail", tail)
        .groupBy("_g", "_cell", "_head", "_tail", "_need")
        .agg(F.count(F.lit(1)).alias("_m"))
        .withColumn("_seen", F.coalesce(F.sum("_m").over(by_group.orderBy("_head", "_tail").rowsBetween(*exclusive)), F.lit(0)))
    )
    at_cut = (F.col("_seen") < F.col("_need")) & (F.col("_seen") + F.col("_m") >= F.col("_need"))
    at_cut = at_cut | ((F.col("_need") == 0) & (F.col("_seen") == 0))
    cuts = digests.where(at_cut).select(
        "_g", F.col("_head").alias("_cut_head"), F.col("_tail").alias("_cut_tail"), "_m",
        (F.col("_need") - F.col("_seen")).alias("_copies"),
    ).join(edge.select("_g", "_size"), "_g")
    cuts = written(cuts, "cuts")  # one row per group, read several times below
    found = cuts.agg(F.count(F.lit(1)).alias("n"), F.max("_size").alias("w")).first()
    sizes = Sizes(found["n"], 1, found["w"] or 0)
    joined = look_up(rows, cuts, ["_g"], sizes=sizes, weight="_size", broadcast_rows=broadcast_rows,
                     hot_rows=hot_rows)
    at = F.col("_head") == F.col("_cut_head")
    if order.tail is not None:
        below = (F.col("_head") < F.col("_cut_head")) | (at & (tail < F.col("_cut_tail")))
        at = at & (tail == F.col("_cut_tail"))
    else:
        below = F.col("_head") < F.col("_cut_head")
    whole = F.col("_copies") == F.col("_m")
    part = F.when(below | (at & whole), F.lit(0)).otherwise(F.lit(1))
    torn = (F.col("_copies") > 0) & (F.col("_copies") < F.col("_m"))
    labelled = joined.withColumn(name, part)
    if cuts.where(torn).isEmpty():
        return labelled.select(*refs(df.columns), ref(name))
    copies = joined.where(torn & at).groupBy(*refs(df.columns), F.col("_copies")).agg(F.count(F.lit(1)).alias("_n"))
    numbered = expand_copies(copies, "_n", "_i", chunk)
    numbered = numbered.withColumn(name, F.when(F.col("_i") < F.col("_copies"), F.lit(0)).otherwise(F.lit(1)))
    rest = labelled.where(~(torn & at))
    return rest.select(*refs(df.columns), ref(name)).unionByName(numbered.select(*refs(df.columns), ref(name)))


def rank_in_group(
    df: DataFrame, group: str, *, seed: object = SEED, keys: Sequence[str] | None = None, name: str = "position",
    hot_rows: int = HOT_ROWS, chunk: int = COPY_CHUNK,
) -> DataFrame:
    """1-based position of every row inside its group under a seeded shuffle.

    Digest prefixes cut each group into cells with known offsets. Rows of cells that hold more than ``hot_rows`` rows, and
    those only, are counted first, ranked in parts by the row's digest, and written out again.
    """
    require_columns(df, [group])
    order = DigestOrder.of(df, seed, keys)
    tail = order.tail if order.tail is not None else F.lit("")
    keyed = df.withColumn("_g", _group_key(group)).withColumn("_head", order.head)
    keyed = keyed.withColumn("_cell", F.substring("_head", 1, 4))
    cells = keyed.groupBy("_g", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = cells.select("_g", "_cell", (F.col("_n") > hot_rows).alias("_crowded"), F.coalesce(before, F.lit(0)).alias("_start"))
    largest = cells.agg(F.max("_n").alias("m")).first()["m"] or 0
    placed = keyed.join(starts, ["_g", "_cell"])
    number = F.row_number().over(Window.partitionBy("_g", "_cell").orderBy(F.col("_head"), tail)).cast("long")
    plain = placed.where(~F.col("_crowded")).withColumn(name, F.col("_start") + number).select(*refs(df.columns), ref(name))
    if largest <= hot_rows:
        return plain
    # A crowded cell holds copies or rows of one key: copies are counted, and what is left goes to parts by the row's digest.
    counted = (
        placed.where("_crowded").withColumn("_tail", tail)
        .groupBy(*refs(df.columns), "_g", "_cell", "_head", "_tail", "_start").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_part", F.substring("_tail", 1, 4))
    )
    by_part = ["_g", "_cell", "_head", "_part"]
    earlier = (Window.unboundedPreceding, -1)
    parts = counted.groupBy(*by_part).agg(F.sum("_n").alias("_size"))
    passed = F.sum("_size").over(Window.partitionBy("_g", "_cell").orderBy("_head", "_part").rowsBetween(*earlier))
    parts = parts.withColumn("_passed", F.coalesce(passed, F.lit(0))).drop("_size")
    seen = F.sum("_n").over(Window.partitionBy(*by_part).orderBy("_tail").rowsBetween(*earlier))
    first = F.col("_start") + F.col("_passed") + F.coalesce(seen, F.lit(0))
    numbered = counted.join(parts, by_part).withColumn("_first", first)
    rows = expand_copies(numbered.select(*refs(df.columns), "_first", "_n"), "_n", "_i", chunk)
    crowded = rows.withColumn(name, F.col("_first") + F.col("_i") + 1).select(*refs(df.columns), ref(name))
    return plain.unionByName(crowded)


def split_sizes(df: DataFrame, name: str = SPLIT) -> DataFrame:
    """Rows per split marker."""
    return df.groupBy(ref(name).alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))
