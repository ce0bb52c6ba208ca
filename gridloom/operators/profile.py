"""Profiles of numeric and categorical columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import numeric_columns, ref, refs, stacked, string_columns
from gridloom.functions.numeric import round_exact, round_scaled, to_number
from gridloom.functions.stats import FLAT, correlation_p_value, pearson
from gridloom.operators.order import BROADCAST_ROWS, HOT_ROWS, SORT_ROWS, look_up, running_total
from gridloom.operators.quantile import DIRECT_ROWS, exact_quantiles

# Fence of extreme outliers, histogram bins, lengths of the listings.
FENCE = 3.0
BINS = 30
LISTED = 15
PREVIEWED = 10
TOTAL = "TOTAL"

NARROW_VALUES = 100_000  # distinct values up to which a feature's ranks are broadcast
GENERATED_PAIRS = 10  # column pairs up to which correlations are generated expressions


# --------------------------------------------------------------------------------------------------------------
# categorical


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A1: rows per present value, ordered by value."""
    return (
        df.where(ref(column).isNotNull())
        .groupBy(ref(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy("value")
    )


def frequency_table(df: DataFrame, column: str, *, sort_rows: int = SORT_ROWS) -> DataFrame:
    """Count, share and running share per category, and a total row.

    Shares are of all rows, missing ones included, at two decimals; the running share adds the rounded shares.
    """
    total = df.count()
    counted = (
        df.where(ref(column).isNotNull())
        .groupBy(ref(column).cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("frequency"))
        # whole hundredths of a percent, so that the running sum is exact
        .withColumn("_share", F.rint(F.col("frequency") / F.lit(total) * 100 * 100).cast("long"))
    )
    running, _ = running_total(counted, "category", "_share", "_before", sort_rows=sort_rows)
    table = running.select(
        "category",
        "frequency",
        (F.col("_share") / 100.0).alias("share_pct"),
        ((F.col("_before") + F.col("_share")) / 100.0).alias("cumulative_pct"),
    )
    closing = counted.agg(
        F.lit(TOTAL).alias("category"),
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("frequency"),
        F.lit(100.0).alias("share_pct"),
        F.lit(100.0).alias("cumulative_pct"),
    )
    return table.unionByName(closing)


def frequency_preview(table: DataFrame, rows: int = PREVIEWED) -> DataFrame:
    """The first categories of a frequency table and its total row."""
    is_total = (F.col("category") == TOTAL) & (F.col("cumulative_pct") == 100.0) & (F.col("share_pct") == 100.0)
    head = table.where(~is_total).orderBy("category").limit(rows)
    return head.unionByName(table.where(is_total).orderBy(F.desc("frequency")).limit(1))


def categorical_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A3: mode (smallest on ties), its count and share of all rows, and distinct values, per string column."""
    names = string_columns(df) if columns is None else columns
    counted = stacked(df, names, key="variable", as_type="string").groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v"))))
    summary = counted.groupBy("variable").agg(
        best.alias("best"), F.sum("n").alias("rows"), F.count("value").alias("n_unique")
    )
    return summary.select(
        "variable",
        F.col("best.v").alias("mode"),
        (-F.col("best.neg")).alias("mode_count"),
        round_scaled(-F.col("best.neg") / F.col("rows") * 100, 2).alias("mode_pct"),
        "n_unique",
    )


def top_categorical(profile: DataFrame, rows: int = LISTED) -> DataFrame:
    """The variables with the most dominant mode."""
    return profile.orderBy(F.col("mode_pct").desc(), "variable").limit(rows)


# --------------------------------------------------------------------------------------------------------------
# numeric


def correlation_pairs(df: DataFrame, columns: list[str] | None = None, *, generated_pairs: int = GENERATED_PAIRS
                      ) -> DataFrame:
    """A5 (input): Pearson correlation of every column pair ``i > j``, over rows where both are present.

    One scan. Few pairs are generated aggregate expressions; many would make that code too large, so matrix
    products of Arrow batches give the pair sums instead.
    """
    names = numeric_columns(df) if columns is None else columns
    numbers = df.select(*[to_number(ref(c), df.schema[c].dataType).alias(c) for c in names])
    pairs = [(i, j) for i in range(len(names)) for j in range(i)]
    schema = "feature_1 string, feature_2 string, correlation double"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    if len(pairs) <= generated_pairs:
        row = numbers.agg(*[pearson(ref(names[i]), ref(names[j])).alias(f"c{i}_{j}") for i, j in pairs])
        entries = [
            F.struct(F.lit(names[i]).alias("feature_1"), F.lit(names[j]).alias("feature_2"),
                     F.col(f"c{i}_{j}").alias("correlation"))
            for i, j in pairs
        ]
        return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return _correlations_by_products(numbers, names)


def _correlations_by_products(numbers: DataFrame, names: list[str]) -> DataFrame:
    row = numbers.agg(*[F.avg(ref(c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    shift = np.array([row[f"m{i}"] or 0.0 for i in range(len(names))])
    size = len(names)

    def pair_sums(batches):
        totals = np.zeros((6, size, size))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            seen = ~np.isnan(x)
            x, seen = np.where(seen, x, 0.0), seen.astype(float)
            squares = x * x
            totals += np.stack([seen.T @ seen, x.T @ seen, seen.T @ x, squares.T @ seen, seen.T @ squares, x.T @ x])
        i, j = np.tril_indices(size, -1)
        n, sx, sy, sxx, syy, sxy = totals[:, i, j]
        yield pd.DataFrame({"i": i, "j": j, "n": n, "sx": sx, "sy": sy, "sxx": sxx, "syy": syy, "sxy": sxy})

    parts = numbers.mapInPandas(
        pair_sums, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    )
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    covariance = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    spread_x = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), F.col("n"))
    spread_y = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), F.col("n"))
    flat = (spread_x <= F.col("sxx") * FLAT) | (spread_y <= F.col("syy") * FLAT)
    value = F.when(~flat, covariance / F.sqrt(spread_x * spread_y))
    label = F.array(*[F.lit(c) for c in names])
    return sums.select(
        F.element_at(label, F.col("i") + 1).alias("feature_1"),
        F.element_at(label, F.col("j") + 1).alias("feature_2"),
        value.alias("correlation"),
    )


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, *, generated_pairs: int = GENERATED_PAIRS
                       ) -> DataFrame:
    """A4: the full matrix in long form; the diagonal is 1, or NULL for a constant column."""
    names = numeric_columns(df) if columns is None else columns
    lower = correlation_pairs(df, names, generated_pairs=generated_pairs)
    both = F.array(F.struct("feature_1", "feature_2"), F.struct(F.col("feature_2").alias("feature_1"),
                                                               F.col("feature_1").alias("feature_2")))
    mirrored = lower.select(F.explode(both).alias("p"), "correlation").select("p.feature_1", "p.feature_2", "correlation")
    if not names:
        return mirrored
    spread = df.agg(*[F.var_pop(to_number(ref(c), df.schema[c].dataType)).alias(f"v{i}") for i, c in enumerate(names)])
    diagonal = spread.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature_1"), F.lit(c).alias("feature_2"),
                 F.when(F.col(f"v{i}") > 0, F.lit(1.0)).alias("correlation"))
        for i, c in enumerate(names)
    ])).alias("e")).select("e.*")
    return mirrored.unionByName(diagonal)


def top_correlations(pairs: DataFrame, rows: int = LISTED) -> DataFrame:
    """The strongest pairs by absolute correlation."""
    present = pairs.where(F.col("correlation").isNotNull())
    return present.orderBy(F.abs("correlation").desc(), "feature_1", "feature_2").limit(rows)


def spearman_with_target(
    df: DataFrame, target: str, columns: list[str] | None = None, *, sort_rows: int = SORT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Spearman correlation of each numeric feature with the target, and its two-sided p-value.

    Ranks are those of counted distinct values. Feature ranks are looked up per row; the target's ranks are only
    needed per distinct target value, after the rank sums have been grouped by it.
    """
    names = [c for c in (numeric_columns(df) if columns is None else columns) if c != target]
    schema = "feature string, n_rows long, rho double, p_value double"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    # features by number, and values first among the keys: sorts then compare one machine word
    entries = [F.struct(F.lit(i).alias("f"), to_number(ref(c), df.schema[c].dataType).alias("x")) for i, c in enumerate(names)]

    def long_of(chosen: list[int]) -> DataFrame:
        return (
            df.select(to_number(ref(target), df.schema[target].dataType).alias("y"), F.array(*[entries[i] for i in chosen]).alias("_f"))
            .where(F.col("y").isNotNull())
            .select("y", F.explode("_f").alias("_e"))
            .select("_e.f", "_e.x", "y")
            .where(F.col("x").isNotNull())
        )

    long = long_of(list(range(len(names))))
    count = F.count(F.lit(1)).alias("n")
    # both counted tables are read several times within this call: kept in memory, then on disk
    x_counts = long.groupBy("x", "f").agg(count).persist()
    x_table, sizes = running_total(x_counts, "x", "n", "before", ["f"], sort_rows=sort_rows)
    x_table = x_table.withColumn("rx", F.col("before") + (F.col("n") + 1) / 2).drop("before")
    narrow, room = [], broadcast_rows if sizes.rows > broadcast_rows else -1  # what look_up broadcasts anyway needs no parting
    for r in sorted(x_counts.groupBy("f").agg(F.count(F.lit(1)).alias("m")).collect(), key=lambda r: (r["m"], r["f"])) if room > 0 else []:
        if r["m"] <= min(NARROW_VALUES, room):
            narrow.append(r["f"])
            room -= r["m"]
    wide = [i for i in range(len(names)) if i not in set(narrow)]
    if narrow:  # features of few values are ranked where their rows are; only the others are shuffled
        few = F.broadcast(x_table.where(F.col("f").isin(narrow)).drop("n"))  # at most broadcast_rows
        ranked = long_of(narrow).join(few, ["x", "f"])
        if wide:
            rest = x_table.where(F.col("f").isin(wide))
            ranked = ranked.unionByName(look_up(long_of(wide), rest, ["x", "f"], sizes=sizes, weight="n", broadcast_rows=broadcast_rows, hot_rows=hot_rows))
    else:
        ranked = look_up(long, x_table, ["x", "f"], sizes=sizes, weight="n", broadcast_rows=broadcast_rows, hot_rows=hot_rows)
    by_y = ranked.groupBy("y", "f").agg(count, F.sum("rx").alias("srx")).persist()
    try:
        y_table, _ = running_total(by_y, "y", "n", "before", ["f"], sort_rows=sort_rows)
        ry = F.col("before") + (F.col("n") + 1) / 2
        y_sums = y_table.groupBy("f").agg(
            F.sum("n").alias("rows"), F.sum(ry * F.col("srx")).alias("sxy"), F.sum(F.col("n") * ry * ry).alias("syy")
        )
        x_sums = x_table.groupBy("f").agg(F.sum(F.col("n") * F.col("rx") * F.col("rx")).alias("sxx"))
        half = (F.col("rows").cast("double") + 1) / 2  # the mean rank
        level = F.col("rows") * half * half
        rho = F.try_divide(F.col("sxy") - level, F.sqrt((F.col("sxx") - level) * (F.col("syy") - level)))
        found = y_sums.join(x_sums, "f").select("f", F.col("rows").alias("n_rows"), rho.alias("rho")).collect()
    finally:
        by_y.unpersist()
        x_counts.unpersist()
    rows = [(names[r["f"]], r["n_rows"], r["rho"], correlation_p_value(r["rho"], r["n_rows"])) for r in found]
    result = df.sparkSession.createDataFrame(rows, schema)  # one row per feature
    return result.orderBy(F.abs("rho").desc_nulls_last(), "feature")


def extreme_outliers(df: DataFrame, columns: list[str] | None = None, *, fence: float = FENCE,
                     direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Per numeric column with values outside ``Q1 - fence*IQR .. Q3 + fence*IQR``: count, share and range.

    All columns share each of the passes; a constant column is skipped.
    """
    schema = ("column string, n_outliers long, pct double, min_outlier double, max_outlier double, "
              "lower_bound double, upper_bound double")
    names = numeric_columns(df) if columns is None else columns
    numbers = df.select(*[to_number(ref(c), df.schema[c].dataType).alias(c) for c in names])
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    row = numbers.agg(*[e for i, c in enumerate(names) for e in (
        F.count(ref(c)).alias(f"n{i}"), F.var_samp(ref(c)).alias(f"v{i}"))]).first()
    kept = {c: row[f"n{i}"] for i, c in enumerate(names) if row[f"n{i}"] and row[f"v{i}"] != 0}
    quartiles = exact_quantiles(numbers, list(kept), [0.25, 0.75], counts=kept, direct_rows=direct_rows) if kept else {}
    parts, entries = [], []
    for i, (c, (q1, q3)) in enumerate(quartiles.items()):
        low, high = q1 - fence * (q3 - q1), q3 + fence * (q3 - q1)
        out = F.when((ref(c) < low) | (ref(c) > high), ref(c))
        parts += [F.count(out).alias(f"n{i}"), F.min(out).alias(f"a{i}"), F.max(out).alias(f"b{i}")]
        entries.append(F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("n_outliers"),
            round_exact(F.col(f"n{i}") / F.lit(kept[c]) * 100, 2).alias("pct"),
            F.col(f"a{i}").alias("min_outlier"),
            F.col(f"b{i}").alias("max_outlier"),
            round_scaled(F.lit(low), 2).alias("lower_bound"),
            round_scaled(F.lit(high), 2).alias("upper_bound"),
        ))
    if not entries:
        return df.sparkSession.createDataFrame([], schema)
    report = numbers.agg(*parts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return report.where(F.col("n_outliers") > 0)


def top_outliers(report: DataFrame, rows: int = LISTED) -> DataFrame:
    """The columns with most extreme outliers."""
    return report.orderBy(F.col("n_outliers").desc(), "column").limit(rows)


def histograms(df: DataFrame, columns: list[str] | None = None, *, bins: int = BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed, per non-constant numeric column."""
    schema = "column string, bin int, lower_edge double, upper_edge double, n_rows long"
    names = numeric_columns(df) if columns is None else columns
    numbers = df.select(*[to_number(ref(c), df.schema[c].dataType).alias(c) for c in names])
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    row = numbers.agg(*[e for i, c in enumerate(names) for e in (
        F.min(ref(c)).alias(f"a{i}"), F.max(ref(c)).alias(f"b{i}"))]).first()
    ends = {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(names)}
    ends = {c: (lo, hi) for c, (lo, hi) in ends.items() if lo is not None and lo < hi}
    if not ends:
        return df.sparkSession.createDataFrame([], schema)

    def edge(k: int, lo: float, hi: float) -> float:
        return hi if k == bins else lo + k * ((hi - lo) / bins)

    guesses, entries = {}, []
    for i, (c, (lo, hi)) in enumerate(ends.items()):
        x, step, guess = ref(c), (hi - lo) / bins, F.col(f"_g{i}")
        guesses[f"_g{i}"] = F.least(((x - F.lit(lo)) / F.lit(hi - lo) * bins).cast("int"), F.lit(bins - 1))
        # the quotient may round across an edge: compare with the edges themselves
        settled = (
            F.when(x < F.lit(lo) + guess * F.lit(step), guess - 1)
            .when((guess != bins - 1) & (x >= F.lit(lo) + (guess + 1) * F.lit(step)), guess + 1)
            .otherwise(guess)
        )
        entries.append(settled + F.lit(i * bins))  # column and bin in one number
    # the guesses are columns of their own: each is used several times
    slots = numbers.withColumns(guesses).select(*[e.alias(f"_s{i}") for i, e in enumerate(entries)])
    binned = slots.select(F.explode(F.array(*refs(slots.columns))).alias("slot")).where(F.col("slot").isNotNull())
    counted = binned.groupBy("slot").agg(F.count(F.lit(1)).alias("n_rows"))
    frame = [
        (i * bins + k, c, k, edge(k, lo, hi), edge(k + 1, lo, hi))
        for i, (c, (lo, hi)) in enumerate(ends.items())
        for k in range(bins)
    ]
    every = df.sparkSession.createDataFrame(frame, "slot int, column string, bin int, lower_edge double, upper_edge double")
    merged = every.join(counted, "slot", "left")  # bins times columns on either side
    return merged.select("column", "bin", "lower_edge", "upper_edge", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
