"""Encoders and scalers: fitted on one frame, applied to any."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import quoted, ref, refs, stacked, string_columns, text_literal
from gridloom.operators.clean import MISSING_CATEGORY, apply_codes, category_codes
from gridloom.operators.order import Sizes, dense_codes

MAX_CATEGORIES = 10_000  # one-hot columns of a table; a wider vocabulary is an error here and goes to ``SparseOneHot``
_EPS = 2.220446049250313e-16

ENCODING_SCHEMA = "column string, category string, ordinal int, encoded_value string"


def filled(column: str) -> Column:
    """Category text of a value, missing values being a category of their own."""
    return F.coalesce(ref(column).cast("string"), F.lit(MISSING_CATEGORY))


def category_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, value, n)`` of all columns from one scan, combined before the shuffle."""
    long = stacked(df, list(columns), keep=by, as_type="string")
    long = long.withColumn("value", F.coalesce("value", F.lit(MISSING_CATEGORY)))
    return long.groupBy(*refs(by), "column", "value").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class OneHot:
    """Sorted categories per column; with ``drop_first`` the first one is the all-zero baseline."""

    categories: Mapping[str, tuple[str, ...]]
    drop_first: bool = True

    @staticmethod
    def fit(df: DataFrame, columns: Iterable[str] | None = None, *, drop_first: bool = True,
            max_categories: int = MAX_CATEGORIES) -> OneHot:
        """E1 (fit): the vocabulary of every string column, from one aggregate."""
        names = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
        if not names:
            return OneHot({}, drop_first)
        rows = category_counts(df, names).select("column", "value").limit(max_categories + 1).collect()
        if len(rows) > max_categories:
            raise ValueError(f"more than {max_categories} categories over {names}; leave out identifier columns")
        found: dict[str, list[str]] = {c: [] for c in names}
        for r in rows:
            found[r["column"]].append(r["value"])
        return OneHot({c: tuple(sorted(found[c])) for c in names}, drop_first)

    def encoded(self, column: str) -> list[tuple[str, str]]:
        """``(category, column name)`` of every category that has a column."""
        kept = self.categories[column][1:] if self.drop_first else self.categories[column]
        return [(c, f"{column}_{c}") for c in kept]

    def names(self) -> list[str]:
        return [name for column in self.categories for _, name in self.encoded(column)]

    def apply(self, df: DataFrame) -> DataFrame:
        """E1, E2 (apply), P20: replace each column by 0/1 columns at the end; unseen values give all zeros."""
        present = [c for c in self.categories if c in df.columns]
        kept = [c for c in df.columns if c not in present]
        clash = sorted({n for c in present for _, n in self.encoded(c)} & set(kept))
        if clash:
            raise ValueError(f"encoded names already in use: {', '.join(clash)}")
        ones = [
            (filled(c) == F.lit(category)).cast("double").alias(name)
            for c in present
            for category, name in self.encoded(c)
        ]
        return df.select(*refs(kept), *ones)

    def invert(self, df: DataFrame) -> DataFrame:
        """Each block of 0/1 columns back to one category column, at the end."""
        blocks = {c: self.encoded(c) for c in self.categories}
        used = {name for block in blocks.values() for _, name in block}
        values = []
        for c, block in blocks.items():
            hits = [F.when(ref(name) == 1.0, F.lit(category)) for category, name in block]
            if self.drop_first and self.categories[c]:
                hits.append(F.lit(self.categories[c][0]))
            values.append(F.coalesce(*hits).alias(c) if hits else F.lit(None).cast("string").alias(c))
        return df.select(*[ref(c) for c in df.columns if c not in used], *values)

    def table(self, spark: SparkSession) -> DataFrame:
        """The mapping as rows; the baseline category has no encoded column."""
        rows = []
        for column, categories in self.categories.items():
            named = dict(self.encoded(column))
            rows += [(column, c, i, named.get(c)) for i, c in enumerate(categories)]
        return spark.createDataFrame(rows, ENCODING_SCHEMA)

    def sql(self, column: str) -> list[tuple[str, str]]:
        """``(expression, name)`` of each encoded column as SQL text, for stored pipelines."""
        value = f"coalesce(cast({quoted(column)} AS STRING), {text_literal(MISSING_CATEGORY)})"
        return [(f"CAST({value} = {text_literal(c)} AS DOUBLE)", name) for c, name in self.encoded(column)]


def encode_on_train(train: DataFrame, others: Sequence[DataFrame] = (), *, columns: Iterable[str] | None = None
                    ) -> tuple[list[DataFrame], OneHot]:
    """Fit on ``train`` alone, apply to it and to every other frame."""
    encoder = OneHot.fit(train, columns)
    return [encoder.apply(df) for df in (train, *others)], encoder


def encode_whole(df: DataFrame) -> tuple[DataFrame, OneHot]:
    """Fit and apply on one frame without a baseline, so that the result can be inverted."""
    encoder = OneHot.fit(df, drop_first=False)
    return encoder.apply(df), encoder


@dataclass(frozen=True)
class SparseOneHot:
    """One-hot blocks of any width as lists of the places that hold a one; the code table stays distributed."""

    columns: tuple[str, ...]
    offsets: Mapping[str, int]
    width: int
    codes: DataFrame | None
    sizes: Sizes | None

    @staticmethod
    def fit(df: DataFrame, columns: Iterable[str] | None = None) -> SparseOneHot:
        """E1 beyond ``MAX_CATEGORIES``: sorted categories per column, the first one being the baseline without a place."""
        names = tuple(string_columns(df) if columns is None else [c for c in columns if c in df.columns])
        if not names:
            return SparseOneHot((), {}, 0, None, None)
        codes, sizes = category_codes(df, names)
        counted = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
        offsets, width = {}, 0
        for c in names:
            offsets[c] = width
            width += max(0, counted.get(c, 0) - 1)
        return SparseOneHot(names, offsets, width, codes, sizes)

    def apply(self, df: DataFrame, name: str = "active") -> DataFrame:
        """The columns replaced by ``name``, the ascending places of the ones; unseen values and baselines have none."""
        present = [c for c in self.columns if c in df.columns]
        kept = [c for c in df.columns if c not in present]
        if not present:
            return df.withColumn(name, F.array().cast("array<int>"))
        coded = apply_codes(df, present, self.codes, self.sizes)
        places = [F.when(ref(c) >= 1, ref(c) - 1 + F.lit(self.offsets[c])) for c in present]
        return coded.select(*refs(kept), F.array_compact(F.array(*places)).alias(name))


def fold_vocabularies(df: DataFrame, columns: Sequence[str], *, folds: int, fold: str = "fold") -> DataFrame:
    """M7: ``(fold, column, category, ordinal)``: what an encoder fitted outside each fold would know.

    A category is known to fold ``f`` when it occurs outside ``f``, which one count per category and fold decides.
    """
    counts = category_counts(df, columns, [fold]).select(ref(fold).alias("_in"), "column", "value", "n")
    per_value = counts.groupBy("column", "value").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("_in", "n"))).alias("inside")  # <= folds
    )
    spread = per_value.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(folds)])))
    inside = F.coalesce(F.try_element_at("inside", F.col("fold")), F.lit(0))
    known = spread.where(F.col("total") - inside > 0).select("fold", "column", F.col("value").alias("category"))
    ranked, _ = dense_codes(known, "category", "ordinal", ["fold", "column"])
    return ranked.select("fold", "column", "category", F.col("ordinal").cast("int").alias("ordinal"))


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column is scaled by 1."""

    mean: Mapping[str, float]
    scale: Mapping[str, float]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str]) -> Scaler:
        """E4 (fit): one aggregate over all columns."""
        parts = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(columns):
            x = ref(c).cast("double")
            parts += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        row = df.agg(*parts).first()
        mean = {c: row[f"m{i}"] for i, c in enumerate(columns)}
        scale = {c: scale_of(row[f"v{i}"], row[f"m{i}"], row["_n"]) for i, c in enumerate(columns)}
        return Scaler(mean, scale)

    def apply(self, df: DataFrame) -> DataFrame:
        """E4 (apply)."""
        return df.withColumns(
            {c: (ref(c).cast("double") - F.lit(self.mean[c])) / F.lit(self.scale[c]) for c in self.mean}
        )


def scale_of(variance: float | None, mean: float | None, rows: int) -> float:
    """Deviation to divide by; 1 where the variance is zero up to rounding."""
    if variance is None or variance <= rows * _EPS * variance + (rows * (mean or 0.0) * _EPS) ** 2:
        return 1.0
    return variance**0.5
