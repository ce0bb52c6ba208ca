"""Datasets with a split marker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import ref
from gridloom.operators.clean import NumericCoder, ensure_numeric
from gridloom.operators.encode import OneHot
from gridloom.operators.project import feature_columns
from gridloom.operators.split import SEED, SPLIT, TEST, TRAIN, VALIDATION, with_validation
from gridloom.sources.reports import exists
from gridloom.sources.tables import write_csv

MARKERS = (TRAIN, VALIDATION, TEST)


def mark(train: DataFrame, test: DataFrame) -> DataFrame:
    """Two frames as one, tagged."""
    return train.withColumn(SPLIT, F.lit(TRAIN)).unionByName(test.withColumn(SPLIT, F.lit(TEST)))


def write_splits(df: DataFrame, parquet: str, text: str | None = None) -> None:
    """The marked frame as Parquet partitioned by marker, so that readers of one split scan that split only."""
    df.write.mode("overwrite").partitionBy(SPLIT).parquet(parquet)
    if text is not None:
        write_csv(df.sparkSession.read.parquet(parquet), text)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """The marked frame; a missing dataset or marker column is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no split dataset at {path}")
    df = spark.read.parquet(path)
    if SPLIT not in df.columns:
        raise KeyError(f"no {SPLIT!r} column in {path}")
    return df


def part(df: DataFrame, marker: str) -> DataFrame:
    """The rows of one split without the marker."""
    return df.where(ref(SPLIT) == marker).drop(SPLIT)


def parts(df: DataFrame) -> dict[str, DataFrame]:
    """Train and test, and validation when the frame has any such row."""
    present = {r[SPLIT] for r in df.where(ref(SPLIT).isin(*MARKERS)).select(SPLIT).distinct().collect()}  # three at most
    wanted = [m for m in MARKERS if m != VALIDATION or m in present]
    return {m: part(df, m) for m in wanted}


def unknown_markers(df: DataFrame) -> DataFrame:
    """Rows per marker that is none of the known ones, a missing marker included."""
    known = ref(SPLIT).isin(*MARKERS)
    return df.where(~F.coalesce(known, F.lit(False))).groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n_rows"))


def numeric_train(df: DataFrame, target: str) -> DataFrame:
    """The train part, encoded on itself and numeric; the target must not reappear as a feature."""
    train = part(df, TRAIN)
    encoder = OneHot.fit(train.select(*[ref(c) for c in feature_columns(train, target)]))
    if target in encoder.names():
        raise ValueError(f"target {target!r} reappears among the encoded features")
    return ensure_numeric(encoder.apply(train))


def numeric_train_validation(df: DataFrame, target: str, *, seed: object = SEED, keys: Sequence[str] | None = None
                             ) -> DataFrame:
    """Train and validation rows in one numeric frame with the marker; encoders and type rules see train rows only.

    Validation rows are taken from the train rows when the dataset has none.
    """
    full = with_validation(df, target, seed=seed, keys=keys)
    both = full.where(ref(SPLIT).isin(TRAIN, VALIDATION))
    train = part(both, TRAIN)
    encoder = OneHot.fit(train.select(*[ref(c) for c in feature_columns(train, target)]))
    coder = NumericCoder.fit(encoder.apply(train))
    made = [coder.apply(encoder.apply(part(both, m))).withColumn(SPLIT, F.lit(m)) for m in (TRAIN, VALIDATION)]
    return made[0].unionByName(made[1])
