"""Profiling jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.columns import string_columns
from gridloom.operators import profile
from gridloom.operators.clean import round_scales
from gridloom.operators.project import drop_listed, varying_columns
from gridloom.sources.tables import read_csv, write_csv


def profile_univariate(df: DataFrame) -> dict[str, DataFrame]:
    """G9 on a frame: the cleaned table, its histograms, extreme outliers, and their listing."""
    kept, _ = drop_listed(df)
    cleaned = round_scales(kept)
    outliers = profile.extreme_outliers(cleaned)
    return {
        "cleaned": cleaned,
        "histograms": profile.histograms(cleaned, varying_columns(cleaned)),
        "outliers": outliers,
        "top_outliers": profile.top_outliers(outliers),
    }


def run_univariate(spark: SparkSession, source: str, cleaned_csv: str) -> dict[str, DataFrame]:
    """From a CSV file; the cleaned table is written once and profiled from there."""
    kept, dropped = drop_listed(read_csv(spark, source))
    rounded = round_scales(kept)
    write_csv(rounded, cleaned_csv)
    reports = profile_univariate(read_csv(spark, cleaned_csv, rounded.schema))
    return {**reports, "dropped": spark.createDataFrame([(dropped, len(kept.columns))], "dropped int, remaining int")}


def profile_bivariate(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """G10 on a frame: correlations, rank correlations with the target, and categorical tables."""
    pairs = profile.correlation_pairs(df)
    categories = profile.categorical_profile(df)
    reports = {
        "correlations": profile.correlation_matrix(df),
        "top_correlations": profile.top_correlations(pairs),
        "spearman": profile.spearman_with_target(df, target),
        "categories": categories,
        "top_categories": profile.top_categorical(categories),
    }
    for c in string_columns(df):
        reports[f"frequencies:{c}"] = profile.frequency_preview(profile.frequency_table(df, c))
    return reports


def run_bivariate(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """From a CSV file."""
    return profile_bivariate(read_csv(spark, source), target)
