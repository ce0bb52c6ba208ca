"""Encoder mappings, importance tables and JSON reports."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.encode import OneHot
from gridloom.sources.tables import write_csv

IMPORTANCE_COLUMNS = ("feature", "importance_mean", "importance_std")


def mapping_rows(encoding: DataFrame) -> DataFrame:
    """``(column, original_value, encoded_value)``; the baseline category has no encoded value."""
    return encoding.select("column", F.col("category").alias("original_value"), "encoded_value")


def mapping_documents(encoding: DataFrame) -> DataFrame:
    """One JSON document per column: its categories, mapping, feature names and kind.

    A column's vocabulary is bounded by what the encoder accepts, so one row holds it.
    """
    entry = F.array_sort(F.collect_list(F.struct("ordinal", "category", "encoded_value")))
    grouped = encoding.groupBy("column").agg(entry.alias("e"))
    named = F.filter("e", lambda x: x["encoded_value"].isNotNull())
    return grouped.select(
        "column",
        F.to_json(F.struct(
            F.transform("e", lambda x: x["category"]).alias("categories"),
            F.map_from_entries(F.transform(named, lambda x: F.struct(x["category"], x["encoded_value"]))).alias("mapping"),
            F.transform(named, lambda x: x["encoded_value"]).alias("feature_names"),
            F.lit("one-hot").alias("type"),
        )).alias("document"),
    )


def write_mapping(spark: SparkSession, encoder: OneHot, json_path: str, csv_path: str) -> None:
    """Both forms; an encoder without columns gives ``{}`` and a header-only CSV."""
    table = encoder.table(spark)
    documents = {r["column"]: json.loads(r["document"]) for r in mapping_documents(table).collect()}
    write_text(spark, json_path, json.dumps({c: documents[c] for c in encoder.categories}, ensure_ascii=False, indent=2))
    write_csv(mapping_rows(table).coalesce(1), csv_path)


def write_importance(summary: DataFrame, path: str) -> None:
    """The importance table as a JSON list, most important first."""
    missing = sorted(set(IMPORTANCE_COLUMNS) - set(summary.columns))
    if missing:
        raise ValueError(f"importance columns not found: {', '.join(missing)}")
    ordered = summary.select(*IMPORTANCE_COLUMNS).orderBy(F.col("importance_mean").desc(), "feature")
    records = [r.asDict() for r in ordered.collect()]  # one per feature
    write_text(summary.sparkSession, path, json.dumps(records, ensure_ascii=False, indent=2))


def write_report(spark: SparkSession, report: Mapping[str, Any], path: str) -> str:
    """A non-empty report as indented JSON."""
    if not report:
        raise ValueError("an empty report is not written")
    return write_text(spark, path, json.dumps(report, ensure_ascii=False, indent=2))


def read_report(spark: SparkSession, path: str) -> dict[str, Any]:
    rows = spark.read.text(path, wholetext=True).collect()  # one report file
    return json.loads(rows[0]["value"])


def read_best_params(spark: SparkSession, path: str) -> dict[str, Any]:
    """The ``best_params`` object of a search report."""
    best = read_report(spark, path).get("best_params")
    if not isinstance(best, dict):
        raise KeyError(f"no 'best_params' object in {path}")
    return best


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """One small text file through the cluster's file system; missing parents are created."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return path


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file over another within one file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(path), hadoop.Path(to)
    system = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(new, False)
    if not system.rename(old, new):
        raise OSError(f"{path} could not be renamed")


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()
