"""Test session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def make_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
