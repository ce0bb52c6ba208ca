"""Registration, and the frames several queries start from (with the same frames as SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import ref

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at fixed digits (without a negative zero), so that both engines print the same value."""
    return df.select(*[
        (F.round(ref(c), digits) + F.lit(0.0)).alias(c) if t == "double" else ref(c) for c, t in df.dtypes
    ])


def r(expression: str, name: str, digits: int = 6) -> str:
    """The SQL side of ``rounded``."""
    return f'round({expression}, {digits}) + 0.0 AS "{name}"'


def digest_sql(key: str, seed: object = 123) -> str:
    return f"md5('{seed}|' || {key})"


def position_sql(key: str, seed: object = 123) -> str:
    """1-based position in the seeded shuffle."""
    return f"row_number() OVER (ORDER BY {digest_sql(key, seed)}, {key})"


KEY = ["o_orderkey"]
TARGET = "o_totalprice"

ORDERS_SQL = """orders_model AS (
  SELECT o_orderkey, o_totalprice, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey,
         CAST(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) AS BIGINT) AS day,
         o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def orders_model(spark: SparkSession, folder: str) -> DataFrame:
    """Wide modelling frame, one row per order, with missing values in one text column."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "c_acctbal", F.col("c_nationkey").cast("long").alias("c_nationkey"),
        F.datediff("o_orderdate", F.lit("1992-01-01")).cast("long").alias("day"),
        "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "c_mktsegment",
    )


LEARNABLE_SQL = f"""{ORDERS_SQL}, learnable AS (
  SELECT o_orderkey, c_acctbal, c_nationkey, day, c_mktsegment,
         3 * c_acctbal + 2 * day + CASE WHEN c_mktsegment = 'BUILDING' THEN 900.0 ELSE 0.0 END AS score
  FROM orders_model)"""


def learnable(spark: SparkSession, folder: str) -> DataFrame:
    """The modelling frame with a target that its features explain."""
    extra = F.when(F.col("c_mktsegment") == "BUILDING", 900.0).otherwise(0.0)
    return orders_model(spark, folder).select(
        "o_orderkey", "c_acctbal", "c_nationkey", "day", "c_mktsegment",
        (3 * F.col("c_acctbal") + 2 * F.col("day") + extra).alias("score"),
    )


def split_sql(key: str = "o_orderkey", source: str = "orders_model", fraction: float = 0.2) -> str:
    """CTE ``marked``: the hold-out split; 'test' for the first round(fraction * n) positions."""
    return f"""marked AS (
  SELECT *, CASE WHEN {position_sql(key)} <= round_even({fraction} * count(*) OVER (), 0)
                 THEN 'test' ELSE 'train' END AS split
  FROM {source})"""


def folds_sql(source: str, key: str = "o_orderkey", folds: int = 5, seed: object = 123) -> str:
    """CTE ``folded``: positions cut into blocks, the first n % k of them one row longer."""
    return f"""ranked AS (
  SELECT *, {position_sql(key, seed)} - 1 AS pos, count(*) OVER () AS n_all FROM {source}),
folded AS (
  SELECT * EXCLUDE (pos, n_all), CAST(CASE
    WHEN pos < (n_all % {folds}) * (n_all // {folds} + 1) THEN pos // (n_all // {folds} + 1)
    ELSE (n_all % {folds}) + (pos - (n_all % {folds}) * (n_all // {folds} + 1)) // (n_all // {folds})
    END AS INTEGER) AS fold FROM ranked)"""
