"""Sources, sinks and column operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.numeric import round_exact
from gridloom.operators import clean, profile, project
from gridloom.operators.split import hold_out
from gridloom.registry.inputs import KEY, ORDERS_SQL, TARGET, orders_model, query, r, rounded, split_sql, table
from gridloom.sources import splits, tables
from gridloom.sources.scratch import scratch_path


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_name END AS c_name,
                 CAST(CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey END AS BIGINT) AS c_nationkey,
                 CASE WHEN c_nationkey = 7 THEN NULL ELSE c_acctbal END AS c_acctbal, c_acctbal > 0 AS positive
          FROM customer""")
def csv_scan(spark, folder):
    """Missing tokens inside text and number columns, types inferred."""
    n = F.col("c_nationkey")
    df = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(n % 5 == 0, "NA").otherwise(F.col("c_name")).alias("c_name"),
        F.when(n == 3, "n/a").otherwise(n.cast("string")).alias("c_nationkey"),
        F.when(n == 7, "NaN").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_acctbal") > 0, "True").otherwise("False").alias("positive"),
    )
    path = scratch_path(spark, "csv-scan")
    tables.write_csv(df, path)
    return tables.read_csv(spark, path)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def parquet_scan(spark, folder):
    """S2."""
    return tables.read_parquet(spark, f"{folder}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("""SELECT form, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
          FROM orders, (VALUES ('csv'), ('parquet')) AS t(form)""")
def table_roundtrip(spark, folder):
    """S3: both forms of the written table, read back."""
    df = table(spark, folder, "orders")
    parquet, text = tables.write_table(df, scratch_path(spark, "table"), "orders")
    a = tables.read_parquet(spark, parquet).withColumn("form", F.lit("parquet"))
    b = tables.read_csv(spark, text, df.schema).withColumn("form", F.lit("csv"))
    return a.unionByName(b)


@query("SELECT p_partkey, p_size, round_even(p_retailprice * 100, 0) / 100 AS rating FROM part")
def cleaned_csv(spark, folder):
    """The rounded table as CSV."""
    df = table(spark, folder, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("rating"))
    path = scratch_path(spark, "cleaned")
    rounded_df = clean.round_scales(df)
    tables.write_csv(rounded_df, path)
    return tables.read_csv(spark, path, rounded_df.schema)


@query(f"""WITH {ORDERS_SQL}, {split_sql()}
           SELECT split, o_orderkey, o_totalprice, c_acctbal, c_nationkey, day, o_orderstatus, o_orderpriority,
                  c_mktsegment FROM marked""")
def split_roundtrip(spark, folder):
    """Split, write, and read the parts again."""
    path = scratch_path(spark, "splits")
    splits.write_splits(hold_out(orders_model(spark, folder), TARGET, keys=KEY), path)
    parts = splits.parts(splits.read_splits(spark, path))
    return splits.mark(parts["train"], parts["test"])


@query("""SELECT 'train' AS split, CAST(count(*) AS BIGINT) AS n_rows FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT 'test', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def split_source_sizes(spark, folder):
    """Rows per known marker; other markers (here 'P') belong to no part."""
    marker = F.when(F.col("o_orderstatus") == "O", "train").when(F.col("o_orderstatus") == "F", "test")
    df = table(spark, folder, "orders").select("o_orderkey", F.coalesce(marker, F.lit("other")).alias("split"))
    parts = splits.parts(df)
    return splits.mark(parts["train"], parts["test"]).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT o_orderstatus AS split, CAST(count(*) AS BIGINT) AS n_rows FROM orders GROUP BY 1")
def unknown_markers(spark, folder):
    """Markers no loader would pick up, with their row counts."""
    return splits.unknown_markers(table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("split")))


@query("""SELECT o_orderkey AS "order-key", o_custkey AS "cust-key", o_totalprice AS "total-price-(usd)",
                 o_orderstatus AS "physical-exercise" FROM orders""")
def normalize_columns(spark, folder):
    """P1, P2."""
    df = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("  Order__Key "), F.col("o_custkey").alias("Cust _ KEY_"),
        F.col("o_totalprice").alias("Total   Price_(USD)"), F.col("o_orderstatus").alias("Physical Exercice"),
    )
    return project.normalize_names(df)


@query("""SELECT event_id, CAST(CASE WHEN event_id % 7 = 0 THEN 0 WHEN event_id % 5 = 0 THEN 0
                 WHEN value > 30 THEN 1 ELSE 0 END AS INTEGER) AS "physical-exercise" FROM events""")
def binarize(spark, folder):
    """Text that does not parse, missing and negative values count as 0."""
    i = F.col("event_id")
    shifted = (F.col("value") - 30).cast("string")
    text = F.when(i % 7 == 0, "twice a week").when(i % 5 == 0, F.lit(None)).otherwise(shifted)
    df = table(spark, folder, "events").select("event_id", text.alias("physical-exercise"))
    return clean.binarize(df)


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                 CAST(format('{:.1f}', l_extendedprice * l_discount) AS DOUBLE) AS "bmi-calc",
                 CAST(format('{:.1f}', l_tax * l_quantity / 7) AS DOUBLE) AS "cal-balance", l_discount AS untouched
          FROM lineitem""")
def round_columns(spark, folder):
    """Absent names are ignored, others stay as they are."""
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_extendedprice") * F.col("l_discount")).alias("bmi-calc"),
        (F.col("l_tax") * F.col("l_quantity") / 7).alias("cal-balance"), F.col("l_discount").alias("untouched"),
    )
    return clean.round_columns(df, clean.ONE_DECIMAL_COLUMNS, 1)


@query("""SELECT event_id, CAST(floor(value) AS INTEGER) AS "Age",
                 CAST(round_even(CASE WHEN user_id % 9 = 0 THEN NULL ELSE value * 1.5 END, 0) AS INTEGER) AS "Max_BPM",
                 round_even(value / 7 * 100, 0) / 100 AS rating, value AS other FROM events""")
def round_scales(spark, folder):
    """P5."""
    v = F.col("value")
    df = table(spark, folder, "events").select(
        "event_id", v.alias("Age"), F.when(F.col("user_id") % 9 != 0, v * 1.5).alias("Max_BPM"),
        (v / 7).alias("rating"), v.alias("other"),
    )
    return clean.round_scales(df)


@query("""SELECT CAST(3 AS INTEGER) AS n_dropped, p_partkey, p_size AS kept FROM part""")
def drop_listed(spark, folder):
    """P6."""
    df = table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").alias("kept"), F.col("p_retailprice").alias("BMI"), F.col("p_name").alias("Workout"),
        F.col("p_brand").alias("Height (m)"),
    )
    kept, dropped = project.drop_listed(df)
    return kept.withColumn("n_dropped", F.lit(dropped))


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, c_acctbal, c_nationkey, day, o_orderstatus, o_orderpriority, c_mktsegment
           FROM orders_model""")
def features_only(spark, folder):
    """P7."""
    df = orders_model(spark, folder)
    return df.select(*project.feature_columns(df, TARGET))


@query("""SELECT p_partkey,
                 TRY_CAST(CASE WHEN p_partkey % 3 = 0 THEN 'none' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS size_text,
                 CAST(dense_rank() OVER (ORDER BY coalesce(nullif(p_type, 'PROMO'), '__MISSING__')) - 1 AS INTEGER) AS p_type,
                 CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
                 CAST(p_size > 25 AS INTEGER) AS large, 1704067200000000000 + CAST(p_size AS BIGINT) * 1000000000 AS made,
                 p_retailprice FROM part""")
def ensure_numeric(spark, folder):
    """Numbers in text, categories with a missing value, truth values, times."""
    df = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 3 == 0, "none").otherwise(F.col("p_size").cast("string")).alias("size_text"),
        F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "p_brand", (F.col("p_size") > 25).alias("large"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("p_size")).alias("made"), "p_retailprice",
    )
    return clean.ensure_numeric(df)


@query("""WITH fitted AS (SELECT DISTINCT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM part WHERE p_type <> 'PROMO'),
          names AS (SELECT DISTINCT p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part WHERE p_type <> 'PROMO')
          SELECT p_partkey, way, CAST(coalesce(f.code, -1) AS INTEGER) AS p_type, CAST(coalesce(n.code, -1) AS INTEGER) AS p_name
          FROM part LEFT JOIN fitted f USING (p_type) LEFT JOIN names n USING (p_name), (VALUES ('broadcast'), ('shuffle')) w(way)""")
def codes_on_unseen(spark, folder):
    """Codes fitted without one type, applied to all rows by both ways of joining."""
    df = table(spark, folder, "part").select("p_partkey", "p_type", "p_name")
    coder = clean.NumericCoder.fit(df.where("p_type <> 'PROMO'"))
    ways = [("broadcast", {}), ("shuffle", {"broadcast_rows": 0, "hot_rows": 20})]
    made = [coder.apply(df, **sizes).withColumn("way", F.lit(way)) for way, sizes in ways]
    return made[0].unionByName(made[1])


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_numeric(spark, folder):
    """P10."""
    return project.select_numeric(table(spark, folder, "lineitem"))


@query("SELECT event_id, user_id, value FROM events")
def varying_columns(spark, folder):
    """Constant and all-missing columns go."""
    df = table(spark, folder, "events")
    return project.select_varying(df.withColumns({"same": F.lit(4.5), "empty": F.lit(None).cast("double")}))


@query("SELECT event_id, value FROM events WHERE value IS NOT NULL AND event_type <> 'view' AND (value < 2.5 OR value > 200)")
def range_filter(spark, folder):
    """Missing values never pass, filters reach the scan."""
    df = table(spark, folder, "events")
    return df.where((F.col("event_type") != "view") & ((F.col("value") < 2.5) | (F.col("value") > 200))).select("event_id", "value")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(format('{:.2f}', l_quantity * l_tax / 3) AS DOUBLE) AS two,
                 CAST(format('{:.0f}', l_quantity / 2) AS DOUBLE) AS whole FROM lineitem""")
def exact_rounding(spark, folder):
    """Scalar: decimal rounding of the binary value, ties to even."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        round_exact(F.col("l_quantity") * F.col("l_tax") / 3, 2).alias("two"),
        round_exact(F.col("l_quantity") / 2, 0).alias("whole"),
    )


@query(f"""SELECT column_name AS "column", {r('v', 'variance', 2)} FROM (
             SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS column_name,
                    unnest([var_samp(l_quantity), var_samp(l_discount), var_samp(l_tax)]) AS v FROM lineitem)""")
def column_variances(spark, folder):
    """P13 (input), P18: variances of several columns from one scan, as rows."""
    df = table(spark, folder, "lineitem")
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])
    return rounded(row.unpivot([], ["l_quantity", "l_discount", "l_tax"], "column", "variance"), 2)


@query("SELECT o_orderpriority AS value, CAST(count(*) AS BIGINT) AS n_rows FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def value_counts(spark, folder):
    """A1."""
    df = table(spark, folder, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return profile.value_counts(df, "p")
