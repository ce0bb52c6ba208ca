"""Shuffles, splits, folds, samples, guards and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import encode, guards, order, split
from gridloom.registry.inputs import (
    KEY,
    ORDERS_SQL,
    TARGET,
    digest_sql,
    folds_sql,
    orders_model,
    position_sql,
    query,
    r,
    rounded,
    split_sql,
    table,
)
from gridloom.sources import reports, splits, tables
from gridloom.sources.scratch import scratch_path

_LINE = "l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber"
_LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_LINE_ORDER = f"{digest_sql(_LINE)}, l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (ORDER BY {_LINE_ORDER}) AS position
           FROM lineitem""")
def shuffle_rank(spark, folder):
    """Q1, W3."""
    return split.shuffled(table(spark, folder, "lineitem").select(*_LINE_KEYS), keys=_LINE_KEYS)


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (ORDER BY {_LINE_ORDER}) AS position, true AS in_order
           FROM lineitem""")
def shuffled_rows(spark, folder):
    """Q1: the rows themselves in shuffled order, in files that follow one another; each row says whether its file keeps to that."""
    path = scratch_path(spark, "shuffled")
    tables.write_in_order(split.shuffled(table(spark, folder, "lineitem").select(*_LINE_KEYS), keys=_LINE_KEYS), path, "position", files=8)
    ranges = tables.position_ranges(spark, path, "position").withColumn("number", F.substring("file", 6, 5).cast("int")).alias("a")
    before = ranges.alias("b")
    follows = ranges.join(before, F.col("b.number") < F.col("a.number"), "left").groupBy("a.file", "a.first", "a.last", "a.n").agg(F.max("b.last").alias("top"))
    kept = follows.select("file", ((F.col("last") - F.col("first") + 1 == F.col("n")) & (F.coalesce("top", F.lit(0)) + 1 == F.col("first"))).alias("in_order"))
    rows = spark.read.parquet(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return rows.join(F.broadcast(kept), "file").drop("file")  # a row per file


_HOT_ROWS = 50


@query(f"""SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n_rows, min(position) AS first, max(position) AS last FROM (
             SELECT l_suppkey, row_number() OVER (ORDER BY {digest_sql('l_suppkey')}) AS position FROM lineitem) GROUP BY 1""")
def shuffle_rank_repeated(spark, folder):
    """Q1, W3 by a key that many rows share: whole key groups stand together at known positions."""
    ranked = order.global_rank(table(spark, folder, "lineitem").select(*_LINE_KEYS), "position", seed=split.SEED, keys=["l_suppkey"], hot_rows=_HOT_ROWS)
    return ranked.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"), F.min("position").alias("first"), F.max("position").alias("last"))


@query(f"""SELECT l_returnflag, l_suppkey, CAST(count(*) AS BIGINT) AS n_rows, min(position) AS first, max(position) AS last FROM (
             SELECT l_returnflag, l_suppkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY {digest_sql('l_suppkey')}) AS position
             FROM lineitem) GROUP BY 1, 2""")
def rank_in_group_repeated(spark, folder):
    """W4 by a key that many rows of a group share."""
    df = table(spark, folder, "lineitem").select("l_returnflag", *_LINE_KEYS)
    ranked = split.rank_in_group(df, "l_returnflag", keys=["l_suppkey"], hot_rows=_HOT_ROWS)
    return ranked.groupBy("l_returnflag", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("position").alias("first"), F.max("position").alias("last"))


@query(f"""WITH {ORDERS_SQL}, {split_sql()} SELECT o_orderkey, o_totalprice, split FROM marked""")
def holdout_split(spark, folder):
    """Q2, U5."""
    return split.hold_out(orders_model(spark, folder).select("o_orderkey", "o_totalprice"), TARGET, keys=KEY)


@query(f"""SELECT l_returnflag, split, CAST(count(*) AS BIGINT) AS n_rows, {r('sum(l_quantity)', 'quantity', 2)} FROM (
             SELECT *, CASE WHEN row_number() OVER (ORDER BY {_LINE_ORDER}) <= round_even(0.2 * count(*) OVER (), 0)
                            THEN 'test' ELSE 'train' END AS split FROM lineitem) GROUP BY 1, 2""")
def holdout_lineitem(spark, folder):
    """Exact split of the largest table, summarised."""
    marked = split.hold_out(table(spark, folder, "lineitem"), "l_quantity", keys=_LINE_KEYS)
    return rounded(marked.groupBy("l_returnflag", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")), 2)


@query("""WITH copies AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)
          SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(round_even(0.2 * sum(n), 0) AS BIGINT) AS n_test,
                 CAST(count(*) AS BIGINT) AS n_kinds FROM copies""")
def holdout_copies(spark, folder):
    """Q2 where each row has thousands of copies: sizes stay exact, no row is lost or added."""
    marked = split.hold_out(table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus"), "l_returnflag")
    return marked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("split") == "test").alias("n_test"),
        F.countDistinct("l_returnflag", "l_linestatus").alias("n_kinds"),
    )


@query(f"""WITH sized AS (
             SELECT o_custkey, count(*) AS n, {digest_sql('o_custkey')} AS h FROM orders GROUP BY 1),
           run AS (SELECT *, sum(n) OVER (ORDER BY h) - n AS seen, sum(n) OVER () AS total FROM sized)
           SELECT o_custkey, CAST(n AS BIGINT) AS n_rows,
                  CASE WHEN seen < round_even(0.2 * total, 0) THEN 'test' ELSE 'train' END AS split FROM run""")
def holdout_whole_keys(spark, folder):
    """Q2: all orders of a customer on one side."""
    marked = split.hold_out(table(spark, folder, "orders"), TARGET, keys=["o_custkey"], whole_keys=True)
    return marked.groupBy("o_custkey", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH {ORDERS_SQL}, {split_sql()},
           held AS (SELECT o_orderkey, CASE WHEN {position_sql('o_orderkey')} <= round_even(0.2 * count(*) OVER (), 0)
                           THEN 'val' ELSE 'train' END AS split FROM marked WHERE split = 'train')
           SELECT o_orderkey, split FROM held UNION ALL SELECT o_orderkey, split FROM marked WHERE split = 'test'""")
def validation_split(spark, folder):
    """Q3."""
    marked = split.hold_out(orders_model(spark, folder).select("o_orderkey", "o_totalprice"), TARGET, keys=KEY)
    return split.with_validation(marked, TARGET, keys=KEY).select("o_orderkey", "split")


@query(f"""WITH marked AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'train' WHEN o_orderstatus = 'O' THEN 'test' END AS split
                           FROM orders),
           held AS (SELECT o_orderkey, CASE WHEN {position_sql('o_orderkey')} <= round_even(0.2 * count(*) OVER (), 0)
                           THEN 'val' ELSE 'train' END AS split FROM marked WHERE split = 'train')
           SELECT o_orderkey, split FROM held UNION ALL SELECT o_orderkey, split FROM marked WHERE split IS DISTINCT FROM 'train'""")
def validation_split_unmarked(spark, folder):
    """Q3 with rows that carry no marker: they stay."""
    status = F.col("o_orderstatus")
    marked = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.when(status == "F", "train").when(status == "O", "test").alias("split"))
    return split.with_validation(marked, TARGET, keys=KEY).select("o_orderkey", "split")


@query("""WITH codes AS (SELECT c_name, dense_rank() OVER (ORDER BY c_name) - 1 AS code FROM customer WHERE c_custkey % 3 > 0),
          kinds AS (SELECT DISTINCT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer WHERE c_custkey % 3 > 0),
          width AS (SELECT count(*) - 1 AS w FROM codes)
          SELECT c_custkey, array_to_string(list_filter([CASE WHEN n.code >= 1 THEN n.code - 1 END, CASE WHEN k.code >= 1 THEN k.code - 1 + w END],
                                                        lambda x: x IS NOT NULL), ',') AS active
          FROM customer LEFT JOIN codes n USING (c_name) LEFT JOIN kinds k USING (c_mktsegment), width""")
def onehot_sparse(spark, folder):
    """E1 with a wide vocabulary: fitted on two thirds of the customers, applied to all, names of the others being unseen."""
    df = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    encoder = encode.SparseOneHot.fit(df.where("c_custkey % 3 > 0"))
    return encoder.apply(df).select("c_custkey", F.array_join("active", ",").alias("active"))


@query(f"""WITH {folds_sql('orders')} SELECT o_orderkey, fold FROM folded""")
def kfold_assign(spark, folder):
    """Q4."""
    return split.assign_folds(table(spark, folder, "orders").select("o_orderkey"), keys=KEY)


@query(f"""WITH {folds_sql('orders', folds=7)} SELECT fold, CAST(count(*) AS BIGINT) AS n_rows FROM folded GROUP BY 1""")
def kfold_sizes(spark, folder):
    """Fold sizes."""
    folded = split.assign_folds(table(spark, folder, "orders").select("o_orderkey"), 7, keys=KEY)
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH g AS (
             SELECT event_id, nullif(event_type, 'view') AS kind,
                    row_number() OVER (PARTITION BY nullif(event_type, 'view') ORDER BY {digest_sql('event_id')}, event_id) AS pos,
                    count(*) OVER (PARTITION BY nullif(event_type, 'view')) AS m FROM events),
           s AS (SELECT *, floor(m * 0.7) + CASE WHEN m - floor(m * 0.7) - floor(m * 0.3) >= 1
                        AND m * 0.7 - floor(m * 0.7) >= m * 0.3 - floor(m * 0.3) THEN 1 ELSE 0 END AS first FROM g)
           SELECT event_id, kind, CAST(CASE WHEN pos <= first THEN 0 ELSE 1 END AS INTEGER) AS part FROM s""")
def stratified_alloc(spark, folder):
    """Proportional parts per group, a missing group being one."""
    df = table(spark, folder, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return split.allocate_in_groups(df, "kind", (0.7, 0.3), keys=["event_id"])


@query(f"""SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY {digest_sql('event_id')}, event_id) AS position
           FROM events""")
def rank_in_group(spark, folder):
    """W4."""
    return split.rank_in_group(table(spark, folder, "events").select("event_id", "user_id"), "user_id", keys=["event_id"])


@query(f"""SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, {position_sql('o_orderkey')} AS p FROM orders)
           WHERE p <= 500""")
def sample_n(spark, folder):
    """Q6: the fixed size is the feature."""
    return split.sample_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 500, keys=KEY)


@query("""SELECT value, (rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0)::DOUBLE AS rank, event_id
          FROM events""")
def average_rank(spark, folder):
    """W2."""
    return order.average_rank(table(spark, folder, "events").select("event_id", "value"), "value", "rank")


@query("""SELECT o_custkey, status FROM (
            SELECT o_custkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE o_totalprice < 250000
            INTERSECT SELECT o_custkey, nullif(o_orderstatus, 'P') FROM orders WHERE o_totalprice >= 250000)""")
def overlap_rows(spark, folder):
    """Missing values match each other."""
    df = table(spark, folder, "orders").select(
        "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice")
    low, high = df.where(F.col("o_totalprice") < 250000), df.where(F.col("o_totalprice") >= 250000)
    return guards.overlap(low.drop("o_totalprice"), high.drop("o_totalprice"))


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O'
          AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def overlap_ids(spark, folder):
    """J2, J3."""
    df = table(spark, folder, "orders")
    return guards.overlap(df.where(F.col("o_orderstatus") == "O"), df.where(F.col("o_orderstatus") == "F"), ["o_custkey"])


@query("SELECT 'rows' AS guard, FALSE AS raised UNION ALL SELECT 'customers', TRUE")
def overlap_guard(spark, folder):
    """J1, J2 as guards over a split: distinct rows pass, shared customers do not."""
    marked = split.hold_out(table(spark, folder, "orders"), TARGET, keys=KEY)
    found = []
    for name, ids in (("rows", None), ("customers", ["o_custkey"])):
        try:
            guards.assert_split_disjoint(marked, id_columns=ids)
            found.append((name, False))
        except guards.OverlapError:
            found.append((name, True))
    return spark.createDataFrame(found, "guard string, raised boolean")


_ONE_HOT = """CAST(coalesce(o_orderpriority, '__MISSING__') = '2-HIGH' AS DOUBLE) AS "o_orderpriority_2-HIGH",
  CAST(coalesce(o_orderpriority, '__MISSING__') = '3-MEDIUM' AS DOUBLE) AS "o_orderpriority_3-MEDIUM",
  CAST(coalesce(o_orderpriority, '__MISSING__') = '4-NOT SPECIFIED' AS DOUBLE) AS "o_orderpriority_4-NOT SPECIFIED",
  CAST(coalesce(o_orderpriority, '__MISSING__') = '__MISSING__' AS DOUBLE) AS "o_orderpriority___MISSING__" """


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, day, CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus_O", {_ONE_HOT}
           FROM orders_model""")
def onehot_train_fit(spark, folder):
    """Fitted without status 'P', which then encodes to zeros; missing is a category."""
    df = orders_model(spark, folder).select("o_orderkey", "day", "o_orderstatus", "o_orderpriority")
    train = df.where(F.col("o_orderstatus") != "P")
    (_, everything), _ = encode.encode_on_train(train, [df])
    return everything


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, CAST(coalesce(o_orderpriority, '__MISSING__') = '1-URGENT' AS DOUBLE)
           AS "o_orderpriority_1-URGENT", {_ONE_HOT} FROM orders_model""")
def onehot_full(spark, folder):
    """E2."""
    return encode.encode_whole(orders_model(spark, folder).select("o_orderkey", "o_orderpriority"))[0]


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, coalesce(o_orderpriority, '__MISSING__') AS o_orderpriority, c_mktsegment
           FROM orders_model""")
def onehot_inverse(spark, folder):
    """E3."""
    encoded, encoder = encode.encode_whole(orders_model(spark, folder).select("o_orderkey", "o_orderpriority", "c_mktsegment"))
    return encoder.invert(encoded)


_VOCABULARY = """v AS (
  SELECT 'o_orderpriority' AS "column", coalesce(o_orderpriority, '__MISSING__') AS category FROM orders_model
  UNION SELECT 'c_mktsegment', c_mktsegment FROM orders_model),
o AS (SELECT "column", category, row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS ordinal FROM v)"""


@query(f"""WITH {ORDERS_SQL}, {_VOCABULARY} SELECT "column", category AS original_value,
           CASE WHEN ordinal > 0 THEN "column" || '_' || category END AS encoded_value FROM o""")
def encoder_mapping(spark, folder):
    """The CSV form."""
    encoder = encode.OneHot.fit(orders_model(spark, folder).select("o_orderpriority", "c_mktsegment"))
    return reports.mapping_rows(encoder.table(spark))


@query(f"""WITH {ORDERS_SQL}, {_VOCABULARY} SELECT "column",
           '{{"categories":[' || string_agg('"' || category || '"', ',' ORDER BY ordinal) || '],"mapping":{{'
           || string_agg('"' || category || '":"' || "column" || '_' || category || '"', ',' ORDER BY ordinal) FILTER (ordinal > 0)
           || '}},"feature_names":[' || string_agg('"' || "column" || '_' || category || '"', ',' ORDER BY ordinal) FILTER (ordinal > 0)
           || '],"type":"one-hot"}}' AS document FROM o GROUP BY 1""")
def encoder_documents(spark, folder):
    """The JSON form."""
    encoder = encode.OneHot.fit(orders_model(spark, folder).select("o_orderpriority", "c_mktsegment"))
    return reports.mapping_documents(encoder.table(spark))


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           {r('(l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER ()', 'l_quantity')},
           {r('(l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER ()', 'l_extendedprice')},
           0.0::DOUBLE AS same FROM lineitem""")
def standardize(spark, folder):
    """Population deviation; a constant column is only centred."""
    df = table(spark, folder, "lineitem").select(*_LINE_KEYS, "l_quantity", "l_extendedprice", F.lit(7.25).alias("same"))
    return rounded(encode.Scaler.fit(df, ["l_quantity", "l_extendedprice", "same"]).apply(df))


@query(f"""WITH src AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey = 11 THEN 'only-once' ELSE o_orderpriority END
                        AS priority FROM orders), {folds_sql('src')},
           long AS (SELECT fold, 'priority' AS "column", priority AS category FROM folded
                    UNION ALL SELECT fold, 'o_orderstatus', o_orderstatus FROM folded),
           known AS (SELECT f.fold, l."column", l.category FROM (SELECT DISTINCT fold FROM folded) f
                     JOIN long l ON l.fold <> f.fold GROUP BY ALL)
           SELECT fold, "column", category,
                  CAST(row_number() OVER (PARTITION BY fold, "column" ORDER BY category) - 1 AS INTEGER) AS ordinal FROM known""")
def fold_vocab(spark, folder):
    """M7: a category that occurs in one fold only is unknown to that fold's encoder."""
    src = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") == 11, "only-once").otherwise(F.col("o_orderpriority")).alias("priority"))
    folded = split.assign_folds(src, keys=KEY)
    return encode.fold_vocabularies(folded, ["priority", "o_orderstatus"], folds=5)


@query(f"""WITH {ORDERS_SQL}, {split_sql()} SELECT o_orderkey, o_totalprice, c_acctbal, c_nationkey, day,
           CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS DOUBLE) AS "o_orderstatus_P",
           CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS "c_mktsegment_BUILDING",
           CAST(c_mktsegment = 'FURNITURE' AS DOUBLE) AS "c_mktsegment_FURNITURE",
           CAST(c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS "c_mktsegment_HOUSEHOLD",
           CAST(c_mktsegment = 'MACHINERY' AS DOUBLE) AS "c_mktsegment_MACHINERY", {_ONE_HOT} FROM marked WHERE split = 'train'""")
def numeric_train(spark, folder):
    """E7, P12, P21."""
    marked = split.hold_out(orders_model(spark, folder), TARGET, keys=KEY)
    return splits.numeric_train(marked, TARGET)


@query(f"""WITH {ORDERS_SQL}, {split_sql()},
           held AS (SELECT *, CASE WHEN {position_sql('o_orderkey')} <= round_even(0.2 * count(*) OVER (), 0)
                           THEN 'val' ELSE 'train' END AS part FROM marked WHERE split = 'train')
           SELECT part AS split, o_orderkey, o_totalprice, CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus_O",
                  CAST(o_orderstatus = 'P' AS DOUBLE) AS "o_orderstatus_P", {_ONE_HOT} FROM held""")
def numeric_train_validation(spark, folder):
    """E6."""
    df = orders_model(spark, folder).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return splits.numeric_train_validation(split.hold_out(df, TARGET, keys=KEY), TARGET, keys=KEY)
