"""Profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import profile, quantile
from gridloom.registry.inputs import ORDERS_SQL, TARGET, orders_model, query, r, rounded, table

_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _outlier_sql(source: str, columns: list[str], expressions: dict[str, str] | None = None) -> str:
    """Outlier report of several columns: quartiles, fences, then counts, one branch per column."""
    parts = []
    for c in columns:
        x = (expressions or {}).get(c, c)
        parts.append(f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (x < lo OR x > hi) AS BIGINT) AS n_outliers,
            CAST(format('{{:.2f}}', count(*) FILTER (x < lo OR x > hi) / count(x) * 100) AS DOUBLE) AS pct,
            min(x) FILTER (x < lo OR x > hi) AS min_outlier, max(x) FILTER (x < lo OR x > hi) AS max_outlier,
            round_even(any_value(lo) * 100, 0) / 100 AS lower_bound, round_even(any_value(hi) * 100, 0) / 100 AS upper_bound
            FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {source}), (
              SELECT q1 - 3.0 * (q3 - q1) AS lo, q3 + 3.0 * (q3 - q1) AS hi FROM (
                SELECT quantile_cont(CAST({x} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({x} AS DOUBLE), 0.75) AS q3
                FROM {source}))""")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_outliers > 0"


_EVENT_NUMBERS = ["event_id", "user_id", "value", "log_value"]
_EVENT_SQL = _outlier_sql("events", _EVENT_NUMBERS, {"log_value": "CASE WHEN user_id % 4 > 0 THEN value * value END"})


def _event_numbers(spark, folder):
    v = F.col("value")
    return table(spark, folder, "events").select(
        "event_id", "user_id", "value", F.when(F.col("user_id") % 4 > 0, v * v).alias("log_value"))


@query(_EVENT_SQL)
def iqr_outliers(spark, folder):
    """A7, P16."""
    return profile.extreme_outliers(_event_numbers(spark, folder))


_STEEP = " * ".join(["(l_extendedprice / 100000.0)"] * 8)


@query(_outlier_sql("lineitem", _LINE_NUMBERS, {"l_extendedprice": f"CAST(l_quantity > 0 AS INTEGER) * {_STEEP}"}))
def iqr_outliers_steep(spark, folder):
    """A7 on the largest table, with a column that has outliers."""
    p = (F.col("l_quantity") > 0).cast("int")
    for _ in range(8):
        p = p * (F.col("l_extendedprice") / 100000.0)
    df = table(spark, folder, "lineitem").select("l_quantity", p.alias("l_extendedprice"), "l_discount", "l_tax")
    return profile.extreme_outliers(df)


@query(_outlier_sql("lineitem", _LINE_NUMBERS, {"l_extendedprice": " * ".join(["(l_extendedprice / 100000.0)"] * 5)}))
def iqr_outliers_lineitem(spark, folder):
    """A7 on the largest table."""
    p = F.col("l_extendedprice") / 100000.0
    df = table(spark, folder, "lineitem").select("l_quantity", (p * p * p * p * p).alias("l_extendedprice"), "l_discount", "l_tax")
    return profile.extreme_outliers(df)


@query(f"SELECT * FROM ({_EVENT_SQL}) ORDER BY n_outliers DESC, \"column\" LIMIT 15")
def top_outliers(spark, folder):
    """A8."""
    return profile.top_outliers(profile.extreme_outliers(_event_numbers(spark, folder)))


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r(f'quantile_cont({c}, 0.25)', 'q25')}, {r(f'quantile_cont({c}, 0.5)', 'q50')},
        {r(f'quantile_cont({c}, 0.99)', 'q99')} FROM lineitem""" for c in _LINE_NUMBERS))
def exact_quantiles(spark, folder):
    """A7, A10 (input): interpolated quantiles by brackets and counted values, no column held in one task."""
    df = table(spark, folder, "lineitem")
    found = quantile.exact_quantiles(df, _LINE_NUMBERS, [0.25, 0.5, 0.99], direct_rows=0)
    return rounded(spark.createDataFrame([(c, *v) for c, v in found.items()], "column string, q25 double, q50 double, q99 double"))


def _histogram_sql(source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS "column", e.bin, {r('lo + e.bin * (hi - lo) / 30', 'lower_edge', 4)},
            {r('lo + (e.bin + 1) * (hi - lo) / 30', 'upper_edge', 4)},
            CAST(count(x) AS BIGINT) AS n_rows
          FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(30)) e
          CROSS JOIN (SELECT min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi FROM {source}) m
          LEFT JOIN (SELECT CAST({c} AS DOUBLE) AS x FROM {source}) s
            ON x >= lo + e.bin * ((hi - lo) / 30) AND (x < lo + (e.bin + 1) * ((hi - lo) / 30) OR e.bin = 29)
          GROUP BY e.bin, lo, hi""")
    return " UNION ALL ".join(parts)


@query(_histogram_sql("events", ["event_id", "user_id", "value"]))
def histogram30(spark, folder):
    """A9."""
    df = table(spark, folder, "events").withColumn("same", F.lit(1.0))
    return rounded(profile.histograms(df), 4)


@query(_histogram_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def histogram30_lineitem(spark, folder):
    """A9 on the largest table."""
    return rounded(profile.histograms(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), 4)


_FREQUENCY = """c AS (SELECT o_orderpriority AS category, count(*) AS frequency FROM orders_model
                WHERE o_orderpriority IS NOT NULL GROUP BY 1),
s AS (SELECT *, round_even(frequency / (SELECT count(*) FROM orders_model) * 100 * 100, 0) / 100 AS share_pct FROM c),
f AS (SELECT category, frequency, share_pct, round_even(sum(share_pct) OVER (ORDER BY category) * 100, 0) / 100 AS cumulative_pct FROM s
      UNION ALL SELECT 'TOTAL', CAST(sum(frequency) AS BIGINT), 100.0, 100.0 FROM c)"""


@query(f"WITH {ORDERS_SQL}, {_FREQUENCY} SELECT * FROM f")
def frequency_table(spark, folder):
    """Shares of all rows, missing ones included."""
    return profile.frequency_table(orders_model(spark, folder), "o_orderpriority")


@query("""WITH c AS (SELECT p_brand AS category, count(*) AS frequency FROM part GROUP BY 1),
          s AS (SELECT *, round_even(frequency / (SELECT count(*) FROM part) * 100 * 100, 0) / 100 AS share_pct FROM c),
          f AS (SELECT category, frequency, share_pct,
                       round_even(sum(share_pct) OVER (ORDER BY category) * 100, 0) / 100 AS cumulative_pct FROM s)
          (SELECT * FROM f ORDER BY category LIMIT 10)
          UNION ALL SELECT 'TOTAL', CAST(sum(frequency) AS BIGINT), 100.0, 100.0 FROM c""")
def frequency_preview(spark, folder):
    """A16, T4."""
    return profile.frequency_preview(profile.frequency_table(table(spark, folder, "part"), "p_brand"))


def _category_sql(source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS variable, v AS mode, CAST(n AS BIGINT) AS mode_count,
            round_even(n / (SELECT count(*) FROM {source}) * 100 * 100, 0) / 100 AS mode_pct,
            CAST((SELECT count(DISTINCT {c}) FROM {source}) AS BIGINT) AS n_unique
            FROM (SELECT {c} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)""")
    return " UNION ALL ".join(parts)


@query(f"WITH {ORDERS_SQL} SELECT * FROM ({_category_sql('orders_model', ['o_orderstatus', 'o_orderpriority', 'c_mktsegment'])})")
def categorical_profile(spark, folder):
    """A3."""
    return profile.categorical_profile(orders_model(spark, folder))


@query(f"SELECT * FROM ({_category_sql('documents', ['lang', 'source', 'text'])}) ORDER BY mode_pct DESC, variable LIMIT 15")
def top_categories(spark, folder):
    """A16 over columns with few and with very many values (whole texts)."""
    df = table(spark, folder, "documents")
    return profile.top_categorical(profile.categorical_profile(df.select("lang", "source", "text")))


def _pairs_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS c FROM {source}"
        for i, a in enumerate(columns) for b in columns[:i])


@query(f"""WITH p AS ({_pairs_sql('lineitem', _LINE_NUMBERS)})
           SELECT feature_1, feature_2, {r('c', 'correlation')} FROM p
           UNION ALL SELECT feature_2, feature_1, {r('c', 'correlation')} FROM p
           UNION ALL SELECT unnest({_LINE_NUMBERS}), unnest({_LINE_NUMBERS}), 1.0
           UNION ALL SELECT 'same', 'same', NULL
           UNION ALL SELECT unnest({_LINE_NUMBERS}), 'same', NULL
           UNION ALL SELECT 'same', unnest({_LINE_NUMBERS}), NULL""")
def corr_matrix(spark, folder):
    """A4: a constant column has no correlation."""
    df = table(spark, folder, "lineitem").select(*_LINE_NUMBERS, F.lit(3.5).alias("same"))
    return rounded(profile.correlation_matrix(df))


_PRICE_NUMBERS = {
    "quantity": "CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity END",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "tax": "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END",
    "gross": "l_extendedprice * (1 + l_tax)",
    "net": "l_extendedprice * (1 - l_discount)",
    "line": "CAST(l_linenumber AS DOUBLE)",
}
_PRICES_SQL = "prices AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _PRICE_NUMBERS.items()) + " FROM lineitem)"


def _prices(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _PRICE_NUMBERS.items()])


@query(f"""WITH {_PRICES_SQL}, p AS ({_pairs_sql('prices', list(_PRICE_NUMBERS))})
           SELECT feature_1, feature_2, {r('c', 'correlation')} FROM p ORDER BY abs(c) DESC, feature_1, feature_2 LIMIT 15""")
def corr_top_pairs(spark, folder):
    """Pairs over rows where both are present."""
    return rounded(profile.top_correlations(profile.correlation_pairs(_prices(spark, folder))))


@query(f"""WITH {_PRICES_SQL}, p AS ({_pairs_sql('prices', list(_PRICE_NUMBERS))})
           SELECT feature_1, feature_2, {r('c', 'correlation')} FROM p""")
def corr_pairs_by_products(spark, folder):
    """A4 as computed for wide tables: pair sums by matrix products of Arrow batches."""
    return rounded(profile.correlation_pairs(_prices(spark, folder), generated_pairs=0))


def _spearman_sql(source: str, features: list[str], target: str) -> str:
    parts = []
    for c in features:
        parts.append(f"""SELECT '{c}' AS feature, CAST(count(*) AS BIGINT) AS n_rows, {r('corr(rx, ry)', 'rho')} FROM (
            SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS rx,
                   rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry
            FROM (SELECT CAST({c} AS DOUBLE) AS x, {target} AS y FROM {source}) WHERE x IS NOT NULL AND y IS NOT NULL)""")
    return " UNION ALL ".join(parts)


@query(f"WITH {ORDERS_SQL} SELECT * FROM ({_spearman_sql('orders_model', ['c_acctbal', 'c_nationkey', 'day'], 'o_totalprice')})")
def spearman_target(spark, folder):
    """A6, W2."""
    df = orders_model(spark, folder).drop("o_orderkey")
    return rounded(profile.spearman_with_target(df, TARGET).drop("p_value"))


@query(f"WITH {_PRICES_SQL} SELECT * FROM ({_spearman_sql('prices', ['quantity', 'discount', 'tax', 'gross', 'net', 'line'], 'price')})")
def spearman_lineitem(spark, folder):
    """A6 with missing values and heavily tied features."""
    return rounded(profile.spearman_with_target(_prices(spark, folder), "price").drop("p_value"))


@query()
def spearman_p_values(spark, folder):
    """P-values of Student's t, which SQL lacks."""
    df = orders_model(spark, folder).drop("o_orderkey")
    return rounded(profile.spearman_with_target(df, TARGET), 4)
