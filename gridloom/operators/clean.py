"""Row-local cleaning and coercion of columns to numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.columns import ref, refs, require_columns, stacked, string_columns
from gridloom.functions.numeric import nanoseconds, parse_number, round_exact, round_scaled, to_number
from gridloom.operators.order import BROADCAST_ROWS, HOT_ROWS, SORT_ROWS, Sizes, dense_codes, look_up
from gridloom.sources.scratch import written

# Stand-in for a missing category.
MISSING_CATEGORY = "__MISSING__"

# The indicator column, and the columns kept at one decimal by the cleaning job.
INDICATOR_COLUMN = "physical-exercise"
ONE_DECIMAL_COLUMNS = (
    "fat-percentage",
    "bmi-calc",
    "protein-per-kg",
    "cal-balance",
    "lean-mass-kg",
    "burns-calories-(per-30-min)-bc",
)

# Measurement scales of the profiled table.
FLOORED_COLUMNS = ("Age",)
WHOLE_COLUMNS = (
    "Max_BPM",
    "Avg_BPM",
    "Resting_BPM",
    "Workout_Frequency (days/week)",
    "Experience_Level",
    "Daily meals frequency",
    "Physical exercise",
    "Calories",
    "sodium_mg",
    "cholesterol_mg",
    "prep_time_min",
    "cook_time_min",
)
TWO_DECIMAL_COLUMNS = (
    "Session_Duration (hours)",
    "Water_Intake (liters)",
    "sugar_g",
    "serving_size_g",
    "rating",
    "pct_maxHR",
    "burns-calories-(per-30-min)-bc",
)


def binarize(df: DataFrame, column: str = INDICATOR_COLUMN) -> DataFrame:
    """1 where the column reads as a number above zero, else 0."""
    require_columns(df, [column])
    number = F.coalesce(to_number(ref(column), df.schema[column].dataType), F.lit(0.0))
    return df.withColumn(column, (number > 0).cast("int"))


def round_columns(df: DataFrame, columns: Sequence[str], decimals: int = 1) -> DataFrame:
    """Round the named columns that exist, text coerced to numbers first; the result stays DOUBLE."""
    present = [c for c in dict.fromkeys(columns) if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: round_exact(to_number(ref(c), df.schema[c].dataType), decimals) for c in present})


def round_scales(
    df: DataFrame,
    floored: Sequence[str] = FLOORED_COLUMNS,
    whole: Sequence[str] = WHOLE_COLUMNS,
    two_decimals: Sequence[str] = TWO_DECIMAL_COLUMNS,
) -> DataFrame:
    """P5: round every present column to its measurement scale; NULL stays NULL."""
    changes = {}
    for c in df.columns:
        number = to_number(ref(c), df.schema[c].dataType)
        if c in floored:
            changes[c] = F.floor(number).cast("int")
        elif c in whole:
            changes[c] = F.rint(number).cast("int")
        elif c in two_decimals:
            changes[c] = round_scaled(number, 2)
    return df.withColumns(changes) if changes else df


def numeric_text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Text columns of which at least ``max(1, rows // 2)`` entries read as numbers, from one aggregate."""
    if not columns:
        return []
    parsed = [F.count(parse_number(ref(c))).alias(c) for c in columns]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *parsed).first()
    return [c for c in columns if row[c] >= max(1, row["_rows"] // 2)]


def category_codes(df: DataFrame, columns: Sequence[str], *, sort_rows: int = SORT_ROWS) -> tuple[DataFrame, Sizes]:
    """Code table ``(column, value, n, code)``: sorted position of each category of each column; missing is one."""
    long = stacked(df, list(columns)).withColumn("value", F.coalesce("value", F.lit(MISSING_CATEGORY)))
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    codes, sizes = dense_codes(counted, "value", "code", ["column"], sort_rows=sort_rows)
    codes = written(codes, "codes")  # joined once per column
    found = codes.agg(F.max("n").alias("w"), F.sum(F.octet_length("value") + 32).alias("b")).first()
    return codes, Sizes(sizes.rows, sizes.largest_group, found["w"] or 0, found["b"] or 0)


@dataclass(frozen=True)
class NumericCoder:
    """The rules that make a frame numeric, fitted on one frame and applied to any.

    Text columns of which enough parses (see ``numeric_text_columns``) are read as numbers; all others become sorted category
    codes. A value that the fitted frame does not hold gets ``unseen``.
    """

    parsed: tuple[str, ...]
    coded: tuple[str, ...]
    codes: DataFrame | None = None
    sizes: Sizes | None = None
    unseen: int = -1

    @staticmethod
    def fit(df: DataFrame, *, sort_rows: int = SORT_ROWS) -> NumericCoder:
        text = string_columns(df)
        parsed = tuple(numeric_text_columns(df, text))
        coded = tuple(c for c in text if c not in parsed)
        return NumericCoder(parsed, coded, *(category_codes(df, coded, sort_rows=sort_rows) if coded else ()))

    def apply(self, df: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
        """Numbers stay, booleans become 0/1, times become nanoseconds, text follows the fitted rules."""
        coded = [c for c in self.coded if c in df.columns]
        changes = {}
        for f in df.schema.fields:
            c = ref(f.name)
            if f.name in self.parsed:
                changes[f.name] = parse_number(c.cast("string"))
            elif f.name in coded:
                continue
            elif isinstance(f.dataType, T.BooleanType):
                changes[f.name] = c.cast("int")
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType)):
                changes[f.name] = nanoseconds(c, f.dataType)
            elif isinstance(f.dataType, T.DecimalType):
                changes[f.name] = c.cast("double")
            elif not isinstance(f.dataType, T.NumericType):
                changes[f.name] = parse_number(c.cast("string"))
        out = df.withColumns(changes) if changes else df
        if not coded:
            return out
        return apply_codes(out, coded, self.codes, self.sizes, unseen=self.unseen, broadcast_rows=broadcast_rows, hot_rows=hot_rows)


def ensure_numeric(
    df: DataFrame, *, sort_rows: int = SORT_ROWS, broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """P8 on one frame: the rules are fitted on it and applied to it."""
    return NumericCoder.fit(df, sort_rows=sort_rows).apply(df, broadcast_rows=broadcast_rows, hot_rows=hot_rows)


def apply_codes(df: DataFrame, columns: Sequence[str], codes: DataFrame, sizes: Sizes, *, unseen: int = -1,
                broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace text columns by the codes of a table fitted elsewhere; values it does not hold get ``unseen``."""
    order = df.columns
    out = df
    for c in columns:
        table = codes.where(F.col("column") == c).select(F.col("value").alias("_value"), "n", F.col("code").alias("_code"))
        keyed = out.withColumn("_value", F.coalesce(ref(c).cast("string"), F.lit(MISSING_CATEGORY)))
        found = look_up(keyed, table, ["_value"], sizes=sizes, weight="n", broadcast_rows=broadcast_rows, hot_rows=hot_rows, how="left")
        out = found.withColumn(c, F.coalesce(F.col("_code"), F.lit(unseen)).cast("int")).select(*refs(order))
    return out
