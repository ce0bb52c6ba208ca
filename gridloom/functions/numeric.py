"""Numeric parsing and rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number: decimal or exponent notation, infinity, surrounding blanks.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"

# Splitter of Veltkamp's algorithm for 53-bit doubles: 2**27 + 1.
_SPLITTER = 134217729.0


def nan_to_null(c: Column) -> Column:
    """NaN and NULL are one kind of missing value; NULL is the one Spark aggregates skip."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def parse_number(c: Column) -> Column:
    """DOUBLE value of a text column, NULL where it does not read as a number."""
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def to_number(c: Column, data_type: T.DataType) -> Column:
    """DOUBLE (NaN folded to NULL) of a column of any scalar type."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.cast("double"))
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return c.cast("int").cast("double") if isinstance(data_type, T.BooleanType) else c.cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType)):
        return nanoseconds(c, data_type).cast("double")
    return parse_number(c.cast("string"))


def nanoseconds(c: Column, data_type: T.DataType) -> Column:
    """Signed nanoseconds (epoch or length) of a time column; microseconds are Spark's resolution."""
    if isinstance(data_type, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000_000)
    if isinstance(data_type, T.DayTimeIntervalType):
        return F.unix_micros(F.timestamp_seconds(F.lit(0)) + c) * F.lit(1000)
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c) * F.lit(1000)
    return F.unix_micros(c) * F.lit(1000)


def round_scaled(c: Column, decimals: int) -> Column:
    """Half-even rounding of the scaled value, the arithmetic of array libraries."""
    scale = F.lit(float(10**decimals))
    return F.rint(c.cast("double") * scale) / scale


def round_exact(c: Column, decimals: int) -> Column:
    """Correctly rounded decimal rounding of the binary value, ties to even.

    ``x * 10**d`` may land on ``.5`` although ``x`` itself is above or below the tie. The error of that product is
    recovered exactly with a two-product (Veltkamp split), and decides such cases.
    """
    x = c.cast("double")
    scale = F.lit(float(10**decimals))
    product = x * scale
    high = x * F.lit(_SPLITTER) - (x * F.lit(_SPLITTER) - x)
    error = (high * scale - product) + (x - high) * scale
    tie = (product - F.floor(product)) == F.lit(0.5)
    whole = (
        F.when(F.abs(product) >= F.lit(float(2**52)), product)
        .when(tie & (error > 0), F.ceil(product).cast("double"))
        .when(tie & (error < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return F.when(F.abs(product) >= F.lit(float(2**52)), x).otherwise(whole / scale)


def ratio_or(numerator: Column, denominator: Column, both_zero: float, zero_denominator: float) -> Column:
    """``numerator / denominator`` with fixed answers for a zero denominator."""
    return (
        F.when(denominator != 0, numerator / denominator)
        .when(denominator.isNull(), F.lit(None))
        .when(numerator == 0, F.lit(both_zero))
        .otherwise(F.lit(zero_denominator))
    )
