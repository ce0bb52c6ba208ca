"""Safe column references and column roles read from a schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Back-ticked name: survives dots, spaces, slashes and brackets."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(quoted(name))


def refs(names: Iterable[str]) -> list[Column]:
    return [ref(n) for n in names]


def text_literal(value: str) -> str:
    """SQL string literal of ``value``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """P10: numeric columns in schema order; booleans are not numbers."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Categorical columns in schema order."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)) and f.name not in skip
    ]


def require_columns(df: DataFrame, names: Iterable[str], error: type[Exception] = KeyError) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise error(f"missing columns: {', '.join(missing)}")


def stacked(df: DataFrame, names: list[str], *, keep: Iterable[str] = (), key: str = "column", value: str = "value",
            as_type: str | None = None) -> DataFrame:
    """Long form ``(keep..., key, value)`` of several columns of one type.

    Built from one array of structs and ``explode`` so that it stays a narrow, code-generated projection over a
    scan that reads only the named columns.
    """
    items = []
    for n in names:
        v = ref(n) if as_type is None else ref(n).cast(as_type)
        items.append(F.struct(F.lit(n).alias(key), v.alias(value)))
    out = df.select(*refs(keep), F.explode(F.array(*items)).alias("_kv"))
    return out.select(*refs(keep), F.col("_kv")[key].alias(key), F.col("_kv")[value].alias(value))
