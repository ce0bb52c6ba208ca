"""CSV and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.columns import ref
from gridloom.functions.numeric import NUMBER_PATTERN

# Cell texts read as missing.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")

#: First rows of a CSV table that rule types out before all rows are tested.
HEAD_ROWS = 1000
_TYPES = ("long", "double", "boolean", "string")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, *, multiline: bool = False) -> DataFrame:
    """A CSV table with a header row.

    Cells are read as text, missing tokens become NULL, and unless a schema is given the types are then inferred by
    one aggregate: whole numbers, numbers, truth values, else text. ``multiline`` admits line breaks inside quotes,
    at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    names = [f.name for f in schema.fields] if schema else None
    if names is None:
        text = reader.option("inferSchema", False).csv(path)
    else:
        text = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)
    text = text.select(*[F.when(~ref(c).isin(*MISSING_TOKENS), ref(c)).alias(c) for c in text.columns])
    if schema is not None:
        return text.select(*[_typed(f.name, f.dataType) for f in schema.fields])
    if not text.columns:
        return text
    kinds = _infer(text)
    typed = []
    for c in text.columns:
        if kinds[c] == "long":
            typed.append(F.trim(ref(c)).cast("long").alias(c))
        elif kinds[c] == "double":
            typed.append(F.trim(ref(c)).try_cast("double").alias(c))
        elif kinds[c] == "boolean":
            typed.append((F.lower(ref(c)) == "true").alias(c))
        else:
            typed.append(ref(c))
    return text.select(*typed)


def _infer(text: DataFrame) -> dict[str, str]:
    """The first of ``_TYPES`` that every present cell of a column reads as; a column without any is a double.

    The first rows rule out types that their cells do not read as; all rows are then tested for those that are left.
    """
    head = text.sparkSession.createDataFrame(text.limit(HEAD_ROWS).collect(), text.schema)  # a bounded number of rows
    left = {c: list(_TYPES) for c in text.columns}
    left |= {c: kinds for c, kinds in _readings(head, left).items() if kinds}
    return {c: kinds[0] for c, kinds in left.items()} | {c: (kinds or ["double"])[0] for c, kinds in _readings(text, left).items()}


def _readings(text: DataFrame, left: dict[str, list[str]]) -> dict[str, list[str]]:
    """Those types ``left`` to a column that all its present cells read as (none without such a cell), from one aggregate.

    Columns to which text alone is left are not looked at.
    """
    columns = [c for c in text.columns if len(left[c]) > 1]
    if not columns:
        return {}
    tests = {"long": lambda c: c.rlike(_WHOLE), "double": lambda c: c.rlike(NUMBER_PATTERN), "boolean": lambda c: c.isin(*_TRUTH)}
    first = []  # the place of the first type that a cell reads as
    for i, c in enumerate(columns):
        place = F.when(ref(c).isNull(), F.lit(None))
        for kind in left[c][:-1]:
            place = place.when(tests[kind](ref(c)), F.lit(_TYPES.index(kind)))
        first.append(place.otherwise(F.lit(len(_TYPES) - 1)).alias(f"k{i}"))
    ends = [f(F.col(f"k{i}")) for i in range(len(columns)) for f in (F.min, F.max)]
    row = text.select(*first).agg(*ends).first()
    found = {}
    for c, low, high in zip(columns, row[::2], row[1::2]):
        # whole numbers are numbers too; any other type is only itself, and all are text
        fits = {"long": high == 0, "double": high is not None and high <= 1, "boolean": low == high == 2, "string": low is not None}
        found[c] = [kind for kind in left[c] if fits[kind]]
    return found


def _typed(name: str, data_type: T.DataType):
    if isinstance(data_type, T.StringType):
        return ref(name)
    return F.trim(ref(name)).cast(data_type).alias(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV dataset with a header in every part."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_table(df: DataFrame, folder: str, name: str) -> tuple[str, str]:
    """S3: the same table as Parquet and CSV; the CSV is written from the Parquet so the plan runs once."""
    parquet, text = f"{folder}/{name}.parquet", f"{folder}/{name}.csv"
    df.write.mode("overwrite").parquet(parquet)
    write_csv(df.sparkSession.read.parquet(parquet), text)
    return parquet, text


def row_and_column_counts(df: DataFrame) -> tuple[int, int]:
    """A14."""
    return df.count(), len(df.columns)


def write_in_order(df: DataFrame, path: str, position: str, *, files: int | None = None) -> None:
    """Q1: rows as Parquet files that follow one another in the order of a unique position, and are ordered inside.

    Each file holds a range of positions, so its statistics tell a reader of some positions which files to open, and files read by
    name give all rows in order. ``files`` is the session's number of shuffle partitions unless it is given.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(files, position).sortWithinPartitions(position).write.mode("overwrite").parquet(path)


def position_ranges(spark: SparkSession, path: str, position: str) -> DataFrame:
    """``(file, first, last, n)`` of a table written in order, from one scan of the position."""
    rows = spark.read.parquet(path).select(F.col(position), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
    return rows.groupBy("file").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count(F.lit(1)).alias("n"))
