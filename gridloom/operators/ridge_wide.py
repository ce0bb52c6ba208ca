"""Ridge regression over vocabularies of any width, by conjugate gradients.

One-hot columns stay lists of the places that hold a one. A round multiplies the standardised columns by a vector and the
result by them again: every task does this for its rows and sends what it adds up in chunks. The driver holds a few vectors
as long as the columns are many, never their products with one another.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import ref, string_columns
from gridloom.operators.encode import SparseOneHot, scale_of
from gridloom.operators.ridge import DEFAULT_ALPHA
from gridloom.sources.scratch import discard, scratch_path, ship_package

#: Rounds at most, and the share of the first residual at which they end.
ROUNDS, TOLERANCE = 2000, 1e-11
#: Sums of a chunk that travels as a row, and rows of a block.
CHUNK, BLOCK_ROWS = 8192, 16_384
_ROWS = "places binary, ends binary, numbers binary, y binary"


@dataclass(frozen=True)
class WideRidge:
    """``coefficients`` are those of the places of the one-hot columns, then of the numbers; all in the scale of the raw columns."""

    encoder: SparseOneHot
    numbers: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float
    rounds: int

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """M8: the frame without its text columns and with a prediction; an unseen category counts as the baseline."""
        ship_package(df.sparkSession)
        coded = self.encoder.apply(df, "_active").withColumn("_numbers", F.array(*[ref(c).cast("double") for c in self.numbers]).cast("array<double>"))
        kept = [c for c in coded.columns if c not in ("_active", "_numbers")]
        shared, width, intercept = df.sparkSession.sparkContext.broadcast(self.coefficients), self.encoder.width, self.intercept

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                active, numbers = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
                guess = np.full(batch.num_rows, intercept)
                places = active.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                np.add.at(guess, np.repeat(np.arange(batch.num_rows), np.diff(active.offsets)), shared.value[places])
                if len(shared.value) > width:
                    guess += numbers.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) @ shared.value[width:]
                yield batch.select(kept).append_column(name, pa.array(guess))

        schema = coded.select(*[ref(c) for c in kept]).schema.add(name, "double")
        return coded.select(*[ref(c) for c in kept], "_active", "_numbers").mapInArrow(run, schema)


class _Rows:
    """The encoded rows as a table of blocks, and the sums over them."""

    def __init__(self, df: DataFrame, active: str, numbers: Sequence[str], target: str, width: int):
        spark = df.sparkSession
        ship_package(spark)
        count = len(numbers)
        self.width, self.size, self.count = width, width + count, count
        source = df.select(ref(active).alias("a"), F.array(*[ref(c).cast("double") for c in numbers]).cast("array<double>").alias("n"), ref(target).cast("double").alias("y"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(start, BLOCK_ROWS)
                    lists = part.column(0)
                    ends = np.cumsum([len(v) for v in lists.to_pylist()]).astype(np.int64)
                    values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)
                    if np.isnan(values).any():
                        raise ValueError("a feature is missing")
                    row = (lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32).tobytes(), ends.tobytes(), values.tobytes(), part.column(2).to_numpy(zero_copy_only=False).tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in row], [c.split()[0] for c in _ROWS.split(", ")])

        self.path = scratch_path(spark, "wide")
        source.mapInArrow(pack, _ROWS).write.parquet(self.path)
        self.df = spark.read.schema(_ROWS).parquet(self.path)

    def sums(self, weight) -> np.ndarray:
        """For each column the sum of its values times ``weight(y, x)``, where ``x(v)`` is a vector times the rows."""
        width, count, size = self.width, self.count, self.size

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for row in batch.to_pylist():
                    places, ends = np.frombuffer(row["places"], np.int32), np.frombuffer(row["ends"], np.int64)
                    y = np.frombuffer(row["y"])
                    numbers = np.frombuffer(row["numbers"]).reshape(len(y), count)
                    own = np.repeat(np.arange(len(y)), np.diff(ends, prepend=0))

                    def times(v: np.ndarray, own=own, places=places, numbers=numbers, n=len(y)) -> np.ndarray:
                        return np.bincount(own, v[places], n) + numbers @ v[width:]

                    t = weight(y, times)
                    total = np.zeros(size) if total is None else total
                    total[:width] += np.bincount(places, t[own], width) if len(places) else 0.0
                    total[width:] += numbers.T @ t
            if total is not None:
                chunks = [(i, total[i * CHUNK : (i + 1) * CHUNK]) for i in range(-(-size // CHUNK))]
                chunks = [(i, c.tobytes()) for i, c in chunks if c.any()]
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in chunks], pa.int32()), pa.array([c[1] for c in chunks], pa.binary())], ["chunk", "part"])

        def join(group: pa.Table) -> pa.Table:
            whole = np.sum([np.frombuffer(p) for p in group["part"].to_pylist()], axis=0)
            return pa.table({"chunk": group["chunk"][:1], "part": pa.array([whole.tobytes()], pa.binary())})

        out = np.zeros(size)
        for r in self.df.mapInArrow(add_up, "chunk int, part binary").groupBy("chunk").applyInArrow(join, "chunk int, part binary").collect():  # one vector
            values = np.frombuffer(r["part"])
            out[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(values)] = values
        return out


def fit_ridge_wide(train: DataFrame, target: str, alpha: float = DEFAULT_ALPHA, *, drop: Sequence[str] = (), rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> WideRidge:
    """M1, E5 for text columns of any number of categories: one-hot them, standardise everything, fit; the intercept is free.

    Rows without a target are left out; a missing number is an error; a missing category is one of its own. ``alpha`` has to be positive.
    """
    if alpha <= 0:
        raise ValueError("the penalty has to be positive")
    train = train.where(ref(target).isNotNull())
    inputs = [c for c in train.columns if c not in {target, *drop}]
    text = string_columns(train.select(*[ref(c) for c in inputs]))
    numbers = tuple(c for c in inputs if c not in text)
    encoder = SparseOneHot.fit(train, text)
    coded = encoder.apply(train.select(*[ref(c) for c in [*inputs, target]]), "_active")
    rows = _Rows(coded, "_active", numbers, target, encoder.width)
    moments = [f(ref(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(numbers) for k, f in (("m", F.avg), ("v", F.var_pop))]
    seen = train.agg(F.count("*").alias("n"), F.avg(ref(target).cast("double")).alias("y"), *moments).first()
    n, middle = seen["n"], seen["y"] or 0.0
    if not n:
        return WideRidge(encoder, numbers, np.zeros(rows.size), 0.0, 0)
    share = rows.sums(lambda y, times: np.ones(len(y)))[: rows.width] / n
    mean = np.concatenate((share, [seen[f"m{i}"] for i in range(len(numbers))]))
    spread = np.concatenate((share - share * share, [seen[f"v{i}"] for i in range(len(numbers))]))
    scale = np.array([scale_of(v, m, n) for v, m in zip(spread.tolist(), mean.tolist())])
    answer = np.zeros(rows.size)
    left = rows.sums(lambda y, times: y - middle) / scale  # the deviations add up to zero, so means of columns drop out
    way, size, first, used = left.copy(), float(left @ left), float(left @ left), 0
    while used < rounds and size > tolerance**2 * first:
        raw = way / scale
        shift = float(mean @ raw)
        product = rows.sums(lambda y, times, raw=raw, shift=shift: times(raw) - shift) / scale + alpha * way
        step = size / float(way @ product)
        answer += step * way
        left -= step * product
        size, before = float(left @ left), size
        way = left + size / before * way
        used += 1
    discard(train.sparkSession, rows.path)
    coefficients = answer / scale
    return WideRidge(encoder, numbers, coefficients, float(middle - coefficients @ mean), used)
