"""Exact, linearly interpolated quantiles of columns of any size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import ref
from gridloom.functions.numeric import to_number
from gridloom.operators.order import SORT_ROWS, running_total

DIRECT_ROWS = 100_000  # rows up to which the built-in percentile may hold a column's values in one task
_ACCURACY = 10_000  # of the approximate percentiles that bracket the exact ones
_SLACK = 2.0 / _ACCURACY


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    *,
    counts: dict[str, int] | None = None,
    direct_rows: int = DIRECT_ROWS,
    sort_rows: int = SORT_ROWS,
) -> dict[str, list[float | None]]:
    """``{column: [quantile per fraction]}`` over present values, interpolated between neighbours.

    The built-in ``percentile`` keeps all distinct values of a column in one task, so it serves tables of checked
    size only. Larger ones are bracketed by approximate percentiles; the few values inside a bracket are counted,
    ordered by range buckets, and the wanted ranks read off. Every step is one distributed aggregate.
    """
    columns = list(columns)
    numbers = df.select(*[to_number(ref(c), df.schema[c].dataType).alias(c) for c in columns])
    if counts is None:
        row = numbers.agg(*[F.count(ref(c)).alias(c) for c in columns]).first()
        counts = {c: row[c] for c in columns}
    answers: dict[str, list[float | None]] = {c: [None] * len(fractions) for c in columns}
    present = [c for c in columns if counts[c]]
    if not present:
        return answers
    if max(counts[c] for c in present) <= direct_rows:
        wanted = F.array(*[F.lit(float(q)) for q in fractions])
        row = numbers.agg(*[F.percentile(ref(c), wanted).alias(c) for c in present]).first()
        return {**answers, **{c: list(row[c]) for c in present}}

    brackets = _brackets(numbers, present, fractions)
    ranks = {}
    for c in present:
        for i, q in enumerate(fractions):
            position = (counts[c] - 1) * q
            ranks[c, i] = (floor(position), ceil(position), position - floor(position))
    below, inside = _count_brackets(numbers, brackets)
    for slot, (first, last, _) in ranks.items():
        if not below[slot] <= first <= last < below[slot] + inside[slot]:
            brackets[slot] = (float("-inf"), float("inf"))  # the approximation missed: take the whole column
            below[slot], inside[slot] = 0, counts[slot[0]]
    # a bracket of one value needs no further look
    values = {(*slot, rank): low for slot, (low, high) in brackets.items() if low == high for rank in ranks[slot][:2]}
    wide = {slot: bracket for slot, bracket in brackets.items() if bracket[0] != bracket[1]}
    if wide:
        few = sum(inside[s] for s in wide) <= direct_rows
        values |= _values_at(numbers, wide, below, {s: ranks[s][:2] for s in wide}, sort_rows, few)
    for (c, i), (first, last, weight) in ranks.items():
        low, high = values[c, i, first], values[c, i, last]
        answers[c][i] = low + (high - low) * weight
    return answers


def _brackets(numbers: DataFrame, columns: list[str], fractions: Sequence[float]) -> dict:
    points = [p for q in fractions for p in (max(0.0, q - _SLACK), min(1.0, q + _SLACK))]
    wanted = F.array(*[F.lit(p) for p in points])
    row = numbers.agg(*[F.percentile_approx(ref(c), wanted, _ACCURACY).alias(c) for c in columns]).first()
    return {(c, i): (row[c][2 * i], row[c][2 * i + 1]) for c in columns for i in range(len(fractions))}


def _count_brackets(numbers: DataFrame, brackets: dict) -> tuple[dict, dict]:
    parts = []
    for (c, i), (low, high) in brackets.items():
        parts.append(F.count_if(ref(c) < low).alias(f"below|{c}|{i}"))
        parts.append(F.count_if(ref(c).between(low, high)).alias(f"inside|{c}|{i}"))
    row = numbers.agg(*parts).first()
    return (
        {s: row[f"below|{s[0]}|{s[1]}"] for s in brackets},
        {s: row[f"inside|{s[0]}|{s[1]}"] for s in brackets},
    )


def _values_at(numbers: DataFrame, brackets: dict, below: dict, ranks: dict, sort_rows: int, few: bool) -> dict:
    slots = list(brackets)
    names = list(dict.fromkeys(c for c, _ in slots))
    bounds = [(names.index(c), *brackets[c, i]) for c, i in slots]

    # in numpy, since generated code that compares many expressions with many brackets is too large to be compiled
    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(names))]  # NaN for null
            for k, (c, low, high) in enumerate(bounds):
                near, n = np.unique(columns[c][(columns[c] >= low) & (columns[c] <= high)] + 0.0, return_counts=True)
                if len(near):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), k), pa.int32()), pa.array(near), pa.array(n, pa.int64())], ["slot", "value", "n"])

    found_here = numbers.select(*[ref(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)]).mapInArrow(inside, "slot int, value double, n long")
    counted = found_here.groupBy("slot", "value").agg(F.sum("n").alias("n"))
    found = {}

    def read_off(k: int, value: float, before: int, n: int) -> None:
        for rank in ranks[slots[k]]:
            if before <= rank - below[slots[k]] < before + n:
                found[(*slots[k], rank)] = value

    if few:  # the brackets hold no more rows than one task may hold anyway
        seen: dict[int, int] = {}
        for r in sorted(counted.collect(), key=lambda r: (r["slot"], r["value"])):
            before = seen.get(r["slot"], 0)
            read_off(r["slot"], r["value"], before, r["n"])
            seen[r["slot"]] = before + r["n"]
        return found
    placed, _ = running_total(counted, "value", "n", "before", ["slot"], sort_rows=sort_rows)
    hits = []
    for k, slot in enumerate(slots):
        for rank in sorted(set(ranks[slot])):
            at = rank - below[slot]
            hits.append((F.col("slot") == k) & (F.col("before") <= at) & (F.col("before") + F.col("n") > at))
    for r in placed.where(reduce(lambda a, b: a | b, hits)).collect():  # at most two rows per column and fraction
        read_off(r["slot"], r["value"], r["before"], r["n"])
    return found
