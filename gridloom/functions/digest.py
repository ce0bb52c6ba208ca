"""Seeded row digests: the order every shuffle, split, fold and sample is drawn from.

A digest depends on the row and the seed alone, so the order is the same for every partitioning, survives task
retries, and can be restated in any SQL engine that has md5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.columns import ref

_NULL_KEY = "\\N"


def key_digest(seed: object, keys: Sequence[str]) -> Column:
    """md5 of ``seed|key|key...`` as 32 hex digits."""
    parts = [F.coalesce(ref(k).cast("string"), F.lit(_NULL_KEY)) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def row_digest(df: DataFrame, seed: object = "") -> Column:
    """md5 of the whole row; every value is length-prefixed so different rows never read alike."""
    parts = []
    for f in df.schema.fields:
        c = ref(f.name)
        text = F.hex(c) if isinstance(f.dataType, T.BinaryType) else c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def unit_interval(text: Column) -> Column:
    """Uniform draw in [0, 1) from the first 48 bits of md5(text)."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))
