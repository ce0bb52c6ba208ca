"""Helpers shared by the operators: tables, Arrow batches, word hashes and bounded worker caches."""

from __future__ import annotations

import contextlib
import ctypes
import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads of a tokenizer cost it time and memory

#: Word separators: space and the five ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: An id that stands for a null one: larger than all others.
NO_ID = 2**63 - 1
#: Rows of an Arrow batch are handed on in slices of about so many bytes of text, which bounds a worker's memory.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def identified(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``_id`` (a null id counts as the largest), ``_text`` (a null text is empty) and, for named columns, the struct ``_kept``."""
    kept = [F.struct(*keep).alias("_kept")] if keep else []
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *kept)


def given_id(c: Column | str) -> Column:
    """The id as it was given: null again for the stand-in."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != NO_ID, c)


def crc_fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the folds."""
    return F.crc32(id_col.cast("string")) % folds


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds few bytes of text (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            floor = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, floor + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def _binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if v is None else v for v in _binary(column)]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once per application: workers keep caches at module level."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for file in sorted((root / "gridloom").rglob("*.py")):
            z.write(file, file.relative_to(root))
    path = Path(tempfile.mkdtemp(prefix="gridloom-")) / "gridloom.zip"  # on the driver; Spark copies it to the executors
    path.write_bytes(held.getvalue())
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Returns freed memory to the system: a worker waits for its next task with what it holds, not with what it once needed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand; the task's memory is given back at its end."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


class WordCache(dict):
    """Results by word, computed on first use; emptied when full, so that it stays bounded and frequent words return at once."""

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.compute(word)
        return value


#: Marks that end a word in most texts; a split pattern by letters, numbers and other signs always cuts before a run of them.
_MARKS = ".,;:!?"


def without_marks(word: str) -> str:
    """The word without the run of marks at its end; the word itself if what stays doesn't end in a Latin letter."""
    core = word.rstrip(_MARKS)
    return core if core and core != word and core[-1] < "\u0100" and core[-1].isalpha() else word


# Hashes of words and of runs of words ------------------------------------------------------------------------------

_SEPARATES = np.zeros(256, bool)
_SEPARATES[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers of two independent polynomial hashes modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_GRAM_BASES = (0xD6E8FEB86659FD93, 0xA3B195354A39B70D)
#: Texts are hashed in parts of about this many bytes.
_PART = 1 << 20
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    held = _POWERS.get((base, inverse))
    if held is None or len(held) < n:
        b = pow(base, -1, 2**64) if inverse else base
        held = np.empty(max(n, _PART + 1), np.uint64)
        held[0], done = 1, 1
        with np.errstate(over="ignore"):
            while done < len(held):
                m = min(done, len(held) - done)
                held[done : done + m] = held[:m] * np.uint64(pow(b, done, 2**64))
                done += m
        _POWERS[base, inverse] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    inside = np.empty(len(text) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SEPARATES[text]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(text: bytes, base: int = BASES[0]) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    whole = np.frombuffer(text, np.uint8)
    if len(whole) <= _PART:
        return _part_hashes(whole, base)
    found, start = [], 0
    while start < len(whole):
        end = min(len(whole), start + _PART)
        if end < len(whole):
            gaps = np.flatnonzero(_SEPARATES[whole[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:  # a word longer than a part stays whole
                while end < len(whole) and not _SEPARATES[whole[end]]:
                    end += 1
        found.append(_part_hashes(whole[start:end], base))
        start = end
    return np.concatenate(found)


def _part_hashes(text: np.ndarray, base: int) -> np.ndarray:
    start, end = word_spans(text)
    if not len(start):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.empty(len(text) + 1, np.uint64)
        total[0] = 0
        np.cumsum(text.astype(np.uint64) * _powers(base, len(text)), out=total[1:])
        h = (total[end] - total[start]) * _powers(base, len(text) + 1, True)[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def gram_hashes(words: np.ndarray, k: int, base: int = _GRAM_BASES[0]) -> np.ndarray:
    """A 64-bit hash of every run of k words, by doubling; empty when there are fewer words."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, width, done, out = words, 1, 0, None
        rest = k
        while rest:
            if rest & 1:
                piece = power if done == 0 else power[done:] * np.uint64(pow(base, done, 2**64))
                n = len(words) - done - width + 1
                out = piece[:n] if out is None else out[:n] + piece[:n]
                done += width
            rest >>= 1
            if rest:
                power = power[: len(power) - width] + power[width:] * np.uint64(pow(base, width, 2**64))
                width *= 2
        return mix(out + np.uint64(k))


def second_gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    return gram_hashes(words, k, _GRAM_BASES[1])


# Answers to many owners in few rows ---------------------------------------------------------------------------------

#: 16-byte keys of owners: digests, or pairs of 64-bit numbers.
KEY = np.dtype("V16")
OWNED = "bucket int, keys binary, counts binary, a binary, b binary"


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 16-byte keys and the place of each among them."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    halves = np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    ordered = halves[order]
    new = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1)))
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return keys[order[new]], place


def owned(keys: np.ndarray, own: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[tuple]:
    """Rows of ``OWNED``: entries by bucket of their owner, ``own`` being places in ``keys``; a row per bucket, however many owners."""
    if not len(own):
        return []
    bucket = (np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 2)[:, 0] % np.uint64(buckets)).astype(np.int64)[own]
    order = np.lexsort((own, bucket))
    own, bucket, columns = own[order], bucket[order], [c[order] for c in columns]
    edges = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(own)]))
    rows = []
    for lo, hi in zip(edges, edges[1:]):
        mine, n = np.unique(own[lo:hi], return_counts=True)
        blobs = [c[lo:hi].tobytes() for c in columns]
        rows.append((int(bucket[lo]), keys[mine].tobytes(), n.astype("<u4").tobytes(), *blobs, *[None] * (2 - len(blobs))))
    return rows


def owned_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in OWNED.split(", ")])


def by_owner(group: pa.Table, kinds: list[np.dtype | type]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Owners of a bucket, where the entries of each begin (and the last end), and the columns in that order."""
    rows = group.select(["keys", "counts", "a", "b"]).to_pylist()
    names, place = distinct_keys(np.concatenate([np.frombuffer(r["keys"], KEY) for r in rows]))
    own = np.repeat(place, np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows]))
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(len(names) + 1))
    return names, cuts, [np.concatenate([np.frombuffer(r[c], k) for r in rows])[order] for c, k in zip("ab", kinds)]


def as_blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of each run of values."""
    data, cuts = values.tobytes(), (cuts * values.itemsize).tolist()
    return pa.array([data[i:j] for i, j in zip(cuts, cuts[1:])], pa.binary())


def key_array(keys: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in keys], pa.binary())
