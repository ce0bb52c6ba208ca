"""Substring deduplication: a count-min sketch rules out most windows, a second pass groups the rest exactly.

A window is ``window`` consecutive words. Its anchor is the least hash among its runs of ``window // 2`` words, so equal
windows have equal anchors, and one anchor stands for some thirteen windows in a row.

1. Every task lists the distinct anchors of its documents, dealt by hash to shards, one entry per document. A shard adds them
   up in a count-min sketch of its own; sketches of partitions are not built or merged. Estimates are never below the number
   of documents with the anchor, hence never below that of a window. Anchors estimated twice or more go back to their documents.
2. Windows with such an anchor are grouped exactly by a 128-bit digest of their words, again in shards. Of the equal windows
   a task holds, only those of its smallest document are sent; the others are already known to repeat an earlier one. So a
   window that every document has is sent once per task, and no group grows hot.

Positions found repeated go back to their documents, and words they cover are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import (
    BASES, KEY, OWNED, as_blobs, by_owner, given_id, gram_hashes, identified, map_arrow, owned, owned_table, second_gram_hashes, ship, slices, texts_as_bytes, word_hashes,
)

WINDOW = 50
#: Rows of the count-min sketch, and its cells per anchor in each row.
DEPTH, CELLS_PER_ANCHOR = 2, 8
#: Entries a task gathers before it sends them to the shards.
FLUSH_ENTRIES = 1_000_000
_ROWS = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)
_SHARDED = "shard int, docs binary, at binary, a binary, b binary, c binary"
_PER_DOC = "_id long, _print long, found binary"


def shard_count(spark: SparkSession) -> int:
    """The session's shuffle partitions, which are to be sized for the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    least, have = values, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors(words: np.ndarray, window: int) -> np.ndarray:
    """The anchor of each window, by its first word."""
    k = max(1, window // 2)
    return sliding_least(gram_hashes(words, k), window - k + 1)


class _Sender:
    """Gathers entries of documents and hands them on by shard."""

    def __init__(self, shards: int):
        self.shards, self.docs, self.parts, self.held = shards, [], [], 0

    def add(self, doc: tuple[int, int], anchor: np.ndarray, *columns: np.ndarray) -> None:
        """Entries of one document; those of equal anchor meet in a shard, so neighbours mostly travel together."""
        self.parts.append((np.full(len(anchor), len(self.docs), np.uint32), anchor, *columns))
        self.docs.append(doc)
        self.held += len(anchor)

    def rows(self, resolve=None) -> Iterator[pa.RecordBatch]:
        """Rows for the shards; ``resolve`` first says which entries need not be sent."""
        if not self.held:
            self.docs, self.parts = [], []
            return
        at, anchor, *columns = (np.concatenate(c) for c in zip(*self.parts))
        docs = np.array(self.docs, np.int64)
        self.docs, self.parts, self.held = [], [], 0
        if resolve is not None:
            known = resolve(docs[:, 0][at], *columns)
            yield self._row_batch(docs, at[known], [columns[-1][known]], None)
            at, anchor, columns = at[~known], anchor[~known], [c[~known] for c in columns]
        yield self._row_batch(docs, at, columns or [anchor], anchor % np.uint64(self.shards))

    def _row_batch(self, docs: np.ndarray, at: np.ndarray, columns: list[np.ndarray], shard: np.ndarray | None) -> pa.RecordBatch:
        made = []
        if shard is None:  # already resolved: any shard passes them on
            made = [(int(docs[at[0], 0] % self.shards), *_packed(docs, at, [None, None, *columns]))] if len(at) else []
        else:
            order = np.argsort(shard, kind="stable")
            shard = shard[order]
            edges = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)])) if len(shard) else [0]
            for lo, hi in zip(edges, edges[1:]):
                take = order[lo:hi]
                made.append((int(shard[lo]), *_packed(docs, at[take], [c[take] for c in columns])))
        made = [(*row, *[None] * (6 - len(row))) for row in made]
        kinds = [pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], k) for i, k in enumerate(kinds)], ["shard", "docs", "at", "a", "b", "c"])


def _packed(docs: np.ndarray, at: np.ndarray, columns: list[np.ndarray | None]) -> list[bytes | None]:
    """The documents, how many entries each has (these come document by document), and the columns."""
    own, n = np.unique(at, return_counts=True)
    return [docs[own].tobytes(), n.astype("<u4").tobytes(), *(None if c is None else c.tobytes() for c in columns)]


def _unpacked(batch: pa.Table) -> list[tuple]:
    """Per row: documents (id, print), entry's document, and the columns a, b, c."""
    kinds = {"a": np.uint64, "b": np.uint64, "c": np.uint32}
    rows = []
    for row in batch.select(["docs", "at", "a", "b", "c"]).to_pylist():
        docs, n = np.frombuffer(row["docs"], np.int64).reshape(-1, 2), np.frombuffer(row["at"], "<u4")
        rows.append((docs, np.repeat(np.arange(len(docs)), n), *(None if row[c] is None else np.frombuffer(row[c], k) for c, k in kinds.items())))
    return rows


def _to_documents(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], buckets: int) -> pa.Table:
    """Entries (documents, places in them, values) on their way back, in a row per bucket of documents."""
    if not parts:
        return owned_table([])
    first = np.cumsum([0] + [len(docs) for docs, _, _ in parts])
    keys = np.concatenate([docs for docs, _, _ in parts]).view(KEY).ravel()
    own = np.concatenate([at + start for (_, at, _), start in zip(parts, first)])
    return owned_table(owned(keys, own, [np.concatenate([values for _, _, values in parts])], buckets))


def _per_document(found: DataFrame, kind: type) -> DataFrame:
    """``_id, _print, found``: all values of a document in one row."""

    def sort(group: pa.Table) -> pa.Table:
        names, cuts, (values,) = by_owner(group, [kind])
        docs = names.view(np.int64).reshape(-1, 2)
        return pa.table({"_id": pa.array(docs[:, 0]), "_print": pa.array(docs[:, 1]), "found": as_blobs(values, cuts)})

    return found.groupBy("bucket").applyInArrow(sort, _PER_DOC)


def count_min_estimates(keys: np.ndarray) -> np.ndarray:
    """For each entry, the least of its counters in a sketch of all entries: at least the number of equal keys."""
    bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * CELLS_PER_ANCHOR))))
    estimate = None
    for row in _ROWS[:DEPTH]:
        with np.errstate(over="ignore"):
            cell = ((keys * np.uint64(row)) >> np.uint64(64 - bits)).astype(np.int64)
        counts = np.bincount(cell, minlength=1 << bits)[cell]
        estimate = counts if estimate is None else np.minimum(estimate, counts)
    return estimate


def repeated_anchors(docs: DataFrame, window: int) -> DataFrame:
    """``_id, _print, found``: anchors of the document that a sketch estimates in two documents or more (64-bit, as bytes)."""
    shards = shard_count(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(shards)
        for batch in slices(batches, 2):
            for doc, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), texts_as_bytes(batch.column(2))):
                own = np.unique(anchors(word_hashes(text), window))
                if len(own):
                    sender.add(doc, own)
                if sender.held >= FLUSH_ENTRIES:
                    yield from sender.rows()
        yield from sender.rows()

    def estimate(group: pa.Table) -> pa.Table:
        rows = _unpacked(group)
        counted = count_min_estimates(np.concatenate([r[2] for r in rows]))
        parts, start = [], 0
        for docs, at, keys, _, _ in rows:
            twice = counted[start : start + len(keys)] >= 2
            start += len(keys)
            parts.append((docs, at[twice], keys[twice]))
        return _to_documents(parts, shards)

    return _per_document(map_arrow(docs, send, _SHARDED).groupBy("shard").applyInArrow(estimate, OWNED), np.uint64)


def _later_copies(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries whose digest also occurs under a smaller id."""
    order = np.lexsort((ids, b, a))
    a, b, ids = a[order], b[order], ids[order]
    first = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    least = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    later = np.empty(len(ids), bool)
    later[order] = ids > least
    return later


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """``_id, _print, found``: first words (32-bit, as bytes) of windows that also start in a document of smaller id."""
    spark = docs.sparkSession
    shards = shard_count(spark)
    candidates = docs.join(repeated_anchors(docs, window), ["_id", "_print"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(shards)
        for batch in slices(batches, 2):
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for doc, text, found in zip(keys, texts_as_bytes(batch.column(2)), batch.column(3).to_pylist()):
                words = word_hashes(text)
                suspect = np.frombuffer(found, np.uint64)
                own = anchors(words, window)
                at = np.flatnonzero(np.isin(own, suspect))
                if len(at):
                    sender.add(doc, own[at], gram_hashes(words, window)[at], second_gram_hashes(word_hashes(text, BASES[1]), window)[at], at.astype(np.uint32))
                if sender.held >= FLUSH_ENTRIES:
                    yield from sender.rows(lambda ids, a, b, _: _later_copies(ids, a, b))
        yield from sender.rows(lambda ids, a, b, _: _later_copies(ids, a, b))

    def settle(group: pa.Table) -> pa.Table:
        rows = _unpacked(group)
        parts = [(docs, at, c) for docs, at, a, _, c in rows if a is None]
        open_rows = [r for r in rows if r[2] is not None]
        if open_rows:
            later = _later_copies(np.concatenate([docs[:, 0][at] for docs, at, *_ in open_rows]), *(np.concatenate([r[i] for r in open_rows]) for i in (2, 3)))
            start = 0
            for docs, at, _, _, c in open_rows:
                mine = later[start : start + len(at)]
                start += len(at)
                parts.append((docs, at[mine], c[mine]))
        return _to_documents(parts, shards)

    sent = map_arrow(candidates.select("_id", "_print", "_text", "found"), send, _SHARDED)
    return _per_document(sent.groupBy("shard").applyInArrow(settle, OWNED), np.uint32)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """``id_col, n_words, n_removed, kept_text`` and the columns named in ``keep``, a row per row.

    Words are runs of other characters than space and the controls from tab to carriage return. A word goes when a window
    that covers it also starts in a document with a smaller id; windows are judged on the input. Kept words are joined by
    one space; with ``as_is``, texts that lose nothing come back unchanged. Null and empty texts have no words; texts shorter than a window lose none; documents of equal id never
    shorten each other; a null id counts as the largest and comes back null. Columns not named in ``keep`` are dropped.
    """
    ship(df.sparkSession)
    named = identified(df, id_col, text_col, keep)
    docs = named.select("_id", F.xxhash64("_text").alias("_print"), "_text", *(["_kept"] if keep else []))
    found = repeated_windows(docs.select("_id", "_print", "_text"), window)
    joined = docs.join(found, ["_id", "_print"], "left").select("_id", "_text", "found", *(["_kept"] if keep else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            total, gone, kept = [], [], []
            for text, found in zip(texts_as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                total.append(len(words))
                if found:
                    at = np.unique(np.frombuffer(found, np.uint32)).astype(np.int64)
                    edges = np.zeros(len(words) + 1, np.int32)
                    edges[at] += 1
                    edges[at + window] -= 1
                    stays = np.cumsum(edges)[:-1] == 0
                    words = list(compress(words, stays.tolist()))
                gone.append(total[-1] - len(words))
                kept.append(text if as_is and not gone[-1] else b" ".join(words))
            columns = [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([batch.column(3)] if keep else []), ["_id", "n_words", "n_removed", "kept_text"] + (["_kept"] if keep else []))

    schema = "_id long, n_words long, n_removed long, kept_text string" + (f", _kept {joined.schema['_kept'].dataType.simpleString()}" if keep else "")
    cleaned = map_arrow(joined, cut, schema)
    return cleaned.select(given_id("_id").alias(id_col), "n_words", "n_removed", "kept_text", *(["_kept.*"] if keep else []))
