"""Collocations: phrases whose words occur together far oftener than apart, by SON partitioning.

A phrase that occurs ``support`` times in a language occurs at least ``support / SHARDS`` times in one of ``SHARDS`` shards.

1. Each shard (the tasks of equal number modulo ``SHARDS``) is mined completely at that lowered support, first for words and
   pairs, then for longer phrases, all of whose pairs must be among the locally frequent ones of some shard. Tasks count
   hashes of phrases, combined before they are sent; a shard's hashes are dealt over many tasks, so no shard has to fit into one.
2. Locally frequent phrases of all shards are united as bits of a map of fixed size, so whatever their number, a bounded
   broadcast. Two phrases on one bit, or of one hash, only let a rare phrase through.
3. All phrases on the map are counted globally, by language and by their words themselves: counts are exact, and what falls short of
   the support goes.

The parts of a frequent phrase are frequent too, so the counts needed for the scores are among those of the third step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import BASES, _powers, map_arrow, mix, ship, slices, texts_as_bytes
from gridloom.sources.scratch import written

SUPPORT, LONGEST, FIRST_ROWS = 100, 5, 2000
#: Shards mined by themselves.
SHARDS = 8
#: Bits of the map of locally frequent phrases: 32 MB when broadcast.
MAP_BITS = 1 << 28
#: Entries a task gathers before it sends them.
FLUSH_ENTRIES = 4_000_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: What a byte is: part of a word, a space, or a break between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2
_PART = 1 << 20
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
UNKNOWN = "und"


class Words:
    """Words of texts of one language, in order: where they lie, the piece they are in, and a hash of each."""

    def __init__(self, texts: list[bytes], seed: int):
        self.data = b"\n".join(texts).translate(_LOWER)
        data = np.frombuffer(self.data, np.uint8)
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kind == 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        breaks = np.flatnonzero(kind == 2)
        self.piece = np.searchsorted(breaks, self.start)
        self.hash = self._hashes(data, seed)

    def _hashes(self, data: np.ndarray, seed: int) -> np.ndarray:
        found, lo = [np.empty(0, np.uint64)], 0
        while lo < len(self.start):  # in parts that end with a word
            hi = max(lo + 1, int(np.searchsorted(self.end, self.start[lo] + _PART, "right")))
            at, to = int(self.start[lo]), int(self.end[hi - 1])
            start, end = self.start[lo:hi] - at, self.end[lo:hi] - at
            with np.errstate(over="ignore"):
                total = np.zeros(to - at + 1, np.uint64)
                np.cumsum(data[at:to].astype(np.uint64) * _powers(BASES[0], to - at), out=total[1:])
                h = (total[end] - total[start]) * _powers(BASES[0], to - at + 1, True)[start]
                found.append(mix(h + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019) + np.uint64(seed)))
            lo = hi
        return np.concatenate(found)

    def phrases(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all phrases of k words within a piece, and their hashes."""
        n = len(self.hash) - k + 1
        if n < 1:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        if k == 1:
            return np.arange(n), self.hash
        first = np.flatnonzero(self.piece[:n] == self.piece[k - 1 :])
        with np.errstate(over="ignore"):
            h = np.full(len(first), k, np.uint64)
            for i in range(k):
                h += self.hash[first + i] * np.uint64(_PLACES[i])
        return first, mix(h)

    def text(self, first: int, k: int) -> bytes:
        return b" ".join(self.data[self.start[i] : self.end[i]] for i in range(first, first + k))


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for batch in slices(batches, 1):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            yield lang, Words(own, _seed(lang))


def _seed(lang: str) -> int:
    """A seed of 64 bits, so that equal words of two languages differ."""
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class FrequentMap:
    """Bits of the hashes of phrases."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, 64 * len(bits)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h % np.uint64(self.size)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _pairs_held(words: Words, pairs: FrequentMap) -> np.ndarray:
    """By word: whether the pair that begins with it may be frequent."""
    first, h = words.phrases(2)
    held = np.zeros(len(words.hash), bool)
    held[first] = pairs.holds(h)
    return held


def _longer(words: Words, held: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of k words whose pairs may all be frequent."""
    first, h = words.phrases(k)
    good = held[first] if len(first) else np.empty(0, bool)
    for i in range(1, k - 1):
        good = good & held[first + i]
    return first[good], h[good]


class _Counts:
    """Counts of hashes, to be sent to the tasks that mine the shard."""

    def __init__(self, buckets: int, shards: int):
        self.buckets, self.shard = buckets, TaskContext.get().partitionId() % shards
        self.parts, self.held = [], 0

    def add(self, h: np.ndarray) -> None:
        self.parts.append(h)
        self.held += len(h)

    def rows(self) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate([*self.parts, np.empty(0, np.uint64)]), return_counts=True)
        self.parts, self.held = [], 0
        edges = np.array([(i << 64) // self.buckets for i in range(self.buckets)], np.uint64)
        cuts = np.searchsorted(found, edges).tolist() + [len(found)]
        some = [i for i in range(self.buckets) if cuts[i] < cuts[i + 1]]
        n = np.minimum(n, 2**32 - 1).astype("<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array([i * 4096 + self.shard for i in some], pa.int64()), pa.array([found[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
             pa.array([n[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary())], ["bucket", "hashes", "counts"],
        )


def frequent_somewhere(counted: DataFrame, least: float, bits: int) -> np.ndarray:
    """The map of all hashes that reach ``least`` in a shard, from rows of ``_Counts``."""

    def mine(group: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(b, np.uint64) for b in group["hashes"].to_pylist()])
        counts = np.concatenate([np.frombuffer(b, "<u4") for b in group["counts"].to_pylist()])
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order].astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        at = np.unique(hashes[new[np.add.reduceat(counts, new) >= least]] % np.uint64(bits))
        word, first = np.unique(at >> np.uint64(6), return_index=True)
        mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else np.empty(0, np.uint64)
        return pa.table({"word": pa.array(word.astype(np.int64)), "mask": pa.array(mask.view(np.int64))})

    mined = counted.groupBy("bucket").applyInArrow(mine, "word long, mask long")
    united = written(mined.groupBy("word").agg(F.bit_or("mask").alias("mask")), "frequent")
    out = np.zeros(bits // 64, np.uint64)
    table = united.toArrow()  # at most a row for each word of the map
    out[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return out


def count_phrases(docs: DataFrame, support: int, longest: int, shards: int, bits: int) -> DataFrame:
    """``lang, phrase, f`` of all phrases (words too) that occur ``support`` times, and ``n`` of each language where ``phrase`` is null."""
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(buckets, shards)
        for _, words in _by_language(batches):
            counts.add(words.hash)
            counts.add(words.phrases(2)[1])
            if counts.held >= FLUSH_ENTRIES:
                yield counts.rows()
        yield counts.rows()

    rows = "bucket long, hashes binary, counts binary"
    least = support / shards
    pairs = spark.sparkContext.broadcast(FrequentMap(frequent_somewhere(map_arrow(docs, short, rows), least, bits)))

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(buckets, shards)
        for _, words in _by_language(batches):
            held = _pairs_held(words, pairs.value)
            for k in range(3, longest + 1):
                counts.add(_longer(words, held, k)[1])
            if counts.held >= FLUSH_ENTRIES:
                yield counts.rows()
        yield counts.rows()

    longer = spark.sparkContext.broadcast(FrequentMap(frequent_somewhere(map_arrow(docs, long, rows), least, bits)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _by_language(batches):
            total = np.array([len(words.hash)], "<u8")
            found = [(np.zeros(1, np.int64), [b""], total)]  # all words, under no phrase
            held = _pairs_held(words, pairs.value)
            for k in range(1, longest + 1):
                first, h = _longer(words, held, k) if k > 2 else words.phrases(k)
                good = (longer if k > 2 else pairs).value.holds(h)
                first, h = first[good], h[good]
                order, new = _groups(h, words, first, k)
                n = np.diff(np.concatenate((new, [len(h)]))).astype("<u8")
                found.append(((h[order[new]] % np.uint64(buckets)).astype(np.int64), [words.text(i, k) for i in first[order[new]].tolist()], n))
            yield _dealt(lang, found, buckets)

    def add_up(group: pa.Table) -> pa.Table:
        counts: dict[tuple[str, bytes], int] = {}
        for lang, phrases, n in zip(*(group[c].to_pylist() for c in ("lang", "phrases", "counts"))):
            for phrase, f in zip(phrases.split(b"\n"), np.frombuffer(n, "<u8").tolist()):
                counts[lang, phrase] = counts.get((lang, phrase), 0) + f
        kept = [(lang, p.decode() or None, f) for (lang, p), f in counts.items() if f >= support or not p]
        return pa.table([pa.array([r[i] for r in kept], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "phrase", "f"])

    dealt = map_arrow(docs, count, "bucket long, lang string, phrases binary, counts binary")
    return dealt.groupBy("bucket").applyInArrow(add_up, "lang string, phrase string, f long")


def _dealt(lang: str, found: list[tuple], buckets: int) -> pa.RecordBatch:
    """Phrases with their counts, in a row per bucket: no phrase holds the line break that parts them."""
    phrases = [p for _, own, _ in found for p in own]
    bucket, n = (np.concatenate([f[i] for f in found]) for i in (0, 2))
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    some, places, n = [i for i in range(buckets) if cuts[i] < cuts[i + 1]], order.tolist(), n[order]
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int64()), pa.array([lang] * len(some), pa.string()),
         pa.array([b"\n".join([phrases[j] for j in places[cuts[i] : cuts[i + 1]]]) for i in some], pa.binary()),
         pa.array([n[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary())], ["bucket", "lang", "phrases", "counts"],
    )


def _groups(h: np.ndarray, words: Words, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal phrases together, and where each begins in it; told apart by a second hash, too."""
    if not len(h):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        again = np.zeros(len(first), np.uint64)
        for i in range(k):
            again = mix(again + words.hash[first + i])
    order = np.argsort(h, kind="stable")
    other = again[order][1:] != again[order][:-1]
    new = h[order][1:] != h[order][:-1]
    if (other & ~new).any():
        order = np.lexsort((again, h))
        other, new = again[order][1:] != again[order][:-1], h[order][1:] != h[order][:-1]
    return order, np.flatnonzero(np.concatenate(([True], new | other)))


def with_score(df: DataFrame) -> DataFrame:
    """``score`` from whole numbers ``a, n, l, r``, in 38 digits: exact while a and n are below 10 ** 17."""
    big = lambda c: F.col(c).cast("decimal(18,0)")
    return df.withColumn("_x", F.lit(1000).cast("decimal(4,0)") * big("a") * big("n")).withColumn("_y", big("l") * big("r")).withColumn("score", F.expr("_x div _y")).drop("_x", "_y")


def collocations(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, longest: int = LONGEST, first_rows: int = FIRST_ROWS,
    shards: int = SHARDS, bits: int = MAP_BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of 2 to ``longest`` words.

    Texts (null: empty) with A-Z lower-cased are split into pieces at ``.,;:!?`` and line breaks, and those into words at spaces and tabs. A
    phrase of ``a`` occurrences is cut where ``floor(1000 * a * n / (l * r))`` is least, ``l`` and ``r`` being the occurrences of its
    parts and ``n`` all words of its language (null: ``und``). Phrases inside a longer one of as many occurrences go. Ties go to
    more occurrences, then to the phrase of lesser bytes. Repeated rows count as often as they come; other columns are dropped;
    an empty table, or one without frequent phrases, gives no rows.
    """
    ship(df.sparkSession)
    docs = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = written(count_phrases(docs, support, longest, shards, bits), "phrases")
    totals = known.where("phrase is null").select("lang", F.col("f").alias("n"))
    counts = known.where("phrase is not null")
    size = F.size(F.split("phrase", " ", -1))
    candidates = counts.withColumn("size", size).where("size >= 2")
    words, k = F.split("phrase", " ", -1), F.col("k")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, 1, k), " ").alias("left"), F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("right"),
    )
    left, right = (counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0])) for side in ("left", "right"))
    parts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    parts = with_score(parts)
    scored = parts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("best"))
    # counts never rise with length, so a longer phrase of as many occurrences shows in steps of one word
    longer = candidates.where("size >= 3")
    inner = F.explode(F.array(F.array_join(F.slice(words, 1, F.col("size") - 1), " "), F.array_join(F.slice(words, 2, F.col("size") - 1), " ")))
    within = longer.select("lang", inner.alias("phrase"), F.col("f").alias("a")).distinct()
    free = scored.select("lang", "phrase", "best.*").join(within, ["lang", "phrase", "a"], "left_anti")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return free.withColumn("rank", place.cast("long")).where(F.col("rank") <= first_rows).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
