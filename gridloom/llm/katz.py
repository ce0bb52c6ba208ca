"""Katz backoff language model of word runs (three words by default): counted, normalised and evaluated by shards.

A run seen r times keeps ``d_r * r`` of its count: Good-Turing's discount for r up to ``LARGEST``, half a count off beyond, so that every
context frees something. What is freed goes to the words never seen after the context, in proportion to their probability after
the shorter context, with a weight that makes the distribution of every context sum to one. Single words are discounted by the same
rule; what they free is the share of all unknown words together. A probability is evaluated recursively: the run if seen, else
the weight of its context times the run without its first word. A document begins with as many marks as a context is long.

Texts are hashed once, to units of some million tokens stored in the shared folder (a dictionary and numbers into it). Then

1. for words, pairs and so on, units send their distinct runs with counts to shards, which answer with the counts of the corpus,
   whether a held-out text has the run, and which unit owns it. From three words on most runs need not travel: one with a part that
   occurs once in the training texts and in no held-out one occurs once itself, and one with an unseen part is unseen;
2. with the answers, a unit sums what it can of its documents' scores, and sends for each context that held-out texts have what its
   own runs free and what they have in the shorter context, with the places where the context met an unseen word. The shard of the
   context adds up the first, which gives the weight, and returns the second as parts of scores.

Answers are tables with a row per unit and shard. A run that every document has is one entry per unit, so nothing grows hot,
and no table passes through the driver, which sees totals and counts of counts only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import give_back, given_id, identified, map_arrow, mix, slices, texts_as_bytes, word_hashes
from gridloom.sources.scratch import written

#: Words of the longest runs.
ORDER = 3
#: Counts up to this have a Good-Turing discount.
LARGEST = 5
#: Tokens of a unit.
UNIT_TOKENS = 1_500_000
#: Stand for the end of a document as a token, and its beginning as a context.
END, BEGIN = np.uint64(1), np.uint64(2)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_OWNER, _WANTED = np.uint64(1 << 63), np.uint64(1 << 62)


def _pack(a: np.ndarray) -> bytes:
    """Compressed, byte by byte of all numbers, which suits small ones."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel() if len(planes) else np.empty(0, kind)


def discounts(seen: list[int], largest: int = LARGEST) -> np.ndarray:
    """``d_1 .. d_largest`` from the numbers of runs seen once, twice, ... ``largest + 1`` times.

    Where the counts of counts are too few for Good-Turing (a discount outside 0 to 1), half a count is taken off instead.
    """
    r = np.arange(1, largest + 1)
    n = np.array(seen, float)
    halved = (r - 0.5) / r
    if len(n) < largest + 1 or n[0] == 0:
        return halved
    common = (largest + 1) * n[largest] / n[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        d = ((r + 1) * n[1 : largest + 1] / (r * n[:largest]) - common) / (1 - common)
    return np.where(np.isfinite(d) & (d > 0) & (d < 1), d, halved)


def stays(count: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return np.where(count <= len(kept), kept[np.clip(count, 1, len(kept)) - 1] * count, count - 0.5)


@dataclass
class Runs:
    """Distinct runs of one length in a unit: hash, places of the run without its last and without its first word, and which run ends
    at each token. The place after the last stands for the marks of a document's beginning."""

    hashes: np.ndarray
    prefix: np.ndarray | None
    suffix: np.ndarray | None
    at: np.ndarray


@dataclass
class Known:
    """What the corpus knows of a unit's runs: counts in training texts, whether this unit owns it, whether a held-out text has it."""

    count: np.ndarray
    owned: np.ndarray
    wanted: np.ndarray


class Unit:
    """Documents of a unit: ids, held-out marks, and tokens as numbers into a dictionary of word hashes."""

    def __init__(self, ids: np.ndarray, held: np.ndarray, lengths: np.ndarray, words: np.ndarray, tokens: np.ndarray):
        self.ids, self.held, self.lengths, self.words, self.tokens = ids, held, lengths, words, tokens
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.training = ~held[self.doc]

    @classmethod
    def of(cls, ids: list[int], held: list[bool], hashes: list[np.ndarray]) -> Unit:
        flat = np.concatenate([part for h in hashes for part in (h, [END])]).astype(np.uint64)
        words, at, n = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent words get small numbers
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        return cls(np.array(ids, np.int64), np.array(held, bool), np.array([len(h) + 1 for h in hashes], np.uint32), words[order], place[at])

    def row(self) -> tuple[bytes, ...]:
        return self.ids.tobytes(), self.held.tobytes(), _pack(self.lengths), self.words.tobytes(), _pack(self.tokens)

    @classmethod
    def read(cls, ids: bytes, held: bytes, lengths: bytes, words: bytes, tokens: bytes) -> Unit:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(held, bool), _unpack(lengths, np.uint32), np.frombuffer(words, np.uint64), _unpack(tokens, np.uint32))

    def runs(self, order: int) -> list[Runs]:
        """Runs of 1 to ``order`` words."""
        levels = [Runs(self.words, None, None, self.tokens)]
        starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        hashed = mix(self.words)
        for _ in range(1, order):
            low = levels[-1]
            before = np.empty(len(self.tokens), np.int64)
            before[1:] = low.at[:-1]
            before[starts] = len(low.hashes)
            code, first, at = np.unique(before * len(self.words) + self.tokens, return_index=True, return_inverse=True)
            prefix, word = code // len(self.words), code % len(self.words)
            with np.errstate(over="ignore"):
                hashes = mix(np.append(low.hashes, BEGIN)[prefix] * np.uint64(0x9E3779B97F4A7C15) + hashed[word])
            levels.append(Runs(hashes, prefix.astype(np.uint32), low.at[first], at.astype(np.uint32)))
        return levels


_UNIT = "unit long, ids binary, held binary, lengths binary, words binary, tokens binary"
_ANSWER = "unit long, kind int, shard int, body binary, totals array<long>"


def encoded(docs: DataFrame, unit_tokens: int) -> DataFrame:
    """Units of ``_id, _text, _held``."""
    names = [c.split()[0] for c in _UNIT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, marks, hashes, tokens = TaskContext.get().partitionId() << 32, [], [], [], 0

        def made() -> pa.RecordBatch:
            row = (number, *Unit.of(ids, marks, hashes).row())
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i == 0 else pa.binary()) for i, v in enumerate(row)], names)

        for batch in slices(batches, 1):
            for doc, text, held in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                ids.append(doc)
                marks.append(held)
                hashes.append(word_hashes(text.translate(_LOWER)))
                tokens += len(hashes[-1]) + 1
                if tokens >= unit_tokens:
                    yield made()
                    number, ids, marks, hashes, tokens = number + 1, [], [], [], 0
        if ids:
            yield made()

    return map_arrow(docs, run, _UNIT)


def _units(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, Unit]]:
    for row in batch.select(["unit", "ids", "held", "lengths", "words", "tokens"]).to_pylist():
        yield row["unit"], Unit.read(*(row[c] for c in ("ids", "held", "lengths", "words", "tokens")))


def _dealt(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each shard, ascending by key."""
    order = np.argsort(keys)
    shard = (keys[order] % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
    by_shard = np.argsort(shard, kind="stable")
    order, shard = order[by_shard], shard[by_shard]
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        yield int(s), order[cuts[s] : cuts[s + 1]]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def _keys_packed(keys: np.ndarray, shards: int) -> bytes:
    """Ascending keys of a shard as packed differences, without the remainder that they share."""
    return _pack(np.diff(keys // np.uint64(shards), prepend=np.uint64(0)))


def _keys_of(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _rounded(values: np.ndarray) -> np.ndarray:
    """To 36 bits after the point, about eleven decimals, so that two bytes of eight are zero."""
    return ((values.view(np.uint64) + np.uint64(1 << 15)) & ~np.uint64(0xFFFF)).view(np.float64)


def _settled(runs: Runs, low: Known | None) -> tuple[np.ndarray, np.ndarray]:
    """Runs that occur once, in this unit, and runs that no training text has, as far as their parts tell."""
    if low is None:
        none = np.zeros(len(runs.hashes), bool)
        return none, none
    rare, unseen = (low.count == 1) & ~low.wanted, low.count == 0
    return (np.append(part, False)[runs.prefix] | part[runs.suffix] for part in (rare, unseen))


def _known(levels: list[Runs], bodies: dict[int, dict[int, bytes]], shards: int, first: int = 1) -> list[Known]:
    """From the shards' answers, for runs of ``first`` and more words. Single words and pairs are asked for whole."""
    known: list[Known] = []
    for length, runs in enumerate(levels[first - 1 :], first):
        once, unseen = _settled(runs, known[-1] if length > 2 else None)
        open_ = np.flatnonzero(~(once | unseen))
        answer = np.where(once, _OWNER | np.uint64(1), np.uint64(0))
        for s, at in _dealt(runs.hashes[open_], shards):
            answer[open_[at]] = _unpack(bodies[length][s], np.uint64)
        known.append(Known((answer & ~(_OWNER | _WANTED)).astype(np.int64), (answer & _OWNER) > 0, (answer & _WANTED) > 0))
    return known


_SENT = "shard int, unit long, keys binary, counts binary, settled long"


def _sent(number: int, unit: Unit, runs: Runs, low: Known | None, shards: int) -> Iterator[tuple]:
    """Rows of ``_SENT``: keys with counts and marks of held-out texts, and how many runs are settled as occurring once."""
    once, unseen = _settled(runs, low)
    n = len(runs.hashes)
    counts = np.bincount(runs.at[unit.training], minlength=n) * 2 + (np.bincount(runs.at[~unit.training], minlength=n) > 0)
    open_ = np.flatnonzero(~(once | unseen))
    for s, at in _dealt(runs.hashes[open_], shards):
        yield s, number, _keys_packed(runs.hashes[open_[at]], shards), _pack(counts[open_[at]].astype(np.uint32)), 0
    if once.any():
        yield number % shards, number, None, None, int(once.sum())


def _bodies(told: pa.Table) -> dict[int, dict[int, bytes]]:
    bodies: dict[int, dict[int, bytes]] = {}
    for r in told.select(["kind", "shard", "body"]).to_pylist():
        bodies.setdefault(r["kind"], {})[r["shard"]] = r["body"]
    return bodies


def _counted(units: DataFrame, length: int, shorter: DataFrame | None, shards: int) -> DataFrame:
    """Answers for runs of ``length`` words: what the corpus knows of each unit's, and totals of each shard."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, unit in _units(batch):
                for row in _sent(number, unit, unit.runs(length)[-1], None, shards):
                    yield _batch([row], _SENT)

    def send_open(held: pa.Table, told: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for number, unit in _units(held):
            levels = unit.runs(length)
            rows += _sent(number, unit, levels[-1], _known(levels[:-1], _bodies(told), shards, 2)[-1], shards)
        give_back()
        return pa.Table.from_batches([_batch(rows, _SENT)])

    def add(group: pa.Table) -> pa.Table:
        rows = group.select(["shard", "unit", "keys", "counts", "settled"]).to_pylist()
        shard, single = rows[0]["shard"], sum(r["settled"] for r in rows)
        rows = [r for r in rows if r["keys"] is not None]
        out, totals = [], np.zeros(LARGEST + 3, np.int64)
        if rows:
            keys = [_keys_of(r["keys"]) for r in rows]
            cuts = np.cumsum([0] + [len(k) for k in keys])
            keys = np.concatenate(keys)
            counts = np.concatenate([_unpack(r["counts"], np.uint32) for r in rows])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            which = np.empty(len(order), np.int64)
            which[order] = np.cumsum(np.concatenate(([True], keys[1:] != keys[:-1]))) - 1
            total = np.bincount(which, counts // 2).astype(np.int64)
            wanted = np.bincount(which, counts % 2) > 0
            answer = (total.astype(np.uint64) | np.where(wanted, _WANTED, np.uint64(0)))[which]
            counting = np.flatnonzero(counts >= 2)  # the first that counted a run owns it
            answer[counting[np.unique(which[counting], return_index=True)[1]]] |= _OWNER
            totals[:-2] = [(total == r).sum() for r in range(1, LARGEST + 2)]
            totals[-2:] = total.sum(), (total > 0).sum()
            out = [(r["unit"], length, shard, _pack(answer[i:j]), None) for r, i, j in zip(rows, cuts, cuts[1:])]
        totals[[0, -2, -1]] += single
        give_back()
        return pa.Table.from_batches([_batch([*out, (None, length, shard, None, totals.tolist())], _ANSWER)])

    if shorter is None:
        sent = map_arrow(units, send, _SENT)
    else:
        sent = units.groupBy("unit").cogroup(shorter.groupBy("unit")).applyInArrow(send_open, _SENT)
    return sent.groupBy("shard").applyInArrow(add, _ANSWER)


@dataclass(frozen=True)
class Totals:
    """Of the training texts, by length of run: numbers of distinct runs seen 1 to ``LARGEST + 1`` times; tokens and distinct tokens."""

    seen: list[list[int]]
    tokens: int
    distinct: int

    def kept(self) -> list[np.ndarray]:
        return [discounts(seen) for seen in self.seen]

    def unknown(self) -> float:
        """Probability of all unknown words together: what the words' discounts free."""
        if not self.tokens:
            return 1.0
        n, r = np.array(self.seen[0][:LARGEST], float), np.arange(1, LARGEST + 1)
        return float((n * r * (1 - self.kept()[0])).sum() + 0.5 * (self.distinct - n.sum())) / self.tokens


_PART = "shard int, unit long, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
_SCORE = "unit long, kind int, a binary, b binary, c binary, d binary, e binary, f binary"


def _evaluated(units: DataFrame, answers: DataFrame, shards: int, totals: Totals) -> DataFrame:
    """Scores without the weights of contexts (kind 0), and what the shards of contexts need (kind: words of the run)."""

    def run(held: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        for number, unit in _units(held):
            rows += _evaluate_unit(number, unit, _bodies(told), shards, totals)
        give_back()
        return pa.Table.from_batches([_batch(rows, _PART)])

    return units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(run, _PART)


def _evaluate_unit(number: int, unit: Unit, bodies: dict, shards: int, totals: Totals) -> list[tuple]:
    levels = unit.runs(len(totals.seen))
    known = _known(levels, bodies, shards)
    count, docs, kept = known[0].count, len(unit.ids), totals.kept()
    beginnings = int(count[unit.words == END][0])  # training documents
    chance = np.where(count > 0, stays(count, kept[0]) / max(totals.tokens, 1), totals.unknown())
    value = np.log10(chance)
    rows, steps = [], []
    for length in range(2, len(levels) + 1):
        runs, low, own = levels[length - 1], known[length - 2], known[length - 1]
        times = np.append(low.count, beginnings)[runs.prefix]  # of the context
        seen, left = own.count > 0, stays(own.count, kept[length - 1])
        mine = own.owned & seen & np.append(low.wanted, True)[runs.prefix]
        freed = np.bincount(runs.prefix[mine], (own.count - left)[mine] / times[mine], len(low.count) + 1)
        covered = np.bincount(runs.prefix[mine], chance[runs.suffix[mine]], len(low.count) + 1)
        steps.append((seen, times, freed, covered))
        with np.errstate(divide="ignore", invalid="ignore"):
            chance = np.where(seen, left / times, np.nan)  # that of an unseen run is never asked for: its context needs a weight
            value = np.where(seen, np.log10(chance), value[runs.suffix])
    base = np.log10((count + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1)))
    sums = [np.bincount(unit.doc, v, docs) for v in ((count > 0)[unit.tokens], base[unit.tokens], value[levels[-1].at])]
    columns = (unit.ids, unit.held, unit.lengths.astype(np.int64), sums[0].astype(np.int64), sums[1], sums[2])
    rows.append((number % shards, number, 0, *(c.tobytes() for c in columns)))

    going = np.arange(len(unit.tokens))  # tokens whose longer runs are unseen
    for length in range(len(levels), 1, -1):
        runs, (seen, times, freed, covered) = levels[length - 1], steps[length - 2]
        going = going[~seen[runs.at[going]]]
        asks = going[times[runs.at[going]] > 0]
        code, often = np.unique(runs.prefix[runs.at[asks]].astype(np.int64) * docs + unit.doc[asks], return_counts=True)
        context, doc = code // docs, code % docs
        needed = freed > 0
        needed[context] = True
        needed = np.flatnonzero(needed)
        hashes = np.append(levels[length - 2].hashes, BEGIN)
        place = np.full(len(hashes), -1)
        for s, at in _dealt(hashes[needed], shards):
            sent = needed[at]
            place[sent] = np.arange(len(sent))
            take = place[context] >= 0
            asked = np.stack([place[context[take]], doc[take], often[take]])
            asked = asked[:, np.argsort(asked[0], kind="stable")]
            asked[0] = np.diff(asked[0], prepend=0)
            packed = _keys_packed(hashes[sent], shards), _pack(freed[sent].astype(np.float32)), _pack(_rounded(covered[sent])), _pack(asked.astype(np.uint32).ravel())
            rows.append((s, number, length, *packed, None, None))
            place[sent] = -1
    return rows


def _weighted(parts: DataFrame) -> DataFrame:
    """Shares of the contexts' weights in the documents' scores; rows of kind 0 pass."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.select(["unit", "kind", "a", "b", "c", "d", "e", "f"]).to_pylist()
        if rows[0]["kind"] == 0:
            return pa.Table.from_batches([_batch([tuple(r.values()) for r in rows], _SCORE)])
        keys = [_keys_of(r["a"]) for r in rows]
        names, which = np.unique(np.concatenate(keys), return_inverse=True)
        freed, covered = (np.bincount(which, np.concatenate([_unpack(r[c], k) for r in rows]), len(names)) for c, k in (("b", np.float32), ("c", np.float64)))
        with np.errstate(divide="ignore"):
            weight = np.log10(freed / np.maximum(1 - covered, 1e-15))
        start, out = 0, []
        for r, k in zip(rows, keys):
            own = which[start : start + len(k)]
            start += len(k)
            place, doc, often = _unpack(r["d"], np.uint32).reshape(3, -1).astype(np.int64)
            if len(doc):
                docs, at = np.unique(doc, return_inverse=True)
                part = np.bincount(at, weight[own[np.cumsum(place)]] * often)
                out.append((r["unit"], r["kind"], docs.astype(np.uint32).tobytes(), part.tobytes(), None, None, None, None))
        give_back()
        return pa.Table.from_batches([_batch(out, _SCORE)])

    return parts.groupBy("shard", "kind").applyInArrow(run, _SCORE)


_ROW = "_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _summed(parts: DataFrame) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        rows = group.select(["kind", "a", "b", "c", "d", "e", "f"]).to_pylist()
        main = next(r for r in rows if r["kind"] == 0)
        score = np.frombuffer(main["f"], np.float64).copy()
        for r in rows:
            if r["kind"] > 0:
                score[np.frombuffer(r["a"], np.uint32)] += np.frombuffer(r["b"], np.float64)
        columns = [np.frombuffer(main[c], k) for c, k in (("a", np.int64), ("b", bool), ("c", np.int64), ("d", np.int64), ("e", np.float64))]
        return pa.table([pa.array(c) for c in (*columns, score)], [c.split()[0] for c in _ROW.split(", ")])

    return parts.groupBy("unit").applyInArrow(run, _ROW)


def score_documents(
    df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", unit_tokens: int = UNIT_TOKENS, order: int = ORDER
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row; scores are log10 probabilities.

    The model learns runs of up to ``order`` words (2 at least) from rows for which ``held_out`` is not true. Words are runs of other
    characters than space and the controls from tab to carriage return, A-Z lower-cased; every text has one end token more. A null or
    empty text is the end alone; a null id comes back null; repeated rows count and are scored each; other columns are dropped. Without
    any training row all words are unknown. The base score is that of single words by add-half, whatever the model's own are.
    """
    if order < 2:
        raise ValueError("a backoff model needs runs of two words at least")
    named = identified(df.withColumn("_out", F.coalesce(held_out, F.lit(False))), id_col, text_col, ("_out",))
    docs = named.select("_id", "_text", F.col("_kept._out").alias("_held"))
    shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = written(encoded(docs, unit_tokens), "units")
    answers: list[DataFrame] = []
    totals = []
    for length in range(1, order + 1):
        shorter = reduce(DataFrame.unionByName, answers[1:]) if length > 2 else None
        counted = written(_counted(units, length, shorter, shards), f"runs-{length}")
        row = counted.select(*(F.sum(F.get("totals", F.lit(i))) for i in range(LARGEST + 3))).first()
        totals.append([x or 0 for x in row])
        answers.append(counted.where("unit is not null"))
    known = Totals([t[:-2] for t in totals], *totals[0][-2:])
    scored = _summed(_weighted(_evaluated(units, reduce(DataFrame.unionByName, answers), shards, known)))
    n = F.lit(known.tokens).cast("long")
    return scored.select(given_id("_id").alias(id_col), "held_out", "n_tokens", "n_known", n.alias("train_tokens"), "base_score", "score")
