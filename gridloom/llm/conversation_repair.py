"""Repair of damaged conversations by the cheapest edits, found by bidirectional Dijkstra over the edit lattice.

A node of the lattice is a place between rows and a state of the wanted role pattern ``(s?(ua)+)?``: nothing yet, after system,
after user, after assistant. Edits are edges: keep a row (K), give it the role the pattern wants (R), delete it (D) or insert an
empty turn (I). A forward heap starts at the first place, a reverse heap at the accepted ends. Both keep for each node the
least audit among its cheapest ones: keys are (cost, place), which orders all edges of equal cost. The search goes on until the
heaps' tops exceed the best crossing, so every cheapest path has an edge from a node settled forwards to one settled
backwards; of these crossings the least concatenated audit is taken.

A state and an audit fix the roles, so audits of equal cost never start one another and a lattice may be cut: segments give
the best audit between each two states, and these join like matrices. Conversations up to ``LONG_ROWS`` rows are read in order
by one task. Longer ones are dealt out by ranges of their order, a segment per task, joined, and then only hashed in order
(a digest of the whole repaired text has no other way), row by row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_arrow, ship
from gridloom.sources.scratch import written

#: Rows of a conversation that one task reads, and steps of the lattice searched at once.
LONG_ROWS, SEGMENT = 20_000, 256
#: Long conversations that are broadcast, at most (ids only).
BROADCAST_ROWS = 500_000
RETITLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
_SPACE = " \t\n\x0b\x0c\r"
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_WANTED = (USER, USER, ASSISTANT, USER)
_FAULTS = ("", "blank", "duplicate", "truncated")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = ", ".join(["conv_id long", *(f"{c} long" for c in _COUNTS), "audit string", "repaired_sha256 string"])

#: A step of the lattice: (role initial, whether truncated), or (number of rows to delete,).
Step = tuple
Best = tuple[int, str] | None


def _ahead(steps: tuple[Step, ...], i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges from a node: place, state, cost, letters."""
    yield i, _WANTED[q], INSERT, "I"
    if i == len(steps):
        return
    step = steps[i]
    if len(step) == 1:
        yield i + 1, q, DELETE * step[0], "D" * step[0]
        return
    initial, truncated = step
    more = UNFINISHED * truncated
    if (q, initial) in _KEPT:
        yield i + 1, _KEPT[q, initial], more, "K"
    yield i + 1, _WANTED[q], RETITLE + more, "R"
    yield i + 1, q, DELETE, "D"


def _behind(steps: tuple[Step, ...], i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into a node: the place and state they come from, cost, letters."""
    for p in range(4):
        if _WANTED[p] == q:
            yield i, p, INSERT, "I"
        if i:
            for _, state, cost, letters in (e for e in _ahead(steps, i - 1, p) if e[0] == i):
                if state == q:
                    yield i - 1, p, cost, letters


def cheapest(steps: tuple[Step, ...], start: int, ends: tuple[int, ...]) -> Best:
    """Cost and least audit of the cheapest edits that lead from one state to one of the ``ends``."""
    n, best = len(steps), float("inf")
    forward, reverse = {(0, start): (0, "")}, {(n, q): (0, "") for q in ends}
    settled, settled_back = set(), set()
    heap, back = [(0, 0, start)], [(0, -n, q) for q in ends]
    heapq.heapify(back)
    for node in forward.keys() & reverse.keys():
        best = 0
    while heap and back and heap[0][0] + back[0][0] <= best:
        ahead = heap[0][0] <= back[0][0]
        own, labels, other, done = (heap, forward, reverse, settled) if ahead else (back, reverse, forward, settled_back)
        cost, place, q = heapq.heappop(own)
        node = (place if ahead else -place, q)
        if node in done:
            continue
        done.add(node)
        audit = labels[node][1]
        for i, state, weight, letters in (_ahead if ahead else _behind)(steps, *node):
            found = (cost + weight, audit + letters if ahead else letters + audit)
            to = (i, state)
            if to not in labels or found < labels[to]:
                if to not in labels or found[0] < labels[to][0]:
                    heapq.heappush(own, (found[0], i if ahead else -i, state))
                labels[to] = found
                if to in other:
                    best = min(best, found[0] + other[to][0])
    if best == float("inf"):
        return None
    settled.add((0, start))
    settled_back.update((n, q) for q in ends)
    least = None
    for node in settled:
        cost, audit = forward[node]
        crossings = [(cost, audit, node)] + [(cost + w, audit + letters, (i, q)) for i, q, w, letters in _ahead(steps, *node)]
        for total, prefix, to in crossings:
            if to in settled_back and total + reverse[to][0] == best:
                whole = prefix + reverse[to][1]
                least = whole if least is None or whole < least else least
    return best, least


@lru_cache(maxsize=50_000)
def _short(steps: tuple[Step, ...]) -> Best:
    return cheapest(steps, START, ACCEPTED)


def matrix(steps: tuple[Step, ...], segment: int = SEGMENT) -> list[list[Best]]:
    """Cheapest edits between each two states."""
    whole = None
    for i in range(0, max(1, len(steps)), segment):
        part = [[cheapest(steps[i : i + segment], p, (q,)) for q in range(4)] for p in range(4)]
        whole = part if whole is None else [joined(row, part) for row in whole]
    return whole


def joined(row: list[Best], part: list[list[Best]]) -> list[Best]:
    """What leads to each state, carried on by a segment."""
    return [min(((a[0] + b[0], a[1] + b[1]) for a, b in zip(row, column) if a and b), default=None) for column in zip(*part)]


def edits(steps: tuple[Step, ...], segment: int = SEGMENT) -> tuple[int, str]:
    if len(steps) <= 16:
        return _short(steps)
    if len(steps) <= segment:
        return cheapest(steps, START, ACCEPTED)
    row: list[Best] = [(0, ""), None, None, None]
    for i in range(0, len(steps), segment):
        part = [[cheapest(steps[i : i + segment], p, (q,)) if row[p] else None for q in range(4)] for p in range(4)]
        row = joined(row, part)
    return min(row[q] for q in ACCEPTED if row[q])


class Facts:
    """What is counted of a run of rows in their order, and the steps of its lattice."""

    def __init__(self) -> None:
        self.faults, self.illegal, self.distinct = [0, 0, 0, 0], 0, 0
        self.first = self.last = self.low = self.high = self.turn_first = None
        self.steps: list[Step] = []

    def add(self, turn: int | None, role: str, fault: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.first is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:  # in ascending order
            self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if fault in (1, 2):
            gone = self.steps.pop()[0] if self.steps and len(self.steps[-1]) == 1 else 0
            self.steps.append((gone + 1,))
        else:
            self.steps.append((initial, fault == 3))

    def counts(self) -> list[int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return [gaps, *self.faults[1:], self.illegal]


def fault_of(text: str, seen: bool) -> int:
    """Place in ``_FAULTS`` of a row's first fault."""
    words = text.strip(_SPACE)
    return 1 if not words else 2 if seen else 0 if words[-1] in ".!?" else 3


class Repair:
    """The digest of a repaired conversation whose rows come in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.some = audit, 0, START, hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.some else "") + role + ":").encode())
        self.digest.update(text.encode())
        self.some = True

    def _turn(self, text: str) -> None:
        self.state = _WANTED[self.state]
        self._write("assistant" if self.state == ASSISTANT else "user", text)

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._turn("")

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = _KEPT[self.state, role[:1]]
            self._write(role, text)
        elif edit == "R":
            self._turn(text)

    def sha256(self) -> str:
        self.inserted()
        return self.digest.hexdigest()


def damaged(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of the rows after the damage; a dropped row has no copies."""
    conv, at = F.col(conv_id).cast("long"), F.col(turn).cast("long")
    part = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(part(conv), F.lit(":"), part(at))) % 20
    said = part(F.col(text))
    return df.select(
        conv.alias("conv_id"), at.alias("turn"), F.when(draw == 4, "user").otherwise(part(F.col(role))).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )


def _runs(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Runs of rows of equal key, one after another; a run has to be read before the next."""
    rows = (r for batch in batches for piece in _pieces(batch) for r in zip(*(c.to_pylist() for c in piece.columns)))
    held = next(rows, None)
    while held is not None:
        now = held[key]

        def run() -> Iterator[tuple]:
            nonlocal held
            while held is not None and held[key] == now:
                yield held
                held = next(rows, None)

        yield now, run()


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, 256):
        yield batch.slice(i, 256)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 9
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if i > 6 else pa.int64()) for i, c in enumerate(columns)], [c.split()[0] for c in _RESULT.split(", ")],
    )


def _repair_short(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in _runs(batches):
            facts, seen, kept = Facts(), set(), []
            for _, turn, role, text, copies in rows:
                for _ in range(copies):
                    facts.add(turn, role, fault_of(text, (role, text) in seen))
                    seen.add((role, text))
                    kept.append((role, text))
            cost, audit = edits(tuple(facts.steps), segment)
            repair = Repair(audit)
            for row in kept:
                repair.row(*row)
            out.append((conv, *facts.counts(), cost, audit, repair.sha256()))
            if len(out) == 4096:
                yield _table(out)
                out = []
        yield _table(out)

    return run


# Long conversations -------------------------------------------------------------------------------------------------


def _segment_rows(segment: int):
    """Facts and matrix of each conversation's rows in a task, in one row ``conv_id, place, facts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], TaskContext.get().partitionId()
        for conv, rows in _runs(batches):
            facts, before = Facts(), None
            for _, turn, role, text, copies, first in rows:
                for _ in range(copies):
                    facts.add(turn, role, fault_of(text, not first or before == (turn, role, text)))
                    before = (turn, role, text)
            f = facts
            known = {"faults": f.faults, "illegal": f.illegal, "distinct": f.distinct, "ends": [f.first, f.last], "turns": [f.low, f.high]}
            out.append((conv, place, zlib.compress(json.dumps(known | {"best": matrix(tuple(f.steps), segment)}).encode())))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["conv_id", "place", "facts"])

    return run


def _joined_rows(group: pa.Table) -> pa.Table:
    """Facts of a long conversation from its segments (as many as tasks), with its audit."""
    row: list[Best] = [(0, ""), None, None, None]
    faults, illegal, distinct, last, low, high = [0] * 4, 0, 0, None, None, None
    for r in sorted(group.to_pylist(), key=lambda r: r["place"]):
        x = json.loads(zlib.decompress(r["facts"]))
        if x["ends"][0] is None:
            continue
        row = joined(row, [[tuple(b) if b else None for b in line] for line in x["best"]])
        faults = [a + b for a, b in zip(faults, x["faults"])]
        illegal += x["illegal"] + (last is not None and last + x["ends"][0] not in ("su", "ua", "au"))
        last = x["ends"][1]
        if x["turns"][0] is not None:
            distinct += x["distinct"] - (x["turns"][0] == high)
            low, high = x["turns"][0] if low is None else low, x["turns"][1]
    cost, audit = min(row[q] for q in ACCEPTED if row[q])
    gaps = 0 if low is None else high - low + 1 - distinct
    return pa.table({"conv_id": group["conv_id"][:1], "counts": pa.array([[gaps, *faults[1:], illegal, cost]], pa.list_(pa.int64())), "text": pa.array([audit])})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of repaired texts: the first row of a conversation is its audit, its rows follow in order."""
    for conv, rows in _runs(batches):
        _, _, counts, _, _, audit, _ = next(rows)
        repair = Repair(audit)
        for _, _, _, _, role, text, copies in rows:
            for _ in range(copies):
                repair.row(role, text)
        yield _table([(conv, *counts, audit, repair.sha256())])


def _repair_long(rows: DataFrame, segment: int) -> DataFrame:
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("int").alias("copies"))
    rows = rows.withColumn("words", F.md5(F.concat("role", F.lit("\0"), "text")))
    earliest = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    first = rows.where("copies > 0").groupBy("conv_id", "words").agg(F.min(earliest).alias("earliest"))
    same = F.col("r.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("r.words") == F.col("f.words"))
    flagged = rows.alias("r").join(first.alias("f"), same, "left").select(
        "r.conv_id", "r.turn", "r.role", "r.text", "r.copies", F.coalesce(F.col("f.earliest.turn").eqNullSafe(F.col("r.turn")), F.lit(False)).alias("first"),
    )
    # a prefix of the text keeps the order and lets a range begin inside one turn
    flagged = flagged.repartitionByRange(tasks, F.col("conv_id").asc_nulls_first(), order[0], "role", F.substring("text", 1, 64)).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)
    parts = written(map_arrow(flagged, _segment_rows(segment), "conv_id long, place int, facts binary"), "segments")
    known = written(parts.groupBy("conv_id").applyInArrow(_joined_rows, "conv_id long, counts array<long>, text string"), "audits")
    none: Column = F.lit(None)
    heads = known.select("conv_id", F.lit(0).alias("kind"), "counts", none.cast("long").alias("turn"), F.lit("").alias("role"), "text", F.lit(1).alias("copies"))
    body = rows.select("conv_id", F.lit(1).alias("kind"), none.cast("array<long>").alias("counts"), "turn", "role", "text", "copies")
    streamed = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *order)
    return map_arrow(streamed, _hashed, _RESULT)


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", long_rows: int = LONG_ROWS, segment: int = SEGMENT) -> DataFrame:
    """A row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are damaged by their ids first (see ``damaged``); a null id, turn, role or text counts as one space there. Rows of one turn
    are taken by role, then text; repeated rows are duplicates of their first. A null ``conv_id`` is a conversation of its own and
    comes back null. A conversation without rows after the damage has zeros, an empty audit and the digest of an empty text. Other
    columns are dropped; an empty table gives no rows.
    """
    ship(df.sparkSession)
    rows = damaged(df, conv_id, turn, role, text)
    sizes = df.groupBy(F.col(conv_id).cast("long").alias("long_id")).count().where(F.col("count") > long_rows)
    long = written(sizes.select("long_id", F.lit(True).alias("found")), "long")
    n = long.count()
    plain = rows
    if n:
        named = F.broadcast(long) if n <= BROADCAST_ROWS else long
        same = F.col("conv_id").eqNullSafe(F.col("long_id"))
        plain = rows.join(named, same, "left_anti")
        rest = rows.join(named, same, "left_semi")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    out = map_arrow(plain.repartition("conv_id").sortWithinPartitions(*order), _repair_short(segment), _RESULT)
    return out.unionByName(_repair_long(rest, segment)) if n else out
