"""Exact global order without a one-partition window.

Three building blocks, all of which stay balanced when one key, value or group of copies holds much of the table:

* ``label_by_position``: label rows by their position in a seeded shuffle. The cut points are found by radix
  selection over digest prefixes, so the table itself is never shuffled or sorted.
* ``global_rank``: the position itself, by prefix buckets with known offsets.
* ``running_total``: prefix sums over ordered values, by value-range buckets with known offsets.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import ref, refs
from gridloom.functions.digest import key_digest, row_digest

_STEP = 4  # hex digits per radix level: at most 65,536 counters per level
_DIGEST = 32  # hex digits of one md5
_PAST = "g"  # sorts after every hex digit
_CROWD = 1_000  # rows from which a prefix with a single digest is worth a look

BUCKET_ROWS = 50_000  # aimed rows per rank bucket while there are fewer than 16**4 buckets
HOT_ROWS = 1_000_000  # a digest or value holding more rows than this is handled on its own
SORT_ROWS = 4_000_000  # distinct values one task may order without range buckets
BROADCAST_ROWS = 1_000_000  # rows of a lookup table that may be broadcast
BROADCAST_BYTES = 64 << 20  # of a lookup table, where its bytes are known
COPY_CHUNK = 100_000  # copies one task writes out


# --------------------------------------------------------------------------------------------------------------
# digest order


@dataclass(frozen=True)
class DigestOrder:
    """Sort order of a seeded shuffle: digest of the keys, ties by digest of the whole row."""

    head: Column
    tail: Column | None

    @staticmethod
    def of(df: DataFrame, seed: object, keys: Sequence[str] | None) -> DigestOrder:
        if keys:
            return DigestOrder(key_digest(seed, keys), row_digest(df))
        return DigestOrder(row_digest(df, seed), None)

    @property
    def length(self) -> int:
        return _DIGEST if self.tail is None else 2 * _DIGEST

    def prefix(self, digits: int) -> Column:
        # the second digest is only computed for rows that share the whole first one
        if digits <= _DIGEST:
            return F.substring(self.head, 1, digits)
        return F.concat(self.head, F.substring(self.tail, 1, digits - _DIGEST))

    def below(self, bound: str) -> Column:
        if len(bound) <= _DIGEST:
            return self.head < bound
        head, tail = bound[:_DIGEST], bound[_DIGEST:]
        if self.tail is None:
            return self.head <= head if tail else self.head < head
        return (self.head < head) | ((self.head == head) & (self.tail < tail))

    def equals(self, value: str) -> Column:
        if self.tail is None:
            return self.head == value
        return (self.head == value[:_DIGEST]) & (self.tail == value[_DIGEST:])


@dataclass(frozen=True)
class Cut:
    """``bound`` separates the digests; of the copies equal to it the first ``copies`` rows lie before the cut."""

    bound: str
    copies: int = 0


def _prefix_counts(df: DataFrame, order: DigestOrder, digits: int, within: Sequence[str]) -> dict[str, int]:
    """Rows per digest prefix. A prefix behind which there is one digest only comes back as that whole digest."""
    if within:
        lengths = {len(w) for w in within}
        inside = [order.prefix(n).isin([w for w in within if len(w) == n]) for n in lengths]
        df = df.where(reduce(lambda a, b: a | b, inside))
    whole = order.head if digits <= _DIGEST else order.tail
    rows = df.select(order.prefix(digits).alias("prefix"), F.xxhash64(whole).alias("h"))
    counted = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), (F.min("h") == F.max("h")).alias("one"))
    found = counted.collect()  # at most 16**4 rows per open cut
    counts = {r["prefix"]: r["n"] for r in found}
    crowded = [r["prefix"] for r in found if r["one"] and r["n"] > _CROWD]
    if crowded and digits % _DIGEST:
        # copies, or rows of one key: skip the levels that could not tell them apart
        full = order.prefix(_DIGEST if digits <= _DIGEST else 2 * _DIGEST)
        behind = df.where(order.prefix(digits).isin(crowded)).groupBy(full.alias("d")).agg(F.count(F.lit(1)).alias("n"))
        for r in behind.collect():
            counts.pop(r["d"][:digits], None)
            counts[r["d"]] = r["n"]
    return counts


def find_cuts(df: DataFrame, order: DigestOrder, positions: Callable[[int], Sequence[int]]) -> tuple[list[Cut], int]:
    """Cuts with exactly ``positions(n)`` rows before them, by radix selection on digest prefixes.

    Every level is one map-side combined count over the key columns, restricted to the prefixes still open.
    """
    counts = _prefix_counts(df, order, _STEP, ())
    total = sum(counts.values())
    wanted = list(positions(total))
    done: dict[int, Cut] = {}
    open_cuts: dict[int, tuple[str, int]] = {}
    for k in wanted:
        if k <= 0:
            done[k] = Cut("")
        elif k >= total:
            done[k] = Cut(_PAST)
        else:
            open_cuts[k] = ("", k)
    while open_cuts:
        ordered = sorted(counts)
        still_open: dict[int, tuple[str, int]] = {}
        for k, (parent, left) in open_cuts.items():
            for prefix in ordered[bisect_left(ordered, parent):]:
                n = counts[prefix]
                if left == n:
                    done[k] = Cut(prefix + _PAST)
                    break
                if left < n:
                    if len(prefix) == order.length:
                        done[k] = Cut(prefix, left)
                    else:
                        still_open[k] = (prefix, left)
                    break
                left -= n
        open_cuts = still_open
        if open_cuts:
            counts = {}
            parents = {p for p, _ in open_cuts.values()}
            for length in sorted({len(p) for p in parents}):
                counts |= _prefix_counts(df, order, length + _STEP, sorted(p for p in parents if len(p) == length))
    return [done[k] for k in wanted], total


def expand_copies(counted: DataFrame, count_col: str, index_col: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """Write each row ``count_col`` times, numbered from 0 in ``index_col``; large counts spread over tasks."""
    chunks = counted.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), ref(count_col) - 1, F.lit(chunk).cast("long")))
    ).repartition(F.xxhash64(*refs(counted.columns), F.col("_from")))
    last = F.least(F.col("_from") + F.lit(chunk).cast("long"), ref(count_col)) - 1
    return chunks.withColumn(index_col, F.explode(F.sequence(F.col("_from"), last))).drop("_from", count_col)


def label_by_position(
    df: DataFrame,
    name: str,
    labels: Sequence[object],
    positions: Callable[[int], Sequence[int]],
    *,
    seed: object,
    keys: Sequence[str] | None = None,
    whole_keys: bool = False,
    chunk: int = COPY_CHUNK,
) -> DataFrame:
    """Add ``name``: ``labels[i]`` for rows between the ``i-1``-th and ``i``-th position of the seeded shuffle.

    Sizes are exact. The result is a map-only plan: a row's label follows from comparing its digest with literal
    cuts. Only when a cut falls inside a group of identical rows are those copies counted and written anew, which
    keeps the size exact without bringing them together in one task. With ``whole_keys`` rows of equal keys always get
    one label, and a size is exact up to the key group its cut falls into.
    """
    order = DigestOrder.of(df, seed, keys)
    if whole_keys:
        order = DigestOrder(order.head, None)
    cuts, _ = find_cuts(df, order, positions)
    if whole_keys:
        cuts = [Cut(c.bound + _PAST) if c.copies else c for c in cuts]
    label: Column | None = None
    for cut, value in zip(cuts, labels):
        before = order.below(cut.bound)
        label = F.when(before, F.lit(value)) if label is None else label.when(before, F.lit(value))
    label = F.lit(labels[-1]) if label is None else label.otherwise(F.lit(labels[-1]))
    split_copies = sorted({c.bound for c in cuts if c.copies})
    if not split_copies:
        return df.withColumn(name, label)

    whole, parts = df, []
    for bound in split_copies:
        first = [i for i, c in enumerate(cuts) if c.bound == bound and c.copies]
        whole = whole.where(~order.equals(bound))
        copies = df.where(order.equals(bound)).groupBy(*refs(df.columns)).agg(F.count(F.lit(1)).alias("_n"))
        numbered = expand_copies(copies, "_n", "_i", chunk)
        part: Column | None = None
        for i in first:
            inside = F.col("_i") < cuts[i].copies
            part = F.when(inside, F.lit(labels[i])) if part is None else part.when(inside, F.lit(labels[i]))
        parts.append(numbered.withColumn(name, part.otherwise(F.lit(labels[first[-1] + 1]))).drop("_i"))
    out = whole.withColumn(name, label)
    for part in parts:
        out = out.unionByName(part)
    return out


def global_rank(
    df: DataFrame,
    name: str,
    *,
    seed: object,
    keys: Sequence[str] | None = None,
    bucket_rows: int = BUCKET_ROWS,
    hot_rows: int = HOT_ROWS,
    chunk: int = COPY_CHUNK,
) -> DataFrame:
    """Add ``name``, the 1-based position of every row in the seeded shuffle.

    Rows go to buckets of digest prefixes whose offsets come from one count; ``row_number`` runs inside a bucket.
    Digests that hold more than ``hot_rows`` rows (a repeated key, a group of copies) are ranked apart, see
    ``_rank_hot``.
    """
    order = DigestOrder.of(df, seed, keys)
    counts = _prefix_counts(df, order, _STEP, ())
    total = sum(counts.values())
    digits = 1
    while digits < _STEP and total / 16**digits > bucket_rows:
        digits += 1
    threshold = max(hot_rows, 8 * total // 16**_STEP)
    suspects = sorted({p[:_STEP] for p, n in counts.items() if n > threshold})  # a crowded prefix may have come back whole
    hot: list[str] = []
    if suspects:
        found = (
            df.where(order.prefix(_STEP).isin(suspects))
            .groupBy(order.head.alias("h"))
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > threshold)
        )
        hot = sorted(r["h"] for r in found.collect())  # at most total / threshold <= 8,192 rows

    # Each hot digest is a bucket of its own: it parts its prefix's bucket into what lies below, itself, and what lies above.
    spark = df.sparkSession
    keyed = df.withColumn("_digest", order.head).withColumn("_bucket", F.substring("_digest", 1, digits))
    if hot:
        inside: dict[str, list[str]] = {}
        for h in hot:
            inside.setdefault(h[:digits], []).append(h)
        bounds = spark.createDataFrame(list(inside.items()), "_bucket string, _hot array<string>")
        keyed = keyed.join(F.broadcast(bounds), "_bucket", "left")  # at most 8,192 digests
        below = F.size(F.filter("_hot", lambda h: h < F.col("_digest"))).cast("int")
        part = F.when(F.col("_hot").isNull(), 0).otherwise(2 * below + F.array_contains("_hot", F.col("_digest")).cast("int"))
        keyed = keyed.withColumn("_part", part).drop("_hot")
        sizes = {(r["_bucket"], r["_part"]): r["n"] for r in keyed.groupBy("_bucket", "_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    else:
        keyed = keyed.withColumn("_part", F.lit(0))
        sizes = {}
        for prefix, n in counts.items():
            sizes[prefix[:digits], 0] = sizes.get((prefix[:digits], 0), 0) + n
    ordered = sorted(sizes)  # at most 16**4 prefixes and two parts per hot digest
    starts = dict(zip(ordered, accumulate([0, *[sizes[p] for p in ordered]])))
    offsets = spark.createDataFrame([(b, p, n) for (b, p), n in starts.items()] or [("", 0, 0)], "_bucket string, _part int, _start long")
    # equal keys are told apart by an 8-byte hash of the row rather than by a second digest: less to shuffle
    tie = [] if order.tail is None else [F.xxhash64(*refs(df.columns))]
    within = Window.partitionBy("_bucket", "_part").orderBy(F.col("_digest"), *tie)
    cold = keyed.where(F.col("_part") % 2 == 0) if hot else keyed
    ranked = cold.join(F.broadcast(offsets), ["_bucket", "_part"]).withColumn(
        name, F.col("_start") + F.row_number().over(within).cast("long")
    ).select(*refs(df.columns), ref(name))
    if not hot:
        return ranked
    hot_start = {h: starts[h[:digits], 2 * inside[h[:digits]].index(h) + 1] for h in hot}
    return ranked.unionByName(_rank_hot(df, order, hot_start, name, chunk))


def _rank_hot(df: DataFrame, order: DigestOrder, hot_start: dict[str, int], name: str, chunk: int) -> DataFrame:
    """Positions of the rows behind a few very frequent digests.

    Copies are first counted (map-side combined), so what is ordered are distinct rows, spread over buckets of the
    row hash; each distinct row is then written out as often as it was counted.
    """
    columns = df.columns
    tie = F.lit(0).cast("long") if order.tail is None else F.xxhash64(*refs(columns))
    counted = (
        df.where(order.head.isin(list(hot_start)))
        .groupBy(*refs(columns))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_digest", order.head)
        .withColumn("_tie", tie)
        .withColumn("_part", F.shiftright("_tie", 48))  # 65,536 parts in the order of the hash
    )
    parts = counted.groupBy("_digest", "_part").agg(F.sum("_n").alias("_size"))
    parts = parts.withColumn(
        "_part_start",
        F.coalesce(F.sum("_size").over(Window.partitionBy("_digest").orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("_size")
    starts = df.sparkSession.createDataFrame(list(hot_start.items()), "_digest string, _start long")
    inside = Window.partitionBy("_digest", "_part").orderBy("_tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        counted.join(parts, ["_digest", "_part"])
        .join(F.broadcast(starts), "_digest")  # at most 8,192 rows
        .withColumn("_first", F.col("_start") + F.col("_part_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    )
    rows = expand_copies(placed.select(*refs(columns), "_first", "_n"), "_n", "_i", chunk)
    return rows.withColumn(name, F.col("_first") + F.col("_i") + 1).select(*refs(columns), ref(name))


# --------------------------------------------------------------------------------------------------------------
# value order


@dataclass(frozen=True)
class Sizes:
    """What is known of a counted table: its rows, those of its largest group, and its largest weight."""

    rows: int
    largest_group: int
    heaviest: float
    bytes: int = 0


def _probe(counted: DataFrame, value: str, weight: str, groups: Sequence[str], slots: int) -> tuple[dict, Sizes]:
    """A pseudo-random choice of values per group, and sizes; the choice only balances the buckets."""
    slot = F.pmod(F.xxhash64(ref(value)), F.lit(slots))
    probe = (
        counted.groupBy(*refs(groups), slot.alias("_slot"))
        .agg(
            F.count(F.lit(1)).alias("_m"),
            F.max(ref(weight)).alias("_w"),
            F.min_by(ref(value), F.xxhash64(ref(value), F.lit(1))).alias("_v"),
        )
        .collect()  # at most ``slots`` rows per group
    )
    chosen: dict[tuple, list] = {}
    sizes: dict[tuple, int] = {}
    for r in probe:
        group = tuple(r[g] for g in groups)
        chosen.setdefault(group, []).append(r["_v"])
        sizes[group] = sizes.get(group, 0) + r["_m"]
    found = Sizes(sum(sizes.values()), max(sizes.values(), default=0), max((r["_w"] or 0 for r in probe), default=0))
    return {g: sorted(vs) for g, vs in chosen.items()}, found


def running_total(
    counted: DataFrame,
    value: str,
    weight: str,
    name: str,
    groups: Sequence[str] = (),
    *,
    sort_rows: int = SORT_ROWS,
) -> tuple[DataFrame, Sizes]:
    """Add ``name``: the sum of ``weight`` over smaller values of the group; also return the table's sizes.

    ``counted`` has one row per group and distinct value (a counted table, so no value is hot). While the largest
    group has at most ``sort_rows`` values, a window per group suffices. Beyond it values go to range buckets, found
    by binary search in a small array, and each bucket starts from its own offset.
    """
    slots = 1024 if groups else 4096
    chosen, sizes = _probe(counted, value, weight, groups, slots)
    before = (Window.unboundedPreceding, -1)
    by_group = Window.partitionBy(*refs(groups))
    if sizes.largest_group <= sort_rows:
        total = F.sum(ref(weight)).over(by_group.orderBy(ref(value)).rowsBetween(*before))
        return counted.withColumn(name, F.coalesce(total, F.lit(0).cast("long"))), sizes

    value_type = counted.schema[value].dataType.simpleString()
    group_types = [f"`{g}` {counted.schema[g].dataType.simpleString()}" for g in groups]
    anchor = list(groups) or ["_all"]
    schema = ", ".join([*(group_types or ["_all int"]), f"_bounds array<{value_type}>"])
    table = [(*(group or (0,)), values) for group, values in chosen.items()]
    bounds = counted.sparkSession.createDataFrame(table, schema)
    spread = counted if groups else counted.withColumn("_all", F.lit(0))
    spread = spread.join(F.broadcast(bounds), anchor)  # at most ``slots`` values per group
    spread = spread.withColumn("_part", F.lit(0))
    step = slots
    while step:  # number of bounds that are not above the value
        hit = F.get("_bounds", F.col("_part") + (step - 1)) <= ref(value)
        spread = spread.withColumn("_part", F.col("_part") + F.when(hit, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    spread = spread.drop("_bounds")
    keys = [*anchor, "_part"]
    totals = spread.groupBy(*refs(keys)).agg(F.sum(ref(weight)).alias("_size"))
    start = F.sum("_size").over(Window.partitionBy(*refs(anchor)).orderBy("_part").rowsBetween(*before))
    totals = totals.select(*refs(keys), F.coalesce(start, F.lit(0)).alias("_start"))
    inner = F.sum(ref(weight)).over(Window.partitionBy(*refs(keys)).orderBy(ref(value)).rowsBetween(*before))
    placed = spread.join(F.broadcast(totals), keys)  # at most ``slots`` + 1 buckets per group
    out = placed.withColumn(name, F.col("_start") + F.coalesce(inner, F.lit(0)))
    return out.select(*refs(counted.columns), ref(name)), sizes


def look_up(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    sizes: Sizes,
    weight: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Join of ``rows`` with a table that has one row per key and a ``weight`` counting its occurrences.

    A table of checked small size, in rows and in bytes where these are known, is broadcast. A larger one joins by shuffle
    when no key is frequent. Else it is split by its own counts: keys with more than ``hot_rows`` occurrences (few by
    arithmetic) are broadcast, all others join by shuffle. With ``how="left"`` rows without an entry stay.
    """
    keys = list(keys)
    if sizes.rows <= broadcast_rows and sizes.bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table.drop(weight)), keys, how)
    if sizes.heaviest <= hot_rows:
        return rows.join(table.drop(weight), keys, how)
    frequent = table.where(ref(weight) > hot_rows)
    hot = F.broadcast(frequent.drop(weight))  # at most occurrences / hot_rows keys
    rest = rows.join(F.broadcast(frequent.select(*refs(keys))), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(table.where(ref(weight) <= hot_rows).drop(weight), keys, how))


def average_rank(
    df: DataFrame, column: str, name: str, *, sort_rows: int = SORT_ROWS, broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``name``, the 1-based rank of ``column`` with ties sharing their mean rank; missing values drop out."""
    present = df.where(ref(column).isNotNull())
    counted = present.groupBy(ref(column)).agg(F.count(F.lit(1)).alias("_n"))
    table, size = running_total(counted, column, "_n", "_before", sort_rows=sort_rows)
    table = table.withColumn(name, F.col("_before") + (F.col("_n") + 1) / 2).drop("_before")
    joined = look_up(present, table, [column], sizes=size, weight="_n", broadcast_rows=broadcast_rows,
                     hot_rows=hot_rows)
    return joined.select(*refs(df.columns), ref(name))


def dense_codes(values: DataFrame, value: str, name: str, groups: Sequence[str] = (), *,
                sort_rows: int = SORT_ROWS) -> tuple[DataFrame, Sizes]:
    """Add ``name``, the 0-based position of every distinct value of its group, and return the sizes."""
    coded, sizes = running_total(values.withColumn("_one", F.lit(1).cast("long")), value, "_one", name, groups,
                                 sort_rows=sort_rows)
    return coded.drop("_one"), sizes
