"""Nearest vectors by a hierarchical k-means tree: best-bin-first traversal, leaf visits widened until a calibrated recall.

Equal vectors form a class, of which a few least ids are kept. The tree is fitted on a bounded sample of the classes; every
class is then put into the leaf that greedy descent finds, and a leaf of many classes is dealt over several tasks. A query
walks the tree with a priority queue of the centroids met so far, nearest first, and visits the leaves in the order they come
out. How many leaves are visited is calibrated: for some queries the true nearest vectors are found by comparing them with all
vectors, in every task of the table, and visits are widened until the leaves visited hold the wanted share of them. What is
found is ranked by the cosine of the given numbers in double precision.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import NO_ID, given_id, map_arrow, ship
from gridloom.sources.scratch import written

NEAREST, QUERY_STEP = 5, 50
#: Classes of the sample that the tree is fitted on, and its numbers (of eight bytes), at most on average.
SAMPLE_ROWS, SAMPLE_NUMBERS = 32_768, 4_000_000
#: Children of a node, rows of the sample in a leaf (at most, where they differ), rounds of k-means.
BRANCHES, LEAF_SAMPLE, ROUNDS = 8, 64, 8
#: Queries of the calibration on average, and the share of their true nearest vectors that visited leaves have to hold.
CALIBRATED, RECALL = 256, 0.97
#: Classes of a shard and queries of a block that one task compares, on average.
PART_ROWS, BLOCK_ROWS = 20_000, 20_000
#: Products of queries and vectors held at once.
_BLOCK = 4_000_000
_SLACK = 1e-9


class Tree:
    """Centroids by node; ``first[i]`` is the first child of node i (children are adjacent, ``count[i]`` of them), or 0 for a leaf."""

    def __init__(self, centroids: np.ndarray, first: np.ndarray, count: np.ndarray):
        self.centroids, self.first, self.count = centroids, first, count

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, self.centroids, self.first, self.count)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as held:
            return cls(*(held[f"arr_{i}"] for i in range(3)))

    @property
    def leaves(self) -> int:
        return int((self.count == 0).sum())

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: always on to the nearest child."""
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.count[at] > 0)
            if not len(inner):
                return at
            for node in np.unique(at[inner]).tolist():
                own = inner[at[inner] == node]
                children = self.centroids[self.first[node] : self.first[node] + self.count[node]]
                at[own] = self.first[node] + _nearest(x[own], children)

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """Leaves for a unit vector, best bin first: the nearest centroid met so far is opened next."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.count[node]:  # down to a leaf; siblings wait in the queue
                start, n = int(self.first[node]), int(self.count[node])
                away = 1.0 - self.centroids[start : start + n] @ q
                order = np.argsort(away, kind="stable").tolist()
                for i in order[1:]:
                    heapq.heappush(queue, (float(away[i]), start + i))
                node = start + order[0]
            yield node


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([(x[i : i + 4096] @ centroids.T).argmax(1) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)


def _unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _kmeans(x: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and the centroid of each row; fewer than k where rows do not differ enough."""
    random = np.random.default_rng(seed)
    chosen, away = [int(random.integers(len(x)))], np.full(len(x), np.inf)
    while len(chosen) < k:  # spread starts
        away = np.minimum(away, 1.0 - x @ x[chosen[-1]])
        weight = np.maximum(away, 0)
        weight[weight < 1e-7] = 0
        if not weight.sum():
            break
        chosen.append(int(random.choice(len(x), p=weight / weight.sum())))
    centroids = x[chosen]
    for _ in range(ROUNDS):
        own = _nearest(x, centroids)
        sums = np.stack([np.bincount(own, weights=x[:, j], minlength=len(centroids)) for j in range(x.shape[1])], 1)
        held = np.bincount(own, minlength=len(centroids)) > 0
        moved = np.where(held[:, None], _unit_rows(sums), centroids)
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    own = _nearest(x, centroids)
    used = np.unique(own)
    return centroids[used], np.searchsorted(used, own)


def fit_tree(x: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_SAMPLE) -> Tree:
    """A tree over unit vectors. A node of equal vectors is a leaf whatever its size."""
    centroids, first, count, waiting = [_unit_rows(x.mean(0, keepdims=True))[0]], [0], [0], [(0, np.arange(len(x)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= leaf_rows:
            continue
        found, own = _kmeans(x[rows], branches, node)
        if len(found) < 2:
            continue
        first[node], count[node] = len(centroids), len(found)
        for i in range(len(found)):
            waiting.append((len(centroids), rows[own == i]))
            centroids.append(found[i])
            first.append(0)
            count.append(0)
    return Tree(np.array(centroids), np.array(first), np.array(count))


# Vectors and their classes ------------------------------------------------------------------------------------------


def _numbers(column: pa.Array) -> list[np.ndarray | None]:
    """The numbers of each vector that takes part."""
    found = []
    for v in column.to_pylist():
        a = None if not v or any(x is None for x in v) else np.array(v, np.float64)
        found.append(a if a is not None and np.isfinite(a).all() and a.any() else None)
    return found


def _classes(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_id, cls, dim, vec`` of the rows that take part: ``cls`` is a digest of the numbers, which ``vec`` holds as bytes."""
    source = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = _numbers(batch.column(1))
            good = [i for i, a in enumerate(numbers) if a is not None]
            data = [(numbers[i] + 0.0).tobytes() for i in good]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(good, pa.int64())), pa.array([hashlib.blake2b(d, digest_size=16).digest() for d in data], pa.binary()),
                 pa.array([len(d) // 8 for d in data], pa.int32()), pa.array(data, pa.binary())], ["_id", "cls", "dim", "vec"],
            )

    return map_arrow(source, run, "_id long, cls binary, dim int, vec binary")


def _scaled(data: list[bytes]) -> np.ndarray:
    """Vectors times a power of two each, so that no square overflows; cosines stay what they are."""
    x = np.stack([np.frombuffer(d, np.float64) for d in data])
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _units(data: list[bytes]) -> np.ndarray:
    return _unit_rows(_scaled(data))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows; the same rows give the same number wherever they stand."""
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def nearest_of(q: np.ndarray, x: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of queries, the places (query, held) and cosines of all held that may be among the ``most`` nearest of a query, ties included."""
    units, step = _unit_rows(x), max(1, _BLOCK // len(x))
    for i in range(0, len(q), step):
        near = _unit_rows(q[i : i + step]) @ units.T
        least = np.partition(near, -most, axis=1)[:, -most] if near.shape[1] > most else np.full(len(near), -np.inf)
        rows, cols = np.nonzero(near >= least[:, None] - _SLACK)
        yield rows + i, cols, cosines(q[rows + i], x[cols])


class _Found:
    """The nearest found so far of each query: places of query and held, and cosines."""

    def __init__(self, ids: list[list[int]], most: int):
        self.least, self.most, self.parts, self.held = np.array([i[0] for i in ids], np.int64), most, [], 0

    def add(self, rows: np.ndarray, cols: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((rows, cols, score))
        self.held += len(rows)
        if self.held > _BLOCK // 4:
            self.parts = [self.kept()]
            self.held = 0  # counts what comes next

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first of each query by cosine, then id."""
        rows, cols, score = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        order = np.lexsort((self.least[cols], -score, rows))
        new = np.concatenate(([True], rows[order][1:] != rows[order][:-1]))
        rank = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        some = order[rank < self.most]
        return rows[some], cols[some], score[some]


_FOUND = "qcls binary, cls binary, leaf int, score double, ids array<long>"


def _found_table(queries: list[bytes], held: dict[str, list], found: _Found) -> pa.Table:
    at = list(zip(*(a.tolist() for a in found.kept()))) if found.parts else []
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.float64(), pa.list_(pa.int64())]
    columns = [[queries[i] for i, _, _ in at], *[[held[c][j] for _, j, _ in at] for c in ("cls", "leaf")], [s for _, _, s in at], [held["ids"][j] for _, j, _ in at]]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _FOUND.split(", ")])


def compare_leaves(held: pa.Table, asked: pa.Table, most: int) -> pa.Table:
    """The nearest of each query among the vectors of the leaves it visits here."""
    rows = held.select(["cls", "leaf", "ids"]).to_pydict()
    found = _Found(rows["ids"], most)
    if len(held) and len(asked):
        x, q = _scaled(held["vec"].to_pylist()), _scaled(asked["vec"].to_pylist())
        leaf = np.array(rows["leaf"])
        by_leaf = np.argsort(leaf, kind="stable")
        visited = asked["leaves"].to_pylist()
        wanted = np.concatenate([np.array(v, np.int64) for v in visited])
        asker = np.repeat(np.arange(len(visited)), [len(v) for v in visited])
        for own in np.unique(wanted).tolist():
            lo, hi = np.searchsorted(leaf[by_leaf], (own, own + 1))
            here, askers = by_leaf[lo:hi], asker[wanted == own]
            if len(here):
                for r, c, score in nearest_of(q[askers], x[here], most):
                    found.add(askers[r], here[c], score)
    return _found_table(asked["cls"].to_pylist(), rows, found)


def _first(df: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each group; Spark keeps so many per task before it shuffles."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_place") <= most).drop("_place")


def fit_trees(classes: DataFrame, rows: int, numbers: int) -> DataFrame:
    """``dim, tree`` from a sample of classes by digest: some ``SAMPLE_ROWS`` of them, fewer where vectors are long."""
    share = min(1.0, SAMPLE_ROWS / max(rows, 1), SAMPLE_NUMBERS / max(numbers, 1))
    drawn = F.pmod(F.xxhash64("cls", F.lit(5)), F.lit(1 << 30)) < math.ceil(share * (1 << 30))

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("cls")
        return pa.table({"dim": group["dim"][:1], "tree": pa.array([fit_tree(_units(group["vec"].to_pylist())).to_bytes()], pa.binary())})

    return classes.where(drawn).select("dim", "cls", "vec").groupBy("dim").applyInArrow(fit, "dim int, tree binary")


class _Trees:
    """The trees in a task, each read from its bytes once; a length without one has a single leaf."""

    def __init__(self, shared: dict[int, bytes]):
        self.shared, self.read = shared, {}

    def of(self, dim: int) -> Tree:
        if dim not in self.read:
            data = self.shared.get(dim)
            self.read[dim] = Tree.from_bytes(data) if data else Tree(np.zeros((1, dim)), np.zeros(1, int), np.zeros(1, int))
        return self.read[dim]


def search(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_step: int = QUERY_STEP, nearest: int = NEAREST,
    recall: float = RECALL, part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS, calibrated: int = CALIBRATED,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest found of each row whose id is divisible by ``query_step``, all rows being candidates.

    Vectors that are null, empty, zero, or hold null or non-finite numbers take no part, and only vectors of equal length are
    compared; a query without any candidate has no rows. A query's own row is no candidate; other rows with its
    id or its vector are. A repeated query row is answered once. A null id counts as the largest, comes back null, and asks nothing.
    Ties go to the smaller id. Other columns are dropped; an empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    most = nearest + 1  # a query's own row is among them
    rows = written(_classes(df, id_col, vector_col), "vectors")
    least = _first(rows.select("cls", "_id", "dim", "vec"), ["cls"], [F.col("_id")], most)
    classes = written(least.groupBy("cls").agg(F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.array_sort(F.collect_list("_id")).alias("ids")), "classes")
    size = classes.agg(F.count("*").alias("n"), F.coalesce(F.sum("dim"), F.lit(0)).alias("numbers")).first()
    trees = {r["dim"]: bytes(r["tree"]) for r in fit_trees(classes, size["n"], size["numbers"]).collect()}  # no larger than the sample
    shared = spark.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Trees(shared.value)
        for batch in batches:
            dims, vectors = np.array(batch.column("dim").to_pylist(), int), batch.column("vec").to_pylist()
            leaf = np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                leaf[own] = known.of(dim).leaf_of(_units([vectors[i] for i in own]))
            yield batch.append_column("leaf", pa.array(leaf, pa.int32()))

    dealt = written(map_arrow(classes, deal, "cls binary, dim int, vec binary, ids array<long>, leaf int"), "leaves")
    parts = shards_of(dealt.groupBy("dim", "leaf").agg(F.count("*").alias("n")).collect(), part_rows)  # a number per leaf of the trees
    placed = spark.createDataFrame([(*at, *v) for at, v in parts.items()], "dim int, leaf int, shard int, parts int")
    asked = written(
        rows.where((F.col("_id") != NO_ID) & (F.pmod(F.col("_id"), F.lit(query_step)) == 0)).select("_id", "cls").distinct(), "asked",
    )
    queries = written(dealt.select("cls", "dim", "vec").join(asked.select("cls").distinct(), "cls", "left_semi"), "queries")
    visits = _calibrated(dealt, queries, trees, nearest, recall, calibrated)
    fan = spark.sparkContext.broadcast((visits, parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query at every shard that holds leaves it visits, once, with those leaves."""
        known, (visited, parted) = _Trees(shared.value), fan.value
        for batch in batches:
            for piece in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                dims, units = piece.column("dim").to_pylist(), [_units([v])[0] for v in piece.column("vec").to_pylist()]
                at, shards, leaves = [], [], []
                for i, (dim, unit) in enumerate(zip(dims, units)):
                    here: dict[int, list[int]] = {}
                    for leaf in islice(known.of(dim).best_bins(unit), visited[dim]):
                        shard, n = parted.get((dim, leaf), (0, 0))
                        for k in range(shard, shard + n):
                            here.setdefault(k, []).append(leaf)
                    at += [i] * len(here)
                    shards += here
                    leaves += here.values()
                taken = piece.select(["cls", "dim", "vec"]).take(pa.array(at, pa.int64()))
                yield taken.append_column("shard", pa.array(shards, pa.int32())).append_column("leaves", pa.array(leaves, pa.list_(pa.int32())))

    routed = written(map_arrow(queries, route, "cls binary, dim int, vec binary, shard int, leaves array<int>"), "routed")
    blocks = routed.groupBy("dim", "shard").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    held = dealt.join(F.broadcast(placed), ["dim", "leaf"]).withColumn("shard", F.col("shard") + F.pmod(F.xxhash64("cls", F.lit(6)), F.col("parts")).cast("int"))
    held = held.join(blocks, ["dim", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    probes = routed.join(blocks, ["dim", "shard"]).withColumn("block", F.pmod(F.xxhash64("cls", F.lit(8)), F.col("blocks")).cast("int"))
    at = ["dim", "shard", "block"]
    held, probes = held.select(*at, "cls", "vec", "ids", "leaf"), probes.select(*at, "cls", "vec", "leaves")
    found = held.groupBy(*at).cogroup(probes.groupBy(*at)).applyInArrow(lambda a, b: compare_leaves(a, b, most), _FOUND)
    best = _first(found, ["qcls"], [F.col("score").desc(), F.element_at("ids", 1)], most)
    near = best.withColumn("row", F.explode(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("away"), i.alias("id"), (F.col("qcls") == F.col("cls")).alias("own")))))
    lists = near.groupBy("qcls").agg(F.array_sort(F.collect_list("row")).alias("near"))  # some ``most`` classes of as many ids
    answered = asked.join(lists, F.col("cls") == F.col("qcls")).select("_id", "near")
    own = F.expr("array_position(transform(near, r -> r.own and r.id = _id), true)").cast("int")
    others = F.when(own == 0, F.col("near")).otherwise(F.concat(F.slice("near", 1, own - 1), F.slice("near", own + 1, F.size("near"))))
    ranked = answered.select("_id", F.posexplode(F.slice(others, 1, nearest)).alias("rank", "r"))
    return ranked.select(
        F.col("_id").alias("query_id"), (F.col("rank") + 1).cast("int").alias("rank"), given_id(F.col("r.id")).alias("vec_id"), (-F.col("r.away")).alias("score"),
    )


def shards_of(leaves: list, part_rows: int) -> dict[tuple[int, int], tuple[int, int]]:
    """First shard and number of shards of each leaf: small leaves share one with their neighbours, a large one has several."""
    placed, shard, room, last = {}, -1, 0, None
    for dim, leaf, n in sorted(tuple(r) for r in leaves):
        if dim != last or n > room:
            shard, room, last = shard + 1, part_rows, dim
        parts = -(-n // part_rows)
        placed[dim, leaf] = (shard, parts)
        shard += parts - 1
        room = room - n if parts == 1 else 0
    return placed


def _calibrated(dealt: DataFrame, queries: DataFrame, trees: dict[int, bytes], nearest: int, recall: float, calibrated: int) -> dict[int, int]:
    """Leaf visits by length of vector: widened until the visited leaves hold the wanted share of what some queries are nearest to.

    The queries are drawn by digest; each is compared with every vector of the table where that vector lies.
    """
    spark = dealt.sparkSession
    n = {r["dim"]: r["n"] for r in queries.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not n:
        return {}
    rank = F.pmod(F.xxhash64("cls", F.lit(7)), F.lit(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(v) for dim, k in n.items() for v in (dim, math.ceil(min(1.0, calibrated / k) * (1 << 30)))]), F.col("dim"))
    drawn: dict[int, tuple[list, list]] = {}
    for r in queries.where(rank < share).collect():  # some ``calibrated`` of each length
        drawn.setdefault(r["dim"], ([], []))[0].append(bytes(r["cls"]))
        drawn[r["dim"]][1].append(bytes(r["vec"]))
    shared = spark.sparkContext.broadcast(drawn)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist(), int)
            for dim in np.unique(dims).tolist():
                if dim in shared.value:
                    own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                    held = own.select(["cls", "leaf", "ids"]).to_pydict()
                    found, (names, vectors) = _Found(held["ids"], nearest + 1), shared.value[dim]
                    for block in nearest_of(_scaled(vectors), _scaled(own.column("vec").to_pylist()), nearest + 1):
                        found.add(*block)
                    yield from _found_table(names, held, found).to_batches()

    exact = map_arrow(dealt, compare, _FOUND).where("cls <> qcls")
    true = _first(exact, ["qcls"], [F.col("score").desc(), F.element_at("ids", 1)], nearest).select("qcls", "leaf").collect()
    wanted: dict[bytes, list[int]] = {}
    for r in true:
        wanted.setdefault(bytes(r["qcls"]), []).append(r["leaf"])
    visits = {}
    for dim, k in n.items():
        tree = _Trees(trees).of(dim)
        places = []  # how many leaves are visited before each true neighbour's
        for cls, vec in zip(*drawn.get(dim, ([], []))):
            order = {leaf: i for i, leaf in enumerate(tree.best_bins(_units([vec])[0]))}
            places += [order[leaf] for leaf in wanted.get(cls, [])]
        visited = 1 if places else tree.leaves  # nothing to measure by: all of them
        while visited < tree.leaves and np.mean(np.array(places) < visited) < recall:
            visited = min(tree.leaves, max(visited + 1, visited * 5 // 4))
        visits[dim] = visited
    return visits
