"""Connected components by alternating stars, for graphs whose nodes may have any number of neighbours.

Each task first joins the edges it holds, so that every node is linked to the least one it reaches within the task. Each round
then links every larger neighbour of a node to the least node of its neighbourhood, then does the same for the smaller
ones. Minima are aggregates with partial sums before the shuffle, so a node with very many neighbours is one row per task.
Rounds are cut off by tables in the shared folder and end when only stars are left, or so few edges that one task joins them
in less time than a round takes to start; that bound does not depend on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_arrow
from gridloom.sources.scratch import written

#: Edges that a task joins at once.
HELD_EDGES = 500_000
#: Edges that one task joins instead of a round.
FEW_EDGES = 16_384


def _joined_in_tasks(edges: DataFrame, listed: bool = False) -> DataFrame:
    """Edges ``a > b`` that connect what the given ones do: in each task, of each node to the least that it reaches there.

    ``listed``: ``b`` is an array of neighbours of ``a``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def root(v):
            while up[v] != v:
                up[v] = up[up[v]]
                v = up[v]
            return v

        def stars(schema: pa.Schema) -> pa.RecordBatch:
            pairs = [(v, r) for v in up if (r := root(v)) != v]
            up.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], schema.field(0).type) for i in range(2)], ["a", "b"])

        schema = None
        for batch in batches:
            schema = batch.schema
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for a, b in ((a, b) for a, near in pairs for b in near) if listed else pairs:
                up.setdefault(a, a)
                up.setdefault(b, b)
                a, b = root(a), root(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if len(up) > HELD_EDGES:
                yield stars(schema)
        if up:
            yield stars(schema)

    kind = edges.schema["a"].dataType.simpleString()
    return map_arrow(edges.select("a", "b"), run, f"a {kind}, b {kind}")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or smaller and larger ones, in edges ``a > b``."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("smaller"), F.lit(0).alias("larger"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast(edges.schema["b"].dataType).alias("smaller"), F.lit(1).alias("larger")))
    ends = ends.groupBy("node").agg(F.min("smaller").alias("first"), F.max("smaller").alias("last"), F.max("larger").alias("larger"))
    return ends.where("first <> last or (first is not null and larger = 1)").count() == 0


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` for every node of an edge between two different nodes; the component is its least node.

    Nodes may be of any type that can be compared. Edges with a null end and loops are ignored; repeated edges count once; no
    edges give no rows.
    """
    current = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where(
        F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))
    )
    return _settled(_joined_in_tasks(current))


def components_of_lists(lists: DataFrame, node: str, near: str) -> DataFrame:
    """``node, component`` as of ``components``, for edges from a node to each of an array of neighbours, which stay in their row."""
    return _settled(_joined_in_tasks(lists.select(F.col(node).alias("a"), F.col(near).alias("b")), listed=True))


def _settled(edges: DataFrame) -> DataFrame:
    current = written(edges, "edges")
    while (few := current.count() <= FEW_EDGES) or not _all_stars(current):
        joined = _joined_in_tasks(current.coalesce(1) if few else current)
        current = written(joined if few else _small_star(_large_star(joined)), "edges")
        if few:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
