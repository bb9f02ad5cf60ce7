"""Connected components: forests within tasks of bounded size, then alternating large and small
stars on shuffles between them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.staging import stage

#: Edges that a task holds, about, when it ties the nodes of its edges together.
EDGES_A_TASK = 200_000


def forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's edges, each with the least node that these edges tie it to."""
    above: dict[int, int] = {}

    def find(node: int) -> int:
        path = []
        while (up := above.get(node, node)) != node:
            path.append(node)
            node = up
        for passed in path:
            above[passed] = node
        return node

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    tied = [(node, find(node)) for node in list(above)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([t[k] for t in tied], pa.int64()) for k in range(2)], names=["a", "b"])


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the least of those neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """For nodes of ``edges`` (a, b, two different longs): node and its component's least node,
    for all nodes but the least ones themselves.

    Each task first replaces its share of the edges by a forest. If there is but one share, its
    forest is the result; the forests of several are tied together by stars.
    """
    current = stage(edges.select("a", "b"), "edges")
    shares = max(1, -(-current.count() // EDGES_A_TASK))
    current = stage(current.coalesce(shares).mapInArrow(forests, "a long, b long"), "edges")
    seen = None
    while shares > 1:
        mark = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
        current = stage(small_star(large_star(current).distinct()).distinct(), "edges")
    return current.toDF("node", "root")
