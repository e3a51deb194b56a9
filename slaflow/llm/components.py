"""Connected components of a graph given by its edges, in Spark.

Every round replaces each edge by edges to the smallest neighbour, first for
the larger neighbours of a node, then for the smaller ones, until every node
is tied to the smallest node of its component.  Minima are combined before
their shuffle, and those of nodes with a thousandth of all edges or more are
broadcast to the edges, so a node with very many edges isn't gathered in one
task; no more edges are made than there were.  Before the first round, every
task ties the nodes of its own edges, in portions of bounded size, so few
rounds are left to do.  The minima that a round begins with show whether
there is anything left to do, and hold the result if not.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slaflow.llm.common import join_weighted, materialize


#: Edges that a task ties at a time.
PORTION = 500_000


def tied(edges: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node tied to it) of every other node of the edges."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(x, r) for x in up if (r := root(x)) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        pairs = tied(p for b in held for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        held.clear()
        columns = zip(*pairs) if pairs else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["u", "v"])

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= PORTION:
            yield flush()
            size = 0
    if held:
        yield flush()


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, most, n): the smallest and the largest neighbour of each node
    and the number of its edges."""
    made = edges.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"), F.count("v").alias("n"))
    return materialize(made, "least")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    moved = join_weighted(_both_ways(edges), least.select("u", F.least("u", "m").alias("m"), "n"), "u").where("v > u")
    return materialize(moved.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges).drop("most")
    moved = join_weighted(edges, least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v), long ids; the
    component is its smallest node.  Loops and repeated edges do no harm, and
    no edges give no rows."""
    # written first, so that the tasks get many edges each
    written = materialize(edges.select("u", "v").where("u <> v"), "edges")
    now = materialize(written.mapInArrow(_contract, "u long, v long"), "edges")
    while True:
        least = _least(_both_ways(now))
        # done: a node with a smaller neighbour has no other one
        if least.where("m < u AND most > m").isEmpty():
            return least.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        now = materialize(_small_star(_large_star(now, least)), "edges")
