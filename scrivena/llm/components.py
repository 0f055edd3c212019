"""Connected components of a table of links, by alternating large-star and small-star steps.

Links are first contracted inside each chunk of rows by union-find. Then each step points neighbours to the least node
next to them, until every component is a star around its least node; the number of steps grows with the logarithm of a
component's size. Least nodes come from partial minima; they are written before they are joined, so that Spark can split
the rows of a node that many links share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.llm._common import discard, scratch

CHUNK = 200_000


def forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, least node of its component) for nodes that aren't the least."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in up if root(x) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(pairs: list) -> pa.RecordBatch:
        found = forest(pairs)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    held: list[tuple[int, int]] = []
    for batch in batches:
        held += zip(batch.column("u").to_pylist(), batch.column("v").to_pylist())
        if len(held) >= CHUNK:
            yield out(held)
            held = []
    if held:
        yield out(held)


def components(links: DataFrame, most_steps: int = 60) -> DataFrame:
    """links: u, v (longs). Returns node, component (the least node reachable) for every node that isn't the least of
    its component. Nulls, loops and repeated links do no harm. The result can stand for its links in another call."""
    edges = links.select("u", "v").where("u != v").mapInArrow(_contract, "u long, v long")
    edges = scratch(edges.dropDuplicates(), "edges")
    for _ in range(most_steps):
        # Large star: each edge's smaller end hands the larger one to its least neighbour.
        least = scratch(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        handed = edges.join(least.select(F.col("u").alias("v"), "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved"))
        handed = scratch(handed.groupBy("u", "v").agg(F.max("moved").alias("moved")), "edges")
        # Stars stay as they are: no edge moved, and no node has two smaller neighbours.
        if handed.where("moved").isEmpty() and least.where("n > 1").isEmpty():
            discard(least, handed)
            break
        discard(edges, least)
        edges = handed.select("u", "v")
        # Small star: the smaller neighbours of a node, and the node, go to the least of them.
        least = scratch(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        edges = edges.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = scratch(edges.where("u != v").dropDuplicates(), "edges")
        discard(handed, least)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
