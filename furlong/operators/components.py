"""Connected components of an undirected graph, without collecting it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.session import cut

MAX_ROUNDS = 60
#: Edges that one pass of the local contraction holds in memory.
CHUNK = 200_000


def forest(pairs) -> list[tuple]:
    """(node, smallest node of its component) for the nodes of ``pairs`` that are not that smallest node."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := root(x)) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of every chunk by stars that connect the same nodes."""
    held: list[tuple] = []
    schema = None

    def stars():
        out = forest(held)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], schema.field(i).type) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        schema = batch.schema
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        if len(held) >= CHUNK:
            yield stars()
            held = []
    if held:
        yield stars()


def _contracted(edges: DataFrame) -> DataFrame:
    return edges.mapInArrow(_contract, edges.schema)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Label every node that has an edge with the smallest node it can reach.

    Returns ``node, component``. Edges are first contracted within each task's
    chunks. Nulls and self loops are ignored; repeated
    edges count once. No more edges than one chunk holds are contracted as
    that chunk, which ends the search. Else each round rewires every node to the smallest node it
    sees, first among all neighbours above it (large star), then among those
    below it (small star); the edges shrink to one star for each component.
    The node minima are written before they are joined, so that the join has
    an exchange of its own on both sides, which adaptive execution can split
    where a hub holds many edges.
    """
    pairs = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s <> d")
    current = pairs.select(F.greatest("s", "d").alias("a"), F.least("s", "d").alias("b")).distinct()
    current = cut(_contracted(current).distinct())
    seen = _signature(current)
    if not seen[0]:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(MAX_ROUNDS):
        if seen[0] < CHUNK:
            current = cut(_contracted(current.coalesce(1)))
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        large = (
            both.join(low, "a")
            .where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = cut(large)
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
        small = small.where("e.x <> e.y").select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).distinct()
        current = cut(_contracted(small).distinct())
        now = _signature(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
