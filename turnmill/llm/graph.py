"""Connected components of edges, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.workspace import Workspace

EDGE = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vertex of some edges, and the least vertex that it is connected to by them."""
    vertices, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(vertices))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (up := root[root]).tolist() != root.tolist():
            root = up
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return vertices, vertices[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the same vertices, at most one for each vertex of a batch."""
    for batch in batches:
        vertex, root = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        apart = vertex != root
        yield pa.RecordBatch.from_arrays([pa.array(vertex[apart]), pa.array(root[apart])], ["a", "b"])


def components(edges: DataFrame, space: Workspace, small: int = 200_000) -> DataFrame:
    """Rows (vertex, component): the least vertex connected to each vertex of edges (a, b).

    Edges are contracted batch by batch, then in rounds: each vertex joins its least neighbour, and
    edges move to the joined vertices. What is left of at most ``small`` edges ends in one task.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    left = space.table(edges.mapInArrow(_contract, EDGE).distinct(), "edges")
    named = None
    while left.count() > small:
        both = left.union(left.select("b", "a"))
        up = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        jumped = up.join(up.select(F.col("a").alias("up"), F.col("up").alias("top")), "up", "left")
        step = space.table(jumped.select(F.col("a").alias("vertex"), F.coalesce("top", "up").alias("component")), "step")
        named = step if named is None else space.table(
            named.join(step.select(F.col("vertex").alias("component"), F.col("component").alias("top")), "component", "left")
            .select("vertex", F.coalesce("top", "component").alias("component")),
            "named",
        )
        heads, tails = (step.select(F.col("vertex").alias(v), F.col("component").alias(c)) for v, c in (("a", "x"), ("b", "y")))
        moved = left.join(heads, "a").join(tails, "b")
        moved = moved.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        left = space.table(moved.mapInArrow(_contract, EDGE).distinct(), "edges")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [x for x in batches if x.num_rows]
        a, b = (np.concatenate([x.column(i).to_numpy() for x in parts] or [np.zeros(0, np.int64)]) for i in (0, 1))
        vertex, root = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(vertex), pa.array(root)], ["vertex", "component"])

    last = left.coalesce(1).mapInArrow(finish, "vertex long, component long")
    if named is None:
        return space.table(last, "components")
    ends = last.select(F.col("vertex").alias("component"), F.col("component").alias("top"))
    return space.table(
        named.join(ends, "component", "left").select("vertex", F.coalesce("top", "component").alias("component")), "components"
    )
