"""Connected components of an edge table, by alternating large-star and small-star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_most, materialize

#: Edges that a task contracts at once; as many stars as that are finished in one task of bounded size.
_LOCAL_EDGES = 1 << 19


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run of edges becomes stars around its components' smallest nodes."""

    def stars(edges: list[np.ndarray]) -> pa.RecordBatch:
        forest = Forest()
        for a, b in np.concatenate(edges).tolist():
            forest.union(a, b)
        nodes = np.fromiter(forest.parent, np.int64, len(forest.parent))
        roots = np.array([forest.find(x) for x in nodes.tolist()], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["a", "b"])

    kept, size = [], 0
    for batch in batches:
        kept.append(np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
        size += batch.num_rows
        if size >= _LOCAL_EDGES:
            yield stars(kept)
            kept, size = [], 0
    if kept:
        yield stars(kept)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges lead to, for every node of an edge.

    ``edges``: a long, b long, in any direction, repeated or looped.  Tasks contract
    their own edges first; then each round points a node's larger neighbours, and next
    its smaller ones, to its smallest neighbour, until nothing changes.  A node's
    neighbours are never gathered in one place: minima are pre-aggregated and joined
    back, and skewed joins are split.  As soon as no more edges are left than a task
    contracts at once, one task does the rest.  Lineage is cut in the shared checkpoint folder.
    """
    star = materialize(edges.filter("a <> b").select("a", "b").mapInArrow(_contract, "a long, b long").distinct(), counted=True)
    mark = None
    while not at_most(star, _LOCAL_EDGES):
        both = star.unionAll(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u")).select("a", "b", "m")
        star = materialize(
            small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(small.select("a", F.col("m").alias("b")))
            .distinct(),
            counted=True,
        )
        now = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        star = materialize(star.coalesce(1).mapInArrow(_contract, "a long, b long"))
    return star.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
