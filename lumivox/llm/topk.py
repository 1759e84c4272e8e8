"""Exact top-k inner-product search with a forest of M-trees.

Inner products become a metric by one more coordinate: a vector x of a tree with
largest squared norm M gets sqrt(M - |x|^2), a query gets 0, and then |q - x|^2 =
|q|^2 + M - 2 q.x, so the nearest are those of the highest score.

Every tree holds a bounded number of vectors in pages.  A node keeps its routing
vector, covering radius and distance to its parent; a leaf keeps for each entry the
distance to the page's routing vector.  A search takes nodes best first; by the
triangle inequality |d(q, parent) - d(o, parent)| bounds d(q, o) from stored numbers,
so nodes and entries beyond the k-th score so far are left without computing their
distance.

The trees' upper level is a bounded number of routing vectors, held by the driver and
sent to tasks: every vector goes to its nearest one, and each keeps its covering radius.
A region of more vectors than a tree holds is several trees, dealt by a salt, so no
label or repeated vector makes one larger.  A query first visits the region of the best
bound; its k-th score there goes with it to the other regions, and only to those whose
bound q.p + |q| radius reaches it.  Answers are k rows a query and tree, merged by a
pre-aggregated ranking.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table

#: Vectors of a tree (more, up to the second number, where there would be over FOREST trees), entries of a page,
#: children of a node.
TREE, TREE_MOST, FOREST, PAGE, FAN = 4096, 65_536, 256, 128, 16
#: Routing vectors of the upper level, and numbers in all of them.
ROUTERS, ROUTER_CELLS = 1024, 1 << 20
SCALE = 1024
#: Levels of nodes; what is still together below them shares a page.
DEEPEST = 64
#: Scores are integers; the bounds are doubles and err by far less than this.
SLACK = 0.5


def _long(score: int) -> int:
    return max(-(2**63), min(2**63 - 1, score))


class MTree:
    """A bulk-loaded M-tree over integer vectors (held as doubles, exact below 2**53)."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fan: int = FAN):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        with np.errstate(over="ignore", invalid="ignore"):
            norms = np.einsum("ij,ij->i", vectors, vectors)
        self.limit = float(norms.max()) if len(norms) else 0.0
        if not np.isfinite(self.limit):  # no distances then: searches compute every score as a whole number
            return
        self.points = np.hstack([vectors, np.sqrt(np.maximum(self.limit - norms, 0))[:, None]])
        self.page, self.fan = page, fan
        #: Scores computed by all searches so far.
        self.scored = 0
        self.router: list[np.ndarray] = []
        self.radius: list[float] = []
        self.to_parent: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.entries: list[np.ndarray | None] = []
        self.entry_distance: list[np.ndarray | None] = []
        if len(ids):
            self._load(np.arange(len(ids)), self.points.mean(axis=0), None)
            self._freeze()

    def _load(self, rows: np.ndarray, router: np.ndarray, parent: np.ndarray | None, depth: int = 0) -> int:
        """A node over ``rows``; returns its number."""
        distance = np.sqrt(((self.points[rows] - router) ** 2).sum(axis=1))
        node = len(self.router)
        self.router.append(router)
        self.radius.append(float(distance.max()))
        self.to_parent.append(0.0 if parent is None else float(np.sqrt(((router - parent) ** 2).sum())))
        self.children.append(None)
        self.entries.append(None)
        self.entry_distance.append(None)
        groups = self._split(rows) if len(rows) > self.page and depth < DEEPEST else []
        if len(groups) < 2:  # a page; rows that nothing tells apart share one
            order = np.argsort(distance, kind="stable")
            self.entries[node], self.entry_distance[node] = rows[order], distance[order]
            return node
        self.children[node] = np.array([self._load(g, self.points[g].mean(axis=0), router, depth + 1) for g in groups])
        return node

    def _split(self, rows: np.ndarray) -> list[np.ndarray]:
        """Groups of ``rows`` around seeds that lie far apart; each row goes to its nearest."""
        points = self.points[rows]
        far = ((points - points[0]) ** 2).sum(axis=1)
        nearest = np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), np.int64)
        seed = int(far.argmax())
        for k in range(min(self.fan, -(-len(rows) // self.page) + 1)):
            distance = ((points - points[seed]) ** 2).sum(axis=1)
            closer = distance < nearest
            owner[closer] = k
            nearest[closer] = distance[closer]
            seed = int(nearest.argmax())
            if nearest[seed] == 0.0:
                break
        return [rows[owner == k] for k in np.unique(owner)]

    def _freeze(self) -> None:
        self.router = np.array(self.router)
        self.radius = np.array(self.radius)
        self.to_parent = np.array(self.to_parent)

    def _whole(self, vector: np.ndarray, own_row: int, k: int) -> list[tuple[int, int]]:
        """The k best by whole numbers, for vectors whose squares leave the range of doubles."""
        query = [int(x) for x in vector]
        scores = [
            (_long(sum(a * int(b) for a, b in zip(query, other) if a and b)), -int(name))
            for row, name, other in zip(self.rows.tolist(), self.ids.tolist(), self.vectors.tolist())
            if row != own_row
        ]
        return [(score, -name) for score, name in sorted(scores, reverse=True)[:k]]

    def search(self, vector: np.ndarray, own_row: int, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """(score, id) of the k best rows but the query's own: by score, then smaller id.

        Rows that score less than ``floor`` may be left out.
        """
        if not len(self.ids):
            return []
        with np.errstate(over="ignore", invalid="ignore"):
            base = float(vector @ vector) + self.limit
        if not np.isfinite(base):
            return self._whole(vector, own_row, k)
        query = np.append(vector, 0.0)
        bound = lambda d: (base - d * d) / 2 + SLACK if d > 0 else np.inf
        best: list[tuple[float, int]] = []  # a min-heap of (score, -id)
        least = floor  # what a row must reach
        first = float(np.sqrt(((query - self.router[0]) ** 2).sum()))
        queue = [(-bound(first - self.radius[0]), 0, first)]
        while queue:
            most, node, distance = heapq.heappop(queue)
            if -most < least:
                break
            children = self.children[node]
            if children is not None:
                apart = np.abs(distance - self.to_parent[children]) - self.radius[children]
                children = children[[bound(x) >= least for x in apart]]  # bounds from stored distances alone
                if len(children):
                    exact = np.sqrt(((self.router[children] - query) ** 2).sum(axis=1))
                    for child, d in zip(children.tolist(), exact.tolist()):
                        value = bound(d - self.radius[child])
                        if value >= least:
                            heapq.heappush(queue, (-value, child, d))
                continue
            rows = self.entries[node]
            if least > -np.inf:  # entries whose stored distance to the page's router keeps them too far
                room = base + 2 * SLACK - 2 * least
                reach = np.sqrt(room) if room > 0 else 0.0
                near = np.searchsorted(self.entry_distance[node], [distance - reach - 1e-6, distance + reach + 1e-6])
                rows = rows[near[0] : near[1]]
            self.scored += len(rows)
            scores = self.vectors[rows] @ vector
            keep = (scores >= least) & (self.rows[rows] != own_row)
            scores, ids = scores[keep], self.ids[rows[keep]]
            if len(ids) > k:
                pick = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[pick], scores[pick]
            for score, name in zip(scores.tolist(), ids.tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -name))
                elif (score, -name) > best[0]:
                    heapq.heapreplace(best, (score, -name))
            if len(best) == k:
                least = max(least, best[0][0])
        return [(int(s), -n) for s, n in sorted(best, reverse=True)]


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): floor(1024 x) of every component, as doubles, of the rows that take part.

    Those are the rows with an id whose vector holds no null and no component that isn't
    finite (after scaling; doubles beyond 1e305 aren't).
    """
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * SCALE)
    # doubles from 2**53 on are whole numbers
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(2**53), F.floor(x).cast("double")).otherwise(x))
    finite = F.forall(scaled, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, padded with zeros to the longest."""
    lists = column.to_numpy(zero_copy_only=False)
    width = max((len(x) for x in lists), default=0)
    out = np.zeros((len(lists), width))
    for row, values in enumerate(lists):
        out[row, : len(values)] = values
    return out


def _wide(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, max(0, width - matrix.shape[1]))))


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", matrix, matrix)


class Regions:
    """The upper level: routing vectors, and covering radii once they are known."""

    def __init__(self, routers: list[list[float]]):
        width = max(map(len, routers), default=0)
        self.routers = np.array([[*r, *([0.0] * (width - len(r)))] for r in routers]).reshape(len(routers), width)
        self.radius = np.zeros(len(routers))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region and distance to its routing vector of every vector (infinite where squares leave the range)."""
        width = max(vectors.shape[1], self.routers.shape[1])
        vectors, routers = _wide(vectors, width), _wide(self.routers, width)
        region = np.empty(len(vectors), np.int64)
        distance = np.empty(len(vectors))
        with np.errstate(over="ignore", invalid="ignore"):
            for at in range(0, len(vectors), 2048):
                part = vectors[at : at + 2048]
                squares = np.nan_to_num(_norms(routers)[None] - 2 * part @ routers.T, nan=np.inf)
                region[at : at + 2048] = squares.argmin(axis=1)
                # differences, not squares of sums: the radius must not be too small
                distance[at : at + 2048] = np.sqrt(_norms(part - routers[region[at : at + 2048]]))
        return region, np.nan_to_num(distance, nan=np.inf, posinf=np.inf)

    def bounds(self, vector: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of ``vector`` in all regions."""
        width = max(len(vector), self.routers.shape[1])
        with np.errstate(over="ignore", invalid="ignore"):
            query = np.pad(vector, (0, width - len(vector)))
            most = _wide(self.routers, width) @ query + np.sqrt(query @ query) * self.radius
            return np.nan_to_num(most * (1 + 1e-9 * np.sign(most)), nan=np.inf, posinf=np.inf) + SLACK


def _assigned(regions: Regions) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, distance = regions.nearest(_matrix(batch.column("v")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), batch.column("v"), pa.array(region), pa.array(distance)], names=["row", "vec_id", "v", "region", "distance"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A blob (rows, ids and vectors) for each tree, from rows sorted by tree."""
    kept: list[pa.RecordBatch] = []

    def blob(number: int, rows: pa.Table) -> pa.RecordBatch:
        content = (rows.column("row").to_numpy(), rows.column("vec_id").to_numpy(), _matrix(rows.column("v").combine_chunks()))
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([pickle.dumps(content, 5)], pa.binary())], names=["tree", "content"])

    number = None
    for batch in batches:
        keys = batch.column("tree").to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            if b <= a:
                continue
            if number is not None and keys[a] != number:
                yield blob(number, pa.Table.from_batches(kept))
                kept = []
            number = int(keys[a])
            kept.append(batch.slice(a, b - a))
    if kept:
        yield blob(number, pa.Table.from_batches(kept))


_VISIT = "tree long, row long, content binary"


def _visits(regions: Regions, trees: list[list[int]], best: bool) -> object:
    """Queries (row, vec_id, v, floor) for the trees of the region of the best bound, or of all others that reach the floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            floors = batch.column("floor").to_pylist()
            for row, name, vector, floor in zip(batch.column("row").to_pylist(), batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), floors):
                vector = np.array(vector, float)
                most = regions.bounds(vector)
                top = int(most.argmax())
                chosen = [top] if best else [r for r in np.flatnonzero(most >= (-np.inf if floor is None else floor)).tolist() if r != top]
                content = pickle.dumps((name, vector, -np.inf if floor is None else floor), 5)
                out += [(tree, row, content) for r in chosen for tree in trees[r]]
            if out:
                a, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["tree", "row", "content"])

    return run


def _search(k: int) -> object:
    """Answers of queries that follow their tree (whose row is null) in (tree, row) order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored, tree = None, None
        for batch in batches:
            found = []
            for row, content in zip(batch.column("row").to_pylist(), batch.column("content")):
                if row is None:
                    stored, tree = pickle.loads(content.as_py()), None
                    continue
                name, vector, floor = pickle.loads(content.as_py())
                if tree is None or tree.vectors.shape[1] < len(vector):
                    rows, ids, vectors = stored
                    tree = MTree(rows, ids, _wide(vectors, len(vector)))
                vector = np.pad(vector, (0, tree.vectors.shape[1] - len(vector)))
                found += [(row, name, other, _long(s)) for s, other in tree.search(vector, row, k, floor)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["row", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """Per query its k highest inner products among ``vectors``: query_id, rank, vec_id, score.

    ``vectors``: vec_id and v (double components of whole numbers, as ``integer_vectors``
    makes them).  ``is_query``: a condition on them; every row that meets it is a query.
    A query isn't compared with its own row, but with all others, those of an equal
    vec_id too; query rows of an equal vec_id have an answer each.  Ties go to the
    smaller vec_id; fewer than k candidates give fewer rows.  Vectors of unequal length
    compare as if padded with zeros.  Scores beyond 2**53 lose their last digits, and
    those beyond the range of long are its ends.  Empty tables give no rows.
    """
    numbered = materialize(vectors.select("vec_id", "v").withColumn("row", F.monotonically_increasing_id()))
    total, width = numbered.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    each = min(max(TREE, total // FOREST), TREE_MOST)
    count = max(1, min(-(-total // each), ROUTERS, ROUTER_CELLS // max(width, 1)))
    chosen = numbered.orderBy(F.xxhash64("v", "vec_id"), "row").limit(count).select("v").collect()
    regions = Regions([r[0] for r in chosen])
    placed = materialize(numbered.mapInArrow(_assigned(regions), "row long, vec_id long, v array<double>, region long, distance double"))
    trees: list[list[int]] = [[] for _ in range(len(chosen))]
    for region, size, radius in placed.groupBy("region").agg(F.count("*"), F.max("distance")).collect():  # count rows at most
        regions.radius[region] = radius
        trees[region] = [region << 32 | part for part in range(-(-size // each))]
    parts = F.element_at(F.array(*(F.lit(max(1, len(t))) for t in trees)), (F.col("region") + 1).cast("int")) if trees else F.lit(1)
    forest = max(1, sum(map(len, trees)))
    salt = F.pmod(F.xxhash64("row"), parts)
    blobs = (
        placed.select("row", "vec_id", "v", (F.shiftleft("region", 32) + salt).alias("tree"))
        .repartition(forest, "tree")
        .sortWithinPartitions("tree")
        .mapInArrow(_pack, "tree long, content binary")
    )
    blobs = materialize(blobs).select("tree", F.lit(None).cast("long").alias("row"), "content")
    queries = numbered.filter(is_query).select("row", "vec_id", "v")
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")

    def visited(asked: DataFrame, best: bool) -> DataFrame:
        visits = asked.mapInArrow(_visits(regions, trees, best), _VISIT)
        both = blobs.unionByName(visits).repartition(forest, "tree").sortWithinPartitions("tree", F.asc_nulls_first("row"))
        return both.mapInArrow(_search(k), "row long, query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    found = ranked(visited(queries.withColumn("floor", F.lit(None).cast("double")), True))
    if count > 1:
        found = materialize(found)
        floors = found.filter(F.col("rank") == k).select("row", F.col("score").cast("double").alias("floor"))
        found = ranked(found.drop("rank").unionByName(visited(queries.join(floors, "row", "left"), False)))
    return found.select("query_id", "rank", "vec_id", "score")


def op10_topk_search(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose vec_id is divisible by 100."""
    return top_k(integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), F.col("vec_id") % 100 == 0, 10)


SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
