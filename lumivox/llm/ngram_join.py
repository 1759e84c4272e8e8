"""N-gram Jaccard self-join by prefix trees.

A document is its set of distinct 5-word shingles, as 64-bit fingerprints; two link
when their Jaccard similarity is 0.8 or more.  Documents of equal sets are one node.

1. Candidates.  With t = ceil(0.8 n), a pair that links shares, in the order of
   fingerprints, its first l common shingles within the first n - t + l of each set.
   Those prefixes alone are dealt by shingle.  A set with fewer than l prefix shingles
   that any other set has links with nothing; it is dropped here, which removes nearly
   all documents without near copies, whatever passages they share.  Of the others,
   only the rarest shared shingles (a second prefix filter, now by frequency) join
   sets to candidate clusters.
2. Prefix-tree join inside a cluster.  Sets, ordered by descending frequency in the
   cluster, go into a path-compressed trie.  Each set walks the trie; nodes share the
   overlap of their common path, and a subtree is left when the overlap so far plus
   what can remain is too small for any set in it, when its lengths don't fit, or when
   all of it is already in the component of the walking set.
3. Clusters of more than one block are dealt to blocks of bounded size, each joined on
   its own; then blocks of the blocks' central sets are joined, level by level.  A large
   family of near copies is one component after that.  What it leaves is exact, too: a
   shared shingle whose holders are all of one component can't add anything.  For every
   other one the holders meet, each that is outside their largest component with all
   others, in groups cut into pairs of blocks where they are beyond a block.
4. The links that join two components inside a task (a spanning forest, never all
   pairs) are merged by connected components.

Shingle fingerprints of 64 bits stand for shingles; two sets of equal size and equal
64-bit sum of mixed fingerprints count as equal.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, arrow_rows, at_most, map_texts, materialize, mix, table, text_chunks, word_bounds, word_hashes
from .graph import components

WORDS = 5
#: Prefix postings of a bucket, on average.
BUCKET = 400_000
#: Shingles of a block of a cluster; where sets are long, a block still holds BLOCK_SETS of them, or what
#: LARGE_BLOCK shingles allow.
BLOCK, BLOCK_SETS, LARGE_BLOCK = 20_000, 64, 2_000_000
#: Shingles of a block where the exact rest is compared: its groups are copied once for each other block.
REST_BLOCK = 200_000
#: Components of a block that send central sets to the next level, sets that each sends, and levels.
CENTRAL, CENTRAL_SETS, LEVELS = 4, 2, 6
#: Up to this many candidate documents (a few dozen bytes each) their ids are broadcast; beyond, they join by shuffle.
BROADCAST_ROWS = 1_000_000
_FLUSH = 1 << 18
#: l = n / DEPTH.  The larger l, the more of a document must be shared for it to stay a candidate: of the n/5 + l
#: prefix shingles, 0.8 l.
DEPTH = 5

_POSTING = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<u4")])
_SHARED = np.dtype([("node", "<i8"), ("n", "<u4"), ("df", "<u4"), ("center", "<i8"), ("token", "<u8")])


def _required(n):
    """Least overlap that a set of n needs for any link: ceil(0.8 n)."""
    return -(-4 * n // 5)


def _depth(n):
    """l: common shingles that must stand in the prefixes of a linked pair, by the size of a set; never falls with n."""
    return np.maximum(1, n // DEPTH)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle fingerprints of each row (A-Z lower-cased)."""
    starts, ends, first = word_bounds(data, offsets, SPACED)
    words = word_hashes(data, starts, ends)
    factor = np.uint64(0x9FB21C651E98DF25)

    def chained(columns: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(columns[0]), 0xA0761D6478BD642F * len(columns) % 2**64, np.uint64)
        for column in columns:
            h = h * factor + column
        return mix(h)

    total = len(words) - WORDS + 1
    grams = chained([words[j : j + total] for j in range(WORDS)]) if total > 0 else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            out.append(chained([words[k : k + 1] for k in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(tokens: np.ndarray) -> int:
    """The set's fingerprint, as a signed number."""
    total = int(mix(tokens ^ np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)) + len(tokens) * 0x8EBC6AF09C88C6E3
    return int(mix(np.array([total % 2**64], np.uint64)).astype(np.int64)[0])


def _text_sets(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, data, offsets in text_chunks(column.cast(pa.string())):
        yield from shingle_sets(data, offsets)


def _identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes = [], []
        for tokens in _text_sets(batch.column("text")):
            sizes.append(len(tokens))
            nodes.append(node_of(tokens) if len(tokens) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], names=["doc_id", "n_shingles", "node"]
        )


def _with_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = [node_of(tokens) if len(tokens) else None for tokens in _text_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("text"), pa.array(nodes, pa.int64())], names=["text", "node"])


def _postings(buckets: int) -> object:
    """Prefix postings of every set, packed by bucket of the shingle; sets seen before by the task are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        kept: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(kept)
            bucket = (rows["token"] >> np.uint64(11)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            numbers, at = np.unique(bucket[order], return_index=True)
            blobs = [x.tobytes() for x in np.split(rows[order], at[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers.astype(np.int64)), pa.array(blobs, pa.binary())], names=["bucket", "blob"]
            )

        for batch in batches:
            for tokens in _text_sets(batch.column("text")):
                n = len(tokens)
                if not n:
                    continue
                node = node_of(tokens)
                if node in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                rows = np.empty(min(n, n - _required(n) + int(_depth(n))), _POSTING)
                rows["token"], rows["node"], rows["n"] = tokens[: len(rows)], node, n
                kept.append(rows)
                size += len(rows)
                if size >= _FLUSH:
                    yield flush()
                    kept, size = [], 0
        if kept:
            yield flush()

    return run


def _keyed_blobs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of equal keys of rows that are sorted by them."""
    current, blobs = None, []
    for batch in batches:
        for number, blob in zip(batch.column(key).to_pylist(), batch.column("blob").to_pylist()):
            if number != current:
                if blobs:
                    yield current, blobs
                current, blobs = number, []
            blobs.append(blob)
    if blobs:
        yield current, blobs


def _shared(buckets: int) -> object:
    """Postings of shingles that two or more sets have, with their frequency and smallest set, packed by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _keyed_blobs(batches, "bucket"):
            rows = np.frombuffer(b"".join(blobs), _POSTING)
            rows = rows[np.lexsort((rows["node"], rows["token"]))]
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
            rows = rows[fresh]
            head = np.ones(len(rows), bool)
            head[1:] = rows["token"][1:] != rows["token"][:-1]
            at = np.flatnonzero(head)
            df = np.diff(np.append(at, len(rows)))
            group = np.cumsum(head) - 1
            keep = df[group] > 1
            if not keep.any():
                continue
            out = np.empty(int(keep.sum()), _SHARED)
            for name in ("node", "n", "token"):
                out[name] = rows[name][keep]
            out["df"], out["center"] = df[group][keep], rows["node"][at][group][keep]
            bucket = out["node"].astype(np.uint64) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            numbers, cut = np.unique(bucket[order], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers.astype(np.int64)), pa.array([x.tobytes() for x in np.split(out[order], cut[1:])], pa.binary())],
                names=["bucket", "blob"],
            )

    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a: set that may link, b: smallest set of one of its rarest shared shingles)."""
    for _, blobs in _keyed_blobs(batches, "bucket"):
        rows = np.frombuffer(b"".join(blobs), _SHARED)
        rows = rows[np.lexsort((rows["token"], rows["df"], rows["node"]))]
        head = np.ones(len(rows), bool)
        head[1:] = rows["node"][1:] != rows["node"][:-1]
        at = np.flatnonzero(head)
        count = np.diff(np.append(at, len(rows)))
        group = np.cumsum(head) - 1
        # partners have 0.8 n shingles at least, and the two prefixes share as many as the smaller set asks for
        enough = count - _depth(_required(rows["n"][at].astype(np.int64))) + 1
        keep = np.arange(len(rows)) - at[group] < enough[group]
        pairs = np.unique(np.column_stack([rows["node"][keep], rows["center"][keep]]), axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


class _Node:
    __slots__ = ("start", "end", "source", "children", "members", "least", "most", "longest", "same")

    def __init__(self, start: int, end: int, source: int):
        self.start, self.end, self.source = start, end, source
        self.children: list[_Node] = []
        self.members: list[int] = []
        self.same = -1


class PrefixTree:
    """Globally ordered sets in a path-compressed trie, joined by walks that share partial overlaps.

    ``known``: a component number for each set, equal for sets that are linked already.
    """

    def __init__(self, sets: list[np.ndarray], known: list[int] | None = None):
        self.sizes = [len(s) for s in sets]
        tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(tokens), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(tokens))
        self.common = int((counts > 1).sum())  # shingles of one set alone add to no overlap
        cuts = np.cumsum(self.sizes)[:-1]
        self.paths = [np.sort(r[r < self.common]) for r in np.split(rank[inverse], cuts)]
        #: How usual a set's shingles are among all sets; the middle of a family of copies has the most usual ones.
        self.centrality = [float(x.mean()) for x in np.split(counts[inverse], cuts)]
        self.parent = list(range(len(sets)))
        first: dict[int, int] = {}
        for i, number in enumerate(known or ()):
            self.parent[i] = first.setdefault(number, i)
        self.root = self._build()

    def _build(self) -> _Node:
        order = sorted(range(len(self.paths)), key=lambda i: self.paths[i].astype(">u4").tobytes())
        root = _Node(0, 0, order[0])
        spine, last = [root], np.zeros(0, np.int64)
        for i in order:
            path = self.paths[i]
            n = min(len(path), len(last))
            apart = np.flatnonzero(path[:n] != last[:n])
            shared = int(apart[0]) if len(apart) else n
            while len(spine) > 1 and spine[-1].start >= shared:
                spine.pop()
            top = spine[-1]
            if top.end > shared:
                lower = _Node(shared, top.end, top.source)
                lower.children, lower.members = top.children, top.members
                top.end, top.children, top.members = shared, [lower], []
            if len(path) == shared:
                top.members.append(i)
            else:
                leaf = _Node(shared, len(path), i)
                leaf.members.append(i)
                top.children.append(leaf)
                spine.append(leaf)
            last = path
        self._measure(root)
        return root

    def _measure(self, root: _Node) -> None:
        nodes = [root]
        for node in nodes:
            nodes.extend(node.children)
        for node in reversed(nodes):
            sizes = [self.sizes[i] for i in node.members]
            node.least = min([*sizes, *(c.least for c in node.children)])
            node.most = max([*sizes, *(c.most for c in node.children)])
            node.longest = max([node.end, *(c.longest for c in node.children)])
            known = {self.find(i) for i in node.members} | {self.find(c.same) if c.same >= 0 else -1 for c in node.children}
            if len(known) == 1:
                node.same = known.pop()

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def links(self, walkers: list[int] | None = None) -> list[tuple[int, int]]:
        """Pairs that link and, together, connect all that links of ``walkers`` (by default all sets) connect."""
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * len(self.paths) + 1000))
        found: list[tuple[int, int]] = []
        mine = np.zeros(self.common, bool)
        for i in range(len(self.paths)) if walkers is None else walkers:
            path = self.paths[i]
            mine[path] = True
            self._walk(self.root, 0, i, mine, found)
            mine[path] = False
        return found

    def central(self) -> list[int]:
        """The most central sets of the largest components of two and more sets."""
        families: dict[int, list[int]] = {}
        for i in range(len(self.paths)):
            families.setdefault(self.find(i), []).append(i)
        largest = sorted((f for f in families.values() if len(f) > 1), key=lambda f: (-len(f), f[0]))[:CENTRAL]
        return [i for f in largest for i in sorted(f, key=lambda i: (-self.centrality[i], i))[:CENTRAL_SETS]]

    def _walk(self, node: _Node, overlap: int, own: int, mine: np.ndarray, found: list[tuple[int, int]]) -> bool:
        """Whether all sets below are known to be in the component of ``own``."""
        if node.same >= 0 and self.find(node.same) == self.find(own):
            return True
        n = self.sizes[own]
        if 4 * n > 5 * node.most or 4 * node.least > 5 * n:
            return False
        left = len(self.paths[own])
        if node.end > node.start:
            stretch = self.paths[node.source][node.start : node.end]
            overlap += int(np.count_nonzero(mine[stretch]))
            left -= int(np.searchsorted(self.paths[own], stretch[-1], "right"))
        smallest = max(node.least, _required(n))
        if 9 * (overlap + min(left, node.longest - node.end)) < 4 * (n + smallest):
            return False
        same = True
        for other in node.members:
            if self.find(other) == self.find(own):
                continue
            if 9 * overlap >= 4 * (n + self.sizes[other]):
                found.append((own, other))
                self.parent[self.find(other)] = self.find(own)
            else:
                same = False
        for child in node.children:
            same &= self._walk(child, overlap, own, mine, found)
        if same:
            node.same = own
        return same


LINKS = "a long, b long, central boolean"


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) inside each group (cluster, i, j) of rows sorted by it, and (central set, cluster) marked central.

    Rows: node, tokens, and, where links are known already, comp (equal for sets that
    are linked) and walks (whether the set must be compared with all others).
    """
    key, sets, walks = None, {}, []

    def joined() -> pa.RecordBatch | None:
        if len(sets) < 2:
            return None
        nodes = list(sets)
        tree = PrefixTree([tokens for tokens, _ in sets.values()], [comp for _, comp in sets.values()])
        pairs = [(nodes[a], nodes[b], False) for a, b in tree.links(walks)]
        pairs += [(nodes[i], key[0], True) for i in tree.central()]
        if not pairs:
            return None
        return arrow_rows(pa.schema([("a", pa.int64()), ("b", pa.int64()), ("central", pa.bool_())]), list(zip(*pairs)))

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "node", "comp", "walks")), batch.column("tokens"))
        for *own, node, comp, walk, tokens in rows:
            if own != key:
                if key is not None and (out := joined()) is not None:
                    yield out
                key, sets, walks = own, {}, []
            if node not in sets:
                if walk:
                    walks.append(len(sets))
                sets[node] = (np.frombuffer(tokens.as_buffer(), np.uint64), comp)
    if key is not None and (out := joined()) is not None:
        yield out


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, cluster, blocks, n, tokens) of the rows whose text has the wanted set; another row may have the same doc_id."""
    for batch in batches:
        sets = list(_text_sets(batch.column("text")))
        wanted = batch.column("node").to_pylist()
        keep = [k for k, tokens in enumerate(sets) if len(tokens) and node_of(tokens) == wanted[k]]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(keep, pa.int64())) for c in ("node", "cluster", "blocks")),
             pa.array([len(sets[k]) for k in keep], pa.int64()), pa.array([sets[k].tobytes() for k in keep], pa.binary())],
            names=["node", "cluster", "blocks", "n", "tokens"],
        )


def candidate_edges(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): a set that may link and the smallest set of one of its rarest shared shingles.

    ``nodes``: node and n_shingles of each distinct set.  Two sets that link both have an
    edge to one same b.
    """
    n = F.col("n_shingles")
    prefix = n - F.ceil(n * 0.8) + F.greatest(F.lit(1), F.floor(n / DEPTH))
    total = nodes.agg(F.coalesce(F.sum(prefix), F.lit(0))).first()[0]
    buckets = max(1, -(-int(total) // BUCKET))
    blobs = "bucket long, blob binary"
    shared = (
        map_texts(docs.select("text"), _postings(buckets), blobs)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_shared(buckets), blobs)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_edges, "a long, b long")
    )
    return materialize(shared)


def few(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if its counted rows allow that."""
    return F.broadcast(df) if at_most(df, BROADCAST_ROWS) else df


def cluster_sets(docs: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, cluster, blocks, n, tokens) of the sets in clusters of two or more that ``edges`` tie together.

    ``blocks``: the number of blocks of the set's cluster.
    """
    survivors = edges.select(F.col("a").alias("node")).distinct()
    found = nodes.join(survivors, "node").join(components(edges).withColumnRenamed("component", "cluster"), "node")
    found = materialize(found)
    sizes = found.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("size")).filter("m > 1")
    sizes = materialize(sizes.select("cluster", _blocks(F.col("size"), F.col("m")).alias("blocks")), counted=True)
    wanted = materialize(found.join(few(sizes), "cluster").select("doc_id", "node", "cluster", "blocks"), counted=True)
    columns = ("node", "cluster", "blocks", "text")
    texts = docs.select("doc_id", "text").join(few(wanted), "doc_id").select(*columns)
    nameless = wanted.filter(F.col("doc_id").isNull()).drop("doc_id")
    if not nameless.isEmpty():  # sets of rows without an id are found by their fingerprints
        own_texts = map_texts(docs.filter(F.col("doc_id").isNull()).select("text"), _with_nodes, "text string, node long")
        texts = texts.unionByName(own_texts.join(few(nameless), "node").select(*columns).dropDuplicates(["node"]))
    return materialize(map_texts(texts, _tokens_of, "node long, cluster long, blocks int, n long, tokens binary"))


def _blocks(size, sets, block: int | None = None):
    """Number of blocks of ``block`` shingles (by default BLOCK) for ``sets`` sets of ``size`` shingles together."""
    mean = size / sets
    each = F.greatest(F.lit(block or BLOCK) / mean, F.least(F.lit(BLOCK_SETS), F.greatest(F.lit(2), F.lit(LARGE_BLOCK) / mean)))
    return F.greatest(F.lit(1), F.ceil(sets / each)).cast("int")


def _deal(node, blocks, level: int = 0):
    return F.pmod(F.xxhash64(node, F.lit(level)), blocks).cast("int")


def _joined(groups: DataFrame) -> DataFrame:
    """Links and central sets of rows (cluster, i, j, node, comp, walks, tokens), grouped by the first three."""
    key = ("cluster", "i", "j")
    return materialize(groups.repartition(*key).sortWithinPartitions(*key).mapInArrow(_join_groups, LINKS))


def _block_links(sets: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(links inside blocks, central sets of the blocks of clusters of several blocks, with their own number of blocks)."""
    dealt = sets.withColumn("i", _deal("node", F.col("blocks"), level))
    found = _joined(dealt.select("cluster", "i", F.lit(0).alias("j"), "node", F.col("node").alias("comp"), F.lit(True).alias("walks"), "tokens"))
    central = few(materialize(found.filter("central").select(F.col("a").alias("node")).distinct(), counted=True))
    chosen = materialize(sets.filter("blocks > 1").join(central, "node", "left_semi").drop("blocks"))
    sizes = chosen.groupBy("cluster").agg(_blocks(F.sum("n"), F.count("*")).alias("blocks"))
    return found.filter("not central").select("a", "b"), chosen.join(few(materialize(sizes, counted=True)), "cluster")


def _rest_links(sets: DataFrame, edges: DataFrame, links: DataFrame) -> DataFrame | None:
    """Links between the components that ``links`` has made of clusters of several blocks.

    ``sets``: the sets of these clusters.  None where nothing is left to compare.
    """
    comps = components(links).withColumnRenamed("component", "comp")
    labelled = sets.select("node").join(comps, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))
    labelled = materialize(labelled)
    own = edges.join(labelled.withColumnRenamed("node", "a"), "a")  # the edges of these clusters alone
    centres = own.select("b").distinct().join(labelled.withColumnRenamed("node", "b"), "b").select("b", "comp")
    open_ = (
        own.select("b", "comp").unionByName(centres)
        .groupBy("b").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
        .filter("least <> most").select("b")
    )
    rest = materialize(own.join(open_, "b", "left_semi").select("a", "b"))
    if rest.isEmpty():
        return None
    # sets that link share a centre: its holders are a group, whose sizes add up to the edges
    slim = rest.select(F.col("a").alias("node"), F.col("b").alias("cluster")).join(labelled, "node").join(sets.select("node", "n"), "node")
    slim = materialize(slim)
    parts = slim.groupBy("cluster", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("size"))
    largest = parts.groupBy("cluster").agg(F.max(F.struct("size", "comp")).alias("x")).select("cluster", F.col("x.comp").alias("main"))
    sized = parts.join(few(materialize(largest, counted=True)), "cluster").withColumn("inside", F.col("comp") == F.col("main"))
    total = lambda inside, column: F.coalesce(F.sum(F.when(F.col("inside") == inside, F.col(column))), F.lit(0))
    plan = (
        sized.groupBy("cluster", "main")
        .agg(total(True, "m").alias("m0"), total(True, "size").alias("s0"), total(False, "m").alias("m1"), total(False, "size").alias("s1"))
        .filter("m1 > 0")
        .select("cluster", "main", _blocks(F.col("s0"), F.col("m0"), REST_BLOCK).alias("p"), _blocks(F.col("s1"), F.col("m1"), REST_BLOCK).alias("q"))
    )
    # blocks 0 to q - 1 hold the sets outside the largest component, -1 to -p those of it; a group is two blocks
    inside = F.col("comp") == F.col("main")
    placed = materialize(
        slim.join(few(materialize(plan, counted=True)), "cluster")
        .withColumn("own", F.when(inside, -1 - _deal("node", F.col("p"))).otherwise(_deal("node", F.col("q"))))
        .select("node", "cluster", "comp", "own", "p", "q")
    )
    outer = F.sequence(F.lit(0), F.col("q") - 1)
    both = F.concat(F.filter(outer, lambda k: (k != F.col("own")) | (F.col("q") == 1)), F.sequence(-F.col("p"), F.lit(-1)))
    met = placed.withColumn("other", F.explode(F.when(F.col("own") < 0, outer).otherwise(both)))
    met = met.select(
        "node", "cluster", "comp", (F.col("own") >= 0).alias("walks"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )
    groups = sets.select("node", "tokens").join(few(met), "node")
    return _joined(groups.select("cluster", "i", "j", "node", "comp", "walks", "tokens")).filter("not central").select("a", "b")


def similarity_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links between distinct sets that connect all linked sets.

    ``nodes``: node, n_shingles and the smallest doc_id of each distinct set.
    """
    edges = candidate_edges(docs, nodes)
    sets = cluster_sets(docs, nodes, edges)
    links, central = _block_links(sets, 0)
    large = sets.filter("blocks > 1")
    if large.isEmpty():
        return links
    for level in range(1, LEVELS):
        if central.isEmpty():
            break
        more, central = _block_links(central, level)
        links = links.unionByName(more)
    rest = _rest_links(large, edges, links)
    return links if rest is None else links.unionByName(rest)


def _rows_and_members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of every row, and (node, component) of every distinct set."""
    rows = materialize(map_texts(docs, _identify, "doc_id long, n_shingles long, node long"))
    nodes = rows.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"))
    nodes = materialize(nodes)
    members = components(similarity_links(docs, nodes))
    return rows, nodes.join(members, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id that links lead to, itself included).

    ``docs``: doc_id (long) and text; further columns are ignored.  A row for each input
    row.  Null texts and texts without words have 0 shingles, link with nothing and are
    their own component.  Rows of equal sets are linked; ids that repeat with unequal
    texts are treated row by row.  A null doc_id links like any other, but names no
    component (a component of null ids alone has a null id).  No table size, group size
    or text length changes what links.
    """
    rows, labelled = _rows_and_members(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    # components of one set need no name but their own; the others' names meet their sets by broadcast, so a large one stays spread
    names = labelled.groupBy("component").agg(F.count("*").alias("m"), F.min("doc_id").alias("component_id")).filter("m > 1")
    names = materialize(names.select("component", "component_id"), counted=True)
    named = labelled.join(few(names), "component", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


_NODE = "__shingle_set"


def _add_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = [node_of(tokens) if len(tokens) else None for tokens in _text_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=[*batch.schema.names, _NODE])


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest doc_id (null last, then by its set).

    Rows are decided one by one, by doc_id and text: rows that share an id with unlike
    texts are documents of their own, and rows without an id take part as any other.
    Of rows that repeat the kept doc_id and set one stays.  Texts without words are
    never dropped.
    """
    rows, labelled = _rows_and_members(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    named = rows.filter("n_shingles > 0").join(labelled.select("node", "component"), "node").select("doc_id", "node", "component").distinct()
    named = materialize(named)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node"))
    keepers = materialize(named.groupBy("component").agg(first.alias("keep"), F.count("*").alias("m")).filter("m > 1").drop("m"), counted=True)
    gone = named.join(few(keepers), "component").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("node") == F.col("keep.node")))
    )
    gone = materialize(gone.select("doc_id", "node"))
    # ids of one row are decided by the id; texts are looked at again only for the others
    several = materialize(rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), counted=True)
    own = F.col("doc_id").cast("long")
    single = docs.filter(own.isNotNull())
    match = lambda df, other: df["doc_id"].cast("long") == other["doc_id"]
    repeated = few(several)
    by_id = few(materialize(gone.filter("doc_id is not null").join(repeated, "doc_id", "left_anti").select("doc_id"), counted=True))
    kept = single.join(by_id, match(single, by_id), "left_anti")
    if several.isEmpty() and rows.filter("doc_id is null").isEmpty():
        return kept
    kept = kept.join(repeated, match(kept, repeated), "left_anti")
    careful = single.join(repeated, match(single, repeated), "left_semi").unionByName(docs.filter(own.isNull()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    noted = map_texts(careful, _add_nodes, f"{schema}, {_NODE} long")
    out = gone.select(F.col("doc_id").alias("__id"), F.col("node").alias("__set"))
    stay = noted.join(out, noted["doc_id"].cast("long").eqNullSafe(out["__id"]) & (noted[_NODE] == out["__set"]), "left_anti")
    once = stay.filter(F.col(_NODE).isNotNull()).dropDuplicates(["doc_id", _NODE]).unionByName(stay.filter(F.col(_NODE).isNull()))
    return kept.unionByName(once.select(*docs.columns))


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS gram
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
c(r, root) AS (SELECT r, r FROM d UNION SELECT e.y, c.root FROM c JOIN e ON e.x = c.r),
m AS (SELECT c.r, min(doc_id) AS component_id FROM c JOIN d ON d.r = c.root GROUP BY c.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (r) JOIN m USING (r)
"""
