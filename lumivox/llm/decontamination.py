"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over the items' normalised words (word fingerprints numbered
by a sorted vocabulary).  A document's words stream through it; the length of the
longest match ending at each word says which words stand inside a benchmark window.
Words that can't belong to a window are skipped in bulk: a window of w words is a
run of w - 1 adjacent word pairs that all occur in the items, so only such runs
reach the automaton.

The walk keeps no more than a window: a longer match moves to the state of its last w
words, so that no more than w states lie above it on the suffix links, and what those
hold is merged once per state.  Its cost per word doesn't depend on the items' lengths
or repeats.

Benchmarks of more than ``block_words`` words are split into blocks.  One block at a time
comes to the driver, becomes an automaton and is run over the documents; only the hits
are kept between blocks, by a digest of the text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, map_texts, materialize, table, text_chunks, word_bounds, word_hashes

WINDOW = 13
#: Words of a block, whose automaton (some hundred bytes a word) is held by the driver and each worker.
BLOCK_WORDS = 250_000


@dataclass
class SuffixAutomaton:
    """States of all substrings of the items, each with its longest length and suffix link."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, parent: int, word: int, target: int) -> int:
        """A copy of ``target`` for the strings that reach it from ``parent`` or a suffix of it."""
        copy = self._state(self.length[parent] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while parent >= 0 and self.step[parent].get(word) == target:
            self.step[parent][word] = copy
            parent = self.link[parent]
        return copy

    def extend(self, last: int, word: int) -> int:
        """The state of the item's text so far plus ``word``."""
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            target = self.step[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return new


class BenchmarkIndex:
    """Vocabulary, admissible word pairs and the automaton of one block of items.

    ``items`` are (item id as text, word fingerprints) with at least one word each.
    """

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int = WINDOW):
        self.window = window
        self.names = sorted({name for name, _ in items}, key=lambda name: (name is None, name or ""))
        number = {name: k for k, name in enumerate(self.names)}
        self.vocabulary = np.unique(np.concatenate([words for _, words in items]))
        size = len(self.vocabulary)
        coded = [(number[name], np.searchsorted(self.vocabulary, words)) for name, words in items]
        pairs = [codes[:-1].astype(np.int64) * size + codes[1:] for _, codes in coded if len(codes) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        self.shortest = min(min(len(codes), window) for _, codes in coded)
        self.automaton = SuffixAutomaton()
        # owners of the windows and of the short items, by the state that holds them and by their length there
        owners: dict[tuple[int, int], set[int]] = {}
        for _, codes in coded:  # all states first: later items split earlier states
            state = 0
            for word in codes.tolist():
                state = self.automaton.extend(state, word)
        self.cut = self._cuts()
        for item, codes in coded:
            size_here = min(window, len(codes))
            for state, matched in self._walk(codes.tolist()):
                if matched >= size_here:
                    owners.setdefault((self._holder(state, size_here), size_here), set()).add(item)
        self.sizes = sorted({n for _, n in owners})
        self.owners = {key: tuple(sorted(items)) for key, items in owners.items()}
        self.holders: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        for (state, n), names in self.owners.items():
            self.holders.setdefault(state, []).append((n, names))
        self._ending: dict[int, tuple[tuple[int, tuple[int, ...]], ...]] = {}

    def _cuts(self) -> list[int]:
        """For each state the one on its suffix links whose strings include the last ``window`` words."""
        length, link = self.automaton.length, self.automaton.link
        cut = list(range(len(length)))
        for state in sorted(range(1, len(length)), key=length.__getitem__):
            if length[link[state]] >= self.window:
                cut[state] = cut[link[state]]
        return cut

    def _walk(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        """State and matching length, ``window`` at most, after each word; words outside the vocabulary are negative."""
        step, length, link, cut, window = self.automaton.step, self.automaton.length, self.automaton.link, self.cut, self.window
        state = matched = 0
        for word in codes:
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
                if matched >= window:
                    state, matched = cut[state], window
            yield state, matched

    def _holder(self, state: int, size: int) -> int:
        """The state whose strings include the suffix of ``size`` words."""
        length, link = self.automaton.length, self.automaton.link
        while length[link[state]] >= size and link[state] >= 0:
            state = link[state]
        return state

    def _endings(self, state: int) -> tuple[tuple[int, tuple[int, ...]], ...]:
        """(size, items) of all windows that end where the state's strings end, merged along its suffix links once."""
        known = self._ending.get(state)
        if known is None:
            own, below = [], state
            while below > 0:
                own += self.holders.get(below, ())
                below = self.automaton.link[below]
            known = self._ending[state] = tuple(own)
        return known

    def scan(self, codes: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Word ranges inside windows (merged, end exclusive) and the items whose windows occur, for one run."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        least = self.sizes[0]
        last = None
        for at, (state, matched) in enumerate(self._walk(codes.tolist()), 1):
            if matched < least:
                continue
            longest = 0
            for n, names in self._endings(state):
                if n <= matched:
                    longest = max(longest, n)
                    if (state, matched) != last:
                        found.update(names)
            last = (state, matched)
            if longest:
                begin = at - longest
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at))
        return spans, found

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def runs(self, codes: np.ndarray, first_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of words that may hold a window; runs do not cross documents."""
        n = len(codes)
        known = codes >= 0
        joined = np.zeros(n, bool)  # word k continues the run of word k - 1
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        if len(both) and len(self.pairs):
            key = codes[both - 1].astype(np.int64) * len(self.vocabulary) + codes[both]
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            joined[both[self.pairs[at] == key]] = True
        joined[first_words[(first_words > 0) & (first_words < n)]] = False
        heads = np.flatnonzero(known & ~joined)
        follows = np.zeros(n, bool)
        follows[:-1] = joined[1:]
        tails = np.flatnonzero(known & ~follows) + 1
        keep = tails - heads >= self.shortest
        return heads[keep], tails[keep]


def item_words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), ALNUM)
    return word_hashes(data, starts, ends)


def _hashed_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [item_words(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array([len(w) for w in words], pa.int64()), pa.array([w.tobytes() for w in words], pa.binary())],
            names=["item", "n", "words"],
        )


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """Blocks of (item id as text, word fingerprints), of ``block_words`` words at most (or one longer item).

    Rows without words are ignored; items without an item_id have windows as any other,
    but no name.  Executors hash the words; the driver holds a block, and a partition of
    about that size, at a time.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    hashed = materialize(rows.filter(F.col("text").isNotNull()).mapInArrow(_hashed_items, "item string, n long, words binary").filter("n > 0"))
    total = hashed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // block_words))
    if parts > 1:
        hashed = hashed.repartition(parts, F.xxhash64("item", "words"))
    items, size = [], 0
    for row in hashed.toLocalIterator():
        words = np.frombuffer(bytes(row["words"]), np.uint64)
        if items and size + len(words) > block_words:
            yield items
            items, size = [], 0
        items.append((row["item"], words))
        size += len(words)
    if items:
        yield items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def _scan_texts(index: BenchmarkIndex, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """Of each text its number of words, hit code point ranges (merged) with their words, and sorted items.

    Yields (n_words, [(start, end, words)], items).
    """
    for first, end, data, offsets in text_chunks(column):
        starts, ends, first_words = word_bounds(data, offsets, ALNUM)
        codes = index.codes(word_hashes(data, starts, ends))
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for head, tail in zip(*index.runs(codes, first_words)):
            ranges, found = index.scan(codes[head:tail])
            if ranges:
                row = int(np.searchsorted(first_words, head, "right")) - 1
                origin = int(head - first_words[row])
                spans.setdefault(row, []).extend((a + origin, b + origin) for a, b in ranges)
                items.setdefault(row, set()).update(index.names[k] for k in found if index.names[k] is not None)
        counts = np.diff(first_words)
        for row in range(end - first):
            ranges = _merged(spans.get(row, []))
            if ranges:  # word ranges become code point ranges of the text
                points = np.cumsum((data[offsets[row] : offsets[row + 1]] & 0xC0) != 0x80)
                at = lambda byte: int(points[byte - 1]) if byte else 0  # noqa: B023, E731
                base, own = offsets[row], first_words[row]
                ranges = [(at(starts[own + a] - base), at(ends[own + b - 1] - base), a, b) for a, b in ranges]
            yield int(counts[row]), ranges, sorted(items.get(row, ()))


def _scan_batches(index: BenchmarkIndex | None, key: str, hits_only: bool = False) -> object:
    """The mapInArrow function; closes over one automaton (sent once to each worker)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if index is None:
                counts = [len(word_bounds(d, o, ALNUM)[0]) for t in batch.column("text") for _, _, d, o in text_chunks(pa.array([t.as_py()], pa.string()))]
                found = [(n, [], []) for n in counts]
            else:
                found = list(_scan_texts(index, batch.column("text")))
            keys = batch.column(key)
            if hits_only:
                keep = [k for k, (_, ranges, _) in enumerate(found) if ranges]
                found, keys = [found[k] for k in keep], keys.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([n for n, _, _ in found], pa.int64()),
                 pa.array([sum(b - a for _, _, a, b in ranges) for _, ranges, _ in found], pa.int64()),
                 pa.array([names for _, _, names in found], pa.list_(pa.string())),
                 pa.array([[dict(zip(("start", "end", "first", "last"), r)) for r in ranges] for _, ranges, _ in found], SPANS)],
                names=[key, "n_words", "n_hit", "items", "spans"],
            )

    return run


SPANS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "end", "first", "last")]))
_SPANS_SQL = "array<struct<start:long,end:long,first:long,last:long>>"
_FOUND = f"n_words long, n_hit long, items array<string>, spans {_SPANS_SQL}"


def _union_spans(spans):
    """Sorted spans of several blocks, merged where their words touch."""

    def grow(out, s):
        last = F.element_at(out, -1)
        joined = F.concat(
            F.slice(out, F.lit(1), F.size(out) - 1),
            F.array(F.struct(
                last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"),
            )),
        )
        return F.when((F.size(out) > 0) & (s["first"] <= F.get(out, F.size(out) - 1)["last"]), joined).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS_SQL), grow)


def _digest(text: str = "text"):
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def _found_by_blocks(docs: DataFrame, blocks: Iterator, window: int) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of several blocks; hits are functions of the text, so its digest carries them."""
    texts = docs.select(_digest().alias("digest"), "text")
    hits = None
    for items in blocks:
        found = map_texts(texts, _scan_batches(BenchmarkIndex(items, window), "digest", True), f"digest string, {_FOUND}")
        found = materialize(found.dropDuplicates(["digest"]))
        hits = found if hits is None else hits.unionByName(found)
    own = hits.groupBy("digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        _union_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    every = map_texts(
        docs.select(F.struct("doc_id", _digest().alias("digest")).alias("row"), "text"),
        _scan_batches(None, "row"),
        f"row struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},digest:string>, {_FOUND}",
    )
    joined = every.select("row.doc_id", "row.digest", "n_words").join(own, "digest", "left")
    spans = F.coalesce("spans", F.array().cast(_SPANS_SQL))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), spans.alias("spans"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (sorted ids), spans (of hit text).

    Spans are code point ranges (start, end) and word ranges (first, last), ends
    exclusive; hit ranges that touch are merged.  A row for each input row, repeated
    doc_ids included; a null or wordless text has 0 words and no hits; a null doc_id
    stays null.  An empty benchmark hits nothing.  Further columns of either table are
    ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    blocks = item_blocks(benchmark, block_words)
    first, second = next(blocks, None), next(blocks, None)
    if second is not None:
        return _found_by_blocks(docs, itertools.chain([first, second], blocks), window)
    index = BenchmarkIndex(first, window) if first else None
    return map_texts(docs, _scan_batches(index, "doc_id"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_FOUND}")


def is_contaminated(coverage: int = 20):
    """At least one in ``coverage`` words is hit."""
    return (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))


def _cut(text: str, ranges) -> str:
    pieces, last = [], 0
    for start, end in ranges:
        pieces.append(text[last:start])
        last = end
    return "".join([*pieces, text[last:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = 20, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` without contaminated rows and, in the others, without benchmark windows.

    Rows whose hits reach 1/``coverage`` of their words go; in rows below that, every
    span that a window covers is cut out of ``text``, and again whatever windows the
    words before and after a cut form, until none is left; ``n_chars`` (where there is
    such a column) follows.  Rows without hits are returned unchanged.
    """
    blocks = item_blocks(benchmark, block_words)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs
    if second is not None:
        return _decontaminate_by_blocks(docs, itertools.chain([first, second], blocks), window, coverage)
    index = BenchmarkIndex(first, window)

    def clean(text: str, ranges: list) -> str:
        while ranges:
            text = _cut(text, [r[:2] for r in ranges])
            _, ranges, _ = next(_scan_texts(index, pa.array([text], pa.string())))
        return text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            found = list(_scan_texts(index, text.cast(pa.string())))
            hits = [sum(b - a for _, _, a, b in ranges) for _, ranges, _ in found]
            kept = [h == 0 or coverage * h < n for h, (n, _, _) in zip(hits, found)]
            columns = {name: batch.column(name) for name in batch.schema.names}
            rows = [k for k, h in enumerate(hits) if h and kept[k]]
            if rows:
                texts = text.to_pylist()
                for row in rows:
                    texts[row] = clean(texts[row], found[row][1])
                columns["text"] = pa.array(texts, text.type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    for row in rows:
                        sizes[row] = len(texts[row])
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema).filter(pa.array(kept, pa.bool_()))

    return map_texts(docs, run, docs.schema)


def _decontaminate_by_blocks(docs: DataFrame, blocks: Iterator, window: int, coverage: int) -> DataFrame:
    """``decontaminate`` with several blocks: the hits of all blocks decide and are cut; cut texts are looked at again.

    The blocks are kept as rows in the shared folder and come to the driver one at a time, each time anew.
    """
    spark, columns = docs.sparkSession, docs.columns
    stored = None
    for items in blocks:
        rows = [(name, words.tobytes()) for name, words in items]
        block = materialize(spark.createDataFrame(rows, "item string, words binary"))
        stored = [*(stored or []), block]

    def again():
        for block in stored:
            yield [(r["item"], np.frombuffer(bytes(r["words"]), np.uint64)) for r in block.toLocalIterator()]

    def found(frame: DataFrame) -> DataFrame:
        slim = frame.select(_digest().alias("doc_id"), F.col("text").cast("string").alias("text"))
        hits = _found_by_blocks(slim, again(), window).filter("n_hit > 0")
        return materialize(hits.select(F.col("doc_id").alias("__digest"), is_contaminated(coverage).alias("__out"), F.col("spans").alias("__spans")).dropDuplicates(["__digest"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_cut(t, [(s["start"], s["end"]) for s in spans]) for t, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist())]
            own = {name: batch.column(name) for name in columns}
            own["text"] = pa.array(texts, own["text"].type)
            if "n_chars" in own:
                own["n_chars"] = pa.array([len(t) for t in texts], own["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(own.values()), names=columns)

    clean, rest, first = [], docs, True
    while True:
        hits = found(rest)
        marked = rest.withColumn("__digest", _digest())
        clean.append(marked.join(hits, "__digest", "left_anti").select(*columns))
        if hits.isEmpty():
            break
        touched = marked.join(hits if not first else hits.filter("not __out"), "__digest")
        rest = materialize(map_texts(touched.select(*columns, "__spans"), cut, docs.schema))
        first = False
    out = clean[0]
    for part in clean[1:]:
        out = out.unionByName(part)
    return out


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Hit words and items of every document against the whole benchmark table (windows of 13 words)."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT r, dw.n, i, item FROM dw JOIN bw ON dw.n = bw.n AND dw.gram = bw.gram),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM m WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
