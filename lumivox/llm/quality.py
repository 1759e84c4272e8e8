"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is good or bad.  A line's potentials come from binned statistics of the line
and of the lines before and after it; transitions tie neighbouring labels together.
Lines inherit the label of their document for training.  A document's score is the
mean of its lines' forward-backward marginals of "good", weighted by length, through
a logistic curve fitted on the training documents.

Statistics are computed for whole batches of bytes with numpy; a line costs no Python
object.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, is_held_out, map_texts, release_memory, table, text_chunks, word_bounds, word_hashes

#: Bounds of the training sample: labelled rows, and code points of all its texts together.
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 16_000_000
#: Predicted good from this score on.
THRESHOLD = 0.3

_LINE = np.ones(256, bool)
_LINE[10] = False
_CLASSES = np.zeros((256, 4), bool)  # upper case, digit, mark of prose, other sign
_CLASSES[0x41:0x5B, 0] = True
_CLASSES[0x30:0x3A, 1] = True
for _mark in b".,;:'-\"()?":
    _CLASSES[_mark, 2] = True
for _sign in range(0x21, 0x7F):
    _CLASSES[_sign, 3] = not (chr(_sign).isalnum() or _CLASSES[_sign, 2])
_CODE = (_CLASSES * np.array([1, 2, 3, 4])).max(axis=1).astype(np.uint8)

#: Cuts of the bins of each statistic.
CUTS = (
    np.array([20, 60, 150, 400, 1000, 4000]),  # bytes
    np.array([0.02, 0.06, 0.15, 0.3, 0.6]),  # upper case / bytes
    np.array([0.01, 0.05, 0.15, 0.4]),  # digits / bytes
    np.array([0.005, 0.02, 0.05, 0.1]),  # prose marks / bytes
    np.array([0.002, 0.01, 0.03, 0.08, 0.2]),  # other signs / bytes
    np.array([3.0, 4.5, 6.0, 7.5, 9.0, 12.0]),  # bytes a word
    np.array([0.01, 0.05, 0.2, 0.6]),  # words equal to the word before them / words
    np.array([0.2, 0.4, 0.6, 0.75, 0.9]),  # different words / words
    np.array([0.5]),  # repeats an earlier line of the document
)
WIDTH = sum(len(c) + 1 for c in CUTS)
#: Own bins, the bins before and after (all zero beyond the ends), first line, last line, constant.
FEATURES = 3 * WIDTH + 3


@dataclass
class Lines:
    """The lines of some documents: feature numbers, lengths, and each document's first line."""

    bins: np.ndarray  # lines x statistics, as columns of the WIDTH one-hot features
    length: np.ndarray
    first: np.ndarray


def line_statistics(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines (runs of bytes other than LF) of each row; rows of empty lines only have none."""
    starts, ends, first = word_bounds(data, offsets, _LINE)
    n = len(starts)
    if n == 0:
        return Lines(np.zeros((0, len(CUTS)), np.int64), np.zeros(0), first)
    length = (ends - starts).astype(float)
    code = _CODE[data]
    marks = np.empty((n, 4))
    for k in range(4):
        sums = np.concatenate([[0], np.cumsum(code == k + 1)])
        marks[:, k] = (sums[ends] - sums[starts]) / length
    word_start, word_end, _ = word_bounds(data, offsets, SPACED)
    line_of = np.searchsorted(starts, word_start, "right") - 1
    words = np.bincount(line_of, minlength=n).astype(float)
    in_words = np.bincount(line_of, weights=word_end - word_start, minlength=n)
    hashes = word_hashes(data, word_start, word_end)
    again = np.zeros(n)
    if len(hashes) > 1:
        same = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
        again = np.bincount(line_of[1:][same], minlength=n).astype(float)
    order = np.lexsort((hashes, line_of))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][fresh], minlength=n).astype(float)
    some = np.maximum(words, 1)
    row_of = np.searchsorted(first, np.arange(n), "right") - 1
    line_hash = word_hashes(data, starts, ends)
    order = np.lexsort((np.arange(n), line_hash, row_of))
    repeats = np.zeros(n)
    repeats[order[1:]] = (line_hash[order][1:] == line_hash[order][:-1]) & (row_of[order][1:] == row_of[order][:-1])
    values = (length, marks[:, 0], marks[:, 1], marks[:, 2], marks[:, 3], in_words / some, again / some, distinct / some, repeats)
    base, columns = 0, []
    for cuts, value in zip(CUTS, values):
        columns.append(base + np.searchsorted(cuts, value, "right"))
        base += len(cuts) + 1
    return Lines(np.column_stack(columns), length, first)


def _lines_of(texts: list[str]) -> Lines:
    """The lines of all texts, counted chunk by chunk."""
    parts = [line_statistics(data, offsets) for _, _, data, offsets in text_chunks(pa.array(texts, pa.string()))]
    first = [np.zeros(1, np.int64)]
    for part in parts:
        first.append(part.first[1:] + first[-1][-1])
    return Lines(np.concatenate([p.bins for p in parts]), np.concatenate([p.length for p in parts]), np.concatenate(first))


@dataclass
class ChainModel:
    """Weights of "good" over "bad" by feature, transition scores, and the logistic curve of the document score."""

    weight: np.ndarray
    transition: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def _neighbours(self, lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(lines.length)
        first = lines.first[:-1][np.diff(lines.first) > 0]
        last = lines.first[1:][np.diff(lines.first) > 0] - 1
        has_before, has_after = np.ones(n, bool), np.ones(n, bool)
        has_before[first] = False
        has_after[last] = False
        return first, last, has_before, has_after

    def unary(self, lines: Lines) -> np.ndarray:
        """Score of "good" over "bad" for every line."""
        first, last, has_before, has_after = self._neighbours(lines)
        w = self.weight
        own = w[:WIDTH][lines.bins].sum(axis=1)
        before = w[WIDTH : 2 * WIDTH][lines.bins].sum(axis=1)
        after = w[2 * WIDTH : 3 * WIDTH][lines.bins].sum(axis=1)
        score = own + w[-1]
        score[1:] += np.where(has_before[1:], before[:-1], 0)
        score[:-1] += np.where(has_after[:-1], after[1:], 0)
        score[first] += w[-3]
        score[last] += w[-2]
        return score

    def marginals(self, lines: Lines, heft: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of every line, summed pair marginals (2 x 2) and the log partition of every document with lines.

        ``heft``: weight of each document's pairs in their sum, by default 1.  Documents advance together, line by line, in the order of their lengths.
        """
        n = len(lines.length)
        score = np.zeros((n, 2))
        if n:
            score[:, 1] = self.unary(lines)
        counts = np.diff(lines.first)
        docs = np.flatnonzero(counts)
        docs = docs[np.argsort(-counts[docs], kind="stable")]
        begin, size = lines.first[:-1][docs], counts[docs]
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        longest = int(size.max()) if len(size) else 0
        active = [int(np.searchsorted(-size, -t, "left")) for t in range(longest)]  # documents with more than t lines
        alpha[begin] = score[begin]
        for t in range(1, longest):
            at = begin[: active[t]] + t
            joint = alpha[at - 1][:, :, None] + self.transition[None]
            alpha[at] = np.logaddexp(joint[:, 0], joint[:, 1]) + score[at]
        for t in range(longest - 1, 0, -1):
            at = begin[: active[t]] + t
            joint = self.transition[None] + (score[at] + beta[at])[:, None, :]
            beta[at - 1] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        end = begin + size - 1
        partition = np.logaddexp(alpha[end, 0], alpha[end, 1])
        z = np.zeros(len(counts))
        z[docs] = partition
        row = np.repeat(np.arange(len(counts)), counts)
        good = np.exp(alpha[:, 1] + beta[:, 1] - z[row])
        pairs = np.zeros((2, 2))
        at = np.flatnonzero(np.diff(row) == 0) + 1 if n else np.zeros(0, np.int64)
        if len(at):
            joint = alpha[at - 1][:, :, None] + self.transition[None] + (score[at] + beta[at])[:, None, :] - z[row[at]][:, None, None]
            pairs = (np.exp(joint) * (1.0 if heft is None else heft[row[at]][:, None, None])).sum(axis=0)
        return good, pairs, z

    def _gradient(self, lines: Lines, residual: np.ndarray) -> np.ndarray:
        """Sum over lines of residual times feature."""
        first, last, has_before, has_after = self._neighbours(lines)
        out = np.zeros(FEATURES)
        shifted_before, shifted_after = np.zeros_like(residual), np.zeros_like(residual)
        shifted_before[:-1] = np.where(has_before[1:], residual[1:], 0)
        shifted_after[1:] = np.where(has_after[:-1], residual[:-1], 0)
        for k, value in enumerate((residual, shifted_before, shifted_after)):
            for column in range(lines.bins.shape[1]):
                out[k * WIDTH : (k + 1) * WIDTH] += np.bincount(lines.bins[:, column], weights=value, minlength=WIDTH)
        out[-3], out[-2], out[-1] = residual[first].sum(), residual[last].sum(), residual.sum()
        return out

    def mean_good(self, lines: Lines) -> np.ndarray:
        """Length-weighted mean marginal of every document; a document without lines counts as one bad line."""
        good, _, _ = self.marginals(lines)
        row = np.repeat(np.arange(len(lines.first) - 1), np.diff(lines.first))
        n = len(lines.first) - 1
        heft = np.bincount(row, weights=lines.length, minlength=n)
        return np.divide(np.bincount(row, weights=lines.length * good, minlength=n), heft, out=np.zeros(n), where=heft > 0)

    def score(self, lines: Lines) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.mean_good(lines) + self.offset)))


def objective(model: ChainModel, lines: Lines, truth: np.ndarray, heft: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted conditional log-likelihood of the documents' lines, and its gradient by all weights and transitions.

    ``truth``: label of each line; ``heft``: weight of each document.
    """
    counts = np.diff(lines.first)
    row = np.repeat(np.arange(len(counts)), counts)
    good, expected, z = model.marginals(lines, heft)
    labels = truth.astype(int)
    at = np.flatnonzero(np.diff(row) == 0) + 1 if len(row) else np.zeros(0, np.int64)
    observed = np.zeros((2, 2))
    np.add.at(observed, (labels[at - 1], labels[at]), heft[row[at]])
    unary = float((truth * heft[row] * model.unary(lines)).sum()) if len(row) else 0.0
    value = unary + float((observed * model.transition).sum()) - float((heft * z).sum())
    return value, np.concatenate([model._gradient(lines, (truth - good) * heft[row]), (observed - expected).ravel()])


def train(texts: list[str], labels: np.ndarray, steps: int = 120, rate: float = 0.15, decay: float = 1e-3) -> ChainModel:
    """Fit the chain by Adam on the penalised conditional log-likelihood of the lines, then the logistic curve.

    Classes weigh alike, and a document weighs by its class, not by its number of lines.
    Without labelled texts every score is 1/2.
    """
    model = ChainModel(np.zeros(FEATURES), np.zeros((2, 2)))
    if len(texts) == 0:
        model.slope = 0.0
        return model
    lines = _lines_of(texts)
    counts = np.diff(lines.first)
    truth = np.repeat(labels.astype(float), counts)
    n = len(truth)
    share = labels.mean() if 0 < labels.mean() < 1 else 0.5
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / np.maximum(counts, 1) / len(texts)
    params = np.zeros(FEATURES + 4)
    first_moment, second_moment = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1) if n else ():
        model.weight, model.transition = params[:FEATURES], params[FEATURES:].reshape(2, 2)
        gradient = objective(model, lines, truth, weight)[1] - decay * params
        first_moment = 0.9 * first_moment + 0.1 * gradient
        second_moment = 0.999 * second_moment + 0.001 * gradient**2
        params = params + rate * (first_moment / (1 - 0.9**step)) / (np.sqrt(second_moment / (1 - 0.999**step)) + 1e-8)
    model.weight, model.transition = params[:FEATURES].copy(), params[FEATURES:].reshape(2, 2).copy()
    mean = model.mean_good(lines)
    heft = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    a, b = 1.0, -0.5
    for _ in range(50):  # Newton steps of a lightly penalised logistic regression in one variable
        p = 1 / (1 + np.exp(-(a * mean + b)))
        curve = heft * p * (1 - p)
        g = np.array([(heft * (labels - p) * mean).sum() - 0.1 * a, (heft * (labels - p)).sum() - 0.1 * b])
        h = np.array([[(curve * mean * mean).sum() + 0.1, (curve * mean).sum()], [(curve * mean).sum(), curve.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
    model.slope, model.offset = float(max(a, 0.0)), float(b)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, rows: int, chars: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of labelled documents, held-out ones excluded: at most ``rows`` of them and ``chars`` code points together.

    Half of both at most for either label.  Documents are taken whole, of any length, in
    the order of hashes of doc_id (so the sample doesn't depend on the order of the
    table), as long as they fit; one that doesn't is passed over.  Only ids and lengths
    of the candidates reach the driver before that; then the texts of the chosen alone.
    """
    known = labels.filter(F.col(column).isin(0, 1) & ~is_held_out()).groupBy("doc_id").agg(F.max(column).alias("label"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    least = lambda k: known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
    ids = least(0).unionByName(least(1))
    sizes = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.sum(F.length("text")).alias("size"), F.xxhash64("doc_id").alias("order"))
    left, chosen = {0: chars // 2, 1: chars // 2}, []
    for r in sorted(sizes.collect(), key=lambda r: (r["order"], r["doc_id"])):
        if r["size"] <= left[r["label"]]:
            left[r["label"]] -= r["size"]
            chosen.append((r["doc_id"], r["label"]))
    if not chosen:
        return [], np.zeros(0)
    wanted = docs.sparkSession.createDataFrame(chosen, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int")
    got = texts.join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "label").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return got.column("text").to_pylist(), np.array(got.column("label").to_pylist(), dtype=float)


def score_quality(
    docs: DataFrame, model: ChainModel, threshold: float = THRESHOLD, score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on); columns of the names given are replaced.

    Every row is scored on its whole text alone.  A text without lines (null, empty,
    only line feeds) scores as one surely bad line.  An empty table gives no rows.
    """
    fields = [f for f in docs.schema.fields if f.name not in (score, predicted)]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(line_statistics(d, o)) for _, _, d, o in text_chunks(batch.column("text").cast(pa.string()))]
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=[*names, score, predicted],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return map_texts(docs.select(*names), run, f"{schema}, `{score}` double, `{predicted}` int")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> ChainModel:
    """The chain model of ``labels.quality``, from a bounded sample of rows that aren't held out."""
    model = train(*labelled_sample(docs, labels, "quality", rows, chars))
    release_memory()
    return model


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
