"""Toxicity: a convolutional text classifier in numpy with thresholds by language.

A word is the sum of the embeddings that its hash and the hashes of its beginnings pick
from one table, so inflections of a stem share what is learnt.  Filters of several
widths slide over the words, each filter's maximum over the text (through a rectifier)
feeds one linear unit.  A filter of width w is a sum of w products of an embedding with a slice of the
filter, so for scoring the products are tabled once per bucket and a word costs a few
look-ups.

Thresholds are calibrated per language on training documents that the fit hasn't seen.
The language of a text is judged from its function words alone; texts of none of the
languages, or without such words, are a group of their own with a threshold of its own.
A text's logit is shifted by its group's threshold, so that 0.5 divides the classes in
every group; a group that the sample doesn't hold in both classes gets the threshold of
all texts together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ALNUM, is_held_out, map_texts, mix, table, text_chunks, word_bounds, word_hashes
from .decontamination import item_words
from .quality import labelled_sample

#: Bounds of the training sample: labelled rows, and code points of all its texts together.
SAMPLE_ROWS, SAMPLE_CHARS = 8000, 16_000_000
BUCKETS, WIDTH_OF_WORD, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
#: Bytes of the beginnings of a word that have hashes of their own.
BEGINNINGS = (4, 5, 6, 7, 8, 9, 10)
THRESHOLD = 0.5
#: One in so many texts of the sample is left out of the fit, for the thresholds; the cost of a false alarm.
CALIBRATION, FALSE_ALARM = 5, 2.0

# Frequent function words by language; a text counts for the language with most of them.
FUNCTION_WORDS = {
    "de": "der die und den von das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass",
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which",
    "es": "de la que el en y los del se las por un para con no una su al lo como más pero sus le ya este porque esta",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au plus ne se ce avec il sont ou son mais",
}
LANGUAGES = (*FUNCTION_WORDS, "other")
#: Share of a text's words that must be function words of its language.
LEAST_SHARE = 0.04


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of all function words and, for each, a weight per language (shared words count less)."""
    owners: dict[int, set[int]] = {}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for h in item_words(words).tolist():
            owners.setdefault(h, set()).add(k)
    hashes = np.array(sorted(owners), np.uint64)
    weights = np.zeros((len(hashes), len(FUNCTION_WORDS)))
    for row, h in enumerate(hashes.tolist()):
        for k in owners[h]:
            weights[row, k] = 1 / len(owners[h])
    return hashes, weights


def languages(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A place in LANGUAGES for each text: that of most votes (the earliest of a tie), the last if these are few."""
    table_hashes, weights = _language_table()
    at = np.searchsorted(table_hashes, hashes)
    at[at == len(table_hashes)] = 0
    known = np.flatnonzero(table_hashes[at] == hashes) if len(hashes) else np.zeros(0, np.int64)
    n = len(first) - 1
    row = np.searchsorted(first, known, "right") - 1
    votes = np.column_stack([np.bincount(row, weights=weights[at[known], k], minlength=n) for k in range(weights.shape[1])])
    few = votes.max(axis=1, initial=0.0) <= LEAST_SHARE * np.diff(first)
    return np.where(few, len(LANGUAGES) - 1, votes.argmax(axis=1))


@dataclass
class TextCnn:
    """Parameters; ``shift`` is the logit of each language's threshold."""

    embedding: np.ndarray  # buckets x word width
    filters: list[np.ndarray]  # for each width: filters x width x word width
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    shift: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each filter width and place, buckets x filters: the place's share of the convolution."""
        return [[np.ascontiguousarray((self.embedding @ f[:, j].T).astype(np.float32)) for j in range(f.shape[1])] for f in self.filters]

    def pooled(self, buckets: np.ndarray, first: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """texts x (widths * filters): rectified maxima over each whole text; 0 where it has fewer words than the width."""
        n = len(first) - 1
        out = np.zeros((n, len(self.filters) * FILTERS), np.float32)
        counts = np.diff(first)
        for k, parts in enumerate(tables):
            width = len(parts)
            total = len(buckets) - width + 1  # buckets: words x hashes
            long_enough = np.flatnonzero(counts >= width)
            if total <= 0 or not len(long_enough):
                continue
            response = np.zeros((total, FILTERS), np.float32)
            for j in range(width):
                for column in range(buckets.shape[1]):
                    response += parts[j][buckets[j : j + total, column]]
            # windows that cross into the next text are left out of its maximum
            begin, end = first[:-1][long_enough], first[1:][long_enough] - width + 1
            edges = np.column_stack([begin, np.minimum(end, total)]).ravel()
            if edges[-1] == total:
                edges = edges[:-1]
            best = np.maximum.reduceat(response, edges, axis=0)[::2]
            out[long_enough, k * FILTERS : (k + 1) * FILTERS] = np.maximum(best + self.bias[k], 0)
        return out

    def logits(self, buckets: np.ndarray, first: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        return self.pooled(buckets, first, tables) @ self.out + self.out_bias


def _fresh(seed: int) -> TextCnn:
    rng = np.random.default_rng(seed)
    return TextCnn(
        rng.normal(0, 0.02, (BUCKETS, WIDTH_OF_WORD)),
        [rng.normal(0, 0.5, (FILTERS, w, WIDTH_OF_WORD)) for w in WIDTHS],
        [np.full(FILTERS, 0.1) for _ in WIDTHS],
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS),
        0.0,
        np.zeros(len(LANGUAGES)),
    )


def word_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """words x (1 + beginnings): rows of the embedding table."""
    out = [hashes]
    for n in BEGINNINGS:
        out.append(mix(word_hashes(data, starts, np.minimum(starts + n, ends)) + np.uint64(n)))
    return np.column_stack([(h % np.uint64(BUCKETS)).astype(np.int32) for h in out])


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, word fingerprints and each text's first word."""
    buckets, hashes, first = [], [], [np.zeros(1, np.int64)]
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.string())):
        starts, ends, heads = word_bounds(data, offsets, ALNUM)
        hashes.append(word_hashes(data, starts, ends))
        buckets.append(word_buckets(data, starts, ends, hashes[-1]))
        first.append(heads[1:] + first[-1][-1])
    return np.concatenate(buckets), np.concatenate(hashes), np.concatenate(first)


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.moments = rate, {}

    def step(self, name: object, value: np.ndarray, gradient: np.ndarray) -> None:
        m, v, t = self.moments.get(name, (np.zeros_like(value), np.zeros_like(value), 0))
        m, v, t = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2, t + 1
        self.moments[name] = m, v, t
        value -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)


def train(texts: list[str], labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 4) -> TextCnn:
    """Fit by minibatches of the logistic loss, classes weighing alike; then calibrate each language's threshold.

    The gradient flows through each filter's best window only, so embeddings get
    sparse updates.  Without texts of both labels every score is the labels' mean (1/2
    without any).
    """
    model = _fresh(seed)
    if len(texts) == 0 or labels.min() == labels.max():
        model.out[:] = 0
        model.out_bias = 0.0 if len(texts) == 0 else (8.0 if labels[0] == 1 else -8.0)
        return model
    buckets, hashes, first = _hashed(texts)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    aside = np.sort(order[: len(order) // CALIBRATION])  # the thresholds are set on texts that the fit hasn't seen
    fitted = order[len(order) // CALIBRATION :]
    heft = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    adam = _Adam(rate)
    seen = np.zeros(BUCKETS)  # squared gradients of the embeddings (Adagrad: they are updated sparsely)
    for _ in range(epochs):
        fitted = rng.permutation(fitted)
        for at in range(0, len(fitted), batch):
            some = fitted[at : at + batch]
            _step(model, [buckets[first[i] : first[i + 1]] for i in some], labels[some], heft[some], adam, seen)
    tables = model.tables()
    logits, own = np.zeros(len(aside)), np.zeros(len(aside), np.int64)
    for k, i in enumerate(aside):
        one = slice(first[i], first[i + 1])
        ends = np.array([0, first[i + 1] - first[i]])
        logits[k], own[k] = model.logits(buckets[one], ends, tables)[0], languages(hashes[one], ends)[0]
    _calibrate(model, logits, own, labels[aside])
    return model


def _step(model: TextCnn, docs: list[np.ndarray], labels: np.ndarray, heft: np.ndarray, adam: _Adam, seen: np.ndarray) -> None:
    counts = np.array([len(d) for d in docs])
    words = np.concatenate(docs)
    first = np.concatenate([[0], np.cumsum(counts)])
    vectors = model.embedding[words].sum(axis=1)
    n, hidden = len(docs), np.zeros((len(docs), len(WIDTHS) * FILTERS))
    where = np.full((len(docs), len(WIDTHS) * FILTERS), -1)
    for k, (w, filters) in enumerate(zip(WIDTHS, model.filters)):
        total = len(words) - w + 1
        if total <= 0:
            continue
        response = sum(vectors[j : j + total] @ filters[:, j].T for j in range(w))
        for row in np.flatnonzero(counts >= w):
            a, b = first[row], first[row + 1] - w + 1
            best = response[a:b].argmax(axis=0)
            value = response[a + best, np.arange(FILTERS)] + model.bias[k]
            here = slice(k * FILTERS, (k + 1) * FILTERS)
            hidden[row, here] = np.maximum(value, 0)
            where[row, here] = np.where(value > 0, a + best, -1)
    p = 1 / (1 + np.exp(-(hidden @ model.out + model.out_bias)))
    delta = (p - labels) * heft / n
    upstream = delta[:, None] * model.out
    touched, forces = [], []
    for k, w in enumerate(WIDTHS):
        gradient, bias = np.zeros_like(model.filters[k]), np.zeros(FILTERS)
        rows, columns = np.nonzero(where[:, k * FILTERS : (k + 1) * FILTERS] >= 0)
        spots = where[rows, k * FILTERS + columns]
        force = upstream[rows, k * FILTERS + columns]
        np.add.at(bias, columns, force)
        for j in range(w):
            np.add.at(gradient[:, j], columns, force[:, None] * vectors[spots + j])
            touched.append(words[spots + j])
            forces.append(force[:, None] * model.filters[k][columns, j])
        adam.step(("filter", k), model.filters[k], gradient)
        adam.step(("bias", k), model.bias[k], bias)
    adam.step("out", model.out, hidden.T @ delta)
    scalar = np.array([model.out_bias])
    adam.step("out_bias", scalar, np.array([delta.sum()]))
    model.out_bias = float(scalar[0])
    rows = np.concatenate(touched)
    if len(rows):
        index, inverse = np.unique(rows, return_inverse=True)
        gradient = np.zeros((len(index), WIDTH_OF_WORD))
        np.add.at(gradient, inverse.ravel(), np.repeat(np.concatenate(forces), rows.shape[1], axis=0))
        seen[index] += (gradient**2).mean(axis=1)
        model.embedding[index] -= 0.1 * gradient / (np.sqrt(seen[index])[:, None] + 1e-8)


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float | None:
    """The logit that divides the texts at the least cost, if both labels occur.

    A false alarm costs FALSE_ALARM times what a miss of the same share of its class does.
    """
    if not 0 < labels.sum() < len(labels):
        return None
    order = np.argsort(logits)
    x, y = logits[order], labels[order]
    # cost if the threshold lies below x[i]: toxic texts under it and others from it on
    missed = np.concatenate([[0], np.cumsum(y)]) / y.sum()
    false = np.concatenate([[0], np.cumsum(1 - y)])
    cost = missed + FALSE_ALARM * (false[-1] - false) / (len(y) - y.sum())
    best = np.flatnonzero(cost == cost.min())
    return float(x[max(best[0] - 1, 0)] + x[min(best[-1], len(x) - 1)]) / 2


def _calibrate(model: TextCnn, logits: np.ndarray, own: np.ndarray, labels: np.ndarray) -> None:
    """Each language's shift is its threshold; where it has none, that of all texts."""
    every = _threshold(logits, labels)
    for k in range(len(LANGUAGES)):
        threshold = _threshold(logits[own == k], labels[own == k])
        model.shift[k] = next((t for t in (threshold, every) if t is not None), 0.0)


def score_toxicity(docs: DataFrame, model: TextCnn, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on); columns of these names are replaced.

    Every row is scored on its whole text alone; null and empty texts score as texts
    without words.  An empty table gives no rows.
    """
    fields = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in fields]
    tables = model.tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for _, _, data, offsets in text_chunks(batch.column("text").cast(pa.string())):
                starts, ends, first = word_bounds(data, offsets, ALNUM)
                hashes = word_hashes(data, starts, ends)
                logit = model.logits(word_buckets(data, starts, ends, hashes), first, tables)
                logit = logit - model.shift[languages(hashes, first)]
                scores.append(1 / (1 + np.exp(-np.clip(logit, -60, 60))))
            score = np.concatenate(scores).astype(float) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return map_texts(docs.select(*names), run, f"{schema}, score double, predicted int")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> TextCnn:
    """The classifier of ``labels.toxic``, from a bounded sample of rows that aren't held out."""
    return train(*labelled_sample(docs, labels, "toxic", rows, chars))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
