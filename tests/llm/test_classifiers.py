import itertools
import random
import zlib

import numpy as np
import pytest
from lumivox.llm import quality, registry, toxicity
from lumivox.llm.common import is_held_out
from pyspark.sql import functions as F

from .helpers import docs

DATA = "/root/testdata/sf0.001"
WORDS = ["alpha", "beta", "gamma", "delta", "stone", "river", "light", "over", "under", "again"]


def sentence(rng, n=12):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", "s"]) for _ in range(n)).capitalize() + "."


def good(rng):
    return "\n".join(sentence(rng) for _ in range(rng.randrange(2, 6)))


def bad(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return "\n".join(sentence(rng).upper().replace(" ", "!! ") for _ in range(3))
    if kind == 1:
        return " ".join([rng.choice(WORDS)] * 60)
    return "\n".join(sentence(rng).replace(" ", "### ") for _ in range(4))


def lines_of(texts):
    blob = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blob])]).astype(np.int64)
    return quality.line_statistics(np.frombuffer(b"".join(blob), np.uint8), offsets)


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    model = quality.ChainModel(rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2)))
    lines = lines_of(["one line", "", "first\nSECOND LINE!!\n\nthird\nfourth 4", "\n\n", "a\nb\na"])
    marginal, pairs, z = model.marginals(lines)
    score, total_pairs = model.unary(lines), np.zeros((2, 2))
    for doc in range(5):
        a, b = lines.first[doc], lines.first[doc + 1]
        if a == b:
            continue
        weights = {}
        for labels in itertools.product((0, 1), repeat=b - a):
            s = sum(score[a + k] for k, y in enumerate(labels) if y) + sum(model.transition[p, q] for p, q in zip(labels, labels[1:]))
            weights[labels] = np.exp(s)
        whole = sum(weights.values())
        assert np.isclose(np.log(whole), z[doc])
        for k in range(b - a):
            assert np.isclose(marginal[a + k], sum(w for y, w in weights.items() if y[k]) / whole)
        for y, w in weights.items():
            for p, q in zip(y, y[1:]):
                total_pairs[p, q] += w / whole
    assert np.allclose(pairs, total_pairs)


def test_gradient_against_differences():
    """Every weight that occurs and every transition, with documents of unlike weights."""
    rng = np.random.default_rng(1)
    lines = lines_of(["first\nSECOND!!\nthird", "x y z\nx x x x", "", "alone"])
    truth, heft = np.array([1.0, 0, 1, 0, 1, 0]), np.array([0.3, 2.0, 1.0, 0.7])
    model = quality.ChainModel(rng.normal(size=quality.FEATURES) * 0.1, rng.normal(size=(2, 2)))
    _, gradient = quality.objective(model, lines, truth, heft)
    params = np.concatenate([model.weight, model.transition.ravel()])

    def value(at, by):
        moved = params.copy()
        moved[at] += by
        return quality.objective(quality.ChainModel(moved[:-4], moved[-4:].reshape(2, 2)), lines, truth, heft)[0]

    places = [*np.flatnonzero(gradient[:-4]), *range(len(params) - 4, len(params))]
    assert len(places) > 40
    for k in places:
        assert np.isclose((value(k, 1e-5) - value(k, -1e-5)) / 2e-5, gradient[k], atol=1e-6)


def test_quality_held_out(spark):
    rng = random.Random(5)
    rows = [(k, good(rng) if k % 3 else bad(rng)) for k in range(600)] + [(900, None), (901, ""), (902, "\n\n")]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(600)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows)
    model = quality.fit(df, labels)
    out = quality.score_quality(df, model)
    assert set(out.columns) == {*df.columns, "predicted"}
    got = {r["doc_id"]: r for r in out.collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 60
    assert sum(got[k]["predicted"] == int(k % 3 > 0) for k in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert got[900]["predicted"] == got[901]["predicted"] == got[902]["predicted"] == 0
    assert quality.score_quality(df.limit(0), model).count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    function = {"en": "the of and to", "de": "der die und nicht"}
    slurs = {"en": ["grubbo", "snarkle"], "de": ["mistbolz", "quarkschuft"]}
    rows = []
    for k in range(900):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(WORDS + function[lang].split()) for _ in range(rng.randrange(6, 60))]
        if k % 4 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(slurs[lang]))
        rows.append((k, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, "x")]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(900)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows)
    model = toxicity.fit(df, labels)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, model).collect()}
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got[k]["predicted"] == int(k % 4 == 0) for k in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0


def test_convolution_tables_equal_the_plain_convolution():
    model = toxicity._fresh(1)
    rng = np.random.default_rng(2)
    docs_ = [rng.integers(0, toxicity.BUCKETS, (n, 1 + len(toxicity.BEGINNINGS))) for n in (0, 1, 2, 3, 40)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in docs_])])
    got = model.pooled(np.concatenate(docs_), first, model.tables())
    for row, words in enumerate(docs_):
        for k, f in enumerate(model.filters):
            w = f.shape[1]
            spans = [sum(model.embedding[words[i + j]].sum(axis=0) @ f[:, j].T for j in range(w)) for i in range(len(words) - w + 1)]
            want = np.maximum(np.max(spans, axis=0) + model.bias[k], 0) if spans else np.zeros(toxicity.FILTERS)
            assert np.allclose(got[row, k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS], want, atol=1e-4)


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0, 0]])
def test_training_without_both_classes(labels):
    texts = ["some text"] * len(labels)
    assert np.isfinite(quality.train(texts, np.array(labels, float)).score(lines_of(["a\nb", ""]))).all()
    toxicity.train(texts, np.array(labels, float))


def test_held_out_rule(spark):
    got = spark.range(200).select("id", is_held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)
    assert spark.sql("select cast(null as bigint) x").select(is_held_out("x").alias("h")).first()["h"]


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    df = docs(spark, [(k, "t" * (k % 50)) for k in range(300)] + [(400, None)])
    labels = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    held = sum(zlib.crc32(str(k).encode()) % 5 == 0 for k in range(300))
    texts, truth = quality.labelled_sample(df, labels, "quality", 10_000, 10**6)
    assert len(texts) == 300 - held and truth.all()
    assert len(quality.labelled_sample(df, labels, "quality", 100, 10**6)[0]) <= 50
    texts, _ = quality.labelled_sample(df, labels, "quality", 10_000, 600)
    assert 250 < sum(map(len, texts)) <= 300


def test_long_documents_take_part_in_learning(spark):
    df = docs(spark, [(k, "word " * (20_000 if k % 2 else 5)) for k in range(20)])
    labels = spark.range(20).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    texts, truth = quality.labelled_sample(df, labels, "toxic", 100, 10**7)
    assert max(map(len, texts)) == 100_000 and 0 < truth.sum() < len(truth)


def test_texts_of_no_known_language_have_a_threshold_of_their_own():
    function = ["the of and to", "der die und nicht", "qux zup vim"]
    rng = random.Random(8)
    texts, labels = [], []
    for k in range(1500):
        words = [rng.choice([*WORDS, *(function[k % 3].split() * 3)]) for _ in range(rng.randrange(8, 40))]
        if k % 5 == 0:
            words[0] = ["grubbo", "mistbolz", "vortax"][k % 3]
        texts.append(" ".join(words))
        labels.append(float(k % 5 == 0))
    hashes, first = toxicity._hashed(texts)[1:]
    own = toxicity.languages(hashes, first)
    assert [toxicity.LANGUAGES[own[k]] for k in range(3)] == ["en", "de", "other"] and len(set(own)) == 3
    model = toxicity.train(texts, np.array(labels))
    buckets, hashes, first = toxicity._hashed(texts)
    logits = model.logits(buckets, first, model.tables()) - model.shift[own]
    for k in set(own):
        assert ((logits[own == k] >= 0) == (np.array(labels)[own == k] == 1)).mean() > 0.97


@pytest.mark.parametrize(("query", "column", "threshold", "right"), [("op2_quality_classifier", "quality", 0.3, 0.9), ("op4_toxicity", "toxic", 0.5, 0.8)])
def test_registered_queries(spark, query, column, threshold, right):
    got = registry.QUERIES[query](spark, DATA)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    for d, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    truth = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    known = [rows[d]["predicted"] == y for d, y in truth.items() if d in rows]
    assert np.mean(known) >= right
