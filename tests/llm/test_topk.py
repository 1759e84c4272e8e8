import math
import random

import numpy as np
from lumivox.llm import topk
from pyspark.sql import functions as F


def clip(score):
    return max(-(2**63), min(2**63 - 1, score))


def brute_force(rows, k):
    good = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(good):
        if q % 100 == 0:
            scores = sorted((-clip(sum(x * y for x, y in zip(a, b))), i) for n, (i, b) in enumerate(good) if n != at)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, k=10, kind="float"):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int")
    return sorted(map(tuple, topk.top_k(topk.integer_vectors(df, "vec_id", "embedding"), F.col("vec_id") % 100 == 0, k).collect()))


def vectors(seed, n, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 16))
    rows = [(i, (centres[rng.integers(5)] + rng.normal(size=16) * 0.3).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(copies)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 300)
    rows = vectors(1, 900, copies=400)
    random.Random(1).shuffle(rows)
    assert run(spark, rows) == brute_force(rows, 10)


def test_repeated_query_ids_have_an_answer_each(spark, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 100)
    rows = vectors(4, 500)
    rows += [(100, rows[100][1]), (100, rows[3][1]), (200, rows[200][1])]
    assert run(spark, rows) == brute_force(rows, 10)


def test_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (100, [-1e300, 2.0]), (200, [1.0, 1.0]), (300, [1e30, 5.0]), (5, [3.0, 1e300]), (6, [1e200, 1e200]), (7, [0.5, 0.25])]
    assert run(spark, rows, kind="double") == brute_force(rows, 10)


def test_only_regions_in_reach_are_visited(spark, monkeypatch):
    """Vectors in clusters far apart: a query's visits stay near one region."""
    monkeypatch.setattr(topk, "TREE", 100)
    seen = []
    real = topk._visits

    def counted(regions, trees, best):
        inner = real(regions, trees, best)
        log = spark.sparkContext.accumulator(0)
        seen.append(log)

        def go(batches):
            for batch in inner(batches):
                log.add(batch.num_rows)
                yield batch

        return go

    monkeypatch.setattr(topk, "_visits", counted)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16)) * 6
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.05).astype(np.float32).tolist()) for i in range(2400)]
    assert run(spark, rows) == brute_force(rows, 10)
    assert seen[0].value >= 24 and seen[1].value < 24 * 24 / 3


def test_odd_vectors_take_no_part(spark):
    rows = vectors(2, 120) + [(200, None), (300, [1.0, None] + [0.0] * 14), (400, [float("nan")] * 16), (500, [float("inf")] * 16), (None, [1.0] * 16), (600, [0.0] * 16)]
    assert run(spark, rows) == brute_force(rows, 10)


def test_few_candidates_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, 0.0]), (3, [0.5, 0.5])]
    assert run(spark, rows) == brute_force(rows, 10)
    assert run(spark, []) == []


def test_tree_visits_less_than_everything():
    rows = vectors(3, 4000)
    tree = topk.MTree(np.arange(4000), np.array([i for i, _ in rows]), np.floor(1024 * np.array([v for _, v in rows], float)), page=64)
    first = tree.search(tree.vectors[0], 0, 10)
    assert tree.scored < 2000
    assert tree.search(tree.vectors[0], 0, 10, first[-1][0]) == first
