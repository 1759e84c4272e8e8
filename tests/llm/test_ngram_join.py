import random

import numpy as np
import pytest
from lumivox.llm import graph, ngram_join
from pyspark.sql import functions as F

from .helpers import SPACED, docs, lower


def shingles(text):
    words = SPACED.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n):
    """Families of edited copies around the threshold, passages that many share, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    passage = [word() for _ in range(30)]
    rows, doc = [], 0
    while len(rows) < n:
        base = [word() for _ in range(rng.choice([3, 6, 20, 80, 200]))]
        for _ in range(rng.choice([1, 1, 1, 2, 5, 12])):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(words) // 25))):
                words[rng.randrange(len(words))] = word()
            if rng.random() < 0.3:
                at = rng.randrange(len(words) + 1)
                words[at:at] = passage
            rows.append((doc, " ".join(words)))
            doc += 1
    rows += [(doc + 1, None), (doc + 2, ""), (doc + 3, " \n\t"), (doc + 4, "One two"), (doc + 5, "one TWO"), (doc + 6, rows[0][1]), (None, rows[0][1]), (None, "quite alone here now then again")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed, 150)
    got = ngram_join.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute_force(rows)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 300)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 2)
    monkeypatch.setattr(ngram_join, "REST_BLOCK", 500)
    monkeypatch.setattr(ngram_join, "BUCKET", 500)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = corpus(3, 90)
    got = ngram_join.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute_force(rows)


def test_family_of_many_blocks(spark, monkeypatch):
    """A family of near copies, a chain that leads away from it, and outsiders that share its passage."""
    monkeypatch.setattr(ngram_join, "BLOCK", 400)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 2)
    monkeypatch.setattr(ngram_join, "REST_BLOCK", 500)
    rng = random.Random(7)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(120):
        words = list(base)
        words[rng.randrange(60)] = f"x{k}"
        rows.append((k, " ".join(words)))
    chain = list(base)
    for k in range(60):
        chain[k] = f"c{k}"
        rows.append((200 + k, " ".join(chain)))
    rows += [(300 + k, " ".join(base[: 36 + k % 9] + [f"o{k}_{j}" for j in range(24)])) for k in range(40)]
    rng.shuffle(rows)
    got = ngram_join.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute_force(rows)


def test_walks_of_some_sets_against_known_components():
    rng = np.random.default_rng(8)
    for _ in range(20):
        base = rng.integers(0, 60, (3, 25))
        sets = [np.unique(np.where(rng.random(25) < 0.08, rng.integers(0, 60, 25), base[rng.integers(3)])).astype(np.uint64) for _ in range(16)]
        sets = list({s.tobytes(): s for s in sets}.values())
        known = [k if k < 4 else 100 for k in range(len(sets))]
        tree = ngram_join.PrefixTree(sets, known)
        tree.links([0, 1, 2, 3])
        parent = graph.Forest()
        for i, a in enumerate(sets):
            if i > 4:
                parent.union(4, i)
            for j, b in enumerate(sets):
                inter = len(np.intersect1d(a, b))
                if i < 4 and 100 * inter >= 80 * (len(a) + len(b) - inter):
                    parent.union(i, j)
        same = lambda f: {(i, j) for i in range(len(sets)) for j in range(i) if f(i) == f(j)}
        assert same(tree.find) == same(parent.find)


def test_tree_finds_exactly_the_linked_components():
    rng = np.random.default_rng(5)
    for _ in range(30):
        base = rng.integers(0, 60, (3, 25))
        sets = [np.unique(np.where(rng.random(25) < 0.1, rng.integers(0, 60, 25), base[rng.integers(3)])).astype(np.uint64) for _ in range(14)]
        sets = list({s.tobytes(): s for s in sets}.values())
        tree = ngram_join.PrefixTree(sets)
        tree.links()
        parent = graph.Forest()
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                inter = len(np.intersect1d(a, b))
                if 100 * inter >= 80 * (len(a) + len(b) - inter):
                    parent.union(i, j)
        same = lambda f: {(i, j) for i in range(len(sets)) for j in range(i) if f(i) == f(j)}
        assert same(tree.find) == same(parent.find)


def test_components_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "_LOCAL_EDGES", 8)
    edges = [(k, k + 1) for k in range(100, 130)] + [(7, k) for k in range(200, 230)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect())
    assert all(got[k] == 100 for k in range(100, 131)) and all(got[k] == 7 for k in range(200, 230))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 230)] + [(5, 5), (3, 9), (9, 3)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect())
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 7 for k in range(200, 230)) and got[9] == got[3] == 3
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_near_copy_without_an_id_bridges_two_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 1_000_000 if broadcast else 0)
    words = [f"w{k}" for k in range(100)]
    first, bridge, last = " ".join(words), " ".join(words[8:] + [f"x{k}" for k in range(8)]), " ".join(words[16:] + [f"x{k}" for k in range(16)])
    rows = [(4, first), (None, bridge), (None, bridge), (7, last), (8, "alone"), (None, " ".join(words[::-1]))]
    got = ngram_join.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute_force(rows)
    assert {r[0]: r[2] for r in got}[7] == 4


def test_one_row_of_each_component_stays(spark):
    text = " ".join(f"w{k}" for k in range(40))
    alone = "other words stand alone here"
    rows = [(4, text), (2, text + " x"), (9, alone), (9, alone), (11, None), (None, text), (None, "a text without an id"), (12, "")]
    df = docs(spark, rows)
    kept = ngram_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r[0] for r in kept.collect()), key=str) == sorted([2, 9, 11, 12, None], key=str)


def test_rows_that_share_an_id_are_decided_by_their_texts(spark):
    text = " ".join(f"w{k}" for k in range(60))
    unlike = "a wholly different text that stands alone"
    rows = [(1, text), (2, text + " x"), (2, unlike), (3, unlike.upper()), (3, unlike), (None, text + " y"), (5, ""), (5, "")]
    df = docs(spark, rows).withColumn("node", F.lit("mine")).withColumn("component", F.lit(1))
    kept = ngram_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect())) == [(1, text), (2, unlike), (5, ""), (5, "")]


def test_near_copies_without_ids_alone(spark):
    text = " ".join(f"w{k}" for k in range(60))
    kept = ngram_join.drop_near_duplicates(docs(spark, [(None, text), (None, text + " x"), (None, text)]))
    assert kept.count() == 1


def test_empty_table(spark):
    assert ngram_join.near_duplicates(docs(spark, [(1, "a")]).limit(0)).count() == 0
