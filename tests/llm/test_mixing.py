import math
import random

import pytest
from lumivox.llm import mixing
from pyspark.sql import functions as F

from .helpers import SPACED, docs


def targets(sizes):
    """Water filling by rounds, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    out, open_ = {}, set(names)
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            out |= share
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            open_.discard(s)
    return out


def rows(seed, n=400):
    rng = random.Random(seed)
    source = lambda: rng.choices(["a", "b", "Z", "é", None, "hot"], [1, 1, 2, 1, 1, 6])[0]
    return [(k, " ".join(rng.choice(["word", "w0", "#!", "x"]) for _ in range(rng.choice([0, 3, 10, 40, 200]))), source()) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken_words(spark, seed):
    data = rows(seed)
    got = mixing.mix_sources(docs(spark, data)).collect()
    size = {k: len(SPACED.findall(t)) for k, t, _ in data}
    source = {k: s for k, _, s in data}
    sizes = {}
    for k, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[k]
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    assert len(got) == len(data)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 101
        own = {r["taken"] // r["size"] for r in got if r["source"] == s and r["size"]}
        assert not own or max(own) - min(own) <= 1  # whole epochs come before any second choice


def test_reruns_agree_whatever_the_partitioning(spark):
    data = rows(4)
    a = sorted(map(tuple, mixing.mix_sources(docs(spark, data)).select("doc_id", "taken").collect()))
    b = sorted(map(tuple, mixing.mix_sources(docs(spark, data).repartition(9)).select("doc_id", "taken").collect()))
    assert a == b


def test_heavier_documents_are_drawn_more_often(spark):
    data = [(k, "word " * 10 if k % 2 else "#### " * 10, "only") for k in range(2000)]
    got = mixing.mix_sources(docs(spark, data)).collect()
    extra = [sum(r["taken"] > r["size"] for r in got if r["doc_id"] % 2 == side) for side in (0, 1)]
    assert extra[1] > 2 * extra[0]


def test_odd_rows(spark):
    data = [(1, None, "a"), (2, "", None), (3, "one", "a"), (3, "one", "a"), (None, "two words", "b")]
    got = mixing.mix_sources(docs(spark, data)).collect()
    assert len(got) == 5 and {r["taken"] for r in got if r["size"] == 0} == {0}
    assert len({r["taken"] for r in got if r["doc_id"] == 3}) == 1
    assert mixing.mix_sources(docs(spark, data).limit(0)).count() == 0


def test_own_columns_and_a_wide_range_of_weights(spark, monkeypatch):
    """Columns named as the plan's own, weights from 0.01 to 1, and edge bins that must be cut again and again."""
    rng = random.Random(6)
    data = [(k, " ".join(["word"] * rng.choice([1, 7, 30])), rng.choice(["a", "b", "c"])) for k in range(3000)]
    df = docs(spark, data)
    for name in ("epochs", "budget", "_size", "_key", "_tie", "key", "row", "lo", "last", "s", "bin", "weight"):
        df = df.withColumn(name, F.lit(name))
    df = df.withColumn("weight", F.pow(F.lit(10.0), -F.pmod(F.xxhash64("doc_id"), F.lit(201)) / 100))
    runs = []
    for edge in (20_000, 10, 1):
        monkeypatch.setattr(mixing, "EDGE_ROWS", edge)
        monkeypatch.setattr(mixing, "BINS", 4096 if edge > 10 else 7)
        out = mixing.mix_sources(df, weight=F.col("weight"))
        assert set(df.columns) <= set(out.columns)
        got = out.collect()
        assert len(got) == 3000 and all(r["epochs"] == "epochs" and r["_size"] == "_size" and r["key"] == "key" for r in got)
        runs.append(sorted((r["doc_id"], r["taken"]) for r in got))
        for source in "abc":
            own = [r for r in got if r["source"] == source]
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 15
    assert runs[0] == runs[1] == runs[2]
    taken = dict(runs[0])
    heavy = [r["doc_id"] for r in got if r["weight"] > 0.5 and r["source"] == "c"]
    light = [r["doc_id"] for r in got if r["weight"] < 0.02 and r["source"] == "c"]
    size = {k: len(t.split()) for k, t, _ in data}
    share = lambda ids: sum(taken[k] > size[k] * (min(taken[i] // size[i] for i in heavy + light)) for k in ids) / len(ids)
    assert share(heavy) > share(light)


def test_rows_without_ids_are_drawn_apart(spark):
    data = [(None, f"word number {k} here", "a") for k in range(400)] + [(1, "same text", "b")] * 50 + [(2, "other text of it", "b")] * 50
    got = mixing.mix_sources(docs(spark, data)).collect()
    more = {r["taken"] for r in got if r["doc_id"] is None}
    assert len(more) == 2 or {r["target"] for r in got if r["source"] == "a"} == {3200.0}
    for k in (1, 2):
        assert len({r["taken"] for r in got if r["doc_id"] == k}) == 1


def test_sources_beyond_the_broadcast_bound(spark, monkeypatch):
    data = rows(5)
    a = sorted(map(tuple, mixing.mix_sources(docs(spark, data)).select("doc_id", "taken").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert a == sorted(map(tuple, mixing.mix_sources(docs(spark, data)).select("doc_id", "taken").collect()))


def test_words_are_counted_without_a_list_of_them(spark):
    rng = random.Random(9)
    texts = [None, "", " ", "\n \t", "a", " a", "a\n", "\x0b\x0ca\r", "é b c d", "\U0001f600 x\x00y \x1c z"]
    texts += ["".join(rng.choice("ab é\U0001f600\x00\x1f\x85  \t\n\x0b\x0c\r") for _ in range(60)) for _ in range(200)]
    counted = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("size", mixing.word_count())
    assert {r["doc_id"]: r["size"] for r in counted.collect()} == {k: len(SPACED.findall(t or "")) for k, t in enumerate(texts)}
    assert "regexp_extract_all" not in counted._jdf.queryExecution().executedPlan().toString()
