import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from lumivox.llm import common, graph, ngram_join

from .helpers import ALNUM, SPACED, lower


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBz09 \n\t.-éß漢\x1f\x7f", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_match_the_patterns(texts, limit):
    for members, pattern in ((common.SPACED, SPACED), (common.ALNUM, ALNUM)):
        got, rows = [], 0
        for first, end, data, offsets in common.text_chunks(pa.array(texts, pa.string()), limit):
            starts, ends, heads = common.word_bounds(data, offsets, members)
            hashes = common.word_hashes(data, starts, ends)
            for a, b in zip(heads[:-1], heads[1:]):
                words = [bytes(data[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b])]
                got.append([(lower(w), int(h)) for w, h in zip(words, hashes[a:b])])
            rows += end - first
        assert rows == len(texts)
        assert [[w for w, _ in row] for row in got] == [pattern.findall(lower(t)) for t in texts]
        seen = {}
        for word, h in (x for row in got for x in row):
            assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_long_text_is_hashed_alike_in_pieces():
    text = ("word " * 500_000 + "x" * 50_000 + " end").encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = common.word_bounds(data, np.array([0, len(data)]), common.SPACED)
    hashes = common.word_hashes(data, starts, ends)
    assert len(np.unique(hashes[:500_000])) == 1 and len(np.unique(hashes)) == 3


def test_counted_tables_are_judged_without_a_job(spark):
    context, nothing = spark.sparkContext, spark.range(9).filter("rand() > 2")
    tables = [spark.range(40).selectExpr("id AS a", "id % 3 AS b").distinct(), spark.range(0), nothing.join(spark.range(9), "id").groupBy("id").count()]
    made = [(common.materialize(df, counted=True), n) for df, n in zip(tables, (40, 0, 0))]
    edges = common.materialize(spark.createDataFrame([(1, 2), (2, 3), (8, 9)], "a long, b long"))
    context.setJobGroup("judged", "")
    try:
        for table, n in made[:2]:
            assert common.at_most(table, n) and not common.at_most(table, n - 1)
        few = ngram_join.few(made[0][0])
        assert not context.statusTracker().getJobIdsForGroup("judged")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert all(common.at_most(table, n) and not common.at_most(table, n - 1) for table, n in made)
    assert few.count() == 40
    assert {r["node"]: r["component"] for r in graph.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}


def test_training_gives_its_memory_back():
    code = """
import re, numpy, pandas, pyarrow
from pathlib import Path
from lumivox.llm import quality

def held():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

def sample(*_):
    line = "Some words of a line number %d, and others: 12 of them. "
    return ["\\n".join(line % (k * n) for n in range(60)) for k in range(4000)], numpy.arange(4000) % 2.0

train = quality.train
quality.train = lambda texts, labels: train(texts, labels, steps=2)
quality.labelled_sample = sample
before = held()
quality.fit(None, None)
print(held() - before)
"""
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(common.__file__).parents[2], check=True)
    assert float(ran.stdout) < 40
