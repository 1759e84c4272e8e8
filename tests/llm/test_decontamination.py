import hashlib
import random
import time

import pytest
from lumivox.llm import decontamination as dc

from .helpers import ALNUM, docs, lower


def brute_force(rows, items):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if w and item is not None else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest))
    return sorted(out, key=str)


def case(seed, short):
    rng = random.Random(seed)
    word = lambda: "t%d" % rng.randrange(12)
    items = [(k, " ".join(word() for _ in range(rng.choice(short)))) for k in range(20)] + [(20, None), (21, "...")]
    rows = [(k, " ".join(word() for _ in range(rng.randrange(60)))) for k in range(60)]
    for k in range(60, 100):
        words = [word() for _ in range(40)]
        item = items[rng.randrange(20)][1].upper().replace(" ", ", ")
        words.insert(rng.randrange(40), item)
        rows.append((k, "-".join(words)))
    return rows + [(100, None), (101, ""), (None, items[0][1])], items


@pytest.mark.parametrize(("seed", "short", "block"), [(1, [15, 20, 40], 10**6), (2, [2, 5, 13, 20], 10**6), (3, [1, 14, 30], 40)])
def test_against_brute_force(spark, seed, short, block):
    rows, items = case(seed, short)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.find_contamination(docs(spark, rows), bench, block_words=block).collect()
    mine = sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in got), key=str)
    assert mine == brute_force(rows, items)


def test_spans_are_code_points_and_are_cut(spark):
    item = " ".join(f"b{k}" for k in range(14))
    clean = "é " * 400
    df = docs(spark, [(1, f"{clean}{item.upper()} ü end"), (2, item), (3, "nothing here"), (4, None)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    span = dc.find_contamination(df, bench).filter("doc_id = 1").first()["spans"]
    assert [(s["start"], s["end"]) for s in span] == [(800, 800 + len(item))]
    out = {r["doc_id"]: r for r in dc.decontaminate(df, bench).collect()}
    assert set(out) == {1, 3, 4}
    assert out[1]["text"] == f"{clean} ü end" and out[1]["n_chars"] == len(out[1]["text"])
    assert out[3]["text"] == "nothing here" and out[4]["text"] is None


@pytest.mark.parametrize("block", [10**6, 20])
def test_no_window_is_left_where_text_is_cut(spark, block):
    item = [f"b{k}" for k in range(20)]
    other = " ".join(f"c{k}" for k in range(15))
    clean = "é " * 900
    rows = [(1, clean + " ".join([*item[:6], *item, *item[6:14]])), (2, clean + " ".join([*item[:8], other, *item[8:]]) + " end"), (3, "plain"), (4, None), (5, other), (5, "plain")]
    df = docs(spark, rows)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, other)], "item_id long, text string")
    out = dc.decontaminate(df, bench, block_words=block)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str)
    assert [(d, t) for d, t, _ in got] == [(1, clean), (2, clean + " end"), (3, "plain"), (4, None), (5, "plain")]
    assert all(n == (None if t is None else len(t)) for _, t, n in got)
    assert dc.find_contamination(out, bench).filter("n_hit > 0").count() == 0


def test_long_repeats_take_linear_time():
    index = dc.BenchmarkIndex([("a", dc.item_words("same " * 2000)), ("b", dc.item_words("one two " * 1000))])
    codes = index.codes(dc.item_words("same " * 100_000 + "two one " * 50_000))
    began = time.monotonic()
    spans, found = index.scan(codes)
    assert time.monotonic() - began < 3
    assert sum(b - a for a, b in spans) == 200_000 and found == {0, 1}


def test_item_without_an_id_hits_but_has_no_name(spark):
    items = [(None, " ".join(f"b{k}" for k in range(14))), (5, " ".join(f"c{k}" for k in range(14)))]
    df = docs(spark, [(1, items[0][1]), (2, f"{items[0][1]} and {items[1][1]}"), (3, "é " * 400 + items[0][1])])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in dc.find_contamination(df, bench).collect()}
    assert got == {1: (14, []), 2: (28, ["5"]), 3: (14, [])}
    out = {r["doc_id"]: r["text"] for r in dc.decontaminate(df, bench).collect()}
    assert out == {3: "é " * 400}


def test_empty_benchmark_and_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(docs(spark, [(1, "a b")]), bench).first()["n_hit"] == 0
    assert dc.find_contamination(docs(spark, [(1, "a")]).limit(0), bench).count() == 0
