import random
import re

import pytest
from lumivox.llm import token_counts as tc

from .helpers import SPACED, docs


def greedy(word, initial, later, bytes_known=False):
    """Pieces of the mark and the word, one after the other, each the longest that fits."""
    pieces = {tc.MARK + p for p in initial} | set(later)
    rest, total = tc.MARK + word, 0
    while rest:
        end = next((e for e in range(len(rest), 0, -1) if rest[:e] in pieces), None)
        if end is None and not bytes_known:
            return 1
        total += 1 if end else len(rest[0].encode())
        rest = rest[end or 1 :]
    return total


@pytest.mark.parametrize("seed", range(8))
def test_automaton_against_greedy(seed):
    rng = random.Random(seed)
    piece = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
    initial, later = {piece() for _ in range(12)}, {piece() for _ in range(12)} | ({"a", "b"} if seed % 2 else set())
    if seed % 4 < 2:
        initial.add("")
    automaton = tc.LongestMatch(sorted(initial), sorted(later), seed > 3)
    for _ in range(3000):
        word = "".join(rng.choice("abcé" if rng.random() < 0.1 else "abc") for _ in range(rng.randrange(1, 14)))
        assert automaton.count(word) == greedy(word, initial, later, seed > 3), word


def public_pieces():
    """The public vocabulary, read as the library lists it."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    every = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return {p for p in every if not re.fullmatch(r"<unk>|</?s>|<0x..>", p)}


def longest_first(word, pieces):
    rest, total = "▁" + word, 0
    while rest:
        end = next((e for e in range(min(len(rest), 40), 0, -1) if rest[:e] in pieces), 0)
        total += 1 if end else len(rest[0].encode())
        rest = rest[max(end, 1) :]
    return total


def test_registered_query_against_longest_match(spark):
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    pieces, known = public_pieces(), {}
    want = {}
    for r in docs_:
        words = SPACED.findall(r["text"] or "")
        for w in words:
            if w not in known:
                known[w] = longest_first(w, pieces)
        want[r["doc_id"]] = (len(words), sum(known[w] for w in words))
    got = tc.op5_token_counts(spark, "/root/testdata/sf0.01")
    assert {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in got.collect()} == want
    assert longest_first("ñción", pieces) == 3


def test_bare_mark_and_bytes():
    import public_tokenizers

    automaton = tc.LongestMatch(*tc.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = public_pieces()
    words = "ñta ñción the Donaudampfschiff a1b2c3 éèê 漢字 supercalifragilistic !!! foo_bar(x)=y; Ωμέγα 😀 ☃☃ ▁ a▁b".split()
    for word in [*words, "x" * 300, "ab" * 200, "\x01\x02", "ø\x7f"]:
        assert automaton.count(word) == longest_first(word, pieces), word
    assert automaton.count("ñta") == 3


def test_frame(spark):
    import public_tokenizers

    vocabulary = tc.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    pieces = public_pieces()
    rows = [(1, "Hello hello\tworld  \n ünïcode"), (2, None), (3, ""), (1, "again"), (4, "word " * 3000)]
    got = tc.count_tokens(docs(spark, rows), *vocabulary)
    assert sorted((r["doc_id"], r["n_words"], r["n_tokens"]) for r in got.collect()) == sorted(
        (k, len(SPACED.findall(t or "")), sum(longest_first(w, pieces) for w in SPACED.findall(t or ""))) for k, t in rows
    )
    assert tc.count_tokens(docs(spark, rows).limit(0), *vocabulary).count() == 0
