"""Word-piece token counts by a linear longest-match automaton, without building pieces.

The vocabulary is a trie.  Greedy longest match would back up after a failed step; a
node's failure link instead leads to the node that stands for what is left after the
pieces that the match would emit there, and the number of those pieces is stored with
the link.  Every character is then read once, however long the word is.

A word is the mark ``▁`` and its characters, as the public vocabulary has them.  The bare
mark is a piece of its own: a word that no longer marked piece begins starts with it.
A character that no piece begins falls back to its UTF-8 bytes, one token each, where
the vocabulary has byte pieces.

Each different word of a run of texts is walked once; all its occurrences share the count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import EXACT, SPACED, map_texts, table, text_chunks, word_bounds, word_hashes

MARK = "▁"
#: Words whose counts a worker remembers.
REMEMBERED = 500_000


class LongestMatch:
    """``initial``: pieces that begin a word ("" the bare mark); ``later``: pieces that go on in one.

    ``bytes_known``: whether characters (and a mark) that no piece covers become bytes.
    """

    def __init__(self, initial: Sequence[str], later: Sequence[str], bytes_known: bool = False):
        self.step: list[dict[str, int]] = [{}, {}]  # nodes 0 and 1: only the mark read of a word, something emitted
        piece = [False, False]
        for root, pieces in ((0, initial), (1, later)):
            for text in pieces:
                node = root
                for c in text:
                    below = self.step[node].get(c)
                    if below is None:
                        below = self.step[node][c] = len(self.step)
                        self.step.append({})
                        piece.append(False)
                    node = below
                if node != 1:
                    piece[node] = True
        self.bytes_known = bytes_known
        #: Node after the failure (-1: no piece fits), and pieces emitted on the way.
        self.fail = [-1] * len(self.step)
        self.popped = [0] * len(self.step)
        if piece[0] or bytes_known:
            self.fail[0], self.popped[0] = 1, 1 if piece[0] else len(MARK.encode())
        layer = [0, 1]
        while layer:
            below_layer = []
            for node in layer:
                for c, below in self.step[node].items():
                    below_layer.append(below)
                    if piece[below]:
                        self.fail[below], self.popped[below] = 1, 1
                        continue
                    # pieces forced out of the path so far, then this character behind them
                    at, pops = (1, 0) if node == 1 else (self.fail[node], self.popped[node])
                    while at > 1 and c not in self.step[at]:
                        pops += self.popped[at]
                        at = self.fail[at]
                    if node != 1 and at >= 0 and c in self.step[at]:
                        self.fail[below], self.popped[below] = self.step[at][c], pops
                    elif at == 1 and bytes_known:
                        self.fail[below], self.popped[below] = 1, pops + len(c.encode())
            layer = below_layer

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match; 1 (an unknown word) where nothing fits at some place."""
        node = total = 0
        step, fail, popped = self.step, self.fail, self.popped
        for c in word:
            while (below := step[node].get(c)) is None:
                if node == 1:
                    break
                if fail[node] < 0:
                    return 1
                total += popped[node]
                node = fail[node]
            if below is None:
                if not self.bytes_known:
                    return 1
                total += len(c.encode())
            else:
                node = below
        while node != 1:
            if fail[node] < 0:
                return 1
            total += popped[node]
            node = fail[node]
        return total


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str], bool]:
    """Pieces that begin with the word mark (taken off; "" is the bare mark), all pieces, and whether bytes are pieces.

    Marked pieces go on in a word, too, where its text holds the mark's character.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    odd = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    pieces = [model.id_to_piece(i) for i in numbers if not odd(i)]
    return [p[1:] for p in pieces if p.startswith(MARK)], pieces, any(model.is_byte(i) for i in numbers)


def count_tokens(docs: DataFrame, initial: Sequence[str], later: Sequence[str], bytes_known: bool = False) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens`` of the whole text (columns of these names are replaced).

    Words are ``[^\\x20\\x09-\\x0D]+``, in their case.  A word that neither pieces
    nor bytes spell counts as one token.  Null and empty texts have 0; an empty table gives no rows.
    """
    fields = [f for f in docs.schema.fields if f.name not in ("n_words", "n_tokens")]
    names = [f.name for f in fields]
    automaton = LongestMatch(initial, later, bytes_known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        for batch in batches:
            words, tokens = [], []
            for _, _, data, offsets in text_chunks(batch.column("text").cast(pa.string())):
                starts, ends, first = word_bounds(data, offsets, SPACED)
                hashes, at, inverse = np.unique(word_hashes(data, starts, ends, EXACT), return_index=True, return_inverse=True)
                if len(known) > REMEMBERED:
                    known.clear()
                sizes = np.empty(len(hashes), np.int64)
                for k, h in enumerate(hashes.tolist()):
                    size = known.get(h)
                    if size is None:
                        size = known[h] = automaton.count(data[starts[at[k]] : ends[at[k]]].tobytes().decode())
                    sizes[k] = size
                sums = np.concatenate([[0], np.cumsum(sizes[inverse])])
                words.append(np.diff(first))
                tokens.append(np.diff(sums[first]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(np.concatenate(words) if words else [], pa.int64()),
                 pa.array(np.concatenate(tokens) if tokens else [], pa.int64())],
                names=[*names, "n_words", "n_tokens"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return map_texts(docs.select(*names), run, f"{schema}, n_words long, n_tokens long")


def op5_token_counts(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Tokens of every document in a public 32k vocabulary."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, *sentencepiece_vocabulary(vocabulary)).select("doc_id", "n_words", "n_tokens")
