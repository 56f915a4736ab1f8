"""Operator 6, token counts: a linear longest-match automaton.

Greedy word pieces (longest match first, pieces inside a word from the continuation
vocabulary) are counted without being built: a trie of the vocabulary has, for each node,
the node where matching goes on when no child fits (failure link) and the number of pieces
which that step completes. Every character is read once. The vocabulary is that of a public
sentencepiece model: pieces with the word mark begin words, the others continue them.

A word is a run of characters other than ASCII white space. A word which the pieces cannot
cover is one unknown token, as greedy word-piece tokenizers have it.

Defined results: null and empty texts have no words; repeated rows and null ids are counted
one by one; extra columns are not read; empty in, empty out.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"


class Automaton:
    """Nodes are numbers: 0 begins a word, 1 continues it. ``link[n]`` is -1 where nothing is left to try."""

    def __init__(self, starts: set[str], rest: set[str]):
        self.child: list[dict[str, int]] = [{}, {}]
        final: set[int] = set()
        for root, pieces in ((0, starts), (1, rest)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.child[node].get(c)
                    if nxt is None:
                        nxt = self.child[node][c] = len(self.child)
                        self.child.append({})
                    node = nxt
                if piece:
                    final.add(node)
        self.link = [-1] * len(self.child)
        self.pops = [0] * len(self.child)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.child[parent].items():
                queue.append(node)
                if node in final:
                    self.link[node], self.pops[node] = 1, 1
                    continue
                back, popped = self.link[parent], self.pops[parent]
                while back >= 0 and c not in self.child[back]:
                    popped += self.pops[back]
                    back = self.link[back]
                if back >= 0:
                    self.link[node], self.pops[node] = self.child[back][c], popped

    def count(self, word: str) -> int:
        """Number of pieces of a word; -1 if the pieces can't cover it."""
        child, link, pops = self.child, self.link, self.pops
        node, n = 0, 0
        for c in word:
            while c not in child[node]:
                if link[node] < 0:
                    return -1
                n += pops[node]
                node = link[node]
            node = child[node][c]
        while node != 1:
            if link[node] < 0:
                return -1
            n += pops[node]
            node = link[node]
        return n


def vocabulary(path: str) -> tuple[set[str], set[str]]:
    """Pieces that begin a word (with the word mark) and pieces that continue one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i) for i in ids}
    starts = {p for p in pieces if p.startswith(MARK)}
    return starts, pieces - starts


class _Counts(dict):
    """Pieces of each word seen; -1 for unknown words."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.automaton.count(MARK + word.decode("utf-8", "surrogatepass"))
        return n


_AUTOMATA: dict = {}


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _counted(path: str, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _AUTOMATA:
            _AUTOMATA[path] = _Counts(Automaton(*vocabulary(path)))
        known = _AUTOMATA[path]
        for b in batches:
            rows = []
            for _, texts in slices(b, "text"):
                if len(known) > keep:
                    known.clear()
                for t in texts:
                    words = t.encode("utf-8", "surrogatepass").split()
                    n = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    rows.append((len(words), int(np.abs(n).sum()), int((n < 0).sum())))
            n_words, n_tokens, n_unknown = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown))],
                                             names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return run


def counts(docs: DataFrame, path: str | None = None, keep: int = 600_000) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown. A worker keeps the counts of up to ``keep`` words."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(
        _counted(path or piece_model(), keep), "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
