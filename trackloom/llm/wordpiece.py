"""Operator 6: token counts by a linear longest-match automaton.

The vocabulary is a trie. Each node knows its failure link: the node that stands for what is left after the greedy
pieces of its string are taken off, and how many pieces those are. Reading a word moves along the trie; where no
edge goes on, the failure link is followed and its count added. No piece is built and no character is read twice,
so a word costs time in proportion to its length however long it is.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: The words of a text.
_words = re.compile(r"[^\x20\x09-\x0D]+").findall
#: A word's first piece bears this mark, as in the vocabulary file.
MARK = "▁"
#: Words remembered by a task, up to so many characters each.
REMEMBER_COUNT, REMEMBER_CHARS = 500_000, 40
NO_NODE = -1


class PieceCounter:
    """Greedy longest-match piece counts of marked words for a vocabulary; the lone mark can be a piece too."""

    def __init__(self, pieces: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}]
        piece = [False]
        for text in pieces:
            node = 0
            for letter in text:
                if letter not in self.edges[node]:
                    self.edges[node][letter] = len(self.edges)
                    self.edges.append({})
                    piece.append(False)
                node = self.edges[node][letter]
            piece[node] = node > 0
        # the mark is a letter like any other, so the root serves both first and further pieces
        self.fail, self.popped = [NO_NODE] * len(self.edges), [0] * len(self.edges)
        waiting = deque((0, letter, node) for letter, node in self.edges[0].items())
        while waiting:
            parent, letter, node = waiting.popleft()
            if piece[node]:
                self.fail[node], self.popped[node] = 0, 1
            else:
                at, count = self.fail[parent], self.popped[parent]
                while at != NO_NODE and letter not in self.edges[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                if at != NO_NODE:
                    self.fail[node], self.popped[node] = self.edges[at][letter], count
            waiting.extend((node, x, child) for x, child in self.edges[node].items())
        self.known: dict[str, int] = {}

    def _pieces(self, word: str) -> int:
        """Number of pieces of a word, 0 if the vocabulary doesn't cover it."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = count = 0
        for letter in MARK + word:
            while (to := edges[node].get(letter)) is None:
                count += popped[node]
                node = fail[node]
                if node == NO_NODE:
                    return 0
            node = to
        while node:
            count += popped[node]
            node = fail[node]
            if node == NO_NODE:
                return 0
        return count

    def __call__(self, word: str) -> int:
        count = self.known.get(word)
        if count is None:
            count = self._pieces(word)
            if len(word) <= REMEMBER_CHARS:
                if len(self.known) >= REMEMBER_COUNT:
                    self.known.clear()
                self.known[word] = count
        return count


_counters: dict[str, PieceCounter] = {}


def counter(vocabulary: str) -> PieceCounter:
    """The counter of a sentence-piece model of ``public_tokenizers`` by name, or of a file that all workers can open."""
    import os

    import public_tokenizers
    import sentencepiece

    if vocabulary not in _counters:
        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        pieces = (model.id_to_piece(i) for i in plain)
        _counters[vocabulary] = PieceCounter(pieces)
    return _counters[vocabulary]


def token_counts(
    docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for every row.

    Words are runs without white space. A word's tokens are the greedy longest-match pieces of the mark and the word
    together, over all of the vocabulary's text pieces (the lone mark is one, so a word may begin with any piece after
    it); a word that can't be covered is one unknown token. Null and empty texts have none;
    repeated rows count each; a null id stays null. Columns other than id and text are left out. No shuffle.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows = [list(map(count, _words(text or ""))) for text in part.column(1).to_pylist()]
                unknown = [row.count(0) for row in rows]
                tokens = [sum(row) + n for row, n in zip(rows, unknown)]
                columns = [part.column(0), *(pa.array(x, pa.int64()) for x in (map(len, rows), tokens, unknown))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    schema = f"doc_id {kind}, n_words long, n_tokens long, n_unknown long"
    return docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text")).mapInArrow(task, schema)
