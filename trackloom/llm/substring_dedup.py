"""Operator 1: substring dedup by suffix automata.

The reference shards are the pieces of text that ``repeats`` leaves to compare: their documents share an anchor with
others. A shard's suffix automaton grows piece by piece in the order of the corpus; each piece is streamed through it
first, which gives the matching statistics (how long a run of words that ends here occurs before). Where they reach
the threshold, the words are part of a span that occurs earlier, and maximal spans are removed.

A broadcast of the automata of a whole corpus would grow with it. A shard is instead sent to the one task that also
receives the pieces that can match it, by their anchor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackloom.llm.repeats import Windows, by_row, covered, ordered, parts_of, removals
from trackloom.llm.sequences import word_hashes, words_of

#: Words of a span that must not occur again, and of an anchor.
LEAST_WORDS, GRAM = 20, 8


class SuffixAutomaton:
    """All runs of symbols of the sequences added so far."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]

    def _state(self, longest: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int) -> int:
        """The state for ``p``'s longest run with the symbol behind it; made from its superset if need be."""
        q = self.next[p][symbol]
        if self.longest[q] == self.longest[p] + 1:
            return q
        own = self._state(self.longest[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = own
            p = self.link[p]
        return own

    def add(self, sequence: list[int]) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._split(last, symbol)
                continue
            state = self._state(self.longest[last] + 1, {}, 0)
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = state
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._split(p, symbol)
            last = state

    def matching(self, sequence: list[int]) -> list[int]:
        """For each place, the length of the longest run ending there that an added sequence has too."""
        out, state, length = [], 0, 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.longest[state]
            to = self.next[state].get(symbol)
            if to is not None:
                state, length = to, length + 1
            out.append(length)
        return out


def _settle(least: int):
    def settle(doc, start, n, units):
        """Windows of each piece that an earlier piece has. Pieces of one place (repeated rows) don't see each other."""
        automaton, which, first = SuffixAutomaton(), [], []
        i = 0
        while i < len(units):
            end = i + 1
            while end < len(units) and doc[end] == doc[i] and start[end] == start[i]:
                end += 1
            sequences = [np.frombuffer(u, np.uint64).tolist() for u in units[i:end]]
            for k, sequence in enumerate(sequences):
                ends = [e for e, long in enumerate(automaton.matching(sequence)) if long >= least]
                which += [i + k] * len(ends)
                first += [e - least + 1 for e in ends]
            for sequence in {tuple(s) for s in sequences}:
                automaton.add(list(sequence))
            i = end
        return which, first, [1] * len(which)

    return settle


def _word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, firsts = words_of(data, offsets)
    return word_hashes(data, starts, ends), firsts


def remove_repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    gram: int = GRAM,
    keep: list[str] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row, with ``text`` (what is kept) if asked, and ``keep``.

    Removed is each word of a span of ``least_words`` that starts earlier in the corpus too: in a document with a
    smaller id, or before in the same one. The text that is kept has its words joined by one space; ``text`` stays as
    it was where nothing is removed. Null and empty texts have no words (a null ``text`` stays null). A row without an
    id keeps all words and nothing is compared with it. Rows that share an id are the same document: equal starts
    don't remove each other. Ids must be integers; columns other than ``keep`` are left out.
    """
    keep = [c for c in keep or [] if c not in (id_column, text)]
    windows = Windows(_word_units, least_words, gram, within=True)
    parts = parts_of(docs, id_column, text, keep)
    found = removals(parts, windows, _settle(least_words))
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    schema += "".join(f", _k{i} {fields[c]}" for i, c in enumerate(keep))

    def task(key: tuple, table: pa.Table, gone: pa.Table) -> pa.Table:
        runs, table = by_row(gone), ordered(table)
        n_words, n_removed, sha, texts = [], [], [], []
        for row, value in enumerate(table["_text"]):
            value = value.as_py()
            words = (value or "").encode().split()
            n_words.append(len(words))
            n_removed.append(0)
            if row in runs:
                cut = covered(len(words), *runs[row], least_words)
                n_removed[-1] = int(cut.sum())
                words = [w for w, c in zip(words, cut.tolist()) if not c]
            kept = b" ".join(words)
            sha.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode() if n_removed[-1] else value)
        columns = {"doc_id": table["_id"], "n_words": n_words, "n_removed": n_removed, "kept_sha256": sha}
        if with_text:
            columns["kept_text"] = pa.array(texts, pa.string())
        return pa.table(columns | {f"_k{i}": table[f"_k{i}"] for i in range(len(keep))})

    made = parts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(task, schema)
    names = {f"_k{i}": c for i, c in enumerate(keep)}
    return made.withColumnsRenamed(names | {"kept_text": "text"} if with_text else names)
