"""Operator 4: exact substring dedup over bytes by suffix arrays.

``repeats`` leaves pieces of text to compare, dealt to shards by anchor. In a shard, windows with a fingerprint of
their own can't repeat, so pieces are cut to the runs that may; equal runs are one run of the smallest document. Runs
that share a window with another distinct run are laid end to end, and the shard's suffix array is built by induced
sorting: suffixes are classified as larger or smaller than the next one, the substrings between leftmost smaller
suffixes are sorted and named, the string of names is sorted by recursion, and all suffixes follow by two scans.
Permuted longest common prefixes, computed in text order, then tell which neighbours in the array share a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackloom.llm.repeats import Windows, by_row, covered, ordered, parts_of, removals
from trackloom.llm.sequences import range_hashes

#: Bytes of a string that must not occur again, and of an anchor.
LEAST_BYTES, GRAM = 50, 24


def _smaller(text: Sequence[int]) -> bytearray:
    """1 where a suffix is smaller than the next one; the last symbol (a sentinel) counts as smaller."""
    types = bytearray(len(text))
    types[-1] = 1
    for i in range(len(text) - 2, -1, -1):
        types[i] = text[i] < text[i + 1] or (text[i] == text[i + 1] and types[i + 1])
    return types


def _induce(text: Sequence[int], types: bytearray, counts: list[int], seeds: Sequence[int]) -> list[int]:
    """All suffixes in the order that follows from leftmost smaller ones in a given order."""
    heads, tails, at = [], [], 0
    for count in counts:
        heads.append(at)
        at += count
        tails.append(at - 1)
    array = [-1] * len(text)
    free = tails[:]
    for i in reversed(seeds):
        symbol = text[i]
        array[free[symbol]] = i
        free[symbol] -= 1
    for i in array:  # the loop sees what it writes ahead of itself
        if i > 0 and not types[i - 1]:
            symbol = text[i - 1]
            array[heads[symbol]] = i - 1
            heads[symbol] += 1
    free = tails
    for at in range(len(array) - 1, -1, -1):
        i = array[at]
        if i > 0 and types[i - 1]:
            symbol = text[i - 1]
            array[free[symbol]] = i - 1
            free[symbol] -= 1
    return array


def suffix_array(text: Sequence[int], n_symbols: int) -> list[int]:
    """Starts of the suffixes in order. ``text`` ends with a 0 that occurs nowhere else."""
    n = len(text)
    if n == 1:
        return [0]
    types = _smaller(text)
    counts = np.bincount(np.asarray(text), minlength=n_symbols).tolist()
    leftmost = [i for i in range(1, n) if types[i] and not types[i - 1]]
    order = [i for i in _induce(text, types, counts, leftmost) if i > 0 and types[i] and not types[i - 1]]
    # equal substrings from one leftmost smaller suffix to the next have one name
    ends = dict(zip(leftmost, leftmost[1:] + [n - 1]))
    names, name, last = {}, -1, None
    for i in order:
        own = text[i : ends[i] + 1]
        if own != last:
            name, last = name + 1, own
        names[i] = name
    if name + 1 < len(leftmost):
        reduced = [names[i] for i in leftmost]
        order = [leftmost[k] for k in suffix_array(reduced, name + 1)]
    return _induce(text, types, counts, order)


def permuted_prefixes(text: Sequence[int], array: list[int]) -> list[int]:
    """For each start, how many symbols its suffix shares with the one before it in the array."""
    before = [-1] * len(text)
    for a, b in zip(array, array[1:]):
        before[b] = a
    out, long = [0] * len(text), 0
    for i, j in enumerate(before):
        if j < 0:
            long = 0
            continue
        while text[i + long] == text[j + long]:
            long += 1
        out[i] = long
        long = long - 1 if long else 0
    return out


def _window_hashes(units: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    return range_hashes(units.astype(np.uint64), begin, begin + length)


def _runs(group: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of the stretches in which ``group`` stays and ``at`` rises by one."""
    new = np.ones(len(at), bool)
    new[1:] = (group[1:] != group[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(at)))


def repeated_starts(runs: list[bytes], docs: list[int], least: int) -> list[tuple[int, int]]:
    """(run, start) of every window that a run of a smaller document has too, by the runs' suffix array."""
    text: list[int] = []
    firsts = []
    for run in runs:
        firsts.append(len(text))
        text += [x + 2 for x in run]
        text.append(1)  # no window crosses it
    text.append(0)
    array = suffix_array(text, 258)
    shared = np.array(permuted_prefixes(text, array))
    array = np.array(array)
    owner = np.searchsorted(np.array(firsts), array, "right") - 1
    ends = np.append(np.array(firsts[1:]), len(text) - 1) - 1
    owner = np.maximum(owner, 0)
    valid = array + least <= ends[owner]
    new = shared[array] < least  # the first of a stretch of suffixes with the same window
    stretch = np.cumsum(new) - 1
    doc = np.where(valid, np.array(docs)[owner], np.iinfo(np.int64).max)
    least_doc = np.minimum.reduceat(doc, np.flatnonzero(new)) if len(doc) else doc
    late = valid & (doc > least_doc[stretch])
    return list(zip(owner[late].tolist(), (array[late] - np.array(firsts)[owner[late]]).tolist()))


def _settle(least: int):
    def settle(doc, start, n, units):
        """Windows of each piece that a piece of a smaller document has."""
        if not units:
            return [], [], []
        data = np.frombuffer(b"".join(units), np.uint8)
        sizes = np.array([len(u) for u in units])
        firsts = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(units)), n)
        first = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        hashes = _window_hashes(data, firsts[piece] + first, least)
        _, where, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        again = np.flatnonzero(counts[where] > 1)
        if not len(again):
            return [], [], []
        at, count = _runs(piece[again], first[again])
        at = again[at]
        contents: dict[bytes, int] = {}
        owners: list[int] = []
        found: list[tuple[int, int, int]] = []
        run_of, texts, run_docs = [], [], []
        for p, f, c in zip(piece[at].tolist(), first[at].tolist(), count.tolist()):
            text = units[p][f : f + c + least - 1]
            k = contents.setdefault(text, len(owners))
            if k == len(owners):
                owners.append(k)
                texts.append(text)
                run_docs.append(int(doc[p]))  # pieces come by document, so this is the smallest
            run_of.append((p, f, c, k))
        late = [(p, f, c) for p, f, c, k in run_of if doc[p] > run_docs[k]]
        found += late
        # runs that share windows with another run
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        firsts, n_windows = np.cumsum(sizes) - sizes, sizes - least + 1
        owner = np.repeat(np.arange(len(texts)), n_windows)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        hashes = _window_hashes(data, firsts[owner] + inside, least)
        _, where, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        asked = np.unique(owner[counts[where] > 1]).tolist()
        if asked:
            at_place: dict[int, list[tuple[int, int]]] = {}
            for p, f, _c, k in run_of:
                if doc[p] == run_docs[k]:
                    at_place.setdefault(k, []).append((p, f))
            for k, inside_start in repeated_starts([texts[k] for k in asked], [run_docs[k] for k in asked], least):
                found += [(p, f + inside_start, 1) for p, f in at_place[asked[k]]]
        return tuple(zip(*found)) if found else ([], [], [])

    return settle


def _byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def remove_repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_bytes: int = LEAST_BYTES,
    gram: int = GRAM,
    with_bytes: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, with ``kept`` (binary) if asked.

    Removed is each byte of a string of ``least_bytes`` that also starts in a document with a smaller id. ``n_spans``
    counts maximal runs of removed bytes. Null and empty texts have no bytes. A row without an id keeps all and
    nothing is compared with it. Rows that share an id don't remove each other's bytes. Ids must be integers; other
    columns are left out.
    """
    windows = Windows(_byte_units, least_bytes, gram, within=False)
    parts = parts_of(docs, id_column, text, [])
    found = removals(parts, windows, _settle(least_bytes))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes

    def task(key: tuple, table: pa.Table, gone: pa.Table) -> pa.Table:
        runs, table = by_row(gone), ordered(table)
        out: list[tuple] = []
        for row, value in enumerate(table["_text"]):
            data = (value.as_py() or "").encode()
            n, spans, kept = len(data), 0, data
            if row in runs:
                cut = covered(n, *runs[row], least_bytes)
                spans = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~cut].tobytes()
            out.append((n, n - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 4 + with_bytes]
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        columns = {c: pa.array([o[i] for o in out], kinds[i]) for i, c in enumerate(names)}
        return pa.table({"doc_id": table["_id"]} | columns)

    return parts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(task, schema)
