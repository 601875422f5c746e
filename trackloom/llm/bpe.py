"""Operator 9: byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte runs. Every adjacent pair that the rank table knows waits in the bucket of its
merge rank; a bitmap says which buckets hold something and a summary bitmap above its 64-bit words finds the lowest
rank by two find-first-set steps. Merges of one rank are taken from left to right; an entry whose pair has
changed since it was queued is stale and skipped. A merge costs a constant number of steps whatever the
length of the pre-token, so a text without any break is encoded in near-linear time.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Pre-tokens up to so many characters are remembered by a task, at most so many of them (about 150 MB).
REMEMBER_CHARS, REMEMBER_COUNT = 40, 1_000_000
#: White space in Unicode, as a class of characters.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Codec:
    """Ranks of one vocabulary file, with the memory of short pre-tokens."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pieces = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.chunks = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        self.known: dict[str, bytes] = {}
        self.bytes_ = [self.ranks[bytes([b])] for b in range(256)]
        #: By id, the ids that it can join with and the rank of what comes of it.
        self.joins: dict[int, dict[int, int]] = {rank: {} for rank in self.pieces}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.joins[left][right] = rank

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue: ``buckets`` has the positions of each rank (one, or a heap of several), ``leaves`` a word with a
        bit for each of 64 ranks, ``top`` a bit for each word in use. An empty queue costs nothing.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = list(map(self.bytes_.__getitem__, piece))
        n, joins, top = len(ids), self.joins, 0
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets: dict[int, int | list[int]] = {}
        leaves: dict[int, int] = {}

        def push(rank: int, position: int) -> None:
            nonlocal top
            there = buckets.get(rank)
            if there is None:
                buckets[rank] = position
                leaf = rank >> 6
                word = leaves.get(leaf, 0)
                leaves[leaf] = word | 1 << (rank & 63)
                if not word:
                    top |= 1 << leaf
            elif there.__class__ is int:
                buckets[rank] = [there, position] if there <= position else [position, there]
            else:
                heappush(there, position)

        #: Rank of the pair that begins here now.
        waiting = [joins[left].get(right) for left, right in zip(ids, ids[1:])]
        waiting.append(None)
        for i, rank in enumerate(waiting):
            if rank is not None:
                push(rank, i)
        while top:
            leaf = (top & -top).bit_length() - 1
            word = leaves[leaf]
            rank = leaf << 6 | (word & -word).bit_length() - 1
            i = buckets[rank]
            if i.__class__ is list and len(i) > 1:
                i = heappop(i)
            else:
                if i.__class__ is list:
                    i = i[0]
                del buckets[rank]
                word &= word - 1
                leaves[leaf] = word
                if not word:
                    top &= top - 1
            if waiting[i] != rank:
                continue  # stale
            gone = after[i]
            ids[i], ids[gone], waiting[gone] = rank, -1, None
            follow = after[i] = after[gone]
            if follow < n:
                before[follow] = i
                fresh = waiting[i] = joins[rank].get(ids[follow])
                if fresh is not None:
                    push(fresh, i)
            else:
                waiting[i] = None
            ahead = before[i]
            if ahead >= 0:
                fresh = waiting[ahead] = joins[ids[ahead]].get(rank)
                if fresh is not None:
                    push(fresh, ahead)
        return [x for x in ids if x >= 0]

    def _packed(self, chunk: str) -> bytes:
        """Ids of a run of white space with what follows it up to the next white space."""
        out = b""
        for token in self.split(chunk):
            ids = self.known.get(token)
            if ids is None:
                piece = token.encode()
                ids = array("I", self.merge(piece)).tobytes()
                self._remember(token, ids)
            out += ids
        self._remember(chunk, out)
        return out

    def _remember(self, token: str, ids: bytes) -> None:
        if len(token) <= REMEMBER_CHARS:
            if len(self.known) >= REMEMBER_COUNT:
                self.known.clear()
            self.known[token] = ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. No pre-token goes on past white space that follows it."""
        get, fresh = self.known.get, self._packed
        return b"".join([get(chunk) or fresh(chunk) for chunk in self.chunks(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(vocabulary: str, pattern: str | None = None) -> Codec:
    """The codec of a vocabulary of ``public_tokenizers`` by name, or of a file that every worker can open."""
    import os

    import public_tokenizers

    pattern = pattern or public_tokenizers.PATTERN
    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_texts(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_multi_50k.tiktoken",
    pattern: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encodes every text and decodes the ids again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``with_ids`` adds the column ``ids`` (binary, little-endian unsigned 32-bit). One row per input row, repeated
    rows included; a null text counts as empty (no tokens), a null id stays null. Other columns are left out, so
    their names can't clash. No shuffle.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                packed = [own.encode(text or "") for text in part.column(1).to_pylist()]
                columns = [
                    part.column(0),
                    pa.array([len(x) // 4 for x in packed], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed]),
                    pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in packed]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(packed, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text")).mapInArrow(task, schema)
