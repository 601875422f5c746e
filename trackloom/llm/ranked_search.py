"""Operator 11: ranked lexical search over posting lists in geometric blocks.

1. One pass over the texts keeps, for every document, its length and the frequencies of the terms that items have. The
   collection's figures (documents, length, documents of a term) are aggregates of that table.
2. A task takes its documents in shards. A shard's posting list of a term is cut into blocks by the similarity of the
   documents: a few of them are centres, and each document goes to the centre it is most similar to. A block's
   summary has the largest impact of each coordinate; the coordinates of a term's list are the terms of the items
   that have the term, for no other item ever asks the list.
3. An item takes the lists of its terms from the one that can add most to the one that can add least. In a list it looks
   at blocks in the order of their bounds (summary times the item's weights, the exact maximum) and stops at the first
   whose bound is below the item's threshold. It stops with the lists when all that remain together can't reach the
   threshold. Documents of blocks that remain are scored exactly, so nothing is ever lost to a bound.
4. Thresholds come from a first pass that takes each item's best list of every shard only: the score of its k-th best
   document so far is one that no document below can come back from. A task's own best documents raise it further.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.storage import stored

TOP = 20
#: Documents of a shard, of a block on average, and of a part of a list that is compared with the centres at once.
SHARD_DOCS, BLOCK_DOCS, ROWS_AT_ONCE = 8192, 64, 512
#: Coordinates that documents are compared with centres on; where a list has more, they are folded (bounds are not).
FOLDED = 256
#: Bytes of item texts that are searched for together (their terms are sent to every task), and of summaries kept.
ITEM_BYTES, KEPT_BYTES = 8_000_000, 64_000_000
#: Parts into which an item's finds go before the last ranking.
SALTS = 32

#: Bytes that end a term become spaces, A-Z become a-z; digits, letters and all bytes beyond ASCII stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def weight(docs: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * with_term + 1)))


class Items:
    """The items of one search: their terms by number, and how often each item has each of them."""

    def __init__(self, texts: list[bytes | None]):
        self.number: dict[bytes, int] = {}
        self.counts: list[dict[int, int]] = []
        for text in texts:
            counted = Counter(terms_of(text) if text else [])
            self.counts.append({self.number.setdefault(term, len(self.number)): n for term, n in counted.items()})
        askers = defaultdict(list)
        for counted in self.counts:
            for term in counted:
                askers[term].append(counted)
        #: For each term, the terms of the items that have it, in rising order.
        self.coordinates = {
            term: np.array(sorted(set().union(*counted)), np.int64) for term, counted in askers.items()
        }

    def weighted(self, weights: dict[int, int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, weights with repeats) of each item, without terms that add nothing."""
        out = []
        for counted in self.counts:
            kept = sorted(term for term in counted if weights.get(term, 0) > 0)
            out.append((np.array(kept, np.int64), np.array([weights[t] * counted[t] for t in kept], np.int64)))
        return out


def postings(docs: DataFrame, items: Items, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n, terms, tfs`` of documents that have a term: its number of terms, and those that items have."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.number
        for batch in batches:
            rows, n, terms, tfs, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = terms_of(text) if text else []
                if found:
                    counted = Counter(found)
                    for term in counted.keys() & number.keys():
                        terms.append(number[term])
                        tfs.append(counted[term])
                    rows.append(row)
                    n.append(len(found))
                    ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    narrow = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return narrow.mapInArrow(task, "doc_id long, n long, terms array<int>, tfs array<int>")


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all places of the ranges, where each range's begin)."""
    n = ends - starts
    first = np.cumsum(n) - n
    return np.arange(n.sum()) + np.repeat(starts - first, n), first


class Shard:
    """Documents of a task: their impacts by document and by term, and the blocks of lists that were asked for."""

    def __init__(self, rows: list[pa.RecordBatch], docs: int, length: int, items: Items):
        table = pa.Table.from_batches(rows).combine_chunks()
        ids = table["doc_id"].combine_chunks()
        self.no_id = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        listed = table["terms"].combine_chunks()
        sizes = np.asarray(listed.value_lengths(), np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.terms = listed.flatten().to_numpy().astype(np.int64)
        tf = table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
        m = 75 + 25 * table["n"].to_numpy() * docs // length
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.impacts = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.doc])
        #: Impacts of documents as vectors of length 1, which only decide who shares a block.
        lengths = np.sqrt(np.bincount(self.doc, self.impacts.astype(float) ** 2, len(sizes)))
        self.unit = (self.impacts / lengths[self.doc]).astype(np.float32)
        order = np.argsort(self.terms, kind="stable")
        there, first = np.unique(self.terms[order], return_index=True)
        self.listed = {t: members for t, members in zip(there.tolist(), np.split(self.doc[order], first[1:]))} if len(there) else {}
        #: The largest impact of each term, by its number.
        self.most = np.zeros(len(items.number) + 1, np.int64)
        if len(there):
            self.most[there] = np.maximum.reduceat(self.impacts[order], first)
        self.items, self.kept, self.kept_bytes = items, {}, 0

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(members block by block, where blocks begin and end, summaries) of a term's list."""
        if term not in self.kept:
            made = self._cut(self.listed[term], self.items.coordinates[term])
            if self.kept_bytes > KEPT_BYTES:
                self.kept, self.kept_bytes = {}, 0
            self.kept[term] = made
            self.kept_bytes += made[2].nbytes + made[0].nbytes
        return self.kept[term]

    def _cut(self, members: np.ndarray, coordinates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = np.full(len(self.most), -1, np.int64)
        place[coordinates] = np.arange(len(coordinates))
        at, first = _ranges(self.starts[members], self.ends[members])
        row = np.repeat(np.arange(len(members)), self.ends[members] - self.starts[members])
        column = place[self.terms[at]]
        asked = column >= 0
        row, column, impact = row[asked], column[asked], self.impacts[at[asked]]
        n = -(-len(members) // BLOCK_DOCS)
        if n > 1:
            value = self.unit[at[asked]]
            block = self._nearest(row, column % FOLDED, value, len(members), min(len(coordinates), FOLDED), n)
        else:
            block = np.zeros(len(members), np.int64)
        used, block = np.unique(block, return_inverse=True)
        summary = np.zeros((len(used), len(coordinates)), np.int32)
        np.maximum.at(summary, (block[row], column), impact.astype(np.int32))
        order = np.argsort(block, kind="stable")
        return members[order], np.searchsorted(block[order], np.arange(len(used) + 1)), summary

    @staticmethod
    def _nearest(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int, n: int) -> np.ndarray:
        """For each row of a sparse matrix, which of ``n`` evenly spaced rows is most similar to it."""
        centres = np.arange(n) * rows // n
        which = np.full(rows, -1)
        which[centres] = np.arange(n)
        centre = np.zeros((n, columns), np.float32)
        own = which[row] >= 0
        np.add.at(centre, (which[row[own]], column[own]), value[own])
        cut = np.searchsorted(row, np.arange(0, rows + ROWS_AT_ONCE, ROWS_AT_ONCE))
        found = []
        for k, begin in enumerate(range(0, rows, ROWS_AT_ONCE)):
            some = slice(cut[k], cut[k + 1])
            part = np.zeros((min(ROWS_AT_ONCE, rows - begin), columns), np.float32)
            np.add.at(part, (row[some] - begin, column[some]), value[some])
            found.append((part @ centre.T).argmax(axis=1))
        return np.concatenate(found)

    def scores(self, members: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at, first = _ranges(self.starts[members], self.ends[members])
        return np.add.reduceat(self.impacts[at] * weights[self.terms[at]], first)


class Best:
    """An item's best documents so far, and the score that a document needs."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, max(floor, 1)
        self.score, self.no_id, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        new = score >= self.floor
        if not new.any():
            return
        score, no_id, ids = (np.concatenate([a, b[new]]) for a, b in ((self.score, score), (self.no_id, no_id), (self.id, ids)))
        order = np.lexsort((ids, no_id, -score))[: self.top]
        self.score, self.no_id, self.id = score[order], no_id[order], ids[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.score[-1]))


def search_shard(shard: Shard, terms: np.ndarray, weights: np.ndarray, best: Best, most_lists: int | None = None) -> int:
    """Brings the shard's documents into ``best`` and returns how many were scored. ``most_lists`` ends it early."""
    reach = shard.most[terms] * weights
    order = np.argsort(-reach, kind="stable")
    left = int(reach.sum())
    if left < best.floor:
        return 0
    dense = np.zeros(len(shard.most), np.int64)
    dense[terms] = weights
    seen = np.zeros(len(shard.ids), bool)
    for taken, k in enumerate(order.tolist()):
        if left < best.floor or not reach[k] or taken == most_lists:
            break
        term = int(terms[k])
        members, ends, summary = shard.blocks(term)
        bounds = summary[:, np.searchsorted(shard.items.coordinates[term], terms)].astype(np.int64) @ weights
        by_bound = np.argsort(-bounds, kind="stable")
        at, step = 0, 1
        while at < len(by_bound) and bounds[by_bound[at]] >= best.floor:
            some = by_bound[at : at + step]
            some = some[bounds[some] >= best.floor]
            docs = members[_ranges(ends[some], ends[some + 1])[0]]
            docs = docs[~seen[docs]]
            if len(docs):
                seen[docs] = True
                best.add(shard.scores(docs, dense), shard.no_id[docs], shard.ids[docs])
            at, step = at + step, 2 * step
        left -= int(reach[k])
    return int(seen.sum())


def _searching(items: Items, weighted: list, docs: int, length: int, top: int, floors: dict[int, int], seeds: bool, shard_docs: int):
    """Task over rows of ``postings``: ``item, doc_id, score`` of each item's best documents in the task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top, floors.get(i, 1)) for i in range(len(weighted))]
        held: list[pa.RecordBatch] = []
        count = 0

        def search() -> None:
            shard = Shard(held, docs, length, items)
            for (terms, weights), found in zip(weighted, best):
                if len(terms):
                    search_shard(shard, terms, weights, found, 1 if seeds else None)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                taken = batch.slice(at, shard_docs - count)
                held.append(taken)
                count, at = count + taken.num_rows, at + taken.num_rows
                if count == shard_docs:
                    search()
                    held, count = [], 0
        if count:
            search()
        for i, found in enumerate(best):
            if len(found.score):
                columns = [
                    pa.array(np.full(len(found.score), i, np.int32)),
                    pa.array(found.id, mask=found.no_id),
                    pa.array(found.score),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return task


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of every item, with ``rank``: first in parts, so that no task meets all finds of an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    in_part = Window.partitionBy("item", "part").orderBy(*order)
    parts = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    first = parts.withColumn("rank", F.row_number().over(in_part)).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def _search(docs: DataFrame, rows: list, id_type: str, id_column: str, text_column: str, top: int, shard_docs: int) -> DataFrame:
    """Results for items that are at hand: ``rows`` of (id, text)."""
    spark = docs.sparkSession
    items = Items([text.encode() if text is not None else None for _, text in rows])
    listed = stored(postings(docs, items, id_column, text_column))
    count, length = listed.agg(F.count("*"), F.sum("n")).first()
    with_term = listed.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weighted = items.weighted({r["term"]: weight(count, r["count"]) for r in with_term})
    schema = "item int, doc_id long, score long"

    def run(floors: dict[int, int], seeds: bool) -> DataFrame:
        return listed.mapInArrow(_searching(items, weighted, count, length or 1, top, floors, seeds, shard_docs), schema)

    floors = {r["item"]: r["score"] for r in _ranked(run({}, True), top).where(F.col("rank") == top).collect()}
    names = spark.createDataFrame([(i, row[0]) for i, row in enumerate(rows)], f"item int, item_id {id_type}")
    ranked = _ranked(run(floors, False), top)
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    top: int = TOP,
    shard_docs: int = SHARD_DOCS,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents with a score above 0, equal scores by rising id.

    Items are searched for in groups of about ``item_bytes`` of text, as many as it takes; items that are equal in id and
    text are one, and items of one id with different texts are ranked each by itself. Null, empty and termless texts
    give no rows and are found by no item; they don't count as documents. Repeated documents are ranked each, and one
    without an id comes after those with one and the same score. Without documents or items there are no rows. The
    documents' id must be an integer. Other columns are left out, so their names can't clash.
    """
    asked = items.select(items[item_id_column].alias("id"), items[item_text_column].cast("string").alias("text"))
    asked = asked.where(F.octet_length("text") > 0).distinct()
    groups = max(1, math.ceil((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / item_bytes))
    group = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(groups))
    found = []
    for number in range(groups):
        rows = [(r["id"], r["text"]) for r in asked.where(group == number).sort("id", "text").collect()]
        if rows or not found and number + 1 == groups:
            id_type = items.schema[item_id_column].dataType.simpleString()
            found.append(_search(docs, rows, id_type, id_column, text_column, top, shard_docs))
    return reduce(DataFrame.unionByName, found)
