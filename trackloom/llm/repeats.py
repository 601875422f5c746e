"""Finding windows that occur elsewhere in a corpus, for the two substring operators.

A text is a sequence of units (words or bytes). Every window of ``length`` units has an anchor: the leftmost gram with
the smallest hash among its grams. Equal windows have equal anchors at the same place, so only windows that share an
anchor need comparing. A piece is a run of windows with one anchor.

1. ``fingerprints``: the hashes of all anchors, packed 32 bits each into one row for a group of documents (a "part")
   and a bucket of hashes; a bucket tells each part which of its anchors occur elsewhere.
2. ``occurrences``: the pieces at those anchors. Equal pieces of a part are settled there, so that a passage that a
   third of all documents share gives one row for each part and not one for each copy.
3. ``resolve``: equal pieces are settled by their order. What is left are anchors with different pieces, for
   which contents must be compared.
4. ``contents``: the units of those pieces, dealt to shards by anchor. A crowded anchor's pieces are dealt by window
   instead, so that no shard holds more than its share.
5. The operator's own index (an automaton, a suffix array) settles a shard.

The texts are shuffled once, by part; all passes read that shuffle. Nothing is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.sequences import mixed, range_hashes, rolling_hashes, signed, text_blocks
from trackloom.llm.storage import partitions

#: Parts and shards for each shuffle partition; pieces that an anchor's shard may hold before it is dealt by window.
PARTS, SHARDS, CROWD = 4, 16, 1000
#: Rows of OCCURRENCE have the first window, the number of windows (NUMBER_BITS) and whether they are settled in one
#: number: they are the widest shuffle. Hashes keep their 64 bits: among one anchor's pieces only the piece's hash and
#: its number of windows tell different pieces apart.
NUMBER_BITS = 15
OCCURRENCE = "hash long, piece long, row long, doc long, place long, part long"
FOUND = "part long, row long, doc long, start long, n long, kind long, hash long"
CONTENT = "shard long, part long, row long, doc long, start long, n long, units binary"
#: Kinds of rows: windows to remove; pieces to compare, of an ordinary or a crowded anchor.
GONE, ASK, ASK_CROWDED = 0, 1, 2

#: A block's units as numbers, and the first unit of each document.
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Windows:
    """``length`` units a window, ``gram`` units an anchor. ``within``: an earlier start in the same document counts
    too, else only documents with a smaller id."""

    units: Units
    length: int
    gram: int
    within: bool

    def __post_init__(self):
        if not 0 < self.gram <= self.length < 1 << NUMBER_BITS:
            raise ValueError(f"an anchor must fit in a window, and a window has fewer than {1 << NUMBER_BITS} units")


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    have, done = values, 1
    while done * 2 <= width:
        have = np.minimum(have[:-done], have[done:])
        done *= 2
    rest = width - done
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def pieces(windows: Windows, values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, piece hash, document, start of the first window, windows) of every piece of a block.

    Starts are counted in the block.
    """
    n_windows = len(values) - windows.length + 1
    if n_windows < 1:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    grams = rolling_hashes(values, windows.gram)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_least(ranked, windows.length - windows.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n_in = np.maximum(np.diff(firsts) - windows.length + 1, 0)
    doc = np.repeat(np.arange(len(n_in)), n_in)
    start = np.arange(len(doc)) + np.repeat(firsts[:-1] - (np.cumsum(n_in) - n_in), n_in)
    anchor = anchor[start]
    if not len(start):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
    n = np.diff(np.append(new, len(start)))
    start, anchor, doc = start[new], anchor[new], doc[new]
    return grams[anchor], range_hashes(values, start, start + n + windows.length - 1, "bytes"), doc, start, n


def ordered(table: pa.Table) -> pa.Table:
    """A part's documents in an order of their own, by which they are numbered; those without an id are last."""
    return table.sort_by([("_id", "ascending"), ("_row", "ascending")])


def _blocks(table: pa.Table, windows: Windows) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first document, ids, units, first units) of a part's documents with an id, block by block."""
    table = ordered(table)
    table = table.slice(0, table.num_rows - table["_id"].null_count)
    ids = table["_id"].to_numpy()
    for first, end, data, offsets in text_blocks(table["_text"]):
        yield first, ids[first:end], *windows.units(data, offsets)


def _table(schema: str, *columns: np.ndarray | pa.Array) -> pa.Table:
    return pa.table(dict(zip([f.split(" ")[0] for f in schema.split(", ")], columns)))


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.table({f.split(" ")[0]: pa.array([], kinds[f.split(" ")[1]]) for f in schema.split(", ")})


def parts_of(docs: DataFrame, id_column: str, text: str, keep: list[str]) -> DataFrame:
    """``_row, _id, _text, part`` and the kept columns as ``_k0, _k1, ...``; ``_row`` stands for id and text together."""
    n = PARTS * partitions(docs.sparkSession)
    row = F.xxhash64(docs[id_column], docs[text])
    return docs.select(
        row.alias("_row"),
        docs[id_column].cast("long").alias("_id"),
        docs[text].alias("_text"),
        *[docs[c].alias(f"_k{i}") for i, c in enumerate(keep)],
    ).withColumn("part", F.pmod("_row", F.lit(n)).cast("long"))


def _suspects(parts: DataFrame, windows: Windows, buckets: int) -> DataFrame:
    """``part, bucket, found``: fingerprints (32 bits) of a part's anchors that occur elsewhere too."""
    schema = "bucket long, part long, once binary, again binary"

    def fingerprints(key: tuple, table: pa.Table) -> pa.Table:
        hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _first, ids, values, firsts in _blocks(table, windows):
            found, _piece, doc, _start, _n = pieces(windows, values, firsts)
            hashes.append(found)
            docs.append(ids[doc])
        hash_, doc = np.concatenate(hashes), np.concatenate(docs)
        order = np.argsort(hash_, kind="stable")  # documents stay in order
        hash_, doc = hash_[order], doc[order]
        new = np.concatenate([[True], hash_[1:] != hash_[:-1]])[: len(hash_)]
        repeat = ~new if windows.within else ~new & np.concatenate([[False], doc[1:] != doc[:-1]])[: len(hash_)]
        often = np.zeros(int(new.sum()), bool)
        often[np.cumsum(new)[repeat] - 1] = True
        packed = []
        for values in (hash_[new][~often], hash_[new][often]):
            bucket = (values % np.uint64(buckets)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            short = (values[order] >> np.uint64(32)).astype(np.uint32)
            packed.append([short[a:b].tobytes() for a, b in zip(cuts, cuts[1:])])
        part = pa.array([key[0].as_py()] * buckets, pa.int64())
        return _table(schema, pa.array(range(buckets), pa.int64()), part, *(pa.array(p, pa.binary()) for p in packed))

    def found(key: tuple, table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(x, np.uint32) for c in ("once", "again") for x in table[c].to_pylist()]
        n_parts = table.num_rows
        values, sizes = np.concatenate(arrays), [len(x) for x in arrays]
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        often = np.zeros(len(values), bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        often[sum(sizes[:n_parts]) :] = True
        each = np.split(often, np.cumsum(sizes)[:-1])
        kept = [a[k].tobytes() + b[l].tobytes() for a, k, b, l in zip(arrays, each, arrays[n_parts:], each[n_parts:])]
        bucket = pa.array([key[0].as_py()] * n_parts, pa.int64())
        return pa.table({"part": table["part"], "bucket": bucket, "found": pa.array(kept, pa.binary())})

    packed = parts.groupBy("part").applyInArrow(fingerprints, schema)
    return packed.groupBy("bucket").applyInArrow(found, "part long, bucket long, found binary")


def _settled(windows: Windows, hash_, piece, doc, start, n) -> tuple[np.ndarray, np.ndarray]:
    """(order by anchor, piece and place; whether an equal piece comes strictly before), both in that order."""
    order = np.lexsort((start, doc, n, piece, hash_))
    new = np.arange(len(order)) == 0
    for x in (hash_, piece, n):
        new[1:] |= x[order][1:] != x[order][:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    late = doc[order] > doc[order][first]
    if windows.within:
        late |= start[order] > start[order][first]
    return order, late


def _occurrences(parts: DataFrame, suspects: DataFrame, windows: Windows, buckets: int) -> DataFrame:
    def task(key: tuple, table: pa.Table, marks: pa.Table) -> pa.Table:
        wanted = [np.zeros(0, np.uint64)]
        for bucket, found in zip(marks["bucket"].to_pylist(), marks["found"].to_pylist()):
            wanted.append(np.frombuffer(found, np.uint32).astype(np.uint64) << np.uint64(32) | np.uint64(bucket))
        wanted = np.sort(np.concatenate(wanted))
        got = []
        for first, ids, values, firsts in _blocks(table, windows) if len(wanted) else ():
            hash_, piece, doc, start, n = pieces(windows, values, firsts)
            mark = (hash_ & np.uint64(0xFFFFFFFF00000000)) | hash_ % np.uint64(buckets)
            at = np.searchsorted(wanted, mark)
            keep = wanted[np.minimum(at, len(wanted) - 1)] == mark
            doc, start = doc[keep], start[keep]
            got.append((signed(hash_[keep]), signed(piece[keep]), first + doc, ids[doc], start - firsts[doc], n[keep]))
        if not got:
            return _empty(OCCURRENCE)
        hash_, piece, row, doc, start, n = map(np.concatenate, zip(*got))
        order, late = _settled(windows, hash_, piece, doc, start, n)
        # what is settled needs no particular task further on
        part = np.full(len(order), key[0].as_py())
        hash_, piece, doc = (np.where(late, rest, x[order]) for x, rest in ((hash_, part), (piece, 0), (doc, 0)))
        place = (start[order] << NUMBER_BITS | n[order]) << 1 | late
        return _table(OCCURRENCE, hash_, piece, row[order], doc, place, part)

    return parts.groupBy("part").cogroup(suspects.groupBy("part")).applyInArrow(task, OCCURRENCE)


def _resolved(occurrences: DataFrame, windows: Windows) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        hash_, piece, row, doc, place, part = (table[c].to_numpy() for c in "hash piece row doc place part".split())
        gone = (place & 1).astype(bool)
        start, n = place >> NUMBER_BITS + 1, place >> 1 & (1 << NUMBER_BITS) - 1
        zero = np.zeros(int(gone.sum()), np.int64)
        out = [(part[gone], row[gone], zero, start[gone], n[gone], zero, zero)]
        hash_, piece, row, doc, start, n, part = (x[~gone] for x in (hash_, piece, row, doc, start, n, part))
        order, late = _settled(windows, hash_, piece, doc, start, n)
        hash_, piece, row, doc, start, n, part = (x[order] for x in (hash_, piece, row, doc, start, n, part))
        if len(hash_):
            new_anchor = np.concatenate([[True], hash_[1:] != hash_[:-1]])
            new_piece = new_anchor | np.concatenate([[True], (piece[1:] != piece[:-1]) | (n[1:] != n[:-1])])
            anchor = np.cumsum(new_anchor) - 1
            classes = np.bincount(anchor, new_piece).astype(np.int64)[anchor]
            kind = np.where(late, GONE, np.where(classes > CROWD, ASK_CROWDED, ASK))
            doc, hash_ = np.where(late, 0, doc), np.where(late, 0, hash_)
            keep = late | (classes > 1)
            out.append(tuple(x[keep] for x in (part, row, doc, start, n, kind, hash_)))
        merged = _table(FOUND, *(np.concatenate(x) for x in zip(*out)))
        yield from merged.to_batches()

    n = partitions(occurrences.sparkSession)
    return occurrences.repartition(n, "hash").mapInArrow(task, FOUND)


def _contents(parts: DataFrame, resolved: DataFrame, windows: Windows, shards: int) -> DataFrame:
    """The units to compare, and with null units what a part settles itself (equal windows of crowded anchors)."""

    def task(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        if not found.num_rows:
            return _empty(CONTENT)
        row, doc, start, n, kind, hash_ = (found[c].to_numpy() for c in "row doc start n kind hash".split())
        order = np.lexsort((start, row))
        row, doc, start, n, kind, hash_ = (x[order] for x in (row, doc, start, n, kind, hash_))
        plain, crowded = [], []
        for first, ids, values, firsts in _blocks(table, windows):
            for j in range(np.searchsorted(row, first), np.searchsorted(row, first + len(ids))):
                at = firsts[row[j] - first] + start[j]
                units = values[at : at + n[j] + windows.length - 1]
                place = int(row[j]), int(doc[j]), int(start[j])
                if kind[j] == ASK:
                    plain.append((int(hash_[j]), *place, int(n[j]), units.tobytes()))
                    continue
                own = rolling_hashes(units.astype(np.uint64), windows.length)
                for k, h in enumerate(signed(own).tolist()):
                    crowded.append((h, *place[:2], place[2] + k, 1, units[k : k + windows.length].tobytes()))
        # of equal windows of crowded anchors only those that may come first go on
        crowded.sort(key=lambda x: (x[0], x[5], x[2], x[3]))
        last = None
        for entry in crowded:
            if last is None or (entry[0], entry[5]) != (last[0], last[5]):
                last = entry
            elif entry[2] > last[2] or windows.within and entry[3] > last[3]:
                entry = (entry[3], *entry[1:5], None)
            plain.append(entry)
        hash_, row, doc, start, n, units = zip(*plain)
        shard = signed(mixed(np.array(hash_, np.int64).view(np.uint64)) % np.uint64(shards))
        part = pa.array([key[0].as_py()] * len(row), pa.int64())
        numbers = (pa.array(x, pa.int64()) for x in (row, doc, start, n))
        return _table(CONTENT, pa.array(shard), part, *numbers, pa.array(units, pa.binary()))

    return parts.groupBy("part").cogroup(resolved.groupBy("part")).applyInArrow(task, CONTENT)


def removals(parts: DataFrame, windows: Windows, settle: Callable) -> DataFrame:
    """``part, row, start, n``: runs of windows that occur before, as rows of FOUND. ``row`` is the document's number
    in its part. ``settle(doc, start, n, units)`` says of some pieces in order of place which windows do:
    it gives (piece, first window, windows) runs."""
    n = partitions(parts.sparkSession)
    suspects = _suspects(parts, windows, n)
    resolved = _resolved(_occurrences(parts, suspects, windows, n), windows)

    def shard(key: tuple, table: pa.Table) -> pa.Table:
        done = table.filter(pa.compute.is_null(table["units"]))
        table = table.filter(pa.compute.is_valid(table["units"])).sort_by([("doc", "ascending"), ("start", "ascending")])
        part, row, doc, start, size = (table[c].to_numpy() for c in "part row doc start n".split())
        which, first, count = settle(doc, start, size, table["units"].to_pylist())
        which = np.asarray(which, np.int64)
        gone = pa.table(
            {
                "part": part[which],
                "row": row[which],
                "doc": doc[which],
                "start": start[which] + np.asarray(first, np.int64),
                "n": np.asarray(count, np.int64),
            }
        )
        gone = pa.concat_tables([gone, done.select(gone.column_names)])
        zero = pa.array(np.zeros(gone.num_rows, np.int64))
        return gone.append_column("kind", zero).append_column("hash", zero)

    asked = _contents(parts, resolved.where(F.col("kind") > GONE), windows, SHARDS * n)
    return resolved.where(F.col("kind") == GONE).unionByName(asked.groupBy("shard").applyInArrow(shard, FOUND))


def covered(n_units: int, start: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Which units of a document the removed windows cover."""
    change = np.zeros(n_units + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + n + length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def by_row(found: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Removed runs (start, windows) of each row of a part."""
    row, start, n = (found[c].to_numpy() for c in ("row", "start", "n"))
    order = np.argsort(row, kind="stable")
    row, start, n = row[order], start[order], n[order]
    ids, firsts = np.unique(row, return_index=True)
    ends = np.append(firsts[1:], len(row))
    return {r: (start[a:b], n[a:b]) for r, a, b in zip(ids.tolist(), firsts, ends)}
