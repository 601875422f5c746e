"""Operator 13: exact duplicates by a tree of merges over sorted digest runs.

1. Every text is normalised and hashed once; what goes on is a narrow table of identifiers and digests.
2. A task sorts the digests of its rows into runs of bounded length. Equal digests of a run become one entry, which
   has their number and the row that stays, so that a hot text is one entry of each run from here on.
3. Runs exchange pieces in rounds. A round looks at the next ``BITS`` bits of the digests: run ``r`` sends the piece
   with the digit ``d`` to the run whose number is ``r`` with that digit set to ``d``, and merges the sorted pieces
   that it gets. After the last round a run has all entries of one range of digests, and nothing else. No run ever
   has more than its range's share, and no task has everything.
4. Entries are ordered by the first 64 bits of their digests; whether two are equal is verified on all 256 bits and
   on the length of the normalised text, at every level.
5. Only texts found twice go back, first to the partitions of the input (one row for each that has the text), then to
   the rows of each partition, so that a hot text meets no task as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.sequences import mixed
from trackloom.llm.storage import stored

#: Characters that don't count, as Spark's ``translate`` takes them.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Rows of a run at most, entries of a message at most, and digest bits of a round (2**BITS runs are merged at once).
RUN_ROWS, MESSAGE_ROWS, BITS = 200_000, 20_000, 4

#: An entry of a run; its digest as four numbers, the leading one first.
ENTRY = np.dtype(
    [("digest", "<u8", 4), ("length", "<i8"), ("chars", "<i8"), ("no_id", "<i8"), ("id", "<i8"), ("row", "<i8"), ("n", "<i8")]
)


def merge(pieces: list[np.ndarray]) -> np.ndarray:
    """Sorted entries of sorted pieces, equal texts as one: the most characters, then the smallest id, stays.

    The stable sort takes the pieces as the runs they are. A row without an id comes after those with one.
    """
    rows = pieces[0] if len(pieces) == 1 else np.concatenate(pieces)
    digest = rows["digest"]
    order = np.lexsort(
        (rows["row"], rows["id"], rows["no_id"], -rows["chars"], rows["length"], digest[:, 3], digest[:, 2], digest[:, 1], digest[:, 0])
    )
    rows, digest = rows[order], digest[order]
    if not len(rows):
        return rows
    new = np.ones(len(rows), bool)
    new[1:] = (digest[1:] != digest[:-1]).any(axis=1) | (rows["length"][1:] != rows["length"][:-1])
    first = np.flatnonzero(new)
    out = rows[first].copy()
    out["n"] = np.add.reduceat(rows["n"], first)
    return out


def digit(entries: np.ndarray, level: int, bits: int = BITS) -> np.ndarray:
    """The ``level``-th digit of the entries' digests; it never falls among entries whose earlier digits agree."""
    lead = entries["digest"][:, 0]
    return ((lead >> np.uint64(64 - bits * (level + 1))) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _messages(run: int, entries: np.ndarray, level: int, rounds: int, bits: int) -> Iterator[tuple[int, bytes]]:
    """(run to go to, packed sorted entries): a run's pieces of one level; after the last one it keeps all."""
    if level == rounds:
        ends = [(run, 0, len(entries))]
    else:
        cut = np.searchsorted(digit(entries, level, bits), np.arange((1 << bits) + 1))
        shift = bits * (rounds - 1 - level)
        rest = run & ~(((1 << bits) - 1) << shift)
        ends = [(rest | d << shift, cut[d], cut[d + 1]) for d in range(1 << bits)]
    for to, start, end in ends:
        for at in range(start, end, MESSAGE_ROWS):
            yield to, entries[at : min(at + MESSAGE_ROWS, end)].tobytes()


def _batch(messages: list[tuple[int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([to for to, _ in messages], pa.int64()), pa.array([data for _, data in messages], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["run", "entries"])


def _first_runs(rounds: int, bits: int, run_rows: int):
    """Task over rows ``row, id, digest, length, chars``: sorted runs and their first messages.

    A run's number comes from its first row. Any number will do: it says where the run's pieces start, and each round
    replaces one digit of it.
    """

    def run_of(rows: list[pa.RecordBatch]) -> tuple[int, np.ndarray]:
        table = pa.Table.from_batches(rows).combine_chunks()
        out = np.zeros(table.num_rows, ENTRY)
        out["row"] = table["row"].to_numpy()
        out["no_id"] = np.asarray(table["id"].is_null()).astype(np.int64)
        out["id"] = table["id"].fill_null(0).to_numpy()
        out["digest"] = np.frombuffer(b"".join(table["digest"].to_pylist()), ">u8").reshape(-1, 4)
        out["length"], out["chars"] = table["length"].to_numpy(), table["chars"].to_numpy()
        out["n"] = 1
        number = mixed(out["row"][:1].view(np.uint64))[0] & np.uint64((1 << bits * rounds) - 1)
        return int(number), merge([out])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                taken = batch.slice(at, run_rows - count)
                held.append(taken)
                count += taken.num_rows
                at += taken.num_rows
                if count == run_rows:
                    yield _batch(list(_messages(*run_of(held), 0, rounds, bits)))
                    held, count = [], 0
        if count:
            yield _batch(list(_messages(*run_of(held), 0, rounds, bits)))

    return task


def _next_runs(level: int, rounds: int, bits: int):
    """Task over messages sorted by run: merges what each run got and sends it on."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, pieces = None, []
        for batch in batches:
            for to, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if to != run and pieces:
                    yield _batch(list(_messages(run, merge(pieces), level, rounds, bits)))
                    pieces = []
                run = to
                pieces.append(np.frombuffer(data.as_buffer(), ENTRY))
        if pieces:
            yield _batch(list(_messages(run, merge(pieces), level, rounds, bits)))

    return task


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of more than one row, unpacked."""
    names = ["digest", "length", "keep_row", "keep_id", "group_size"]
    for batch in batches:
        for data in batch.column(1):
            rows = np.frombuffer(data.as_buffer(), ENTRY)
            rows = rows[rows["n"] > 1]
            if len(rows):
                columns = [
                    pa.array([d.tobytes() for d in rows["digest"].astype(">u8")], pa.binary()),
                    pa.array(rows["length"]),
                    pa.array(rows["row"]),
                    pa.array(rows["id"], mask=rows["no_id"] == 1),
                    pa.array(rows["n"]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def merged_runs(rows: DataFrame, runs: int, bits: int = BITS, run_rows: int = RUN_ROWS) -> DataFrame:
    """``digest, length, keep_row, keep_id, group_size`` of the texts that ``rows`` has more than once.

    ``rows`` has ``row, id, digest, length, chars``. There are as many rounds as ``runs`` has digits.
    """
    rounds = max(1, math.ceil(math.log(max(runs, 2), 2) / bits))
    packed = rows.select("row", "id", "digest", "length", "chars").mapInArrow(
        _first_runs(rounds, bits, run_rows), "run long, entries binary"
    )
    for level in range(1, rounds + 1):
        dealt = packed.repartition("run").sortWithinPartitions("run")
        packed = dealt.mapInArrow(_next_runs(level, rounds, bits), "run long, entries binary")
    return packed.mapInArrow(_repeated, "digest binary, length long, keep_row long, keep_id long, group_size long")


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits: int = BITS,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal when they are identical without white space; a null text counts as empty, so nulls, empty and white
    texts are one group. Of a group the row with the most code points in its text stays, then the smallest id, then
    any one of the rows with that id: exactly one row of a group is kept, also among repeated rows. A row without an id
    stays only where no row with as many code points has one; its group's ``keep_id`` is null. The id must be an
    integer. Other columns are left out, so their names can't clash.
    """
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    rows = stored(
        docs.select(docs[id_column].cast("long").alias("id"), text.alias("text"))
        .withColumn("normal", F.translate("text", WHITE, ""))
        .select(
            F.spark_partition_id().alias("source"),
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.unhex(F.sha2("normal", 256)).alias("digest"),
            F.length("normal").cast("long").alias("length"),
            F.length("text").cast("long").alias("chars"),
        )
    )
    last, count = rows.agg(F.max("source"), F.count("*")).first()
    repeated = merged_runs(rows, max((last or 0) + 1, count // run_rows), bits, run_rows)
    text_of = ["source", "digest", "length"]
    by_source = rows.select(*text_of).distinct().join(repeated, ["digest", "length"])
    found = rows.join(by_source, text_of, "left")
    return found.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
