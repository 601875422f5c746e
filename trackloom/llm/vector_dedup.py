"""Operator 10: near-duplicate vectors by p-stable (Gaussian) hashing.

For unit vectors a cosine of at least ``c`` is a Euclidean distance of at most ``sqrt(2 - 2c)``. A hash is a random
Gaussian projection, shifted and cut into cells of a fixed width; a table's bucket is several hashes together.
Their number grows with the logarithm of the number of vectors, so that a vector meets a bounded number of strangers
in a table, and the number of tables follows from the recall wanted at the threshold itself.

Equal vectors are one class with a weight. A bucket is cut into blocks of bounded size and the pairs of blocks are
dealt to tasks; a task checks exact cosines and gives sums and a spanning forest, never the pairs. A pair counts in
the first table in which its vectors meet only, which either can tell from its own keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.components import components
from trackloom.llm.sequences import mixed, signed
from trackloom.llm.storage import partitions, stored

COSINE, WIDTH, RECALL, SEED = 0.9, 2.0, 0.97, 31
#: Vectors of a block on average, and pairs checked at once.
BLOCK, PAIRS_AT_ONCE = 256, 60_000
#: Strangers are taken to be at least this far apart; so many of them may share a vector's bucket on average.
STRANGERS, MOST_STRANGERS = 1.2, 4.0


def meet(distance: float, width: float = WIDTH) -> float:
    """Chance that two vectors at a distance have one hash in common."""
    c = distance / width
    tail = NormalDist().cdf(-1 / c)
    return 1 - 2 * tail - 2 * c / math.sqrt(2 * math.pi) * (1 - math.exp(-1 / (2 * c * c)))


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(hashes in a bucket, tables) for ``n`` vectors."""
    near, far = meet(math.sqrt(2 - 2 * cosine)), meet(STRANGERS)
    hashes = max(4, math.ceil(math.log(max(n, 2) / MOST_STRANGERS) / -math.log(far)))
    return hashes, math.ceil(math.log(1 - recall) / math.log(1 - near**hashes))


def _projections(dim: int, hashes: int, tables: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([seed, dim])
    return draw.standard_normal((dim, hashes * tables)), draw.random(hashes * tables) * WIDTH


def bucket_keys(unit: np.ndarray, hashes: int, tables: int, seed: int = SEED) -> np.ndarray:
    """64-bit bucket keys, one column for each table."""
    lines, shifts = _projections(unit.shape[1], hashes, tables, seed)
    cells = np.floor((unit @ lines + shifts) / WIDTH).astype(np.int64).view(np.uint64)
    keys = np.tile(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(unit), 1))
    for i in range(hashes):
        keys = mixed(keys + cells[:, i::hashes] * np.uint64(0xC2B2AE3D27D4EB4F))
    return keys


def _unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())


def _keyed(classes: DataFrame, hashes: int, tables: int, seed: int) -> DataFrame:
    """Classes with ``keys``. Vectors of different lengths share no key."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                flat, sizes = _lists(part.column(2))
                ends = np.cumsum(sizes)
                keys = np.zeros((len(sizes), tables), np.uint64)
                for dim in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dim)
                    values = np.stack([flat[ends[r] - dim : ends[r]] for r in rows]).astype(float)
                    keys[rows] = bucket_keys(_unit(values), hashes, tables, seed)
                starts = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables)
                listed = pa.ListArray.from_arrays(starts, pa.array(signed(keys.ravel())))
                yield pa.RecordBatch.from_arrays([*part.columns, listed], names=["rep", "weight", "vector", "keys"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    schema = f"rep {kinds['rep']}, weight long, vector {kinds['vector']}, keys array<long>"
    return classes.select("rep", "weight", "vector").mapInArrow(task, schema)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of the sorted input, about PAIRS_AT_ONCE rows together at most (a group has two blocks)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column(0).to_numpy()
        salt = batch.column(1).to_numpy()
        change = np.flatnonzero((tile[1:] != tile[:-1]) | (salt[1:] != salt[:-1])) + 1
        if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (int(tile[0]), int(salt[0])):
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, change[-1])])
            held = [batch.slice(change[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _root(parent: dict, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _compare(cosine: float, hashes: int, tables: int, seed: int):
    """Task over rows ``key, tile, half, table, rep, weight, vector`` sorted by key and tile.

    Only vectors of a near pair have all their keys made again. Gives ``a, b, add``: with ``b`` null, ``add`` vectors more that ``a`` is linked to; else a link of the forest.
    """

    def pairs(half: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs within groups, PAIRS_AT_ONCE or so at once: each row with the later ones of its group (other
        half only, if the group has two)."""
        later = last[np.arange(len(half))] - np.arange(len(half)) - 1
        total = np.cumsum(later)
        at = 0
        while at < len(half):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            n = later[at:end]
            i = np.repeat(np.arange(at, end), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            both = (half[i] != half[j]) | (half[first[i]] == half[last[i] - 1])
            yield i[both], j[both]
            at = end

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add: dict[int, int] = {}
        parent: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for rows in _groups(batches):
            rows = rows.combine_chunks()
            key, tile, half, table, rep, weight = (rows.column(i).to_numpy() for i in range(6))
            flat, sizes = _lists(rows.column(6).combine_chunks())
            group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))])
            first = np.searchsorted(group, group)
            last = np.searchsorted(group, group, "right")
            dim = int(sizes.max())
            if (sizes != dim).any():  # vectors of different lengths in one chunk: zeros at the end change no cosine
                full = np.zeros((len(sizes), dim))
                full[np.arange(dim) < sizes[:, None]] = flat
                flat = full.ravel()
            unit = _unit(flat.reshape(-1, dim).astype(float))
            for i, j in pairs(half, first, last):
                near = (np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine) & (sizes[i] == sizes[j])
                i, j = i[near], j[near]
                if not len(i):
                    continue
                own, place = np.unique(np.concatenate([i, j]), return_inverse=True)
                keys = np.zeros((len(own), tables), np.uint64)
                for d in np.unique(sizes[own]):
                    keys[sizes[own] == d] = bucket_keys(unit[own[sizes[own] == d], :d], hashes, tables, seed)
                new = (keys[place[: len(i)]] == keys[place[len(i) :]]).argmax(axis=1) == table[i]
                for a, b in zip(i[new].tolist(), j[new].tolist()):
                    x, y = int(rep[a]), int(rep[b])
                    add[x] = add.get(x, 0) + int(weight[b])
                    add[y] = add.get(y, 0) + int(weight[a])
                    rx, ry = _root(parent, parent.setdefault(x, x)), _root(parent, parent.setdefault(y, y))
                    if rx != ry:
                        parent[max(rx, ry)] = min(rx, ry)
                        edges.append((x, y))
            if len(add) > 100_000:
                yield _rows(add, edges)
                add, parent, edges = {}, {}, []
        if add:
            yield _rows(add, edges)

    return task


def _rows(add: dict[int, int], edges: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [
        pa.array([*add, *(x for x, _ in edges)], pa.int64()),
        pa.array([*[None] * len(add), *(y for _, y in edges)], pa.int64()),
        pa.array([*add.values(), *[0] * len(edges)], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "add"])


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    A vector that is null, empty, zero or holds a null or non-finite component links with nothing; so does a row
    without an id (its component is null, it is kept). Vectors of different lengths don't link. Repeated rows are
    vectors of their own and link with each other; rows with one id count as one node of the graph. The id must be an
    integer. Other columns are left out.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col(id_column).isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.when(F.coalesce(usable, F.lit(False)), F.col(vector)).alias("vector")
    )
    classes = stored(
        rows.where(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("weight"))
    )
    hashes, tables = plan(classes.count(), cosine, recall)
    keyed = stored(_keyed(classes, hashes, tables, seed))
    spread = keyed.select("rep", F.posexplode("keys").alias("table", "key"))
    buckets = spread.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    placed = (
        spread.join(buckets, "key")
        .withColumn("_blocks", F.ceil(F.col("_n") / block))
        .withColumn("_own", F.pmod(F.xxhash64("rep", "table"), F.col("_blocks")))
        .select("key", "table", F.col("rep").alias("_rep"), "_blocks", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
        .withColumn("tile", F.least("_own", "_other") * F.col("_blocks") + F.greatest("_own", "_other"))
        .withColumn("half", (F.col("_own") < F.col("_other")).cast("int"))
    )
    n = max(partitions(vectors.sparkSession), 1)
    met = (
        placed.join(keyed, F.col("_rep") == F.col("rep"))
        .select("key", "tile", "half", "table", "rep", "weight", "vector")
        .repartition(n, "key", "tile")
        .sortWithinPartitions("key", "tile", "half", "rep")
        .mapInArrow(_compare(cosine, hashes, tables, seed), "a long, b long, add long")
    )
    found = stored(met)
    sums = found.where("b is null").groupBy(F.col("a").alias("_a")).agg(F.sum("add").alias("_add"))
    reached = components(found.where("b is not null"))
    known = (
        classes.join(sums, F.col("rep") == F.col("_a"), "left")
        .join(reached, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vector").alias("_vector"),
            (F.coalesce("_add", F.lit(0)) + F.col("weight") - 1).alias("_links"),
            F.coalesce("component", "rep").alias("_component"),
        )
    )
    component = F.coalesce("_component", "vec_id")
    return rows.join(known, F.col("vector") == F.col("_vector"), "left").select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
