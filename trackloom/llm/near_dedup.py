"""Operator 2: near duplicates by MinHash bands and odd sketches.

1. A document's set is that of the hashes of its shingles. Documents with equal sets are one class, kept by its
   smallest id; everything else works on classes.
2. MinHash samples, in bands of rows, give the keys of a class. The samples are also folded into an odd sketch: a
   bitmap in which each sample flips a bit, so that the bits in which two sketches differ estimate how many samples
   differ. For high similarities that is precise, and a pair far below the threshold is dropped by one XOR. A second
   bitmap is folded from the set itself (from a sample of it by hash, if it is large): as many bits of two such
   bitmaps differ as shingles do, at most, which tells pairs just below the threshold apart.
3. Within a key every class is compared with a few leaders only (stars, linear in the key's size). Links are
   confirmed on the full sets.
4. Where a key still holds classes of more than one component, pairs across components go on whose sketches are near
   the threshold, each in the first key that both have. Pairs inside a component can't change the result, so a
   bucket's pairs are never all formed, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.components import components
from trackloom.llm.names import free_name
from trackloom.llm.sequences import lower, mixed, range_hashes, signed, text_blocks, word_hashes, words_of
from trackloom.llm.storage import stored

#: Words of a shingle; a link needs ``100 * intersection >= PERCENT * union``.
SHINGLE, PERCENT = 5, 75
#: A pair at the threshold shares no band with a chance of (1 - 0.75**4)**40 = 2.6e-7.
BANDS, ROWS = 40, 4
#: Bits of an odd sketch over BANDS * ROWS samples. A pair is dropped where the estimate is below LEAST_ESTIMATE: one at
#: the threshold with a chance of 1.4e-7 (exact, binomial samples and parity of bits), less than it shares no band.
SKETCH_BITS, LEAST_ESTIMATE = 512, 0.51
#: Bits of the bitmap of a set, which has the shingles of larger sets by 1 in 2, 4, ... only. From a sample, a pair is
#: dropped beyond six standard deviations.
SET_BITS, DEVIATIONS = 1024, 6
#: Classes of a key that all others of it are compared with.
LEADERS = 5

_draw = np.random.default_rng(20_23)
_FACTORS = _draw.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, where each document's begin): the distinct shingles of every document, in rising order.

    A document with fewer words than a shingle has its whole sequence as the only one; without words it has none.
    """
    data = lower(data)
    starts, ends, firsts = words_of(data, offsets)
    words = word_hashes(data, starts, ends)
    counts = np.diff(firsts)
    doc = np.repeat(np.arange(len(counts)), np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1)))
    n = np.bincount(doc, minlength=len(counts))
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    begin = firsts[:-1][doc] + place
    hashes = range_hashes(words, begin, np.minimum(begin + shingle, firsts[1:][doc]))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(counts) + 1))


def _samples(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """MinHash samples of documents that have shingles, one row each."""
    out = np.empty((len(firsts), len(_FACTORS)), np.uint64)
    for k, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS)):
        scrambled = hashes * factor + shift
        out[:, k] = np.minimum.reduceat(scrambled ^ (scrambled >> np.uint64(32)), firsts)
    return out


def _bands(samples: np.ndarray) -> np.ndarray:
    keys = np.empty((len(samples), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(samples), band + 1, np.uint64)
        for row in range(ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, band * ROWS + row])
        keys[:, band] = key
    return keys


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps: each sample, together with its number, flips one of ``bits`` bits. 64 bits a word."""
    at = mixed(samples + np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(bits)
    flat = (np.arange(len(samples), dtype=np.int64)[:, None] * bits + at.astype(np.int64)).ravel()
    odd = (np.bincount(flat, minlength=len(samples) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(samples), bits), axis=1).view(np.uint64)


def set_sketches(hashes: np.ndarray, firsts: np.ndarray, bits: int = SET_BITS) -> np.ndarray:
    """Parity bitmaps of whole sets, or of the shingles that a large set's rate takes."""
    sizes = np.diff(firsts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    rate = (np.uint64(1) << _halvings(sizes).astype(np.uint64)) - np.uint64(1)
    taken = (hashes >> np.uint64(40)) & rate[doc] == 0
    at = doc[taken] * bits + (hashes[taken] % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(sizes) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sizes), bits), axis=1).view(np.uint64)


def _halvings(sizes: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.maximum(sizes / SET_BITS, 1))).astype(np.int64)


def most_odd_bits(estimate: float = LEAST_ESTIMATE, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS) -> int:
    """Differing bits at which two sketches stand for a similarity of ``estimate``."""
    return int(bits / 2 * (1 - np.exp(-4 * samples * (1 - estimate) / bits)))


def _listed(values: np.ndarray) -> pa.Array:
    """A two-dimensional array as an Arrow list column."""
    starts = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(starts, pa.array(signed(values.ravel())))


def signatures(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b`` (128 bits that stand for the set), ``bands, sketch,
    halvings, parity`` (arrays are null for empty sets)."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"
    schema += ", halvings int, parity array<long>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                hashes, firsts = shingle_sets(data, offsets)
                sizes = np.diff(firsts)
                full = np.flatnonzero(sizes)
                whole = [np.zeros(len(sizes), np.int64) for _ in range(2)]
                bands, sketch = pa.nulls(len(sizes), pa.list_(pa.int64())), pa.nulls(len(sizes), pa.list_(pa.int64()))
                if len(full):
                    samples = _samples(hashes, firsts[full])
                    back = np.full(len(sizes), -1)
                    back[full] = np.arange(len(full))
                    take = pa.array(np.maximum(back, 0), mask=back < 0)
                    bands, sketch = _listed(_bands(samples)).take(take), _listed(odd_sketches(samples)).take(take)
                    for i, base in enumerate(("grams", "bytes")):
                        whole[i][full] = signed(range_hashes(hashes, firsts[:-1][full], firsts[1:][full], base))
                columns = [batch.column(0).slice(first, end - first), *map(pa.array, (sizes, *whole)), bands, sketch]
                columns += [pa.array(_halvings(sizes), pa.int32()), _listed(set_sketches(hashes, firsts))]
                names = ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch", "halvings", "parity"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text")).mapInArrow(task, schema)


def full_sets(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``id, shingles``: every document's set."""
    kind = docs.schema[id_column].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                hashes, firsts = shingle_sets(data, offsets)
                sets = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(signed(hashes)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), sets], names=["id", "shingles"])

    return docs.select(docs[id_column], docs[text]).mapInArrow(task, f"id {kind}, shingles array<long>")


def _differing(a: Column, b: Column, bits: int) -> Column:
    """Bits in which two bitmaps differ."""
    words = (F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(bits // 64))
    return reduce(lambda x, y: x + y, words)


def _may_link(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Whether the bitmaps of two classes leave a link possible. ``a`` and ``b`` give a class's columns by name.

    Sets that reach the threshold differ in a bounded share of all their shingles, and so do the bitmaps of sets.
    """
    share = (100 - PERCENT) / (100 + PERCENT)
    most = (a("n_shingles") + b("n_shingles")) * share / F.pow(F.lit(2.0), a("halvings"))
    most = F.when(a("halvings") > 0, most + DEVIATIONS * F.sqrt(most)).otherwise(most)
    near = _differing(a("sketch"), b("sketch"), SKETCH_BITS) <= most_odd_bits()
    return near & ((a("halvings") != b("halvings")) | (_differing(a("parity"), b("parity"), SET_BITS) <= most))


SKETCHES = ("n_shingles", "sketch", "halvings", "parity")


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that the bitmaps don't rule out."""
    first, second = (
        classes.select(F.col("rep").alias(f"_rep{i}"), *[F.col(c).alias(f"_{c}{i}") for c in SKETCHES]) for i in (1, 2)
    )
    joined = pairs.join(first, F.col("a") == F.col("_rep1")).join(second, F.col("b") == F.col("_rep2"))
    return joined.where(_may_link(lambda c: F.col(f"_{c}1"), lambda c: F.col(f"_{c}2"))).select("a", "b").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """The pairs that reach the threshold on their full sets. Only the documents in ``pairs`` have their sets built."""
    needed = stored(pairs.select(F.col("a").alias("_needed")).union(pairs.select("b")).distinct())
    wanted = docs.select(id_column, text).join(needed, F.col(id_column) == F.col("_needed"), "left_semi")
    sets = full_sets(wanted, id_column, text)
    first = sets.select(F.col("id").alias("_ia"), F.col("shingles").alias("_fa"))
    second = sets.select(F.col("id").alias("_ib"), F.col("shingles").alias("_fb"))
    common = F.size(F.array_intersect("_fa", "_fb"))
    joined = pairs.join(first, F.col("a") == F.col("_ia")).join(second, F.col("b") == F.col("_ib"))
    return (
        joined.withColumn("_both", common)
        .where(100 * F.col("_both") >= PERCENT * (F.size("_fa") + F.size("_fb") - F.col("_both")))
        .select("a", "b")
        .distinct()
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Words are compared in lower case (A-Z). ``component_id`` is the smallest id that links reach, ``kept`` tells
    whether it is the row's own. Empty and null texts have an empty set and link with nothing. A row without an id
    can't be part of a link: its component is null and it is kept. Rows with one id are one node. Columns other than
    id and text are left out.
    """
    rows = stored(signatures(docs, id_column, text))
    classes = stored(
        rows.where(F.col("n_shingles") > 0)
        .where(F.col("doc_id").isNotNull())
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), *[F.any_value(c).alias(c) for c in ("bands", *SKETCHES)])
    )
    keys = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    # the smallest class by each of a few orders, one of them that of the ids
    orders = [F.col("rep"), *(F.xxhash64(F.lit(i), "rep") for i in range(1, LEADERS))]
    leaders = keys.groupBy(F.col("key").alias("_key")).agg(
        F.count("*").alias("_n"), *(F.min(F.struct(o.alias("o"), "rep"))["rep"].alias(f"_l{i}") for i, o in enumerate(orders))
    )
    leaders = leaders.where("_n > 1")
    stars = (
        keys.join(leaders, F.col("key") == F.col("_key"))
        .select("rep", F.explode(F.array_distinct(F.array([f"_l{i}" for i in range(LEADERS)]))).alias("_lead"))
        .where("rep != _lead")
    )
    tried = stored(stars.select(F.least("rep", "_lead").alias("a"), F.greatest("rep", "_lead").alias("b")).distinct())
    links = stored(confirmed(stored(_with_sketches(tried, classes)), docs, id_column, text))
    reached = components(links)

    # keys that still hold several components: pairs across them
    known = reached.select(F.col("node").alias("_node"), F.col("component").alias("_comp"))
    labelled = (
        keys.join(leaders.where("_n > 2").select("_key"), F.col("key") == F.col("_key"))
        .join(known, F.col("rep") == F.col("_node"), "left")
        .select("key", "band", "rep", F.coalesce("_comp", "rep").alias("comp"))
    )
    several = labelled.groupBy("key").agg(F.min("comp").alias("_least"), F.max("comp").alias("_most"))
    several = several.where("_least != _most").select(F.col("key").alias("_open"))
    members = classes.select(F.col("rep").alias("_rep"), "bands", *SKETCHES)
    opened = stored(
        labelled.join(several, F.col("key") == F.col("_open"), "left_semi")
        .join(members, F.col("rep") == F.col("_rep"))
        .drop("_rep")
    )
    other = opened.select(*[F.col(c).alias(f"_{c}") for c in opened.columns])
    first_common = F.array_position(F.zip_with("bands", "_bands", lambda x, y: x == y), True) - 1
    across = opened.join(
        other,
        (F.col("key") == F.col("_key"))
        & (F.col("rep") < F.col("_rep"))
        & (F.col("comp") != F.col("_comp"))
        & _may_link(F.col, lambda c: F.col(f"_{c}"))
        & (first_common == F.col("band")),
    ).select(F.col("rep").alias("a"), F.col("_rep").alias("b"))
    candidates = stored(across.join(tried, ["a", "b"], "left_anti"))
    more = stored(confirmed(candidates, docs, id_column, text))
    reached = components(links.unionByName(more))

    placed = classes.select(F.col("set_a").alias("_a"), F.col("set_b").alias("_b"), "rep").join(
        reached, F.col("rep") == F.col("node"), "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return rows.join(
        placed, (F.col("set_a") == F.col("_a")) & (F.col("set_b") == F.col("_b")) & (F.col("n_shingles") > 0), "left"
    ).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one with the smallest id."""
    gone = free_name("_gone", docs.columns)
    out = near_duplicates(docs, id_column, text).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(out, F.col(id_column) == F.col(gone), "left_anti")
