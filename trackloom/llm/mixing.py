"""Operator 3: mixing sources to target weights.

Documents of a source lie end to end in a pseudorandom order and are cut into blocks of a fixed number of words. The
mix is a sequence of output shards of ``shard_slots`` slots; every slot draws its source by the targets, so the
counts of a shard are multinomial. The slots that a source has drawn are numbered through all shards. Slot ``i``
takes block ``i mod n`` of round ``i div n`` through a pseudorandom permutation of the source's ``n`` blocks, so that
every block is used once before any is used twice; slots and blocks meet in a join by block index. Draws beyond a
source's target are taken back and what other sources lack is dealt to closing shards, so the totals are exact.

Only DataFrame functions are used. Nothing is gathered but one row for each source (its size).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.names import positional
from trackloom.llm.storage import partitions, stored

#: The words of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in the order of their names, repeating; share of all words that the mix has.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
BLOCK_WORDS, SHARD_SLOTS, SEED = 64, 4096, 17
#: Rows that one window orders at most on average.
CHUNK = 2_000
#: Rounds of the permutation.
ROUNDS = 6


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], share: float, weights: tuple, most: float) -> list[float]:
    """Words of the mix for each source.

    ``share`` of all words is dealt by weight; a source stops at ``most`` times its size and its excess is dealt
    again among the others. Sources come by code point, null last, and have the weights in turn.
    """
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    goal, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(size for _, size in sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        full = {i for i in open_ if left * weight[i] / total > most * sizes[i][1]}
        if not full:
            for i in open_:
                goal[i] = left * weight[i] / total
            break
        for i in full:
            goal[i] = most * sizes[i][1]
            left -= goal[i]
        open_ -= full
    return goal


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    rows: int
    target: float
    blocks: int
    slots: int


@dataclass
class Mix:
    """What the operator makes.

    ``rows``: every input row with its kept columns and its number ``_row``. ``documents``: for each of them ``_row``,
    ``_source`` (number of the source), ``_size`` (words) and ``_from`` (its place among the words of its source).
    ``slots``: ``_shard, _source, _slot, _block``,
    one row for each block that the mix takes. ``uses``: ``_row, _block, _first, _words, _times``, the part of a
    document that lies in a block (first word, counted in the document, and number) and how often the mix takes it.
    """

    rows: DataFrame
    documents: DataFrame
    slots: DataFrame
    uses: DataFrame
    sources: list[Source]


def _lookup(values: list, key: Column, kind: str) -> Column:
    return F.element_at(F.lit([*values]).cast(f"array<{kind}>"), (key + 1).cast("int"))


def _alias_table(weights: list[float]) -> tuple[list[float], list[int]]:
    """A draw in constant time: take a column by chance, keep it with its share or else take its alias."""
    n, total = len(weights), sum(weights)
    share = [w * n / total for w in weights]
    alias = list(range(n))
    small, large = [i for i in range(n) if share[i] < 1], [i for i in range(n) if share[i] >= 1]
    while small and large:
        i, j = small.pop(), large[-1]
        alias[i] = j
        share[j] -= 1 - share[i]
        if share[j] < 1:
            small.append(large.pop())
    return share, alias


def _chance(*key: Column) -> Column:
    """A number from 0 up to 1 by hash."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _multiplier(n: int) -> int:
    """An odd-looking factor without a common divisor with ``n``."""
    factor = 746_773
    while math.gcd(factor, n) > 1:
        factor += 1
    return factor


def _permuted(index: Column, n: Column, factor: Column, *salt: Column) -> Column:
    """A pseudorandom permutation of ``0 .. n-1``: an affine map, then rounds in which a number and its mirror image
    about a random point change places or not, by a coin that both share."""

    def swap(at: Column, step: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(step, *salt), n) - at, n)
        return F.when(F.xxhash64(F.greatest(at, mirror), step, *salt) % 2 == 0, at).otherwise(mirror)

    return F.aggregate(F.lit(list(range(ROUNDS))), F.pmod(index * factor, n), swap)


def _running(df: DataFrame, group: str, chunk: str, order: list, value: str, to: str) -> DataFrame:
    """``to``: the sum of ``value`` over the rows of the group before this one, by chunk and then by ``order``.

    Only one row of each chunk is ordered within the whole group.
    """
    whole = Window.partitionBy(group).orderBy(chunk)
    inner = Window.partitionBy(group, chunk).orderBy(*order)
    sums = df.groupBy(group, chunk).agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_ahead", F.sum("_sum").over(whole) - F.col("_sum")).drop("_sum")
    inside = df.withColumn("_inside", F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
    joined = inside.withColumnsRenamed({group: "_g", chunk: "_c"}).join(
        sums, F.col("_g").eqNullSafe(F.col(group)) & F.col("_c").eqNullSafe(F.col(chunk))
    )
    return joined.withColumn(to, F.col("_ahead") + F.col("_inside")).drop("_ahead", "_inside", "_g", "_c")


def mix(
    docs: DataFrame,
    keep: list[str],
    source: str = "source",
    text: str = "text",
    share: float = SHARE,
    weights: tuple = WEIGHTS,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """The mix of ``docs`` (see the module).

    A null source is a source of its own, the last. Empty and null texts have no words: they stay in ``documents``
    and are in no block. Repeated rows count each. Of an empty table comes an empty mix. Columns other than ``keep``
    are left out; kept columns must not be named ``_name``, ``_size``, ``_hash`` or ``_row``.
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(
            *keep,
            docs[source].alias("_name"),
            n_words(docs[text]).alias("_size"),
            F.xxhash64(F.lit(seed), docs[text], *[docs[c] for c in keep]).alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    found = sized.groupBy("_name").agg(F.sum("_size").alias("size"), F.count("*").alias("rows")).collect()
    found.sort(key=lambda r: (r["_name"] is None, (r["_name"] or "").encode()))
    goal = targets([(r["_name"], r["size"]) for r in found], share, weights, most)
    sources = []
    for r, target in zip(found, goal):
        blocks = -(-r["size"] // block_words)
        slots = min(round(target * blocks / r["size"]), int(most * blocks)) if blocks else 0
        sources.append(Source(r["_name"], r["size"], r["rows"], target, blocks, slots))

    names = spark.createDataFrame(
        [(s.name, i, -(-s.rows // CHUNK)) for i, s in enumerate(sources)], "_known string, _source int, _chunks long"
    )
    numbered = sized.select("_name", "_size", "_hash", "_row").join(names, F.col("_name").eqNullSafe(F.col("_known"))).drop("_name", "_known")
    chunked = numbered.withColumn("_chunk", F.pmod("_hash", "_chunks"))
    documents = _running(chunked, "_source", "_chunk", ["_hash", "_row"], "_size", "_from")
    documents = documents.select("_row", "_source", "_size", "_from")

    total = sum(s.slots for s in sources)
    per_source = {k: [getattr(s, k) for s in sources] or [0] for k in ("blocks", "slots")}
    share_of, alias = _alias_table([s.slots for s in sources]) if total else ([1.0], [0])
    column = F.floor(_chance(F.lit(seed), F.col("id")) * len(share_of)).cast("int")
    drawn = (
        spark.range(total)
        .select(F.floor(F.col("id") / shard_slots).alias("_shard"), column.alias("_column"), "id")
        .withColumn(
            "_source",
            F.when(
                _chance(F.lit(seed + 1), F.col("id")) < _lookup(share_of, F.col("_column"), "double"), F.col("_column")
            ).otherwise(_lookup(alias, F.col("_column"), "int")),
        )
        .groupBy("_shard", "_source")
        .agg(F.count("*").alias("_count"))
        .withColumn("_part", F.floor(F.col("_shard") / CHUNK))
    )
    numbered_draws = _running(drawn, "_source", "_part", ["_shard"], "_count", "_before")
    last = F.least(F.col("_before") + F.col("_count"), _lookup(per_source["slots"], F.col("_source"), "long")) - 1
    # a few draws become many slots: they are dealt out first
    dealt = numbered_draws.repartition(partitions(spark), "_shard", "_source")
    open_slots = dealt.where(F.col("_before") <= last).select(
        "_shard", "_source", F.explode(F.sequence(F.col("_before"), last)).alias("_slot")
    )
    have = drawn.groupBy(F.col("_source").alias("_drawn")).agg(F.sum("_count").alias("_have"))
    lacking = (
        spark.range(len(sources))
        .select(F.col("id").cast("int").alias("_source"))
        .join(have, F.col("_source") == F.col("_drawn"), "left")
        .select("_source", F.coalesce("_have", F.lit(0)).alias("_have"))
        .withColumn("_want", _lookup(per_source["slots"], F.col("_source"), "long"))
        .where("_have < _want")
        .select("_source", F.explode(F.sequence(F.col("_have"), F.col("_want") - 1)).alias("_slot"))
        .select(
            (F.lit(-(-total // shard_slots)) + F.floor(F.col("_slot") / shard_slots)).alias("_shard"),
            "_source",
            "_slot",
        )
    )
    n = _lookup(per_source["blocks"], F.col("_source"), "long")
    factors = _lookup([_multiplier(max(1, b)) for b in per_source["blocks"]], F.col("_source"), "long")
    slots = (
        open_slots.unionByName(lacking)
        .withColumn("_n", n)
        .withColumn("_factor", factors)
        .withColumn(
            "_block",
            _permuted(
                F.col("_slot") % F.col("_n"),
                F.col("_n"),
                F.col("_factor"),
                F.col("_source"),
                F.floor(F.col("_slot") / F.col("_n")),
                F.lit(seed),
            ),
        )
        .drop("_n", "_factor")
    )
    times = slots.groupBy(F.col("_source").alias("_s"), F.col("_block").alias("_b")).agg(F.count("*").alias("_times"))
    start = F.greatest(F.col("_from"), F.col("_block") * block_words)
    end = F.least(F.col("_from") + F.col("_size"), (F.col("_block") + 1) * block_words)
    cut = (
        documents.where("_size > 0")
        .select(
            "_row",
            "_source",
            "_size",
            "_from",
            F.explode(
                F.sequence(
                    F.floor(F.col("_from") / block_words),
                    F.floor((F.col("_from") + F.col("_size") - 1) / block_words),
                )
            ).alias("_block"),
        )
        .select("_row", "_source", "_block", (start - F.col("_from")).alias("_first"), (end - start).alias("_words"))
    )
    uses = cut.join(times, (F.col("_source") == F.col("_s")) & (F.col("_block") == F.col("_b"))).select(
        "_row", "_block", "_first", "_words", "_times"
    )
    return Mix(sized.drop("_name", "_size", "_hash"), documents, slots, uses, sources)


def _named(options: dict, name: dict[str, str]) -> dict:
    """The options of ``mix`` for a table whose columns were renamed."""
    return {**options, **{k: name[options.get(k, k).lower()] for k in ("text", "source")}}


def mix_report(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row: the words that the mix takes of it."""
    docs, name = positional(docs)
    id_column = name[id_column.lower()]
    made = mix(docs, [id_column], **_named(options, name))
    taken = made.uses.groupBy(F.col("_row").alias("_r")).agg(
        F.sum(F.col("_words") * F.col("_times")).alias("_taken")
    )
    sources = made.sources or [Source(None, 0, 0, 0.0, 0, 0)]
    joined = made.documents.join(taken, F.col("_row") == F.col("_r"), "left").drop("_r")
    return joined.join(made.rows.withColumnRenamed("_row", "_r"), F.col("_row") == F.col("_r")).select(
        F.col(id_column).alias("doc_id"),
        F.col("_size").alias("size"),
        _lookup([s.size for s in sources], F.col("_source"), "long").alias("source_size"),
        _lookup([s.target for s in sources], F.col("_source"), "double").alias("target"),
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document comes once with all words that the mix takes
    at least once and again with those that it takes twice (and so on). Words are joined by one space; what a column
    says about the old text is left as it was. Columns may have any names."""
    columns = docs.columns
    docs, name = positional(docs)
    text = name[text.lower()]
    made = mix(docs, docs.columns, **_named(options, name) | {"text": text})
    taken = (
        made.uses.select("_row", "_block", "_first", "_words", F.explode(F.sequence(F.lit(1), "_times")).alias("_again"))
        .groupBy(F.col("_row").alias("_r"), "_again")
        .agg(F.sort_array(F.collect_list(F.struct("_first", "_words"))).alias("_parts"))
    )
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))

    def taken_words(all_words: Column) -> Column:
        parts = F.transform(
            "_parts", lambda p: F.slice(all_words, (p["_first"] + 1).cast("int"), p["_words"].cast("int"))
        )
        return F.array_join(F.flatten(parts), " ")

    # as a lambda's variable the words of a text are taken once, not once for each part
    joined = made.rows.join(taken, F.col("_row") == F.col("_r"))
    return joined.withColumn(text, F.get(F.transform(F.array(words), taken_words), F.lit(0))).select(*docs.columns).toDF(*columns)
