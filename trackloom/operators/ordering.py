"""Ordered operators that never sort one whole group in one task.

A group (a video, a tube, or the whole table) is cut into chunks by an expression that grows
with the order. Each chunk is sorted alone; what a chunk needs from the ones before it is
carried by a summary with one row per chunk. The summary of the largest group is smaller than
the group by the chunk size, so a group that holds a third of all rows is spread over as many
tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_FRAMES = 1024


def _cut(df: DataFrame, keys: list[str], chunk: Column) -> DataFrame:
    """Rows with their chunk. The null tests make both sides of the later join the same plan,
    so Spark runs their common shuffle once."""
    out = df.withColumn("_chunk", chunk)
    for name in [*keys, "_chunk"]:
        out = out.where(F.col(name).isNotNull())
    return out


def frame_chunk(index: str | Column, size: int = CHUNK_FRAMES) -> Column:
    column = F.col(index) if isinstance(index, str) else index
    return F.floor(column / size).cast("bigint")


def near_chunks(index: str, margin: int, size: int = CHUNK_FRAMES) -> Column:
    """Chunks that a frame is in or at most ``margin`` frames away from."""
    return F.sequence(frame_chunk(F.col(index) - margin, size), frame_chunk(F.col(index) + margin, size))


def frame_words(frames: DataFrame, size: int = CHUNK_FRAMES) -> DataFrame:
    """Frame numbers of each video as bits: (video_id, _chunk, _words), one row per chunk of ``size`` frames.

    ``size`` is a multiple of 64, the bits of a word. ``has_frame`` tests them.
    """
    at = F.pmod("frame_idx", F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    word = F.floor(at / 64)
    words = [F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0).cast("bigint")) for i in range(size // 64)]
    return (
        frames.select("video_id", "frame_idx", frame_chunk("frame_idx", size).alias("_chunk"))
        .groupBy("video_id", "_chunk")
        .agg(F.array(*words).alias("_words"))
    )


def has_frame(words: Column, chunk: Column, frame: Column, size: int = CHUNK_FRAMES) -> Column:
    """Whether ``frame`` is set in ``words``, which start at the first frame of ``chunk``; false beyond their end."""
    at = frame - chunk * size
    word = F.get(words, F.floor(at / 64).cast("int"))
    return F.coalesce(F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1, F.lit(False))


def frames_in(words: Column, chunk: Column, size: int = CHUNK_FRAMES) -> Column:
    """Frames set in ``words``, in order."""

    def bits(word: Column, at: Column) -> Column:
        set_here = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda bit: F.getbit(word, bit) == 1)
        return F.when(word != 0, F.transform(set_here, lambda bit: chunk * size + at * 64 + bit)).otherwise(F.array().cast("array<bigint>"))

    return F.flatten(F.transform(words, bits))


def row_numbers(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    chunk: Column,
    name: str = "rn",
    total: str | None = None,
) -> DataFrame:
    """1-based row number per key in ``order``; ``chunk`` must follow that order.

    Keys and ``chunk`` must not be null. ``total`` also adds the number of rows of the key.
    """
    part = [*keys, "_chunk"]
    cut = _cut(df, keys, chunk)
    local = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *part,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(per_key).alias("_total"),
        )
    )
    columns = [*df.columns, (F.col("_rn") + F.col("_before")).cast("bigint").alias(name)]
    if total:
        columns.append(F.col("_total").cast("bigint").alias(total))
    return local.join(offsets, part).select(*columns)


def _carried(summary: DataFrame, keys: list[str], breaks: Callable[[Column, Column], Column], *more: Column) -> DataFrame:
    """What each chunk of a key needs from the ones before it; ``more`` may look along the chunks as well."""
    along = Window.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.col("_mark_max"), F.when(F.col("_first_brk"), F.col("_first")))
    started = F.col("_starts_sum") + F.col("_first_brk").cast("bigint")
    return (
        summary.withColumn("_prev_last", F.lag("_last").over(along))
        .withColumn(
            "_first_brk",
            F.col("_prev_last").isNull() | breaks(F.col("_prev_last"), F.col("_first")),
        )
        .select(
            *keys,
            "_chunk",
            "_first",
            "_prev_last",
            "_first_brk",
            F.max(opened).over(before).alias("_carry"),
            F.coalesce(F.sum(started).over(before), F.lit(0)).alias("_runs_before"),
            *more,
        )
    )


def step_carry(rows: DataFrame, keys: list[str], index: str) -> DataFrame:
    """``_carried`` of runs of step 1 over rows with ``_chunk``, with ``_end``, the last index of the run that is open at
    the end of the chunk, as far as the next chunk reaches.
    """
    part = [*keys, "_chunk"]
    one = lambda prev, cur: cur - prev != 1
    here = Window.partitionBy(*part).orderBy(index)
    prev = F.lag(index).over(here)
    marked = rows.select(*part, index, prev.alias("_prev")).withColumn("_brk", F.col("_prev").isNotNull() & one(F.col("_prev"), F.col(index)))
    summary = marked.groupBy(*part).agg(
        F.min(index).alias("_first"),
        F.max(index).alias("_last"),
        F.max(F.when(F.col("_brk"), F.col(index))).alias("_mark_max"),
        F.sum(F.col("_brk").cast("bigint")).alias("_starts_sum"),
        F.min(F.when(F.col("_brk"), F.col("_prev"))).alias("_head_end"),
    )
    along = Window.partitionBy(*keys).orderBy("_chunk")
    ahead = F.when(~one(F.col("_last"), F.lead("_first").over(along)), F.lead(F.coalesce("_head_end", "_last")).over(along))
    return _carried(summary, keys, one, F.coalesce(ahead, "_last").alias("_end"))


def label_runs(
    df: DataFrame,
    keys: list[str],
    index: str,
    breaks: Callable[[Column, Column], Column],
    copies: str | None = None,
    constants: tuple[str, ...] = (),
    chunk: int = CHUNK_FRAMES,
    then: tuple[str, ...] = (),
) -> DataFrame:
    """Gaps and islands over rows ordered by index within each key.

    Keys and index must not be null. Rows are unique by (keys, index), or by (keys, index, ``then``): rows of one index then
    follow each other in the order of ``then`` with a step of 0.

    ``breaks(previous, current)`` says whether a new run starts; beside its arguments it may
    use the columns in ``constants``, which have one value per key. ``copies`` names a column with
    the number of equal rows the row stands for: the first copy continues the run, every other
    copy starts a new one, and the next index follows the last copy.

    Adds ``prev`` (previous index), ``brk`` (a run starts at the first copy), ``head`` (start of
    the run of the first copy), ``tail`` (start of the run of the last copy) and ``run_no``
    (0-based number of the run of the first copy within its key).
    """
    part = [*keys, "_chunk"]
    idx = F.col(index)
    extra = (F.col(copies) - 1) if copies else F.lit(0)
    cut = _cut(df, keys, frame_chunk(index, chunk))

    def marked(order: tuple[str, ...]) -> tuple[DataFrame, Window]:
        here = Window.partitionBy(*part).orderBy(*order)
        rows = (
            cut.withColumn("_prev", F.lag(index).over(here))
            .withColumn("_brk", F.col("_prev").isNotNull() & breaks(F.col("_prev"), idx))
            .withColumns(
                {
                    "_mark": F.when(F.col("_brk") | (extra > 0), idx),
                    "_starts": F.col("_brk").cast("bigint") + extra,
                }
            )
        )
        return rows, here

    local, here = marked((index, *then))
    upto, earlier = (
        here.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1)
    )
    # Rows of one index mark the same whichever comes first, so a chunk is summed up without ``then`` and what makes it.
    summary = marked((index,))[0].groupBy(*part).agg(
        F.min(index).alias("_first"),
        F.max(index).alias("_last"),
        F.max("_mark").alias("_mark_max"),
        F.sum("_starts").alias("_starts_sum"),
        *[F.min(c).alias(c) for c in constants],
    )
    carried = _carried(summary, keys, breaks)
    first = F.col("_prev").isNull()
    chunk_head = F.when(F.col("_first_brk"), F.col("_first")).otherwise(F.col("_carry"))
    brk = F.when(first, F.col("_first_brk")).otherwise(F.col("_brk"))
    run_no = F.col("_runs_before") + F.col("_first_brk").cast("bigint") + F.col("_runs_local") - 1
    rows = local.withColumns(
        {
            "_tail": F.max("_mark").over(upto),
            "_tail_before": F.max("_mark").over(earlier),
            "_runs_local": F.sum("_starts").over(upto) - extra,
        }
    )
    return rows.join(carried, part).select(
        *df.columns,
        F.when(first, F.col("_prev_last")).otherwise(F.col("_prev")).alias("prev"),
        brk.alias("brk"),
        F.when(brk, idx).otherwise(F.coalesce(F.col("_tail_before"), chunk_head)).alias("head"),
        F.coalesce(F.col("_tail"), chunk_head).alias("tail"),
        run_no.cast("bigint").alias("run_no"),
    )


def distinct_diffs(
    df: DataFrame, keys: list[str], index: str, chunk: int = CHUNK_FRAMES
) -> DataFrame:
    """Count of each difference between neighbouring distinct indices of a key.

    Differences inside a chunk are counted there; the ones between chunks come from the first
    and last index of each chunk.
    """
    part = [*keys, "_chunk"]
    unique = _cut(df.select(*keys, index), keys, frame_chunk(index, chunk)).distinct()
    here = Window.partitionBy(*part).orderBy(index)
    inside = (
        unique.withColumn("diff", F.col(index) - F.lag(index).over(here))
        .where(F.col("diff").isNotNull())
        .groupBy(*keys, "diff")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ends = unique.groupBy(*part).agg(F.min(index).alias("_first"), F.max(index).alias("_last"))
    return _all_diffs(inside, ends, keys)


def _all_diffs(inside: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """Differences inside chunks and the ones between them, from the first and last index of each chunk."""
    along = Window.partitionBy(*keys).orderBy("_chunk")
    between = ends.select(
        *keys, (F.col("_first") - F.lag("_last").over(along)).alias("diff"), F.lit(1).cast("bigint").alias("n")
    ).where(F.col("diff").isNotNull())
    return inside.unionByName(between).groupBy(*keys, "diff").agg(F.sum("n").alias("n"))


def word_diffs(words: DataFrame) -> DataFrame:
    """``distinct_diffs`` of the frames of each video that are set in rows of ``frame_words``.

    A chunk's frames are listed from its bits, so the rows that set them are not dealt.
    """
    listed = words.select("video_id", "_chunk", frames_in(F.col("_words"), F.col("_chunk")).alias("_at")).where(F.size("_at") > 0)
    steps = F.transform(F.slice("_at", F.lit(2), F.size("_at")), lambda frame, i: frame - F.col("_at")[i])
    inside = listed.select("video_id", F.explode(steps).alias("diff")).groupBy("video_id", "diff").agg(F.count(F.lit(1)).alias("n"))
    ends = listed.select("video_id", "_chunk", F.col("_at")[0].alias("_first"), F.element_at("_at", -1).alias("_last"))
    return _all_diffs(inside, ends, ["video_id"])


def first_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rn"
) -> DataFrame:
    """First ``k`` rows of each key.

    Spark keeps at most ``k`` rows per key in every map task before the shuffle, so a hot key
    sends ``k`` rows per task and no more.
    """
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(name) <= k)
