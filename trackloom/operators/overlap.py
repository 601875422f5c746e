"""Same-frame and cross-dataset box overlaps.

Only pairs that share area are built; pairs without overlap are counted by arithmetic. Boxes of
a frame are dealt to blocks of bounded size by their position and meet block by block in equi-joins; an
ordinary frame is one block, and no task holds a crowded frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import UNKNOWN
from trackloom.functions.geometry import intersects, iou, is_valid_box
from trackloom.operators.quantiles import five_numbers

FRAME = ["video_id", "frame_idx"]
BOX = ["x1", "y1", "x2", "y2"]
BLOCK = 4096
THRESHOLDS = (0.1, 0.3, 0.5)


def valid_boxes(boxes: DataFrame) -> DataFrame:
    return boxes.where(is_valid_box()).withColumn(
        "action", F.when(F.col("action") == "", F.lit(UNKNOWN)).otherwise(F.col("action"))
    )


def _side(df: DataFrame, prefix: str, keys: list[str], columns: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in columns])


def _blocked_join(left: DataFrame, right: DataFrame, keys: list[str], block: int, same_side: bool) -> DataFrame:
    """Join on ``keys`` in which no task meets all rows of a large group.

    A row's block follows from its position. Rows of equal blocks meet by one equi-join, which is all there is in an
    ordinary group, so nothing is counted first. Only groups with more than one block have rows that go on to later blocks
    of the other side. With ``same_side`` only later rows of the right side are wanted.
    """
    a = left.withColumn("_block", F.floor(F.col("a_pos") / block))
    b = right.withColumn("_block", F.floor(F.col("b_pos") / block))
    cell = [*keys, "_block"]

    def sent_on(rows: DataFrame, others: DataFrame) -> DataFrame:
        """Rows once for every later block that the other side has."""
        later = others.where("_block > 0").select(*keys, F.col("_block").alias("_later")).distinct()
        return rows.join(later, keys).where("_block < _later").withColumn("_block", F.col("_later")).drop("_later")

    parts = [a.join(b, cell), sent_on(a, b).join(b, cell)]
    if not same_side:
        parts.append(a.join(sent_on(b, a), cell))
    return reduce(DataFrame.unionByName, parts).drop("_block")


def _overlaps(a: DataFrame, b: DataFrame, keys: list[str], same_side: bool, block: int) -> DataFrame:
    """Pairs with a positive common area; sides carry prefixes ``a_`` and ``b_``."""
    meet = intersects("a_", "b_")
    if same_side:
        meet = meet & (F.col("a_pos") < F.col("b_pos"))
    return _blocked_join(a, b, keys, block, same_side).where(meet).withColumn("iou", iou("a_", "b_"))


def frame_pairs(
    boxes: DataFrame,
    columns: tuple[str, ...] = ("action",),
    block: int = BLOCK,
) -> DataFrame:
    """Pairs of valid boxes of one frame with IoU > 0: keys, a_*, b_*, iou (a_pos < b_pos)."""
    valid = valid_boxes(boxes)
    names = ["pos", *columns, *BOX]
    sides = [_side(valid, p, FRAME, names) for p in ("a_", "b_")]
    return _overlaps(*sides, FRAME, True, block)


def cross_pairs(
    a: DataFrame,
    b: DataFrame,
    keys: list[str],
    columns: tuple[str, ...] = ("action",),
    block: int = BLOCK,
) -> DataFrame:
    """Pairs of boxes of two datasets that share ``keys``, with IoU > 0."""
    names = ["pos", *columns, *BOX]
    return _overlaps(_side(a, "a_", keys, names), _side(b, "b_", keys, names), keys, False, block)


def frame_counts(boxes: DataFrame) -> DataFrame:
    """Valid boxes and unordered pairs per frame."""
    n = F.count(F.lit(1)).cast("bigint")
    return (
        valid_boxes(boxes)
        .groupBy(*FRAME)
        .agg(n.alias("n_boxes"))
        .withColumn("n_pairs", F.expr("n_boxes * (n_boxes - 1) div 2"))
    )


def totals(boxes: DataFrame) -> DataFrame:
    """Frames with boxes, frames with an overlap, boxes and pairs."""
    counts = frame_counts(boxes).agg(
        F.count(F.lit(1)).alias("frames_with_boxes"),
        F.coalesce(F.sum("n_boxes"), F.lit(0)).alias("total_boxes"),
        F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("total_pairs"),
    )
    overlapping = (
        frame_pairs(boxes, ())
        .select(*FRAME)
        .distinct()
        .agg(F.count(F.lit(1)).alias("frames_with_overlaps"))
    )
    return counts.select("*", overlapping.scalar().alias("frames_with_overlaps"))


def _reached(pairs: DataFrame, thresholds: tuple[float, ...], keys: list) -> DataFrame:
    """Per key and threshold: number of pairs with IoU at or above it (rows with none left out).

    One conditional count per threshold keeps one row per pair through the shuffle.
    """
    counts = [F.count_if(F.col("iou") >= t).alias(f"_n{i}") for i, t in enumerate(thresholds)]
    wide = pairs.where(F.col("iou") >= min(thresholds)).groupBy(*keys).agg(*counts)
    return _by_threshold(wide, thresholds)


def _by_threshold(wide: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    names = [f"_n{i}" for i in range(len(thresholds))]
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(c).alias("n"))
            for t, c in zip(thresholds, names)
        ]
    )
    return (
        wide.withColumn("_t", F.explode(rows))
        .select("*", "_t.threshold", "_t.n")
        .drop("_t", *names)
        .where(F.col("n") > 0)
    )


def counts_by_threshold(
    boxes: DataFrame, thresholds=THRESHOLDS
) -> DataFrame:
    """All pairs with IoU at or above each threshold."""
    counts = [F.count_if(F.col("iou") >= t).alias(f"_n{i}") for i, t in enumerate(thresholds)]
    wide = frame_pairs(boxes, ()).agg(*counts)
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_n{i}").alias("pairs"))
            for i, t in enumerate(thresholds)
        ]
    )
    return wide.select(F.inline(rows))


def same_action(boxes: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Per threshold and action: pairs of equal action, and frames that hold one."""
    equal = frame_pairs(boxes).where(F.col("a_action") == F.col("b_action"))
    per_frame = _reached(equal, thresholds, [F.col("a_action").alias("action"), *FRAME])
    return per_frame.groupBy("threshold", "action").agg(
        F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("frames")
    )


def action_pairs(boxes: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Per threshold and unordered pair of actions: pairs."""
    keys = [
        F.least("a_action", "b_action").alias("action_a"),
        F.greatest("a_action", "b_action").alias("action_b"),
    ]
    return _reached(frame_pairs(boxes), thresholds, keys).withColumnRenamed(
        "n", "pairs"
    )


def bin_counts(pairs: DataFrame, total: DataFrame) -> DataFrame:
    """Ten equal bins of IoU; pairs without overlap are the rest of ``total`` (one row, n)."""
    spark = pairs.sparkSession
    counted = pairs.groupBy(F.least(F.lit(9), F.floor(F.col("iou") * 10)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    met = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    rest = total.select(F.lit(0).alias("bin"), (F.col("n") - met).alias("n"))
    spine = spark.range(10).select(F.col("id").cast("int").alias("bin"), F.lit(0).cast("bigint").alias("n"))
    return (
        counted.unionByName(rest)
        .unionByName(spine)
        .groupBy("bin")
        .agg(F.sum("n").alias("pairs"))
    )


def iou_histogram(boxes: DataFrame) -> DataFrame:
    total = frame_counts(boxes).agg(F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("n"))
    return bin_counts(frame_pairs(boxes, ()), total)


def iou_summary(boxes: DataFrame) -> DataFrame:
    """Five-number summary of IoU over all pairs, the ones without overlap included as zeros."""
    met = frame_pairs(boxes, ()).groupBy("iou").agg(F.count(F.lit(1)).alias("w"))
    total = frame_counts(boxes).agg(F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("n"))
    positive = met.agg(F.coalesce(F.sum("w"), F.lit(0))).scalar()
    zeros = total.select(F.lit(0.0).alias("iou"), (F.col("n") - positive).alias("w"))
    return five_numbers(
        met.unionByName(zeros), [], {"iou": F.col("iou")}, F.col("w"), rescan=False
    )


def degree_histogram(
    boxes: DataFrame, thresholds=THRESHOLDS
) -> DataFrame:
    """Boxes by number of partners at each threshold.

    ``degree`` is the true number; ``degree_ref`` is one less, as the copied rule subtracts the
    box itself although it was never counted. Isolated boxes have no ``degree_ref``.
    """
    ends = frame_pairs(boxes, ()).select(
        *FRAME, "iou", F.explode(F.array("a_pos", "b_pos")).alias("pos")
    )
    per_box = _reached(ends, thresholds, [*FRAME, "pos"]).withColumnRenamed("n", "degree")
    counted = per_box.groupBy("threshold", "degree").agg(F.count(F.lit(1)).alias("boxes"))
    spine = boxes.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    in_pairs = frame_counts(boxes).where(F.col("n_boxes") >= 2).agg(
        F.coalesce(F.sum("n_boxes"), F.lit(0)).alias("n")
    )
    isolated = (
        spine.join(counted.groupBy("threshold").agg(F.sum("boxes").alias("met")), "threshold", "left")
        .select(
            "threshold",
            F.lit(0).cast("bigint").alias("degree"),
            (in_pairs.scalar() - F.coalesce("met", F.lit(0))).alias("boxes"),
        )
    )
    return (
        counted.unionByName(isolated)
        .where(F.col("boxes") > 0)
        .withColumn("degree_ref", F.when(F.col("degree") > 0, F.col("degree") - 1))
    )


def frame_maxima(boxes: DataFrame) -> DataFrame:
    """Largest IoU per frame that has valid boxes; 0 where nothing overlaps."""
    best = frame_pairs(boxes, ()).groupBy(*FRAME).agg(F.max("iou").alias("max_iou"))
    return (
        frame_counts(boxes)
        .join(best, FRAME, "left")
        .select(*FRAME, F.coalesce("max_iou", F.lit(0.0)).alias("max_iou"))
    )


def sudden_changes(boxes: DataFrame) -> DataFrame:
    """Neighbouring frames f, f+1: every lost id against every gained id, with their IoU.

    ``gid`` is the numeric track id, -1 when absent. Every pair of a lost and a gained box is a
    wanted row, so the join is only cut into blocks, never thinned.
    """
    gid = F.coalesce(F.col("track_id").try_cast("bigint"), F.lit(-1).cast("bigint"))
    valid = boxes.where(is_valid_box()).withColumn("gid", gid)
    ids = valid.select(*FRAME, "gid").distinct()
    names = ["pos", "action", "gid", *BOX]
    step = F.col("frame_idx")
    # An id is lost when the next frame does not hold it, gained when the previous one did not.
    lost = ids.join(ids.withColumn("frame_idx", step - 1), [*FRAME, "gid"], "left_anti")
    gained = ids.join(ids.withColumn("frame_idx", step + 1), [*FRAME, "gid"], "left_anti")
    a = _side(valid.join(lost, [*FRAME, "gid"], "left_semi"), "a_", FRAME, names)
    b = _side(
        valid.join(gained, [*FRAME, "gid"], "left_semi").withColumn("frame_idx", step - 1),
        "b_",
        FRAME,
        names,
    )
    return _blocked_join(a, b, FRAME, BLOCK, False).withColumn("iou", iou("a_", "b_"))
