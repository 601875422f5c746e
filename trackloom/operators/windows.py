"""Fixed windows over tubes, frame context, resampling and crop geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.fields import pad_number, stem
from trackloom.functions.geometry import clamp
from trackloom.functions.rows import once
from trackloom.operators.ordering import (
    CHUNK_FRAMES,
    first_per_group,
    frame_chunk,
    frame_words,
    has_frame,
    near_chunks,
    row_numbers,
    step_carry,
)
from trackloom.operators.tubes import KEY, SEGMENT, in_tube, reference_boxes, segment_name
from trackloom.session import cut_lineage

WINDOW = [*SEGMENT, "win_no"]


def window_starts(
    rows: DataFrame,
    segments: DataFrame,
    frames: DataFrame,
    win: int,
    step: int | None = None,
    min_len: int = 1,
    pad: bool = False,
    lazy: bool = False,
) -> DataFrame:
    """Windows of ``win`` frames over every segment: (SEGMENT, start_f, end_f, stride, win_no, start).

    Long segments get a window every ``step`` frames (half a window by default) and one forced
    to end at their last frame. Short ones get one window around their mean frame, moved into
    the frames at hand unless ``pad`` is set. Starts follow from the segment's row alone, so ``rows`` aren't read. The first
    and last frames of the videos are written once before, unless ``lazy`` is set.
    """
    step = step if step and step > 0 else max(1, win // 2)
    segments = segments.where(F.col("length") >= min_len)
    low, last = F.col("start_f"), F.col("end_f") - win + 1
    at = F.bround(F.col("frame_sum") / F.col("length")).cast("bigint") - win // 2
    if not pad:
        extent = frames.groupBy("video_id").agg(F.min("frame_idx").alias("_low"), F.max("frame_idx").alias("_high"))
        extent = extent if lazy else cut_lineage(extent)
        segments = segments.join(extent, "video_id", "left")
        at = F.greatest("_low", F.least(at, F.col("_high") - win + 1))
    forced = F.when((last - low) % step != 0, F.array(last)).otherwise(F.array().cast("array<bigint>"))
    sliding = F.sequence(low, F.greatest(low, last), F.lit(step).cast("bigint"))
    starts = F.when(last >= low, F.concat(sliding, forced)).otherwise(F.array(at))
    return segments.select(*SEGMENT, "start_f", "end_f", "stride", F.posexplode(starts).alias("_no", "start")).select(
        *SEGMENT, "start_f", "end_f", "stride", F.col("_no").cast("bigint").alias("win_no"), "start"
    )


def _around(frame: Column) -> dict[str, Column]:
    """Place of a frame in its segment: inside or not, and the annotated frames (or the edge) on both sides."""
    low, high, step = (F.col(c) for c in ("start_f", "end_f", "stride"))
    inside = (frame >= low) & (frame <= high)
    edge = F.when(frame < low, low).otherwise(high)
    before = low + F.floor((frame - low) / step) * step
    return {
        "inside": inside,
        "edge": edge,
        "annotated": inside & ((frame - low) % step == 0),
        "before": F.when(inside, before).otherwise(edge).cast("bigint"),
        "after": F.when(inside, F.least(before + step, high)).otherwise(edge).cast("bigint"),
    }


def windows(starts: DataFrame, frames: DataFrame, win: int) -> DataFrame:
    """``starts`` with ``_present``, whether each of a window's frames has an image, and ``_near``, the nearest image of
    the ones inside the segment that have none (by offset).

    A window stays one row: images come as bits of the chunk it starts in and the ones it reaches. Frames of a segment
    have images, so only a stride over 1 leaves frames inside without; those are looked up one by one.
    """
    reach = (win - 2 + CHUNK_FRAMES) // CHUNK_FRAMES + 1
    empty = F.array_repeat(F.lit(0).cast("bigint"), CHUNK_FRAMES // 64)
    ahead = F.explode(F.sequence(F.lit(0), F.lit(reach - 1))).alias("_k")
    words = (
        frame_words(frames)
        .select("video_id", "_chunk", "_words", ahead)
        .groupBy("video_id", (F.col("_chunk") - F.col("_k")).alias("_chunk"))
        .agg(F.map_from_entries(F.collect_list(F.struct("_k", "_words"))).alias("_by"))
        .select(
            "video_id",
            "_chunk",
            F.flatten(
                F.transform(F.sequence(F.lit(0), F.lit(reach - 1)), lambda k: F.coalesce(F.col("_by")[k], empty))
            ).alias("_words"),
        )
    )

    def seen(some: DataFrame) -> DataFrame:
        has = F.array(*[has_frame(F.col("_words"), F.col("_chunk"), F.col("start") + o) for o in range(win)])
        return (
            some.withColumn("_chunk", frame_chunk("start"))
            .join(words, ["video_id", "_chunk"], "left")
            .select(*WINDOW, "start_f", "end_f", "stride", "start", has.alias("_present"))
        )

    dense = seen(starts.where("stride = 1")).withColumn("_near", F.lit(None).cast("map<int,bigint>"))
    sparse = seen(starts.where("stride <> 1"))
    frame = F.col("start") + F.col("offset")
    gap = ["video_id", "frame", "before", "after"]
    place = _around(frame)
    holes = (
        sparse.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(win - 1))))
        .where(place["inside"] & ~F.get("_present", F.col("offset")))
        .select(*WINDOW, "offset", frame.alias("frame"), *[place[c].alias(c) for c in ("before", "after")])
    )
    manifest = frames.select("video_id", F.col("frame_idx").alias("near")).distinct()
    distance = F.abs(F.col("near") - F.col("frame"))
    nearest = (
        holes.select(*gap)
        .distinct()
        .withColumn("near", F.explode(F.sequence("before", "after")))
        .join(manifest, ["video_id", "near"])
        .groupBy(*gap)
        .agg(F.min_by("near", F.struct(distance, F.col("near"))).alias("near"))
    )
    filled = (
        holes.join(nearest, gap)
        .groupBy(*WINDOW)
        .agg(F.map_from_entries(F.collect_list(F.struct("offset", "near"))).alias("_near"))
    )
    return dense.unionByName(sparse.join(filled, WINDOW, "left"))


def _slots(win: int, pad: bool) -> list[dict[str, Column]]:
    """Frames of a row of ``windows`` with the frames that their image and their box are taken from.

    They are spelled out one by one, so that Spark compiles them; functions over arrays are interpreted.
    """

    def slot(o: int) -> dict[str, Column]:
        f = F.col("start") + o
        place, has = _around(f), F.get("_present", F.lit(o))
        nearer = F.when(f - place["before"] <= place["after"] - f, place["before"]).otherwise(place["after"])
        outside = F.when(place["inside"], F.col("_near")[o]).otherwise(place["edge"])
        padded = F.lit(pad) & ~place["inside"] & ~has
        return {
            "offset": F.lit(o),
            "frame": f,
            "img_src": F.when(has, f).otherwise(outside),
            "box_src": F.when(place["inside"], nearer).otherwise(place["edge"]),
            "anno_missing": ~place["annotated"],
            "img_missing": ~has & ~padded,
            "edge_padded": padded,
        }

    return [slot(o) for o in range(win)]


def _listed(slots: list[dict[str, Column]], names: tuple[str, ...]) -> Column:
    return F.array(*[F.struct(*[s[c].alias(c) for c in names]) for s in slots])


def window_frames(starts: DataFrame, frames: DataFrame, win: int, pad: bool = False) -> DataFrame:
    """One row per window and frame with the frames its image and its box are taken from.

    Frames of a segment lie ``stride`` apart without holes, so the nearest annotated frame
    follows from arithmetic. The nearest image is looked up only where the frame has none, among
    the frames between two annotated ones.
    """
    slots = _slots(win, pad)
    return windows(starts, frames, win).select(*WINDOW, F.inline(_listed(slots, tuple(slots[0]))))


def window_name() -> Column:
    return F.concat(segment_name(), F.lit("__win"), pad_number(F.col("win_no"), 3))


MASKS = {"anno_mask": "anno_missing", "img_mask": "img_missing", "edge_pad": "edge_padded"}


def window_masks(plan: DataFrame) -> DataFrame:
    """1-based places per window that were filled in; windows without any are left out.

    A window has a fixed number of frames, so the collected lists are small. Rows of ``windows`` need no gathering;
    see ``masks_of``.
    """

    def places(flag: str) -> Column:
        at = F.when(F.col(flag), F.col("offset") + 1)
        return F.array_join(F.sort_array(F.collect_list(at)), ",")

    any_mark = F.col("anno_missing") | F.col("img_missing") | F.col("edge_padded")
    return (
        plan.where(any_mark)
        .groupBy(*WINDOW)
        .agg(*[places(flag).alias(name) for name, flag in MASKS.items()])
        .select(window_name().alias("window"), *MASKS)
    )


def masks_of(listed: DataFrame, win: int, pad: bool = False) -> DataFrame:
    """``window_masks`` of rows of ``windows``, without a row per frame."""
    slots = _slots(win, pad)

    def places(flag: str) -> Column:
        return F.concat_ws(",", *[F.when(s[flag], F.lit(str(o + 1))) for o, s in enumerate(slots)])

    texts = listed.select(window_name().alias("window"), *[places(flag).alias(name) for name, flag in MASKS.items()])
    return texts.where(" OR ".join(f"{name} <> ''" for name in MASKS))


#: Frames whose boxes travel together to the windows that use them.
PIECE = 64


def _with_boxes(listed: DataFrame, rows: DataFrame, slots: list[dict[str, Column]]) -> DataFrame:
    """``windows`` with ``_boxes``, the piece ``_c`` of the segment that holds boxes of the window.

    A window meets the one or two pieces it takes boxes from as one row each.
    """
    box = F.struct("frame_idx", "x1", "y1", "x2", "y2")
    pieces = (
        rows.withColumn("_c", frame_chunk("frame_idx", PIECE))
        .groupBy(*SEGMENT, "_c")
        .agg(F.sort_array(F.collect_list(box)).alias("_boxes"))
    )
    used = F.array_distinct(F.array(*[frame_chunk(s["box_src"], PIECE) for s in slots]))
    return listed.withColumn("_c", F.explode(used)).join(pieces, [*SEGMENT, "_c"])


def _box_at(frame: Column) -> Column:
    """Box of an annotated frame of a piece; they lie ``stride`` apart."""
    first = F.col("_boxes")[0]["frame_idx"]
    return F.get("_boxes", ((frame - first) / F.col("stride")).cast("int"))


def filled_boxes(listed: DataFrame, rows: DataFrame, win: int, pad: bool = False) -> DataFrame:
    """Frames of the rows of ``windows`` with the box of their source frame."""
    slots, sides = _slots(win, pad), ("x1", "y1", "x2", "y2")
    names = ("offset", "frame", "img_src", "box_src")
    box = _box_at(F.col("box_src"))
    return (
        _with_boxes(listed, rows, slots)
        .select(*WINDOW, "stride", "_c", "_boxes", F.inline(_listed(slots, names)))
        .where(frame_chunk("box_src", PIECE) == F.col("_c"))
        .select(*WINDOW, *names, *[box[c].alias(c) for c in sides])
    )


def window_shapes(listed: DataFrame, rows: DataFrame, boxes: DataFrame, win: int, pad: bool = False) -> DataFrame:
    """Shapes written for each frame of the rows of ``windows``.

    They are the shapes of the track in the image's own frame, whatever their action; where that
    frame has none, one shape is made from the source box. A window carries its distinct source boxes to the pieces of
    its track that hold the frames its images are from.
    """
    slots, sides = _slots(win, pad), ("x1", "y1", "x2", "y2")
    shape = F.struct(F.col("pos").alias("shape_pos"), F.col("action").alias("shape_action"), *sides)
    track = ["video_id", "track_id", "_i"]
    own = (
        boxes.select("video_id", "track_id", "frame_idx", frame_chunk("frame_idx", PIECE).alias("_i"), "pos", "action", *sides)
        .repartition(*track)
        .groupBy(*track, "frame_idx")
        .agg(F.collect_list(shape).alias("shapes"))
        .groupBy(*track)
        .agg(F.collect_list(F.struct("frame_idx", "shapes")).alias("_own"))
        .select(*track, F.col("_own.frame_idx").alias("_at"), F.col("_own.shapes").alias("_shapes"))
    )
    mine = [F.when(frame_chunk(s["box_src"], PIECE) == F.col("_c"), _box_at(s["box_src"])) for s in slots]
    met = F.array(*[F.when(frame_chunk(s["box_src"], PIECE) == F.col("_c"), frame_chunk(s["img_src"], PIECE)) for s in slots])
    boxed = (
        _with_boxes(listed, rows, slots)
        .select(
            *WINDOW,
            *("start_f", "end_f", "stride", "start", "_present", "_near", "_c"),
            F.array_distinct(F.array_compact(F.array(*mine))).alias("_boxes"),
            F.explode(F.array_distinct(F.array_compact(met))).alias("_i"),
        )
        .join(own, track, "left")
    )
    # Places are found by array_position, which gives 0 where a frame has no shape of the track.
    at = F.coalesce(F.array_position("_at", F.col("img_src")).cast("int"), F.lit(0))
    box = F.get("_boxes", F.array_position(F.col("_boxes.frame_idx"), F.col("box_src")).cast("int") - 1)
    made = F.struct(F.lit(0).cast("bigint").alias("shape_pos"), F.col("action").alias("shape_action"), *[box[c].alias(c) for c in sides])
    return (
        boxed.select(*WINDOW, "_c", "_i", "_boxes", "_at", "_shapes", F.inline(_listed(slots, ("offset", "img_src", "box_src"))))
        .where((frame_chunk("box_src", PIECE) == F.col("_c")) & (frame_chunk("img_src", PIECE) == F.col("_i")))
        .select(
            window_name().alias("window"),
            "offset",
            F.inline(F.when(at > 0, F.get("_shapes", at - 1)).otherwise(F.array(made))),
        )
        .withColumnRenamed("shape_action", "action")
    )


def _tube(track: str = "track_id", action: str = "action") -> Column:
    return F.struct(F.col(track).alias("track_id"), F.col(action).alias("action"))


def dense_window_shapes(
    dealt: DataFrame, bare: DataFrame, frames: DataFrame, win: int, step: int, pad: bool = False
) -> DataFrame:
    """``window_shapes`` of videos whose boxes lie a frame apart, from one dealing of the boxes.

    ``dealt`` are numbered boxes with ``_chunk``, dealt by video and chunk with a margin of ``win`` frames; ``bare`` are the
    same boxes once each, without their position. Every frame of a segment has a box, so the box in a window's first
    frame has the window (the segment's first box where the segment is shorter), and the shapes around a box in its chunk
    are all that its window needs. Chunks give each other only where runs that cross them start and end.
    """
    size, margin = CHUNK_FRAMES, 64 * -(-win // 64)
    images = frame_words(frames)
    usable = (
        in_tube(bare.select(*KEY, "frame_idx"))
        .withColumn("_chunk", frame_chunk("frame_idx"))
        .join(images, ["video_id", "_chunk"])
        .where(has_frame(F.col("_words"), F.col("_chunk"), F.col("frame_idx")))
        .select(*KEY, "_chunk", "frame_idx")
    )
    carried = step_carry(usable, KEY, "frame_idx")
    values = F.struct("_first_brk", "_carry", "_runs_before", "_end")
    # One row per video and chunk, so that the boxes stay where they were dealt.
    packed = carried.groupBy("video_id", "_chunk").agg(
        F.map_from_entries(F.collect_list(F.struct(_tube(), values))).alias("_tubes")
    )
    wide = frames.select("video_id", "frame_idx", F.explode(near_chunks("frame_idx", win)).alias("_chunk"))
    at = F.col("frame_idx") - F.col("_chunk") * size + margin
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    words = [
        F.coalesce(F.bit_or(F.when(F.floor(at / 64) == i, bit)), F.lit(0).cast("bigint")) for i in range((size + 2 * margin) // 64)
    ]
    seen = wide.groupBy("video_id", "_chunk").agg(F.array(*words).alias("_seen"))
    extent = frames.groupBy("video_id").agg(F.min("frame_idx").alias("_low"), F.max("frame_idx").alias("_high"))

    def present(frame: Column) -> Column:
        place = frame - F.col("_chunk") * size + margin
        word = F.get("_seen", F.floor(place / 64).cast("int"))
        return F.coalesce(F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1, F.lit(False))

    frame, sides = F.col("frame_idx"), ("x1", "y1", "x2", "y2")
    shape = F.struct("pos", "frame_idx", "action", *sides)
    around = Window.partitionBy("video_id", "_chunk", "track_id").orderBy("frame_idx").rangeBetween(-(win - 1), win - 1)
    own = (frame_chunk("frame_idx") == F.col("_chunk")) & (F.col("track_id") != "") & (F.col("action") != "")
    part = Window.partitionBy("video_id", "_chunk", "track_id", "action", "_use")
    here, back = part.orderBy("frame_idx", "pos"), part.orderBy(F.desc("frame_idx"), F.desc("pos"))
    upto, later = here.rowsBetween(Window.unboundedPreceding, 0), back.rowsBetween(Window.unboundedPreceding, -1)
    # What is long (images, shapes around a box) is attached behind the last sort.
    rows = (
        dealt.select("video_id", "_chunk", "track_id", "action", "frame_idx", "pos", *sides)
        .join(seen, ["video_id", "_chunk"])
        .withColumn("_use", own & present(frame))
        .drop("_seen")
        .withColumn("_prev", F.lag("frame_idx").over(here))
        .withColumn("_brk", F.col("_prev").isNotNull() & (frame - F.col("_prev") != 1))
        .withColumns(
            {
                "_first": F.min("frame_idx").over(part),
                "_tail": F.max(F.when(F.col("_brk"), frame)).over(upto),
                "_runs": F.sum(F.col("_brk").cast("bigint")).over(upto),
                "_next": F.min(F.when(F.col("_brk"), F.col("_prev"))).over(later),
            }
        )
        .withColumn("_near", F.collect_list(shape).over(around))
        .where("_use")
        .join(packed, ["video_id", "_chunk"])
        .withColumn("_tube", F.element_at("_tubes", _tube()))
        .join(F.broadcast(extent), "video_id")
    )
    head = F.when(F.col("_tube._first_brk"), F.col("_first")).otherwise(F.col("_tube._carry"))
    rows = rows.select(
        *KEY,
        (F.col("_tube._runs_before") + F.col("_tube._first_brk").cast("bigint") + F.col("_runs") - 1).alias("run_no"),
        F.coalesce("_tail", head).alias("start_f"),
        F.coalesce("_next", F.col("_tube._end")).alias("end_f"),
        *("_chunk", "_near", "_low", "_high", "frame_idx", *sides),
    )
    low, high = F.col("start_f"), F.col("end_f")
    last, ahead = high - win + 1, frame - low
    long = last >= low
    centre = F.bround((low + high) / 2).cast("bigint") - win // 2
    if not pad:
        centre = F.greatest("_low", F.least(centre, F.col("_high") - win + 1))
    owns = F.when(long, (frame <= last) & ((ahead % step == 0) | (frame == last))).otherwise(frame == low)
    number = F.when(long, F.floor(ahead / step) + (ahead % step != 0).cast("bigint")).otherwise(F.lit(0)).cast("bigint")
    started = (
        rows.where(owns)
        .select("*", number.alias("win_no"), F.when(long, frame).otherwise(centre).alias("start"))
        .join(seen, ["video_id", "_chunk"])
    )
    # Only a short segment's window reaches beyond it; its row is the first box, and the last one is the first of its kind.
    closing = F.array_min(F.filter("_near", lambda s: (s["frame_idx"] == high) & (s["action"] == F.col("action"))))
    named = once(started, _window=window_name(), _closing=F.when(~long & (low < high), closing))

    def slot(o: int) -> Column:
        f = F.col("start") + o
        inside = (f >= low) & (f <= high)
        edge = F.when(f < low, low).otherwise(high)
        source = F.when(inside | present(f), f).otherwise(edge)
        return F.struct(F.lit(o).alias("offset"), source.alias("_source"), ((f > high) & (low < high)).alias("_after"))

    # Sources are worked out in front of the search, which would work them out anew for every shape.
    slots = named.select("_window", "_near", "_closing", "action", *sides, F.inline(F.array(*[slot(o) for o in range(win)])))
    found = once(slots, _found=F.filter("_near", lambda s: s["frame_idx"] == F.col("_source")))
    ends = [F.when(F.col("_after"), F.col("_closing")[c]).otherwise(F.col(c)).alias(c) for c in sides]
    made = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("frame_idx"), F.col("action"), *ends)
    return (
        found.select("_window", "offset", F.inline(F.when(F.size("_found") > 0, F.col("_found")).otherwise(F.array(made))))
        .select(F.col("_window").alias("window"), "offset", F.col("pos").alias("shape_pos"), "action", *sides)
    )


def window_index(starts: DataFrame, membership: DataFrame) -> DataFrame:
    """Split list of the windows: one row per split that lists the sample."""
    return starts.join(membership, "video_id").select(
        "split", F.concat(F.lit("videos/"), window_name()).alias("path"), F.col("action").alias("label")
    )


def tube_shapes(rows: DataFrame, segments: DataFrame, boxes: DataFrame, min_len: int = 1) -> DataFrame:
    """Shapes of each tube as a sample of its own: all shapes of the track in the tube's frames."""
    kept = segments.where(F.col("length") >= min_len).select(*SEGMENT)
    shapes = boxes.select(
        "video_id",
        "frame_idx",
        "track_id",
        F.col("pos").alias("shape_pos"),
        F.col("action").alias("shape_action"),
    )
    return (
        rows.select(*SEGMENT, "frame_idx")
        .join(kept, SEGMENT, "left_semi")
        .join(shapes, ["video_id", "frame_idx", "track_id"])
        .select(segment_name().alias("sample"), "frame_idx", "action", "shape_pos", "shape_action")
    )


def tube_list(segments: DataFrame, labels: DataFrame, min_len: int = 1) -> DataFrame:
    """Tube list (tube, label, frames); the label is the id of the action where one is known."""
    names = labels.select(
        F.col("label_name").alias("action"), F.col("label_id").cast("string").alias("_id")
    )
    return (
        segments.where(F.col("length") >= min_len)
        .join(names, "action", "left")
        .select(
            F.concat(segment_name(), F.lit(".mp4")).alias("tube"),
            F.coalesce("_id", "action").alias("label"),
            F.col("length").alias("frames"),
        )
    )


def crop_plan(
    rows: DataFrame, strategy: str = "letterbox", out_w: int = 224, out_h: int = 224
) -> DataFrame:
    """Crop window of every tube box, sized by the tube's largest box and centred on its own.

    The window is cut at the image; ``letterbox`` keeps its shape inside the output and adds
    offsets, ``square`` fills the output. A window outside the image has zero size.
    """
    refs = reference_boxes(rows)
    w = F.greatest(F.lit(1.0), F.col("ref_x2") - F.col("ref_x1"))
    h = F.greatest(F.lit(1.0), F.col("ref_y2") - F.col("ref_y1"))
    if strategy == "square":
        side = F.greatest(
            F.lit(1.0), F.greatest(F.col("ref_x2") - F.col("ref_x1"), F.col("ref_y2") - F.col("ref_y1"))
        )
        w = h = side
    joined = rows.join(refs, SEGMENT).withColumns(
        {
            "_w": w,
            "_h": h,
            "_cx": (F.col("x1") + F.col("x2")) / 2.0,
            "_cy": (F.col("y1") + F.col("y2")) / 2.0,
        }
    )

    def side_of(centre: str, size: str, sign: int, limit: str) -> Column:
        at = F.col(centre) + F.lit(sign) * F.col(size) / 2.0
        return clamp(F.bround(at).cast("bigint"), F.lit(0), F.col(limit).cast("bigint"))

    cut = joined.withColumns(
        {
            "crop_x1": side_of("_cx", "_w", -1, "img_w"),
            "crop_y1": side_of("_cy", "_h", -1, "img_h"),
            "crop_x2": side_of("_cx", "_w", 1, "img_w"),
            "crop_y2": side_of("_cy", "_h", 1, "img_h"),
        }
    ).withColumns(
        {
            "_cw": F.col("crop_x2") - F.col("crop_x1"),
            "_ch": F.col("crop_y2") - F.col("crop_y1"),
        }
    )
    empty = (F.col("_cw") <= 0) | (F.col("_ch") <= 0)
    if strategy == "square":
        new_w, new_h = F.lit(out_w), F.lit(out_h)
    else:
        scale = F.least(out_w / F.col("_cw"), out_h / F.col("_ch"))
        new_w, new_h = (
            F.greatest(F.lit(1), F.bround(F.col(c) * scale).cast("int")) for c in ("_cw", "_ch")
        )
    zero = F.lit(0)
    return cut.select(
        *SEGMENT,
        "frame_idx",
        "pos",
        "crop_x1",
        "crop_y1",
        "crop_x2",
        "crop_y2",
        F.when(empty, zero).otherwise(new_w).cast("int").alias("new_w"),
        F.when(empty, zero).otherwise(new_h).cast("int").alias("new_h"),
        F.when(empty, zero).otherwise(F.floor((out_w - new_w) / 2)).cast("int").alias("x_off"),
        F.when(empty, zero).otherwise(F.floor((out_h - new_h) / 2)).cast("int").alias("y_off"),
    )


def name_ranks(frames: DataFrame, name: str = "image_name", total: str | None = None) -> DataFrame:
    """1-based rank of each file in its video by name (column ``rank``).

    Chunks are name prefixes. Their length is the common prefix of the video's names plus the
    digits that bring a chunk to about a thousand files.
    """
    low, high = F.col("_low"), F.col("_high")
    common = F.size(
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1))),
            lambda i: F.left(low, i) == F.left(high, i),
        )
    )
    digits = F.greatest(F.lit(0), F.ceil(F.log10(F.col("_n") / 1000.0)))
    widths = (
        frames.groupBy("video_id")
        .agg(F.min(name).alias("_low"), F.max(name).alias("_high"), F.count(F.lit(1)).alias("_n"))
        .select("video_id", (common + digits).cast("int").alias("_width"))
    )
    return row_numbers(
        frames.join(widths, "video_id"),
        ["video_id"],
        [F.col(name)],
        F.left(F.col(name), F.col("_width")),
        name="rank",
        total=total,
    ).drop("_width")


def sample_frames(boxes: DataFrame, per_class: int = 3, seed: int = 0) -> DataFrame:
    """Up to ``per_class`` frames of each action, in the order of a seeded hash."""
    from trackloom.operators.profile import named_action

    keyed = boxes.select(
        F.trim(named_action()).alias("action"), "video_id", "frame_idx"
    ).distinct()
    text = F.concat_ws(
        "/", F.col("video_id"), F.col("frame_idx").cast("string"), F.lit(str(seed))
    )
    order = [F.md5(text.cast("binary")), F.col("video_id"), F.col("frame_idx")]
    return first_per_group(keyed, ["action"], order, per_class).drop("rn")


def context_frames(
    centres: DataFrame, frames: DataFrame, around: int = 6, missing: str = "first"
) -> DataFrame:
    """Frames up to ``around`` places before and after each centre, by file name.

    Without an image of the centre the first image of the folder stands in (``first``) or the
    centre's own number is kept without an image (``centre``).
    """
    ranked = name_ranks(frames).select("video_id", "frame_idx", "image_name", "rank")
    place = ranked.select("video_id", "frame_idx", F.col("rank").alias("_centre"))
    found = centres.join(place, ["video_id", "frame_idx"], "left")
    near = (
        found.where(F.col("_centre").isNotNull())
        .withColumn("offset", F.explode(F.sequence(F.lit(-around), F.lit(around))))
        .withColumn("rank", F.col("_centre") + F.col("offset"))
        .join(
            ranked.select("video_id", "rank", "image_name"), ["video_id", "rank"]
        )
        .select("action", "video_id", "frame_idx", "offset", "image_name")
    )
    lost = found.where(F.col("_centre").isNull()).select("action", "video_id", "frame_idx")
    lost = lost.withColumn("offset", F.lit(0))
    if missing == "first":
        first = frames.groupBy("video_id").agg(F.min("image_name").alias("image_name"))
        return near.unionByName(lost.join(first, "video_id"))
    return near.unionByName(lost.withColumn("image_name", F.lit(None).cast("string")))


def upsample(frames: DataFrame, src_fps: int, dst_fps: int) -> DataFrame:
    """Each frame repeated ``dst_fps / src_fps`` times and numbered from 1 in file-name order.

    The number width is that of the first name of the video when it is all digits, else 6.
    """
    if src_fps <= 0 or dst_fps <= 0 or dst_fps % src_fps:
        raise ValueError("dst_fps must be a positive multiple of src_fps")
    times = dst_fps // src_fps
    first = stem(F.min("image_name"))
    widths = frames.groupBy("video_id").agg(
        F.when(first.rlike("^[0-9]+$"), F.length(first)).otherwise(6).alias("_width")
    )
    number = (F.col("rank") - 1) * times + F.col("copy")
    text = number.cast("string")
    padded = F.when(F.length(text) >= F.col("_width"), text).otherwise(
        F.lpad(text, F.col("_width"), F.lit("0"))
    )
    extension = F.regexp_extract("image_name", "(?<=.)(\\.[^.]*)$", 1)
    return (
        name_ranks(frames)
        .join(widths, "video_id")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
        .select(
            "video_id",
            F.col("image_name").alias("src_name"),
            number.cast("bigint").alias("new_index"),
            F.concat(padded, extension).alias("new_name"),
        )
    )


def upsample_annotations(rows: DataFrame, src_fps: int, dst_fps: int) -> DataFrame:
    """Tube list with its frame counts multiplied; counts that are not whole numbers stay."""
    times = dst_fps // src_fps
    count = F.col("frames").try_cast("bigint")
    return rows.withColumn(
        "frames", F.coalesce((count * times).cast("string"), F.col("frames").cast("string"))
    )



def upsample_lists(lines: DataFrame, src_fps: int, dst_fps: int) -> DataFrame:
    """Lines (path, row_no, value) of tube lists with the count in their third field multiplied.

    A file whose first line has three fields or more and names ``frames`` among them is a list with counts; the lines of
    other files stay as they are. In a list blank lines go, and lines whose third field
    is no whole number stay.
    """
    if src_fps <= 0 or dst_fps <= 0 or dst_fps % src_fps:
        raise ValueError("dst_fps must be a positive multiple of src_fps")
    parts = F.split("value", ",", -1)
    names = F.transform(parts, lambda p: F.lower(F.trim(p)))
    head = lines.groupBy("path").agg(
        F.min("row_no").alias("_first"), F.min_by((F.size(parts) >= 3) & F.array_contains(names, "frames"), "row_no").alias("_counts")
    )
    count = F.trim(F.get(parts, 2))
    whole = F.when(count.rlike("^[+-]?[0-9]+$"), count.try_cast("bigint"))
    changed = F.concat_ws(
        ",", F.slice(parts, 1, 2), F.array((whole * (dst_fps // src_fps)).cast("string")), F.slice(parts, 4, 2**31 - 1)
    )
    body = F.col("_counts") & (F.col("row_no") > F.col("_first"))
    return (
        lines.join(head, "path")
        .where(~body | (F.trim("value") != ""))
        .select("path", "row_no", F.when(body & whole.isNotNull(), changed).otherwise(F.col("value")).alias("value"))
    )
