"""User-level jobs: each turns the tables of a dataset into named result tables.

``ingest`` reads the per-frame JSON files once into Parquet; the other jobs read those tables
(or the JSON files, for a single job).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.fields import base_name, matches_prefixes
from trackloom.operators import align as A
from trackloom.operators import clean as C
from trackloom.operators import coco as Q
from trackloom.operators import datasets as D
from trackloom.operators import interaction_records as N
from trackloom.operators import interactions as I
from trackloom.operators import overlap as O
from trackloom.operators import profile as P
from trackloom.operators import relabel as R
from trackloom.operators import tubes as T
from trackloom.operators import tubetable as B
from trackloom.operators import windows as W
from trackloom.operators.quantiles import five_numbers
from trackloom.plans.stages import Stage, run_stages
from trackloom.session import cut_lineage
from trackloom.sources import files as S
from trackloom.sources import images as G
from trackloom.sources import labelme as L
from trackloom.sources import tables as X
from trackloom.sources import tube_pickle as K
from trackloom.sources import versioned as V

Tables = dict[str, DataFrame]


class Dataset:
    """Boxes and frames of one dataset, from ingested tables or from its files."""

    def __init__(self, spark: SparkSession, root: str, from_json: bool = False):
        self.spark, self.root, self.from_json = spark, root.rstrip("/"), from_json

    @cached_property
    def files(self) -> DataFrame:
        return S.list_files(self.spark, self.root)

    @cached_property
    def records(self) -> DataFrame:
        """Record texts (path, value) as they are in the files, for jobs that write records back."""
        if not self.from_json:
            return self.spark.read.parquet(f"{self.root}/records")
        return L.read_texts(self.spark, self.root)

    @cached_property
    def record_frames(self) -> DataFrame:
        """One row per record with the image size that it states."""
        return L.frames_of(L.parse_text(self.records))

    @cached_property
    def boxes(self) -> DataFrame:
        """Every shape; those whose points give no box have null coordinates."""
        if not self.from_json:
            return self.spark.read.parquet(f"{self.root}/boxes")
        records = L.read_records(self.spark, self.root)
        return L.fill_index(L.to_boxes(records), L.frames_of(records))

    @cached_property
    def usable(self) -> DataFrame:
        """Shapes that have a box."""
        return self.boxes.where(F.col("x1").isNotNull())

    @cached_property
    def frames(self) -> DataFrame:
        """Images with the size that their record gives (null without a record).

        An image whose name holds no number has its place in file order, as the boxes of such a frame do.
        """
        if not self.from_json:
            return self.spark.read.parquet(f"{self.root}/frames")
        images = S.frame_manifest(self.files)
        ranks = W.name_ranks(images.select("video_id", "image_name").distinct())
        places = ranks.select("video_id", "image_name", (F.col("rank") - 1).cast("bigint").alias("_place"))
        images = images.join(places, ["video_id", "image_name"]).select(
            "video_id", "image_name", F.coalesce("frame_idx", "_place").alias("frame_idx")
        )
        sizes = self.record_frames.select("video_id", "frame_idx", "img_w", "img_h")
        return images.join(sizes, ["video_id", "frame_idx"], "left")

    @cached_property
    def rows(self) -> DataFrame:
        """Annotated tube rows; several results read them, so they are written once."""
        return cut_lineage(T.annotated_rows(self.usable, self.frames))


def ingest(data: Dataset) -> Tables:
    return {"boxes": data.boxes, "frames": data.frames, "records": data.records}


def analyze_dirs(data: Dataset) -> Tables:
    return {
        "videos": P.analyze(data.usable, data.frames),
        "action_distribution": P.action_distribution(data.usable),
        "bbox_normalized": five_numbers(data.usable, [], P.box_sizes(), large_cells=True),
        "anomalies": P.anomalies(data.boxes),
        "resolutions": P.resolutions(data.record_frames),
        "image_size": P.image_sizes(data.record_frames),
        "tubes_per_action": P.tubes_per_action(T.tube_segments(data.usable, "fixed")),
        "ignored": P.shapes_without_track(data.usable),
    }


def analyze_folder(data: Dataset, video: str) -> Tables:
    one = Dataset(data.spark, data.root, data.from_json)
    one.boxes = data.boxes.where(F.col("video_id") == video)
    one.frames = data.frames.where(F.col("video_id") == video)
    one.record_frames = data.record_frames.where(F.col("video_id") == video)
    return analyze_dirs(one)


def analyze_overlaps(data: Dataset, thresholds: tuple[float, ...] = O.THRESHOLDS) -> Tables:
    boxes = data.usable
    return {
        "basic": O.totals(boxes),
        "counts_ge": O.counts_by_threshold(boxes, thresholds),
        "same_action": O.same_action(boxes, thresholds),
        "action_pairs": O.action_pairs(boxes, thresholds),
        "iou": O.iou_summary(boxes),
        "histogram": O.iou_histogram(boxes),
        "degree": O.degree_histogram(boxes, thresholds),
        "frame_max": five_numbers(
            O.frame_maxima(boxes), [], {"max_iou": F.col("max_iou")}, rescan=False
        ),
    }


def tube_lengths(data: Dataset) -> Tables:
    segments = T.tube_segments(data.usable, "auto", dedup=True)
    return {"lengths": T.length_summary(segments), "outliers": T.length_outliers(segments)}


def tube_lengths_of_pickles(data: Dataset) -> Tables:
    return {"lengths": B.file_lengths(K.read_tubes(data.spark, data.root))}


def length_bins(data: Dataset) -> Tables:
    return {"length_bins": T.length_bins(T.tube_segments(data.usable, "auto"))}


def time_bins(data: Dataset, spf: float = 0.04) -> Tables:
    return {"time_bins": T.time_bins(T.tube_segments(data.usable, "auto"), spf)}


def one_shot_stats(data: Dataset, spf: float = 0.04, skip: tuple[str, ...] = ()) -> Tables:
    """Folder statistics, length bins and time bins of one reading of the input (``skip``: dirs, lengths, times).

    Boxes, frames and records' sizes are written once, and the tubes that both kinds of bins count are made once.
    """
    unknown = set(skip) - {"dirs", "lengths", "times"}
    if unknown:
        raise ValueError(f"nothing is named {sorted(unknown)}")
    once = Dataset(data.spark, data.root, data.from_json)
    once.boxes = cut_lineage(data.boxes) if data.from_json else data.boxes
    out: Tables = {}
    if "dirs" not in skip:
        once.frames, once.record_frames = cut_lineage(data.frames), cut_lineage(data.record_frames)
        out = analyze_dirs(once)
    if not {"lengths", "times"} <= set(skip):
        segments = cut_lineage(T.tube_segments(once.usable, "auto"))
        if "lengths" not in skip:
            out["length_bins"] = T.length_bins(segments)
        if "times" not in skip:
            out["time_bins"] = T.time_bins(segments, spf)
    return out


def clean_json(
    data: Dataset, sigma: float = 3.0, max_len: int = 64, exceptions: tuple[str, ...] = C.LONG_ALLOWED
) -> Tables:
    """Records as they were without the shapes that the rules remove; emptied records are written too."""
    kept = C.clean_boxes(data.boxes, sigma, max_len, exceptions)
    return {
        "records": L.keep_shapes(data.records, kept).select("path", "value"),
        "limits": P.size_thresholds(data.usable, sigma),
        "summary": C.clean_summary(data.boxes, sigma, max_len, exceptions),
    }


def remove_tubes(data: Dataset, listed: str) -> Tables:
    """The list is matched against the group id of the shapes; records left empty are not written."""
    gone = X.read_removals(data.spark, listed)
    kept = C.remove_tubes(data.boxes, gone, track="group_id")
    boxes = data.boxes.withColumn("track_id", F.col("group_id"))
    return {
        "records": L.keep_shapes(data.records, kept, emptied=False).select("path", "value"),
        "summary": C.remove_tubes_summary(boxes, gone),
    }


def filter_std(data: Dataset, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), target: str = "out") -> Tables:
    keep = matches_prefixes(F.col("video_id"), list(include), list(exclude))
    samples = data.frames.select("video_id").distinct()
    return {
        "manifest": D.sample_manifest(samples.where(keep), target),
        "summary": samples.agg(
            F.count(F.lit(1)).alias("input_samples"),
            F.count_if(keep).alias("kept"),
            F.count_if(~keep).alias("removed"),
        ),
    }


def convert_std(data: Dataset, mapping: str) -> Tables:
    names = X.read_mapping(data.spark, mapping)
    return {
        "records": _relabelled(data.records, names).select("path", "value"),
        "summary": R.relabel_summary(data.boxes, names),
    }


def view_clean(
    data: Dataset, stages: str, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), labels: str | None = None
) -> Tables:
    """Cleaning by view: samples by prefix, first frame of each track, and with ``labels`` the removal of what is labelled 0.

    ``labels`` is what a classifier wrote for the listed first frames (``file_id,label`` lines). ``stages`` is a folder that
    keeps every stage, so that the second call, with the labels, or a call after a lost one builds the missing stages only.
    """
    spark = data.spark

    def kept(table: DataFrame, name: str = "video_id") -> DataFrame:
        return table.where(matches_prefixes(F.col(name), list(include), list(exclude)))

    def filtered(_done) -> Tables:
        texts = data.records.withColumn("video_id", L.sample_of(F.col("path")))
        return {"boxes": kept(data.boxes), "records": kept(texts).drop("video_id")}

    def first_frames(done) -> Tables:
        return {"list": T.first_track_frames(done["filtered"]["boxes"])}

    def pairs(_done) -> Tables:
        lines = X.classifier_lines(spark.read.text(labels))
        return {"list": X.zero_pairs(lines).distinct()}

    def removed(done) -> Tables:
        boxes, gone = done["filtered"]["boxes"], done["pairs"]["list"]
        left = C.remove_tubes(boxes, gone, track="group_id")
        return {
            "records": L.keep_shapes(done["filtered"]["records"], left, emptied=False).select("path", "value"),
            "summary": C.remove_tubes_summary(boxes.withColumn("track_id", F.col("group_id")), gone),
        }

    prefixes = {"include": list(include), "exclude": list(exclude), "json": data.from_json}
    chain = [
        Stage("filtered", filtered, files=(data.root,), options=prefixes),
        Stage("first-frames", first_frames, after=("filtered",)),
    ]
    if labels:
        chain += [Stage("pairs", pairs, files=(labels,)), Stage("removed", removed, after=("filtered", "pairs"))]
    done = run_stages(spark, stages, chain)
    out = {"first_frames": done["first-frames"]["list"]}
    return {**out, "pairs": done["pairs"]["list"], **done["removed"]} if labels else out


def _relabelled(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Mapped record texts without those that the mapping empties."""
    return R.relabel_records(texts, names).where("n_before = 0 OR n_after > 0")


def convert_records(data: Dataset, mapping: str) -> Tables:
    """Mapped record texts of both formats with every other key kept; per-frame records left without shapes are dropped."""
    names = X.read_mapping(data.spark, mapping)
    changed = Q.relabel_any(data.records, names)
    return {
        "records": changed.where("NOT emptied").select("path", "value"),
        "summary": changed.agg(
            F.count(F.lit(1)).alias("files"),
            F.count_if(F.col("emptied") & (F.col("n_before") > 0)).alias("files_deleted"),
            F.sum("n_before").alias("annotations_before"),
            F.sum("n_after").alias("annotations_after"),
        ),
    }


def subset_std(data: Dataset, per_class: int = 3, target: str = "out") -> Tables:
    picked = D.cover_subset(data.usable, per_class)
    chosen = data.spark.createDataFrame(
        list(enumerate(picked, 1)), "pick int, video_id string"
    )
    boxes = data.usable.join(chosen.select("video_id"), "video_id", "left_semi")
    return {
        "picks": chosen,
        "manifest": D.sample_manifest(chosen, target),
        "tubes": T.tube_segments(boxes, "fixed").groupBy("video_id", "action").agg(F.sum("n").alias("tubes")),
    }


def _labels(spark: SparkSession, path: str | None) -> DataFrame:
    if path:
        return X.read_labels(spark, path)
    return spark.createDataFrame([], "label_id bigint, label_name string")


def split_std(
    data: Dataset, ratios=(8.0, 1.0, 1.0), seed: int = 42, infer_labels: bool = False, labels: str | None = None
) -> Tables:
    boxes = data.usable if infer_labels else None
    listing = D.split_samples(data.boxes, data.frames, _labels(data.spark, labels), boxes, ratios, seed)
    return {"splits": listing}


def split_gt_csv(data: Dataset, ratios=(8.0, 1.0, 1.0), seed: int = 42, column: str | None = None, prefix: str = "videos/") -> Tables:
    listing = data.spark.read.option("header", True).csv(data.root)
    return {"splits": D.split_listing(listing, ratios, seed, column, prefix)}


def split_by_tube(data: Dataset, min_len: int = 1) -> Tables:
    segments = T.annotated_segments(data.rows)
    return {"shapes": W.tube_shapes(data.rows, segments, data.boxes, min_len)}


def split_by_tube_fpswin(
    data: Dataset,
    fps: int,
    stride: int | None = None,
    min_len: int = 1,
    pad: bool = False,
    splits: dict[str, str] | None = None,
) -> Tables:
    """Windows with shapes, masks and, with split lists, the window index per split."""
    segments = T.annotated_segments(data.rows)
    starts = W.window_starts(data.rows, segments, data.frames, fps, stride, min_len, pad)
    out: Tables = {}
    if splits:
        listed = [X.read_split(data.spark, path, name) for name, path in splits.items()]
        members = listed[0]
        for other in listed[1:]:
            members = members.unionByName(other)
        members = X.split_samples(members)
        starts = starts.join(members.select("video_id").distinct(), "video_id", "left_semi")
        out["index"] = W.window_index(starts, members)
    listed = W.windows(starts, data.frames, fps)
    return {
        **out,
        "masks": W.masks_of(listed, fps, pad),
        "shapes": W.window_shapes(listed, data.rows, data.boxes, fps, pad),
    }


def export_tubes(data: Dataset, strategy: str = "letterbox", size: int = 224, min_len: int = 1, labels: str | None = None) -> Tables:
    """Tube list and the crop window of every frame (pixels are left to a video tool)."""
    segments = T.annotated_segments(data.rows)
    return {
        "gt": W.tube_list(segments, _labels(data.spark, labels), min_len),
        "crops": W.crop_plan(data.rows, strategy, size, size),
    }


def export_samples(data: Dataset, per_class: int = 3, context: int = 6) -> Tables:
    picked = W.sample_frames(data.usable, per_class)
    return {"frames": W.context_frames(picked, data.frames, context)}


def visualize_samples(data: Dataset, per_class: int = 3, context: int = 25) -> Tables:
    """Context frames and the boxes to draw on them."""
    frames = W.context_frames(W.sample_frames(data.usable, per_class), data.frames, context, "centre")
    numbers = data.frames.select("video_id", "image_name", F.col("frame_idx").alias("shown"))
    boxes = data.usable.withColumnRenamed("frame_idx", "shown").withColumnRenamed("action", "box_action")
    return {
        "frames": frames,
        "boxes": frames.join(numbers, ["video_id", "image_name"]).join(boxes, ["video_id", "shown"]),
    }


def merge_flatten(data: Dataset) -> Tables:
    """Flat names for ``<dataset>/<action>/<sample>/<file>`` trees."""
    parts = [F.element_at(F.split("path", "/"), i) for i in (-4, -3, -2, -1)]
    names = ("dataset", "action", "sample", "file")
    return {"files": D.flatten_names(data.files.select(*[p.alias(n) for p, n in zip(parts, names)]))}


def layout_to_std(data: Dataset, target: str = "out") -> Tables:
    """Copy plan from any tree of image folders to ``videos/<sample>``; folders of one name get ``_<n>``.

    Fails if a numbered name is also the name of another folder.
    """
    named = cut_lineage(D.folder_layout(S.sample_dirs(data.files)))
    twice = named.groupBy("sample").count().where("count > 1").select("sample").first()
    if twice:
        raise ValueError(f"two folders would be the sample {twice['sample']!r}")
    return {"samples": named, "manifest": D.layout_manifest(data.files, named, target)}


def merge_into_single(data: Dataset, name: str = "merged_all") -> Tables:
    files = data.files.select(
        base_name(S.parent(F.col("path"))).alias("video_id"), base_name(F.col("path")).alias("file")
    )
    return {"manifest": D.merge_single(files, name)}


def rename_by_action(data: Dataset, name_format: str = "{action}__{orig}") -> Tables:
    return {"names": D.rename_by_action(data.usable, name_format)}


def upsample_fps(data: Dataset, src_fps: int, dst_fps: int, annotations: str | None = None) -> Tables:
    """Repeated frames and, with a folder of tube lists, the lines of its CSV files with their counts multiplied."""
    out = {"frames": W.upsample(data.frames, src_fps, dst_fps)}
    if annotations:
        out["annotations"] = W.upsample_lists(X.read_list_lines(data.spark, annotations), src_fps, dst_fps)
    return out


def std_to_tubes(data: Dataset) -> Tables:
    tubes = B.from_segments(data.rows)
    return {
        "tubes": B.nest(tubes),
        "labels": B.class_ids(data.rows),
        "videos": B.video_table(data.frames),
    }


def tubes_to_std(data: Dataset, frames: str) -> Tables:
    """Shapes of a tube dataset that ``std-to-tubes`` wrote, for the images below ``frames``."""
    stored = V.read_tables(data.spark, data.root)
    labels = stored["labels"].select(F.col("class_id").alias("label_id"), F.col("action").alias("label_name"))
    images = Dataset(data.spark, frames, from_json=True).frames
    return {"shapes": B.to_shapes(B.explode_tubes(stored["tubes"]), labels, images)}


def pickle_to_std(data: Dataset, frames: DataFrame) -> Tables:
    return {"shapes": B.to_shapes(K.read_tubes(data.spark, data.root), None, frames)}


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """Split lists of a tube dataset; a split without a file has no rows."""
    out = spark.createDataFrame([], "row_no bigint, path string, label string, split string")
    for split in D.SPLITS:
        try:
            rows = X.read_split(spark, f"{root}/annotations/{split}.csv", split)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out = out.unionByName(rows)
    return out


def tube_stats(data: Dataset) -> Tables:
    listing = _listing(data.spark, data.root)
    labels = X.read_labels(data.spark, f"{data.root}/annotations/labels_dict.json")
    path = F.regexp_extract("path", "(videos/[^/]+)", 1).alias("path")
    existing = S.list_files(data.spark, f"{data.root}/videos").select(path).distinct()
    return {
        "counts": D.listing_stats(listing, labels),
        "totals": D.listing_totals(listing),
        "missing": D.missing_paths(listing, existing),
        "audit": D.split_audit(listing),
        "distribution": D.label_distribution(listing, labels),
    }


def merge_tube_datasets(spark: SparkSession, roots: list[str]) -> Tables:
    listings = dims = None
    for number, root in enumerate(roots, 1):
        rows = _listing(spark, root).withColumn("input_no", F.lit(number))
        names = X.read_labels(spark, f"{root}/annotations/labels_dict.json").withColumn(
            "input_no", F.lit(number)
        )
        listings = rows if listings is None else listings.unionByName(rows)
        dims = names if dims is None else dims.unionByName(names)
    return {
        "splits": D.merge_listings(listings, dims),
        "labels": D.label_names(dims),
        "summary": D.merge_summary(listings, dims),
    }


def interaction_profile(spark: SparkSession, paths: dict[str, str], actions: str) -> Tables:
    from trackloom.schema import INTERACTION_COLUMNS

    rows, names = X.read_interactions(spark, paths), X.read_actions(spark, actions)
    named = I.with_action_names(rows, names)
    return {
        "basic": I.profile(rows),
        "actions": I.action_counts(named),
        "sports": I.sport_counts(named),
        "top_per_sport": I.top_per_sport(named),
        "per_video_top": P.top_k(rows, F.col("video_id"), "video_id", 30),
        "bbox_primary": I.box_summary(rows),
        "bbox_secondary": I.box_summary(rows, "_2"),
        "anomalies_primary": I.box_anomalies(rows),
        "anomalies_secondary": I.box_anomalies(rows, "_2"),
        "duplicates": I.duplicate_rows(rows, INTERACTION_COLUMNS),
        "unknown": I.unknown_ids(rows, names),
        "tube_lengths": I.tube_lengths(rows, names),
    }


def interactions_to_shapes(spark: SparkSession, paths: dict[str, str], actions: str, sizes: DataFrame, secondary: bool = False) -> Tables:
    """Pixel shapes of interaction rows; ``sizes`` has (video_id, width, height)."""
    rows = I.with_action_names(X.read_interactions(spark, paths), X.read_actions(spark, actions))
    stacked = I.stack_boxes(rows, secondary).join(sizes, "video_id")
    return {"shapes": I.pixel_shapes(stacked, F.col("width"), F.col("height"))}


def interactions_to_records(
    data: Dataset,
    splits: dict[str, str],
    actions: str,
    frames: str,
    secondary: bool = False,
    only: list[str] | None = None,
    videos: int | None = None,
    per_video: int | None = None,
    per_action: int | None = None,
) -> Tables:
    """Records of the chosen frames and the images to copy; ``splits`` and ``actions`` are below the input folder,
    ``frames`` is the folder of the videos' images. Only headers of the images that are named are read."""
    paths = {n: f"{data.root}/{p}" for n, p in splits.items()}
    rows = N.frame_keys(X.read_interactions(data.spark, paths, numbered=True))
    named = I.with_action_names(rows, X.read_actions(data.spark, f"{data.root}/{actions}"))
    order = ["part_no", "row_no"]
    chosen = N.chosen_frames(named, order, only, videos, per_video, per_action)
    listed = S.list_files(data.spark, frames).where(S.is_image(F.col("path"), "jpg")).select(
        base_name(S.parent(F.col("path"))).alias("video_id"), base_name(F.col("path")).alias("image_name"), "path"
    )
    found = S.find_frames(chosen, listed).where(F.col("image_name").isNotNull())
    sized = G.header_sizes(listed.join(found.select("video_id", "image_name"), ["video_id", "image_name"], "left_semi"))
    placed = cut_lineage(N.place_frames(chosen, sized))
    records = cut_lineage(N.record_texts(named, placed, order, secondary))
    copied = listed.join(chosen.select("video_id"), "video_id", "left_semi")
    return {"records": records, "images": copied, "summary": N.placement_summary(placed, records)}


def compare_aligned(ms: Dataset, sh: Dataset, alignment: str, threshold: float = 0.5) -> Tables:
    """Cross-dataset chain from an alignment table: runs, matches, action pairs, merge, endings."""
    rows = A.usable_alignment(X.read_alignment(ms.spark, alignment))
    run = A.common_run(rows, ms.frames, sh.frames)
    a, b = A.run_boxes(run, ms.usable, "ms"), A.run_boxes(run, sh.usable, "sh")
    best = A.best_matches(a, b)
    endings = A.endings(rows, ms.frames, sh.frames)
    return {
        "run": run,
        "histogram": A.histogram(a, b),
        "per_frame": A.match_summary(best, A.STEP),
        "per_video": A.match_summary(best, ["video_id"]),
        "action_pairs": A.action_pairs(a, b, threshold),
        "pairs": A.pairs_over(a, b, threshold),
        "first_high": A.first_high(a, b),
        "endings": endings,
        "ending_counts": A.ending_counts(endings),
        "ending_summary": A.ending_summary(endings),
        "merged": A.merge_aligned(run, ms.usable, sh.usable, sh.frames, ms.frames),
    }


def align_images(spark: SparkSession, ms_root: str, sh_root: str, threshold: float = 3.0, max_k: int | None = 20) -> Tables:
    """Alignment table of two image trees."""
    ms, sh = (G.read_images(spark, r).where(F.col("frame_idx").isNotNull()) for r in (ms_root, sh_root))
    found = A.align_search(_first_files(ms), _first_files(sh), threshold, max_k, G.pixel_difference())
    return {"alignment": found}


def _first_files(images: DataFrame) -> DataFrame:
    """First file by name of each frame number, with its size as ``dims``."""
    named = images.withColumn("dims", F.concat_ws("x", F.col("width").cast("string"), F.col("height").cast("string")))
    record = F.struct("file", "pixels", "dims")
    return named.groupBy("video_id", "frame_idx").agg(F.min_by(record, "file").alias("_r")).select(
        "video_id", "frame_idx", "_r.*"
    )


def first_frame_difference(spark: SparkSession, a_root: str, b_root: str) -> Tables:
    """Gray difference of the first frame of each video that both trees have."""
    a, b = (_first_files(G.read_images(spark, r).where(F.col("frame_idx").isNotNull())) for r in (a_root, b_root))
    first = A.common_index(a, b).withColumnRenamed("first_common", "frame_idx")
    keys = ["video_id", "frame_idx"]
    left = a.join(first, keys).select(*keys, F.col("pixels").alias("a"))
    right = b.join(first, keys).select(*keys, F.col("pixels").alias("b"))
    return {
        "difference": left.join(right, keys).select(*keys, G.pixel_difference(gray=True)("a", "b").alias("mean"))
    }


def merge_with(data: Dataset, others: list[str]) -> Tables:
    """The tube dataset merged with others; the first one's paths win."""
    return merge_tube_datasets(data.spark, [data.root, *others])


def profile_interactions(data: Dataset, splits: dict[str, str], actions: str) -> Tables:
    """``splits`` and ``actions`` are files below the input folder."""
    return interaction_profile(data.spark, {n: f"{data.root}/{p}" for n, p in splits.items()}, f"{data.root}/{actions}")


def compare_with(data: Dataset, other: str, alignment: str, threshold: float = 0.5) -> Tables:
    return compare_aligned(data, Dataset(data.spark, other, data.from_json), alignment, threshold)


def align_with(data: Dataset, other: str, threshold: float = 3.0, max_k: int | None = 20) -> Tables:
    return align_images(data.spark, data.root, other, threshold, max_k)


def first_frames_with(data: Dataset, other: str) -> Tables:
    return first_frame_difference(data.spark, data.root, other)


def pickle_with_frames(data: Dataset, frames: str) -> Tables:
    """``frames`` is the folder of the images that the pickle's videos have."""
    return pickle_to_std(data, Dataset(data.spark, frames, from_json=True).frames)


# Jobs whose tables are one dataset and become visible together.
WHOLE = {"std-to-tubes"}

# Jobs of a dataset and plain options.
COMMANDS: dict[str, Callable[..., Tables]] = {
    "ingest": ingest,
    "analyze-folder": analyze_folder,
    "analyze-dirs": analyze_dirs,
    "analyze-overlaps": analyze_overlaps,
    "analyze-tube-lengths": tube_lengths,
    "analyze-pickle-lengths": tube_lengths_of_pickles,
    "one-shot-stats": one_shot_stats,
    "length-bins": length_bins,
    "time-bins": time_bins,
    "clean-json": clean_json,
    "remove-tubes": remove_tubes,
    "filter-std": filter_std,
    "view-clean": view_clean,
    "convert-std": convert_std,
    "convert-records": convert_records,
    "subset-std": subset_std,
    "split-std": split_std,
    "split-gt-csv": split_gt_csv,
    "split-by-tube": split_by_tube,
    "split-by-tube-fpswin": split_by_tube_fpswin,
    "export-tubes": export_tubes,
    "export-samples": export_samples,
    "visualize-samples": visualize_samples,
    "merge-flatten": merge_flatten,
    "layout-to-std": layout_to_std,
    "merge-into-single": merge_into_single,
    "rename-by-action": rename_by_action,
    "upsample-fps": upsample_fps,
    "std-to-tubes": std_to_tubes,
    "tubes-to-std": tubes_to_std,
    "tube-stats": tube_stats,
    "merge-tube-datasets": merge_with,
    "interaction-profile": profile_interactions,
    "interactions-to-records": interactions_to_records,
    "compare-aligned": compare_with,
    "align-images": align_with,
    "first-frame-difference": first_frames_with,
    "pickle-to-std": pickle_with_frames,
}
