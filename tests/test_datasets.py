"""Subsets, splits, merges, cleaning and relabelling on small data."""

import json
import random

import pytest
from pyspark.sql import functions as F

from trackloom.operators import clean as C
from trackloom.operators import datasets as D
from trackloom.operators import relabel as R


def loop_cover(actions, per_class):
    need = {a: per_class for s in actions.values() for a in s}
    picked, rest = [], set(actions)
    while rest:
        gain = {s: sum(need[a] > 0 for a in actions[s]) for s in rest}
        best = min(rest, key=lambda s: (-gain[s], -len(actions[s]), s))
        if not gain[best]:
            break
        picked.append(best)
        rest.remove(best)
        for a in actions[best]:
            need[a] -= 1
    return picked


@pytest.mark.parametrize("seed,per_class", [(1, 1), (2, 3), (3, 2)])
def test_cover(spark, seed, per_class):
    rng = random.Random(seed)
    actions = {f"s{i:02d}": set(rng.sample("abcdef", rng.randint(1, 3))) for i in range(30)}
    rows = [(s, a) for s, acts in actions.items() for a in acts for _ in range(2)] + [("s99", "")]
    boxes = spark.createDataFrame(rows, "video_id string, action string")
    assert D.cover_subset(boxes, per_class) == loop_cover(actions, per_class)


def test_ratio_split_sizes(spark):
    df = spark.range(1003).select(F.col("id").cast("string").alias("path"))
    got = D.ratio_split(df, F.col("path"))
    sizes = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"train": round(0.8 * 1003), "val": round(0.1 * 1003), "test": 1003 - 802 - 100}
    again = D.ratio_split(df.repartition(7), F.col("path"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    with pytest.raises(ValueError):
        D.ratio_split(df, F.col("path"), (-1.0, 1.0, 1.0))


def test_split_listing_finds_the_column(spark):
    df = spark.createDataFrame([(1, "videos/a", 5), (2, "b", 6)], "n int, File string, frames int")
    got = D.split_listing(df)
    assert sorted(got.columns) == ["File", "n", "split"]
    assert {r["File"] for r in got.collect()} == {"videos/a", "videos/b"}


def test_merge(spark):
    listings = spark.createDataFrame(
        [
            (1, 1, "train", "videos/a", "0"),
            (1, 2, "train", "/x/videos/a", "1"),
            (1, 3, "train", "b", "zed"),
            (2, 1, "train", "videos/a", "1"),
            (2, 2, "val", "videos/a", "7"),
            (2, 3, "val", "q", "9"),
            (2, 4, "val", "r", "nope"),
        ],
        "input_no int, row_no int, split string, path string, label string",
    )
    dims = spark.createDataFrame(
        [(1, 0, "kick"), (1, 1, "ball"), (2, 7, "zed"), (2, 1, "kick")],
        "input_no int, label_id int, label_name string",
    )
    got = {tuple(r) for r in D.merge_listings(listings, dims).select("split", "path", "label").collect()}
    assert got == {("train", "videos/a", "1"), ("train", "videos/b", "2"), ("val", "videos/a", "2")}


def test_unique_names(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(["a.jpg", "b.jpg", "a.jpg", "a.jpg"])], "i int, name string")
    got = {r["i"]: r["name"] for r in D.unique_names(df, "name", [F.col("i")], F.floor(F.col("i") / 2)).collect()}
    assert got == {0: "a.jpg", 1: "b.jpg", 2: "a_dup1.jpg", 3: "a_dup2.jpg"}


def test_folder_layout(spark):
    dirs = spark.createDataFrame([("/a/x",), ("/b/x",), ("/b/y",)], "dir string")
    got = {r["dir"]: r["sample"] for r in D.folder_layout(dirs).collect()}
    assert got == {"/a/x": "x", "/b/x": "x_1", "/b/y": "y"}


def test_clean_counts_a_tube_once_and_keeps_the_rest(spark):
    rows = [("v", f, 1, "1", "run", 0.0, 0.0, 10.0, 10.0) for f in range(8)]
    rows += [("v", f, 2, "2", "run", 0.0, 0.0, 10.0 + 90 * (f == 20), 10.0) for f in range(20, 23)]
    rows += [("v", f, 3, "", "run", 0.0, 0.0, 10.0, 10.0) for f in range(3)]
    rows += [("v", f, 4, "4", "hold", 0.0, 0.0, 10.0, 10.0) for f in range(9)]
    rows += [("v", 50, 5, "5", "run", None, None, None, None)]
    boxes = spark.createDataFrame(
        rows,
        "video_id string, frame_idx bigint, pos bigint, track_id string, action string, x1 double, y1 double, x2 double, y2 double",
    )
    s = C.clean_summary(boxes, 3.0, 5).first().asDict()
    # The shape without a box belongs to no tube, yet counts as a shape before cleaning.
    assert (s["removed_by_length"], s["removed_by_bigbox"]) == (1, 1)
    assert s["shapes_before"] == 24 and s["shapes_after"] == 3 + 9
    kept = C.clean_boxes(boxes, 3.0, 5).select("pos").distinct().collect()
    assert {r["pos"] for r in kept} == {3, 4}


def test_relabel_rules(spark):
    boxes = spark.createDataFrame(
        [("v", 1, "a", "l"), ("v", 1, "b", "l"), ("v", 2, "", "a"), ("v", 2, "", ""), ("w", 1, "gone", "x"), ("w", 2, "c", "")],
        "video_id string, frame_idx bigint, action string, label string",
    )
    rows = spark.createDataFrame(
        [(1, "a", "old"), (2, " a ", "A"), (3, "gone", None), (4, "nan", "x"), (5, "", "y")],
        "n int, label string, label2 string",
    )
    mapping = R.clean_mapping(rows, "n")
    assert {tuple(r) for r in mapping.collect()} == {("a", "A"), ("gone", "")}
    got = sorted(tuple(r) for r in R.relabel(boxes, mapping).collect())
    assert got == [("v", 1, "A", "l"), ("v", 1, "b", "l"), ("v", 2, "", "A"), ("w", 2, "c", "")]
    s = R.relabel_summary(boxes, mapping).first()
    assert (s["json_files_total"], s["json_files_deleted"], s["annotations_after"], s["samples_deleted_after"]) == (4, 1, 4, 0)


def test_relabel_records_keeps_other_keys(spark):
    texts = [
        '{"version": "2", "shapes": [{"label": "l", "x": [1, {"y": 2.5}], "attributes": {"action": " a ", "id": 7}},'
        ' {"label": "gone", "z": null}, {"label": "b", "attributes": null}, {"label": " "}]}',
        '{"shapes": [{"label": "gone"}]}',
        '{"annotations": [], "categories": []}',
        "not json",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    mapping = spark.createDataFrame([("a", "A"), ("gone", "")], "label string, label2 string")
    got = {r["i"]: r for r in R.relabel_records(df, mapping).collect()}
    first = json.loads(got[0]["value"])
    assert first == {
        "version": "2",
        "shapes": [
            {"label": "l", "x": [1, {"y": 2.5}], "attributes": {"action": "A", "id": 7}},
            {"label": "b", "attributes": None},
        ],
    }
    assert (got[0]["n_before"], got[0]["n_after"], got[1]["n_after"]) == (4, 2, 0)
    assert got[2]["value"] == texts[2] and got[3]["value"] == texts[3]
    one = R.keep_track(df.where("i = 0"), F.lit("7")).first()["value"]
    assert [s["label"] for s in json.loads(one)["shapes"]] == ["l"]


def test_records_are_rebuilt_once_however_often_they_are_filtered(spark):
    from trackloom.sources import labelme as L

    texts = spark.range(4).selectExpr(
        "concat('/d/videos/v/', lpad(cast(id AS STRING), 6, '0'), '.json') AS path",
        """concat('{"shapes":[{"label":"', if(id = 2, 'gone', 'a'), '","points":[[1,2],[3,4]],"group_id":"', id, '"}],"k":', id, '}') AS value""",
    )
    mapping = spark.createDataFrame([("a", "A"), ("gone", "")], "label string, label2 string")
    changed = L.to_boxes(L.parse_text(R.relabel_records(texts, mapping).where("n_after > 0")))
    own = L.to_boxes(L.parse_text(R.keep_track(texts, F.lit("3"))))
    assert sorted((r["frame_idx"], r["label"]) for r in changed.collect()) == [(0, "A"), (1, "A"), (3, "A")]
    assert [(r["frame_idx"], r["x1"], r["y2"]) for r in own.collect()] == [(3, 1.0, 4.0)]
    for df in (changed, own):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # One reading of the record, one of its rebuilt text.
        assert (plan.count("StructsToJsonEvaluator"), plan.count("from_json(")) == (1, 2), plan


def test_cleaning_judges_boxes_that_were_not_dealt(spark):
    from trackloom.plans.fixtures import Views
    from trackloom.plans.catalog_sources import _clean_records

    plan = _clean_records(Views(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    # Once for the texts and once for the boxes that stay.
    assert plan.count("RepartitionByExpression") == 2
