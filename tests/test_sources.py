"""Readers and writers on small hand-made files."""

import json
import pickle
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import align as A
from trackloom.sources import files as S
from trackloom.sources import images as I
from trackloom.sources import labelme as L
from trackloom.sources import sinks as K
from trackloom.sources import tables as R
from trackloom.sources import tube_pickle as P


def png(path, pixels):
    """Minimal PNG of an (H, W, 3) array."""
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + row.astype(np.uint8).tobytes() for row in pixels)

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    header = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    )


@pytest.fixture
def dataset(tmp_path):
    root = tmp_path / "std" / "videos"
    shapes = [
        {"label": "p", "points": [[5, 6], [1, 2]], "attributes": {"action": "run", "id": 7}, "extra": 1},
        {"points": [[9, 9, 3, 3]], "flags": {"action": "hit", "track_id": "t"}, "attributes": {"action": ""}},
        {"points": [[1, 2]], "group_id": 4},
        {"points": [], "attributes": {"player_id": ""}},
        {"points": [[0, 0], [2, 0], [2, 2], [0, 2]], "group_id": 4, "flags": {"id": "f"}},
    ]
    for sample, name, body in [
        ("s1", "img_0003", {"imagePath": "x.jpg", "imageWidth": 10, "imageHeight": 20, "shapes": shapes}),
        ("s1", "img_0001", {"shapes": [], "version": "1"}),
        ("s2", "noindex", {"imagePath": "n.png", "shapes": shapes[:1]}),
        ("s2", "0009", {"imagePath": "n.png", "shapes": shapes[:1]}),
    ]:
        (root / sample).mkdir(parents=True, exist_ok=True)
        (root / sample / f"{name}.json").write_text(json.dumps(body, indent=1))
    (root / "s1" / "broken.json").write_text("{nope")
    return root


def test_labelme_rules(spark, dataset):
    records = L.read_records(spark, str(dataset))
    assert records.count() == 4
    rows = {(r["video_id"], r["frame_idx"], r["pos"]): r for r in L.to_boxes(records).collect()}
    assert len(rows) == 7
    a = rows["s1", 3, 1]
    assert (a["x1"], a["y1"], a["x2"], a["y2"]) == (1, 2, 5, 6)
    assert (a["action"], a["track_id"], a["img_w"], a["img_h"], a["label"]) == ("run", "7", 10, 20, "p")
    b = rows["s1", 3, 2]
    assert (b["x1"], b["x2"], b["action"], b["track_id"]) == (9, 3, "hit", "t")
    assert rows["s1", 3, 3]["x1"] is None and rows["s1", 3, 3]["track_id"] == "4"
    assert rows["s1", 3, 4]["track_id"] == "" and rows["s1", 3, 4]["x1"] is None
    assert rows["s1", 3, 5]["track_id"] == "f" and rows["s1", 3, 5]["action"] == ""
    filled = L.fill_index(L.to_boxes(records), L.frames_of(records)).where("video_id = 's2'")
    # Files in name order: 0009.json is place 0, noindex.json place 1.
    assert {r["frame_idx"] for r in filled.collect()} == {9, 1}


def test_raw_keeps_every_key(spark, dataset):
    raw = L.read_raw(spark, str(dataset))
    assert raw.count() == 4
    extra = raw.select(F.try_variant_get("raw", "$.shapes[0].extra", "int").alias("e")).where("e = 1")
    assert extra.count() == 3


def test_records_round_trip(spark, dataset, tmp_path):
    boxes = L.read_boxes(spark, str(dataset)).where("x1 IS NOT NULL AND x1 < x2 AND frame_idx = 3")
    L.write_records(L.frame_records(boxes), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 1 and set(back.columns) >= {"video_id", "shapes", "imagePath"}
    assert len(back.first()["shapes"]) == boxes.count() == 2


def test_folders_and_images(spark, dataset):
    files = S.list_files(spark, str(dataset))
    assert {r[0] for r in S.list_samples(files).collect()} == {"s1", "s2"}
    paths = spark.createDataFrame(
        [("/r/a/1.json",), ("/r/a/b/2.json",), ("/r/c/3.jpg",), ("/r/c/d/4.PNG",), ("/r/c/d/5.txt",)], "path string"
    )
    assert [r[0] for r in S.leaf_dirs(paths).collect()] == ["/r/a"]
    assert [r[0] for r in S.sample_dirs(paths).collect()] == ["/r/c/d"]
    records = spark.createDataFrame(
        [("v", "1.json", "real.png"), ("v", "2.json", "gone.jpg"), ("v", "3.json", "")],
        "video_id string, record_name string, image_path string",
    )
    images = spark.createDataFrame(
        [("v", n) for n in ("real.png", "1.jpg", "2.png", "2.JPEG", "2.gif")], "video_id string, image_name string"
    )
    got = {r["record_name"]: r["image_name"] for r in S.pair_images(records, images).collect()}
    assert got == {"1.json": "real.png", "2.json": "2.JPEG", "3.json": None}


def test_find_frames(spark):
    images = spark.createDataFrame(
        [("v", n) for n in ("img_00012.jpg", "000013.JPG", "zz000014_b.jpeg", "pre_tag7x.jpg", "000015.png")],
        "video_id string, image_name string",
    )
    wanted = spark.createDataFrame(
        [("v", i) for i in ("0012", "13", "14", "15", "tag7")] + [("w", "1")], "video_id string, frame_id string"
    )
    got = {r["frame_id"]: r["image_name"] for r in S.find_frames(wanted, images).collect()}
    assert got == {
        "0012": "img_00012.jpg", "13": "000013.JPG", "14": "zz000014_b.jpeg", "15": None, "tag7": "pre_tag7x.jpg", "1": None,
    }


def test_lists(spark, tmp_path):
    (tmp_path / "train.csv").write_text('tube,label,frames\nvideos/a,x,3\nvideos/b\n\n"videos/c,d", y \n')
    got = R.read_split(spark, str(tmp_path / "train.csv"), "train")
    assert [(r["path"], r["label"]) for r in got.orderBy("row_no").collect()] == [
        ("videos/a", "x"), ("videos/b", "unknown"), ("videos/c,d", "y"),
    ]
    assert {r["video_id"] for r in R.split_samples(got).collect()} == {"a", "b", "c,d"}
    (tmp_path / "map.csv").write_text("Label ,LABEL2\na,b\n gone ,\na,c\n")
    assert {tuple(r) for r in R.read_mapping(spark, str(tmp_path / "map.csv")).collect()} == {("a", "c"), ("gone", "")}
    (tmp_path / "rm.txt").write_text("# note\nv1\t3\nv2, 4 ,x\nv3\nv1,3\n")
    assert {tuple(r) for r in R.read_removals(spark, str(tmp_path / "rm.txt")).collect()} == {("v1", "3"), ("v2", "4")}
    for i, (text, want) in enumerate(
        [('{"0": "a", "1": "b"}', {(0, "a"), (1, "b")}), ('{"a": 0, "b": "2"}', {(0, "a"), (2, "b")}), ('["a", "b"]', {(0, "a"), (1, "b")})]
    ):
        (tmp_path / f"l{i}.json").write_text(text)
        assert {tuple(r) for r in R.read_labels(spark, str(tmp_path / f"l{i}.json")).collect()} == want
    (tmp_path / "a.pbtxt").write_text('item {\n  name: "ball - pass"\n  label_id: 3\n  label_type: P\n}\nitem {\n  name: bare\n  label_id: 4\n')
    assert {tuple(r) for r in R.read_actions(spark, str(tmp_path / "a.pbtxt")).collect()} == {(3, "ball - pass", "P"), (4, "bare", None)}
    (tmp_path / "p.csv").write_text("id,label_name\ns/1.jpg,t\n,t\n")
    assert R.read_predictions(spark, str(tmp_path / "p.csv")).count() == 1
    (tmp_path / "bad.csv").write_text("id,x\n1,2\n")
    with pytest.raises(ValueError):
        R.read_predictions(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "al.csv").write_text(
        "video_id,sh_index,sh_file,ms_index,ms_file,k,mean,status\nv,1,a,3,b,2,0.5,ok\nw,0,a,3,b,2,0.5,ok\nx,1,a,3,b,2,,no_match\n"
    )
    al = R.read_alignment(spark, str(tmp_path / "al.csv"))
    assert [r["video_id"] for r in A.usable_alignment(al).collect()] == ["v"]
    row = "v,0001,0.1,0.2,bad,0.4,,,,,5.0,2,\n"
    (tmp_path / "hhi.csv").write_text(row)
    got = R.read_interactions(spark, {"train": str(tmp_path / "hhi.csv"), "val": str(tmp_path / "hhi.csv")}).collect()
    assert len(got) == 2 and got[0]["x2"] is None and got[0]["action_id"] == 5 and got[0]["frame_id"] == "0001"


def test_tube_pickle(spark, tmp_path):
    data = {
        "labels": ["run"], "videos": ["v"], "nframes": {"v": 9}, "resolution": {"v": (20, 30)}, "train_videos": [["v"]],
        "gttubes": {"v": {0: [np.array([[1, 0, 1, 2, 3, 4], [2, 0, 5, 6, 7, 8]], dtype=np.float32)], 3: [np.zeros((1, 3))]}},
    }
    (tmp_path / "gt.pkl").write_bytes(pickle.dumps(data))
    got = sorted(P.read_tubes(spark, str(tmp_path / "gt.pkl")).drop("path").collect())
    assert [tuple(r) for r in got] == [
        ("v", 0, "run", 0, 1, 1, 2, 3, 4),
        ("v", 0, "run", 0, 2, 5, 6, 7, 8),
        ("v", 3, "3", 0, 0, None, None, None, None),
    ]
    video = P.read_videos(spark, str(tmp_path / "gt.pkl")).first()
    assert (video["split"], video["nframes"], video["height"], video["width"]) == ("train", 9, 20, 30)
    with pytest.raises(pickle.UnpicklingError):
        P.load(pickle.dumps(print))


def test_images(spark, tmp_path):
    for folder, base in (("v", 10), ("w", 30)):
        (tmp_path / folder).mkdir()
        for i in range(2):
            png(tmp_path / folder / f"{i + 1:04d}.png", np.full((4, 6, 3), base + 5 * i))
    (tmp_path / "v" / "0000.png").write_bytes(b"no image")
    images = I.read_images(spark, str(tmp_path)).where("pixels IS NOT NULL")
    assert {tuple(r) for r in I.resolutions(images).collect()} == {("v", 4, 6), ("w", 4, 6)}
    a, b = (images.where(F.col("video_id") == x).select("frame_idx", F.col("pixels").alias(x)) for x in "vw")
    for gray in (False, True):
        got = a.join(b, "frame_idx").select(I.pixel_difference(gray)("v", "w").alias("d")).collect()
        assert [r["d"] for r in got] == [20.0, 20.0]


def test_image_jobs(spark, tmp_path):
    from trackloom.plans import commands as J

    for tree, shift in (("ms", 2), ("sh", 0)):
        (tmp_path / tree / "v").mkdir(parents=True)
        for i in range(1, 6):
            png(tmp_path / tree / "v" / f"{i:04d}.png", np.full((4, 6, 3), 20 * (i - shift) + 60))
    roots = [str(tmp_path / t) for t in ("ms", "sh")]
    found = J.align_images(spark, *roots)["alignment"].first()
    assert (found["status"], found["sh_index"], found["ms_index"], found["k"], found["mean"]) == ("ok", 1, 3, 2, 0.0)
    assert J.align_images(spark, *roots, max_k=1)["alignment"].first()["status"] == "no_below_threshold"
    diff = J.first_frame_difference(spark, *roots)["difference"].first()
    assert (diff["frame_idx"], diff["mean"]) == (1, 40.0)


def test_sinks(spark, tmp_path):
    masks = spark.createDataFrame([("w1", "1,2", "", "")], "window string, anno_mask string, img_mask string, edge_pad string")
    K.mask_csv(masks, str(tmp_path / "mask"))
    text = "".join(p.read_text() for p in (tmp_path / "mask").glob("*.csv"))
    assert '"w1","1,2"' in text
    listing = spark.createDataFrame([("train", "a", "x"), ("val", "b", "y")], "split string, path string, label string")
    K.split_csv(listing, str(tmp_path / "ann"), header=False)
    assert sorted(p.name for p in (tmp_path / "ann").glob("split=*")) == ["split=train", "split=val"]
    K.one_csv(listing, str(tmp_path / "one"))
    K.stats_json(listing, str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).count() == 2
    counts = spark.createDataFrame([("a", 3), ("b", 5)], "name string, count bigint")
    K.write_lines(K.list_report(counts, "T", "name"), str(tmp_path / "md"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "md")).collect()]
    assert lines == ["## T", "- b: 5", "- a: 3"]
    labels = spark.createDataFrame([(10, "j"), (2, "c")], "label_id int, label_name string")
    assert K.labels_text(labels).first()[0] == '{"2":"c","10":"j"}'


def test_find_frames_joins_pieces_once(spark):
    """A piece inside very many names meets the wanted frames as one row, the first of its names."""
    images = spark.createDataFrame([("v", f"a_5_{i:03d}.jpg") for i in range(50)], "video_id string, image_name string")
    wanted = spark.createDataFrame([("v", "5")], "video_id string, frame_id string")
    found = S.find_frames(wanted, images)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min(image_name" in plan and any("Aggregate [video_id" in p and ", piece" in p and "min(image_name" in p for p in plan.splitlines())
    assert [r["image_name"] for r in found.collect()] == ["a_5_000.jpg"]


def frame_by_loop(frame_id, names):
    """Image of a frame id, every pattern tried on every name."""
    digits = frame_id.strip() if frame_id is not None else ""
    number = int(digits) if digits.lstrip("+-").isdigit() and -(2**63) <= int(digits) < 2**63 else None
    bases = [] if frame_id is None else [f"img_{frame_id}", frame_id]
    if number is not None:
        text = str(number)
        bases = [f"img_{text.rjust(5, '0')}", text.rjust(6, "0"), text, f"img_{text}", *bases]
    for base in bases:
        for ext in (".jpg", ".JPG", ".jpeg", ".JPEG"):
            if base + ext in names:
                return base + ext
    loose = [n for n in names if n.lower().endswith((".jpg", ".jpeg")) and any(b and b in n for b in bases)]
    return min(loose, default=None)


def test_find_frames_by_loop(spark):
    names = (
        "img_00012.JPG 12.jpeg 000012.jpg 13.jpg img_0013.jpg x000123_a.jpeg b120007_c1.jpg 99999999999999999999.jpg img_000-5.jpg t-012.jpg"
        " z-12.jpg img_.jpg .jpg cam12_000450.Jpg 0.png q0.jpeg 9223372036854775807_k.jpg img_tag7.jpeg pre_tag8x.JPG 300400.jpg img_img_4.jpg +8.jpg"
    ).split()
    ids = [
        "12", "0012", "13", "0013", "00013", "123", "23", "7", "07", "0", "00", "-5", "-012", "-12", "", None, "tag7", "tag8", "45", "0450", "4500",
        "9223372036854775807", "99999999999999999999", "30", "img_4", "4", "+8", " 8", "8", "1200", "2000", "99999",
    ]
    images = spark.createDataFrame([(v, n) for v in ("a", "b") for n in names if v == "a" or n[0] in "bx"], "video_id string, image_name string")
    wanted = spark.createDataFrame([(v, i) for v in ("a", "b", "c", None) for i in ids] * 2, "video_id string, frame_id string")
    kept = {v: [r["image_name"] for r in images.collect() if r["video_id"] == v] for v in ("a", "b", "c", None)}
    got = S.find_frames(wanted, images).collect()
    assert len(got) == 4 * len(ids)
    assert {(r["video_id"], r["frame_id"]): r["image_name"] for r in got} == {(v, i): frame_by_loop(i, n) for v, n in kept.items() for i in ids}


def test_find_frames_asks_numbers_once(spark):
    """Ids that are numbers meet the names by number: they aren't spread into stems, nor names into texts of any kind."""
    images = spark.createDataFrame([("v", f"x{i:06d}_a.jpeg") for i in range(300)], "video_id string, image_name string")
    found = S.find_frames(spark.range(300).selectExpr("'v' AS video_id", "printf('%04d', id) AS frame_id"), images)
    assert {(r["frame_id"], r["image_name"]) for r in found.collect()} == {(f"{i:04d}", frame_by_loop(f"{i:04d}", [f"x{k:06d}_a.jpeg" for k in range(300)])) for i in range(300)}
    done = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "posexplode" not in done and "piece" not in done
