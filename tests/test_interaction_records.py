"""Interaction lists to records, against a plain loop; image sizes from headers; rescaled lists; folder layouts; statistics of one reading."""

import io
import json
import struct

import pytest

from trackloom.plans import commands as J
from trackloom.sources import images as G


def jpeg(width, height, before=b""):
    head = b"\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00" + before
    return head + b"\xff\xff\xc2\x00\x11\x08" + struct.pack(">HH", height, width) + b"\x03" + bytes(12)


def test_sizes_in_headers():
    exif = b"\xff\xe1" + struct.pack(">H", 60_000) + b"\xff\xc0" * 29_999
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 70_000, 3)
    cases = [
        (jpeg(640, 360), (640, 360)), (jpeg(9, 8, exif), (9, 8)), (jpeg(9, 8, b"\xff\xc4\x00\x03\x00"), (9, 8)), (png, (70_000, 3)),
        (b"", None), (b"\xff\xd8", None), (b"\xff\xd8\xff\xda\x00\x02", None), (b"GIF89a" + bytes(30), None), (jpeg(9, 8)[:26], None), (png[:20], None),
    ]
    for data, want in cases:
        assert G.size_in_header(io.BytesIO(data)) == want


NAMES = {1: "ball - pass", 2: "ball - shot", 3: ""}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("hhi")
    text = "".join(f'item {{\n  name: "{n}"\n  label_id: {i}\n  label_type: P\n}}\n' for i, n in NAMES.items() if n)
    (base / "actions.pbtxt").write_text(text)
    rows = []
    for video in ("b/game", "a"):
        name = video.split("/")[-1]
        for f in range(1, 7):
            for k in range(3):
                second = ("0.1", "0.2", "0.3", "0.45") if k == 1 else ("", "0.2", "0.3", "0.4") if k == 2 else ("", "", "", "")
                action = (f + k) % 4
                rows.append((name, str(f), f"0.{k}1", "0.25", "0.9", "0.5", *second, str(action) if action else "", str(5 - k), str(k)))
    rows.append(("a", "0002", "", "0.1", "0.2", "0.3", "", "", "", "", "1", "9", "9"))
    rows.append(("nowhere", "0001", "0.1", "0.1", "0.2", "0.3", "", "", "", "", "1", "9", "9"))
    (base / "train.csv").write_text("".join(",".join(r) + "\n" for r in rows[::2]))
    (base / "val.csv").write_text("".join(",".join(r) + "\n" for r in rows[1::2]))
    for video, size in (("a", (640, 360)), ("game", (100, 50))):
        (base / "frames" / video).mkdir(parents=True)
        for f in range(1, 6):
            (base / "frames" / video / f"img_{f:05d}.jpg").write_bytes(jpeg(*size) if f < 5 else b"no image")
    base.joinpath("rows.json").write_text(json.dumps(rows[::2] + rows[1::2]))
    return base


def expected(rows, secondary, only=None, videos=None, per_video=None, per_action=None):
    frames, names = {}, {}
    for r in rows:
        names.setdefault((r[0], r[1].zfill(4)), []).append(NAMES.get(int(r[10]) if r[10] else None, ""))
        shape = lambda box, team: (box, int(r[11]), team, NAMES.get(int(r[10]) if r[10] else None, ""))  # noqa: B023, E731
        frames.setdefault((r[0], r[1].zfill(4)), [])
        if r[2]:
            frames[r[0], r[1].zfill(4)].append(shape(r[2:6], "0"))
            if secondary and all(r[6:10]):
                frames[r[0], r[1].zfill(4)].append(shape(r[6:10], "1"))
    keys = sorted(k for k in frames if only is None or k[0] in only)
    first = sorted({v for v, _ in keys})[:videos]
    keys = [k for v in first for k in [k for k in keys if k[0] == v][:per_video]]
    if per_action is not None:
        action = lambda k: next((n for n in names[k] if n), "")
        keys = [k for a in {action(k) for k in keys} for k in [k for k in keys if action(k) == a][:per_action]]
    out = {}
    for video, frame in keys:
        if video not in ("a", "game") or int(frame) > 5:
            continue
        w, h = (0, 0) if int(frame) == 5 else (640, 360) if video == "a" else (100, 50)
        shapes = []
        for box, person, team, name in frames[video, frame]:
            x1, y1, x2, y2 = (round(float(c) * t, 3) for c, t in zip(box, (w, h, w, h)))
            shapes.append(
                {"label": "player", "description": None, "points": [[x1, y1], [x2, y1], [x2, y2], [x1, y2]], "group_id": person, "difficult": False,
                 "direction": 0, "shape_type": "rectangle", "flags": {"visibility": 1.0, "class_id": 1}, "attributes": {"team": team, "action": name}}
            )
        stem = f"img_{int(frame):05d}"
        out[f"{video}/{stem}.json"] = {
            "version": "2.5.4", "flags": {}, "shapes": shapes, "imagePath": f"{stem}.jpg", "imageData": None, "imageHeight": h, "imageWidth": w,
        }
    return out, len(keys)


@pytest.mark.parametrize(
    "options",
    [{}, {"videos": 1, "per_video": 3, "secondary": True}, {"only": ["game", "x"], "per_video": 5, "per_action": 2}],
)
def test_records_equal_a_plain_loop(spark, root, options):
    splits = {"train": "train.csv", "val": "val.csv"}
    out = J.interactions_to_records(J.Dataset(spark, str(root)), splits, "actions.pbtxt", str(root / "frames"), **options)
    want, chosen = expected(json.loads((root / "rows.json").read_text()), **{"secondary": False, **options})
    got = {r["path"]: json.loads(r["value"]) for r in out["records"].collect()}
    assert got == want
    summary = out["summary"].first()
    assert (summary["frames_chosen"], summary["records"]) == (chosen, len(want))
    assert summary["frames_without_image"] == chosen - len(want)
    assert {r["video_id"] for r in out["images"].collect()} >= {k.split("/")[0] for k in want}


def test_lists_are_rescaled(spark, tmp_path):
    texts = {
        "train.csv": "tube,label,Frames\nvideos/a,1,7\n\nvideos/b,2,x\nvideos/c,3,04,more\nshort,1\n",
        "val.CSV": "videos/a,1\n\nvideos/b,2\n",
        "two.csv": "tube,frames\nvideos/a,5\n",
        "empty.csv": "",
        "other.txt": "tube,label,frames\nvideos/a,1,7\n",
    }
    (tmp_path / "ann").mkdir()
    for name, text in texts.items():
        (tmp_path / "ann" / name).write_text(text)
    frames = spark.createDataFrame([("v", "000001.jpg")], "video_id string, image_name string")
    data = J.Dataset(spark, str(tmp_path))
    data.frames = frames
    got = {}
    for r in J.upsample_fps(data, 10, 30, str(tmp_path / "ann"))["annotations"].orderBy("path", "row_no").collect():
        got.setdefault(r["path"].rsplit("/", 1)[1], []).append(r["value"])
    assert got.pop("empty.csv", [""]) == [""]
    assert got == {
        "train.csv": ["tube,label,Frames", "videos/a,1,21", "videos/b,2,x", "videos/c,3,12,more", "short,1"],
        "val.CSV": ["videos/a,1", "", "videos/b,2"],
        "two.csv": ["tube,frames", "videos/a,5"],
    }


def test_layout(spark, tmp_path):
    for name in ("x/one/1.jpg", "x/one/sub/note.txt", "y/one/a b.png", "y/1.json", "z/two/deep/2.jpeg", "z/two/3.jpg"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text("x")
    out = J.layout_to_std(J.Dataset(spark, str(tmp_path / "in")), "/o")
    pairs = {r["src_path"].split("/in/")[1]: r["dst_path"] for r in out["manifest"].collect()}
    assert pairs == {
        "x/one/1.jpg": "/o/videos/one/1.jpg", "x/one/sub/note.txt": "/o/videos/one/sub/note.txt", "y/one/a b.png": "/o/videos/one_1/a b.png",
        "z/two/deep/2.jpeg": "/o/videos/deep/2.jpeg",
    }
    (tmp_path / "in" / "w" / "one_1").mkdir(parents=True)
    (tmp_path / "in" / "w" / "one_1" / "1.jpg").write_text("x")
    with pytest.raises(ValueError, match="one_1"):
        J.layout_to_std(J.Dataset(spark, str(tmp_path / "in")))


def test_one_shot_statistics(spark, tmp_path, rows_of, monkeypatch):
    from trackloom.operators import tubes as T

    (tmp_path / "v").mkdir()
    for f in range(1, 7):
        shapes = [{"points": [[g, 1], [g + 4, 9]], "group_id": g, "attributes": {"action": "run"}} for g in range(2) if (f, g) != (3, 1)]
        (tmp_path / "v" / f"{f:03d}.json").write_text(json.dumps({"imageWidth": 64, "imageHeight": 48, "shapes": shapes}))
    data = lambda: J.Dataset(spark, str(tmp_path), from_json=True)
    made, segments = [], T.tube_segments

    def counted(*args, **options):
        made.append(args[1])
        return segments(*args, **options)

    monkeypatch.setattr(T, "tube_segments", counted)
    out = J.one_shot_stats(data())
    assert sorted(made) == ["auto", "fixed"]
    want = {**J.analyze_dirs(data()), **J.length_bins(data()), **J.time_bins(data())}
    assert out.keys() == want.keys()
    for name in ("videos", "action_distribution", "resolutions", "length_bins", "time_bins"):
        assert rows_of(out[name]) == rows_of(want[name])
    assert list(J.one_shot_stats(data(), skip=("dirs", "lengths"))) == ["time_bins"]
    with pytest.raises(ValueError):
        J.one_shot_stats(data(), skip=("all",))


def test_record_rows_are_dealt_by_frame_only(spark):
    """Rows meet their image where they are, no shape is shuffled, and shapes that the order leaves equal stand by their texts."""
    from trackloom.operators import interaction_records as N

    columns = "video_id string, frame_id string, person_id bigint, action_id bigint, x1 double, y1 double, x2 double, y2 double, x1_2 double, y1_2 double, x2_2 double, y2_2 double, action_name string"
    rows = [("v", "0001", 1, 2, 0.1, 0.2, 0.3, 0.4, second, 0.5, 0.6, 0.7, "a") for second in (0.099, 0.1, None)]
    named = spark.createDataFrame(rows, columns)
    placed = spark.createDataFrame([("v", "0001", "1.jpg", 1000, 10)], "video_id string, frame_id string, image_name string, width int, height int")
    out = N.record_texts(named, placed, N.VALUE_ORDER, secondary=True)
    dealt = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert not any("image_name" in line or "width" in line for line in dealt)
    record = json.loads(out.first()["value"])
    assert [(s["attributes"]["team"], s["points"][0][0]) for s in record["shapes"]] == [("0", 100.0)] * 3 + [("1", 100.0), ("1", 99.0)]
    assert list(record) == ["version", "flags", "shapes", "imagePath", "imageData", "imageHeight", "imageWidth"]
