"""The user-level jobs from files to result tables."""

import json

import pytest

from trackloom.plans import commands as J


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("std")
    for video in ("v1", "v2"):
        folder = base / "videos" / video
        folder.mkdir(parents=True)
        for f in range(1, 9):
            shapes = [
                {
                    "label": "p",
                    "points": [[10 * t, 5], [10 * t + 12, 25]],
                    "group_id": t,
                    "attributes": {"action": "run" if t else "hit"},
                }
                for t in range(2)
                if not (video == "v2" and f == 4)
            ]
            record = {"imagePath": f"{f:06d}.jpg", "imageWidth": 64, "imageHeight": 48, "shapes": shapes}
            (folder / f"{f:06d}.json").write_text(json.dumps(record))
            (folder / f"{f:06d}.jpg").write_bytes(b"x")
    return base


@pytest.fixture(scope="module")
def data(spark, root, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    for name, table in J.ingest(J.Dataset(spark, str(root / "videos"), from_json=True)).items():
        table.write.parquet(str(out / name))
    return J.Dataset(spark, str(out))


def test_ingest(data):
    assert data.boxes.count() == 30 and data.frames.count() == 16
    assert data.frames.where("img_w = 64").count() == 16


def test_profile_jobs(data):
    out = J.analyze_dirs(data)
    rows = {r["video_id"]: r for r in out["videos"].collect()}
    assert rows["__all__"]["num_boxes"] == 30 and rows["v2"]["tubes_total"] == 4 and rows["v1"]["num_images"] == 8
    one = {r["video_id"] for r in J.analyze_folder(data, "v1")["videos"].collect()}
    assert one == {"v1", "__all__"}
    over = J.analyze_overlaps(data, (0.05,))
    assert over["basic"].first()["total_pairs"] == 15
    assert over["counts_ge"].first()["pairs"] == 15
    lengths = {r["action"]: r["count"] for r in J.tube_lengths(data)["lengths"].collect()}
    assert lengths == {"run": 3, "hit": 3, "__all__": 6}
    assert J.time_bins(data)["time_bins"].first()["num_tubes"] == 6


def test_rewriting_jobs(data, tmp_path):
    (tmp_path / "rm.txt").write_text("v1,0\n")
    gone = J.remove_tubes(data, str(tmp_path / "rm.txt"))["summary"].first()
    assert (gone["shapes_before"], gone["shapes_after"], gone["affected_samples"]) == (30, 22, 1)
    (tmp_path / "map.csv").write_text("label,label2\nhit,\nrun,walk\n")
    kept = J.convert_std(data, str(tmp_path / "map.csv"))["summary"].first()
    assert (kept["annotations_after"], kept["json_files_deleted"]) == (15, 0)
    clean = J.clean_json(data, max_len=5)["summary"].first()
    assert clean["removed_by_length"] == 2
    assert [r["video_id"] for r in J.subset_std(data, 1)["picks"].collect()] == ["v1"]
    assert J.split_std(data, infer_labels=True)["splits"].count() == 2
    assert J.filter_std(data, include=("v1",))["summary"].first()["kept"] == 1


def test_records_are_written_back_as_they_were(spark, tmp_path):
    """Polygons, flags, unknown keys, a seven-digit frame, an emptied frame, an unreadable shape."""
    folder = tmp_path / "d" / "v1"
    folder.mkdir(parents=True)
    shape = {"label": "p", "points": [[1, 2.5], [9, 2.5], [5, 30.25]], "group_id": 3, "shape_type": "polygon", "flags": {"hard": True}, "note": {"a": [1, None]}}
    for f in range(1234560, 1234570):
        run = shape | {"attributes": {"action": "run", "id": 3}}
        other = {"label": "q", "points": [[0, 0], [4, 4]], "group_id": 4, "attributes": {"action": "hit"}, "occluded": False}
        broken = {"label": "z", "points": [], "group_id": 9}
        shapes = [run] if f == 1234562 else [run, other, broken] if f % 2 else [other, run]
        record = {"version": "5.0", "imagePath": f"img_{f}.png", "imageData": None, "imageWidth": 64, "imageHeight": 48, "extra": {"k": 1.5}, "shapes": shapes}
        (folder / f"{f}.json").write_text(json.dumps(record))
    out = tmp_path / "t"
    for name, table in J.ingest(J.Dataset(spark, str(tmp_path / "d"), from_json=True)).items():
        table.write.parquet(str(out / name))
    before = {p.name: json.loads(p.read_text()) for p in folder.iterdir()}

    def written(tables):
        return {r["path"].rsplit("/", 1)[1]: json.loads(r["value"]) for r in tables["records"].collect()}

    for data in (J.Dataset(spark, str(tmp_path / "d"), from_json=True), J.Dataset(spark, str(out))):
        clean = written(J.clean_json(data, sigma=50.0, max_len=5))
        kept = {n: [s for s in r["shapes"] if s.get("group_id") == 4] for n, r in before.items()}
        assert clean.keys() == before.keys() and clean["1234562.json"]["shapes"] == []
        for name, record in clean.items():
            assert record | {"shapes": []} == before[name] | {"shapes": []}
            assert all(s in before[name]["shapes"] for s in record["shapes"])
            assert record["shapes"] == kept[name] or record["shapes"] == []
        (tmp_path / "rm.txt").write_text("v1,4\n")
        left = written(J.remove_tubes(data, str(tmp_path / "rm.txt")))
        for name, record in before.items():
            assert left[name] == record | {"shapes": [s for s in record["shapes"] if s["group_id"] != 4]}
        (tmp_path / "rm.txt").write_text("v1,3\n")
        assert "1234562.json" not in written(J.remove_tubes(data, str(tmp_path / "rm.txt")))
        (tmp_path / "map.csv").write_text("label,label2\nrun,walk\nhit,\n")
        mapped = written(J.convert_std(data, str(tmp_path / "map.csv")))
        walk = shape | {"attributes": {"action": "walk", "id": 3}}
        assert mapped["1234562.json"] == before["1234562.json"] | {"shapes": [walk]}
        assert walk in mapped["1234563.json"]["shapes"]


def test_pickles_with_labels_of_their_own(spark, tmp_path):
    import pickle

    import numpy as np

    tube = np.array([[1, 0, 1, 2, 3, 4], [2, 0, 1, 2, 3, 4]])
    for name, labels in (("a", ["walk", "run"]), ("b", ["run", "walk"])):
        data = {"labels": labels, "videos": ["v"], "gttubes": {"v": {0: [tube], 1: [tube[:1, :3]]}}}
        (tmp_path / f"{name}.pkl").write_bytes(pickle.dumps(data))
    lengths = J.tube_lengths_of_pickles(J.Dataset(spark, str(tmp_path)))["lengths"]
    assert {r["action"]: (r["count"], r["min"], r["max"]) for r in lengths.collect()} == {
        "walk": (2, 1, 2), "run": (2, 1, 2), "__all__": (4, 1, 2)
    }
    frames = spark.createDataFrame([("v", 1, "1.jpg"), ("v", 2, "2.jpg")], "video_id string, frame_idx long, image_name string")
    shapes = J.pickle_to_std(J.Dataset(spark, str(tmp_path)), frames)["shapes"]
    assert sorted(r["action"] for r in shapes.collect()) == ["run", "run", "walk", "walk"]


def test_sizes_come_from_records(spark, tmp_path):
    """Records without images, an image without a record, names without a number."""
    folder = tmp_path / "v1"
    folder.mkdir()
    shape = {"points": [[0, 0], [4, 4]], "group_id": 1, "attributes": {"action": "run"}}
    for name, width in (("1", 64), ("2", 64), ("3", 32), ("first", 64)):
        (folder / f"{name}.json").write_text(json.dumps({"imageWidth": width, "imageHeight": 48, "shapes": [shape]}))
    for name in ("1", "9", "first"):
        (folder / f"{name}.jpg").write_bytes(b"x")
    data = J.Dataset(spark, str(tmp_path), from_json=True)
    out = J.analyze_dirs(data)
    assert {r["resolution"]: r["count"] for r in out["resolutions"].collect()} == {"64x48": 3, "32x48": 1}
    rows = {r["video_id"]: r for r in out["videos"].collect()}
    assert rows["v1"]["num_images"] == 3 and rows["v1"]["num_boxes"] == 4
    assert data.frames.where("frame_idx IS NULL").count() == 0


def test_window_jobs(data, tmp_path):
    (tmp_path / "train.csv").write_text("videos/v1,x\n")
    out = J.split_by_tube_fpswin(data, 4, splits={"train": str(tmp_path / "train.csv")})
    assert {r["path"] for r in out["index"].collect()} == {
        f"videos/v1__tid{t}__seg00__win{w:03d}" for t in "01" for w in range(3)
    }
    assert out["masks"].count() == 0 and out["shapes"].count() == 24
    assert J.split_by_tube(data)["shapes"].count() == 30
    gt = {r["tube"]: r["frames"] for r in J.export_tubes(data)["gt"].collect()}
    assert gt["v1__tid0__seg00.mp4"] == 8 and len(gt) == 6
    assert J.std_to_tubes(data)["tubes"].count() == 6
    assert J.upsample_fps(data, 6, 12)["frames"].count() == 32
    assert J.export_samples(data, 1, 1)["frames"].count() > 0


def test_command_line(spark, data, tmp_path, monkeypatch):
    from trackloom import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda *a: spark)
    cli.main(["time-bins", data.root, "--out", str(tmp_path / "o"), "--set", "spf=0.1"])
    assert spark.read.parquet(str(tmp_path / "o" / "time_bins")).count() == 1


def test_tube_dataset_jobs(spark, tmp_path):
    for name, labels in (("a", '{"0": "hit", "1": "run"}'), ("b", '{"0": "run", "1": "zap"}')):
        notes = tmp_path / name / "annotations"
        notes.mkdir(parents=True)
        (tmp_path / name / "videos" / "x1").mkdir(parents=True)
        (tmp_path / name / "videos" / "x1" / "1.jpg").write_bytes(b"x")
        (notes / "labels_dict.json").write_text(labels)
        (notes / "train.csv").write_text(f"videos/x1,0\nvideos/{name},1\n")
        if name == "a":
            (notes / "val.csv").write_text("videos/x1,1\n")
    stats = J.tube_stats(J.Dataset(spark, str(tmp_path / "a")))
    assert {(r["split"], r["label_name"]): r["count"] for r in stats["counts"].collect()} == {
        ("train", "hit"): 1,
        ("train", "run"): 1,
        ("val", "run"): 1,
    }
    assert [r["path"] for r in stats["missing"].collect()] == ["videos/a"]
    shared = stats["audit"].where("measure = 'train_val_shared'").first()["value"]
    assert shared == 1.0
    merged = J.merge_tube_datasets(spark, [str(tmp_path / n) for n in "ab"])
    assert {tuple(r) for r in merged["labels"].collect()} == {(0, "hit"), (1, "run"), (2, "zap")}
    rows = {(r["split"], r["path"]): r["label"] for r in merged["splits"].collect()}
    assert rows == {
        ("train", "videos/x1"): "0",
        ("train", "videos/a"): "1",
        ("train", "videos/b"): "2",
        ("val", "videos/x1"): "1",
    }


def test_compare_job(data, tmp_path):
    (tmp_path / "al.csv").write_text(
        "video_id,sh_index,sh_file,ms_index,ms_file,k,mean,status\n"
        "v1,1,a.jpg,1,a.jpg,0,0.1,ok\nv2,1,a.jpg,2,a.jpg,1,0.1,ok\n"
    )
    out = J.compare_aligned(data, data, str(tmp_path / "al.csv"))
    steps = {r["video_id"]: r["count"] for r in out["run"].groupBy("video_id").count().collect()}
    assert steps == {"v1": 8, "v2": 7}
    summary = {r["video_id"]: r for r in out["per_video"].collect()}
    assert summary["v1"]["ms_boxes"] == 16 and summary["v1"]["mean_ms_to_sh"] == 1.0
    # Frame 4 of v2 has no boxes: it drops out of both sides, one step apart.
    assert summary["v2"]["ms_boxes"] == 10
    pairs = {(r["sh_action"], r["ms_action"]): r["count"] for r in out["action_pairs"].collect()}
    assert pairs == {("hit", "hit"): 13, ("run", "run"): 13}
    ends = {r["video_id"]: r["ends_first"] for r in out["endings"].collect()}
    assert ends == {"v1": "tie", "v2": "ms"}
    # v1: 8 steps of 2 boxes on both sides; v2: 7 steps, one of them empty, on either side.
    assert out["merged"].count() == 2 * 16 + 2 * 12


def test_interaction_jobs(spark, tmp_path):
    (tmp_path / "actions.pbtxt").write_text('item {\n  name: "ball - pass"\n  label_id: 1\n}\n')
    (tmp_path / "train.csv").write_text(
        "v,0001,0.1,0.2,0.3,0.4,0.5,0.5,0.6,0.7,1,1,1\nv,0001,0.1,0.2,0.3,0.4,0.5,0.5,0.6,0.7,1,1,1\n"
        "v,0002,0.1,0.2,1.3,0.4,,,,,9,2,\n"
    )
    paths, actions = {"train": str(tmp_path / "train.csv")}, str(tmp_path / "actions.pbtxt")
    out = J.interaction_profile(spark, paths, actions)
    basic = out["basic"].first()
    assert (basic["num_rows_total"], basic["num_person_ids"], basic["num_instances"]) == (3, 2, 1)
    assert out["duplicates"].first()[0] == 1 and out["unknown"].first()[0] == 1
    assert out["anomalies_primary"].first()["coords_out_of_range"] == 1
    second = out["anomalies_secondary"].first()
    assert (second["missing_values"], second["coords_out_of_range"], second["num_boxes"]) == (1, 1, 2)
    sizes = spark.createDataFrame([("v", 100, 50)], "video_id string, width int, height int")
    shapes = J.interactions_to_shapes(spark, paths, actions, sizes, secondary=True)["shapes"]
    assert shapes.count() == 5
    assert shapes.where("team = '1'").first()["points"][2] == [60.0, 35.0]
