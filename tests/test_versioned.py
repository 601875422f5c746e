"""Tables that become visible together, and the tube dataset written and read again."""

import json

import pytest
from pyspark.sql import functions as F

from trackloom.operators import tubetable as B
from trackloom.plans import commands as J
from trackloom.sources import versioned as V


def test_versions(spark, tmp_path, rows_of):
    out = str(tmp_path / "d")
    one = {"a": spark.range(3), "b": spark.createDataFrame([("x", None)], "k string, v double")}
    with pytest.raises(FileNotFoundError):
        V.read_tables(spark, out)
    V.write_tables(one, out)
    read = V.read_tables(spark, out)
    assert rows_of(read["a"]) == [(0,), (1,), (2,)] and read["b"].schema == one["b"].schema
    fails = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        V.write_tables({"a": spark.range(9), "b": fails}, out)
    assert V.read_tables(spark, out)["a"].count() == 3
    V.write_tables({"a": spark.range(5)}, out)
    assert list(V.read_tables(spark, out)) == ["a"] and V.read_tables(spark, out)["a"].count() == 5
    assert read["a"].count() == 3


def test_a_version_without_a_manifest_is_refused(spark, tmp_path):
    fails = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        V.write_tables({"a": spark.range(9), "b": fails}, str(tmp_path / "d"))
    assert (tmp_path / "d").is_dir()
    with pytest.raises(FileNotFoundError):
        V.read_tables(spark, str(tmp_path / "d"))


def test_tube_dataset_comes_back_whole(spark, tmp_path, monkeypatch):
    """A tube of 1300 frames, a gap, two actions, a video without sizes; every value is compared."""
    from trackloom import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda *a: spark)
    for video, frames, size in (("v1", range(1, 1301), 64), ("v2", [1, 2, 3, 7, 8], 0)):
        folder = tmp_path / "d" / video
        folder.mkdir(parents=True)
        for f in frames:
            boxes = [("run", 0, f)] + ([("hit", 1, 2 * f)] if f % 5 else [])
            shapes = [{"points": [[x, 1.5], [x + 9, 20.25]], "group_id": t, "attributes": {"action": a}} for a, t, x in boxes]
            (folder / f"{f:06d}.json").write_text(json.dumps({"imageWidth": size, "imageHeight": size, "shapes": shapes}))
            (folder / f"{f:06d}.jpg").write_bytes(b"x")
    out = str(tmp_path / "o")
    cli.main(["std-to-tubes", str(tmp_path / "d"), "--json", "--out", out])
    read = V.read_tables(spark, out)
    data = J.Dataset(spark, str(tmp_path / "d"), from_json=True)
    want = B.from_segments(data.rows).drop("pos")
    got = B.explode_tubes(read["tubes"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert got.where("video_id = 'v1' AND class_id = 1").groupBy("tube_no").count().collect()[0]["count"] == 1300
    assert {tuple(r) for r in read["labels"].collect()} == {("hit", 0), ("run", 1)}
    assert {tuple(r) for r in read["videos"].collect()} == {("v1", 1300, 64, 64), ("v2", 8, 0, 0)}
    shapes = J.tubes_to_std(J.Dataset(spark, out), str(tmp_path / "d"))["shapes"]
    assert {r["action"]: r["count"] for r in shapes.groupBy("action").count().collect()} == {"run": 1305, "hit": 1040 + 5}
