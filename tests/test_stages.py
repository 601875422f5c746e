"""Chains that go on where they ended, and the cleaning chain from files to records."""

import json

import pytest
from pyspark.sql import functions as F

from trackloom.plans import commands as J
from trackloom.plans.stages import Stage, run_stages


def test_only_missing_stages_are_built(spark, tmp_path):
    source = tmp_path / "in.txt"
    source.write_text("a\nb\n")
    built, fails = [], [True]

    def lines(_done):
        built.append("lines")
        return {"t": spark.read.text(str(source))}

    def counted(done):
        built.append("counted")
        table = done["lines"]["t"].groupBy("value").count()
        return {"ok": table, "n": table.select(F.raise_error(F.lit("lost")).alias("x")) if fails[0] else table}

    def chain(factor=1):
        return [
            Stage("lines", lines, files=(str(source),)),
            Stage("counted", counted, after=("lines",), options={"factor": factor}),
            Stage("aside", lambda _d: built.append("aside") or {"t": spark.range(factor)}, options={}),
        ]

    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        run_stages(spark, out, chain())
    assert built == ["lines", "counted"]
    fails[0] = False
    done = run_stages(spark, out, chain())
    assert built == ["lines", "counted", "counted", "aside"] and done["counted"]["n"].count() == 2
    run_stages(spark, out, chain())
    assert len(built) == 4
    run_stages(spark, out, chain(2))
    assert built[4:] == ["counted"]
    source.write_text("a\nb\nccc\n")
    assert run_stages(spark, out, chain())["counted"]["n"].count() == 3
    assert built[5:] == ["lines", "counted"]
    with pytest.raises(ValueError):
        run_stages(spark, out, [*chain(), *chain()])


def test_view_clean(spark, tmp_path, monkeypatch):
    """A sample left out by its name, a track labelled 0, a frame left empty, a shape without a group."""
    for video in ("keep_1", "keep_2", "drop_1"):
        folder = tmp_path / "d" / video
        folder.mkdir(parents=True)
        for f in range(3, 6):
            shapes = [{"label": "p", "points": [[g, f], [g + 9, f + 9]], "group_id": g, "attributes": {"action": "run"}} for g in (1, 2)]
            if f == 5:
                shapes = shapes[:1]
            if f == 4:
                shapes.append({"label": "q", "points": [[0, 0], [3, 3]], "attributes": {"action": "hit"}})
            (folder / f"{f:06d}.json").write_text(json.dumps({"imageWidth": 64, "imageHeight": 48, "note": f, "shapes": shapes}))
    data = lambda: J.Dataset(spark, str(tmp_path / "d"), from_json=True)
    stages, names = str(tmp_path / "stages"), {"exclude": ("drop",)}
    first = J.view_clean(data(), stages, **names)
    assert list(first) == ["first_frames"]
    listed = sorted(r["file_id"] for r in first["first_frames"].collect())
    assert listed == ["keep_1_1_000003", "keep_1_2_000003", "keep_2_1_000003", "keep_2_2_000003"]
    labels = tmp_path / "labels.txt"
    labels.write_text("".join(f"{n},{int(not n.startswith('keep_1_1'))}\n" for n in listed))

    from trackloom.sources import labelme as L

    def read_again(*_args):
        raise AssertionError("the records are read again")

    monkeypatch.setattr(L, "read_texts", read_again)
    out = J.view_clean(data(), stages, labels=str(labels), **names)
    assert [tuple(r) for r in out["pairs"].collect()] == [("keep_1", "1")]
    got = {"/".join(r["path"].split("/")[-2:]): json.loads(r["value"]) for r in out["records"].collect()}
    assert sorted(got) == ["keep_1/000003.json", "keep_1/000004.json"] + [f"keep_2/00000{f}.json" for f in (3, 4, 5)]
    assert [s.get("group_id") for s in got["keep_1/000004.json"]["shapes"]] == [2, None]
    before = json.loads((tmp_path / "d" / "keep_2" / "000004.json").read_text())
    assert got["keep_2/000004.json"] == before
    assert out["summary"].first()["shapes_after"] == 9
