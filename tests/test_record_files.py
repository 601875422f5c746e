"""Records as files of their own, and category documents, against plain loops."""

import json
import random
from pathlib import Path

import pytest

from trackloom.operators import coco
from trackloom.plans import commands as J
from trackloom.sources import record_files as W


def tree(root):
    return {str(p.relative_to(root)): p.read_text() for p in Path(root).rglob("*") if p.is_file()}


def test_one_file_per_row(spark, tmp_path):
    rows = [(f"/in/s{i % 7}/json/{i:05d}.json", f'{{"n": {i}, "t": "é\n"}}') for i in range(2500)] + [("file:/in/a%20b+c/1.json", "x"), ("/in/e/2.json", None)]
    df = spark.createDataFrame(rows, "path string, value string").repartition(5)
    W.write_record_files(df, str(tmp_path / "out"))
    want = {f"s{i % 7}/json/{i:05d}.json": f'{{"n": {i}, "t": "é\n"}}' for i in range(2500)} | {"a b+c/1.json": "x", "e/2.json": ""}
    assert tree(tmp_path / "out") == want
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(Exception, match="is there already"):
        W.write_record_files(df, str(tmp_path / "out"))
    assert tree(tmp_path / "out") == want


def test_no_rows_make_an_empty_folder(spark, tmp_path):
    W.write_record_files(spark.createDataFrame([], "path string, value string"), str(tmp_path / "out"))
    assert (tmp_path / "out").is_dir() and tree(tmp_path / "out") == {}


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(W.RecordFiles)
    rows = [(f"s/{i}.json", "x") for i in range(3000)] + [("../escape.json", "x")]
    df = spark.createDataFrame(rows, "path string, value string").repartition(4)
    with pytest.raises(Exception, match="below the output folder"):
        df.write.format("record_files").mode("append").save(str(tmp_path / "out"))
    assert list(tmp_path.iterdir()) == []


def test_two_records_of_one_name_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("/a/s/1.json", "x"), ("/b/s/1.json", "y")], "path string, value string")
    with pytest.raises(ValueError, match="s/1.json"):
        W.write_record_files(df, str(tmp_path / "out"))
    assert list(tmp_path.iterdir()) == []


def test_an_attempt_that_runs_again_writes_the_same_files(tmp_path):
    writer = W.RecordFilesWriter(str(tmp_path / "out"))
    rows = [(f"s/{i}.json", str(i)) for i in range(10)]
    with pytest.raises(ZeroDivisionError):
        writer.write(row if k < 7 else 1 / 0 for k, row in enumerate(rows))
    assert not (tmp_path / "out").exists()
    writer.commit([writer.write(iter(rows)), writer.write(iter(rows[:3]))])
    assert tree(tmp_path / "out") == {f"s/{i}.json": str(i) for i in range(10)}
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def record(f, actions):
    shapes = [{"label": "p", "points": [[0, 0], [4, 4]], "group_id": k, "attributes": {"action": a}} for k, a in enumerate(actions)]
    return {"imagePath": f"{f}.jpg", "imageWidth": 64, "imageHeight": 48, "note": [1, None], "shapes": shapes}


def test_jobs_write_record_files(spark, tmp_path, monkeypatch):
    from trackloom import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda *a: spark)
    before = {f"v{v}/{f:06d}.json": record(f, ["run", "hit"][: 1 + (f != 3)]) for v in (1, 2) for f in range(1, 7)}
    for name, text in before.items():
        (tmp_path / "d" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "d" / name).write_text(json.dumps(text))
    (tmp_path / "rm.txt").write_text("v1,0\n")
    cli.main(["remove-tubes", str(tmp_path / "d"), "--json", "--files", "--out", str(tmp_path / "o"), "--set", f"listed={tmp_path / 'rm.txt'}"])
    got = {n: json.loads(t) for n, t in tree(tmp_path / "o" / "records").items()}
    want = {}
    for name, text in before.items():
        left = [s for s in text["shapes"] if not (name.startswith("v1/") and s["group_id"] == 0)]
        if left:
            want[name] = text | {"shapes": left}
    assert got == want and "v1/000003.json" not in got
    assert spark.read.parquet(str(tmp_path / "o" / "summary")).count() == 1
    cli.main(["clean-json", str(tmp_path / "d"), "--json", "--files", "--out", str(tmp_path / "c"), "--set", "sigma=50.0", "--set", "max_len=3"])
    cleaned = {n: json.loads(t) for n, t in tree(tmp_path / "c" / "records").items()}
    # "run" is one tube of six frames; "hit" has two tubes of two and three.
    assert cleaned == {n: r | {"shapes": [s for s in r["shapes"] if s["attributes"]["action"] == "hit"]} for n, r in before.items()}


def relabel_loop(document, mapping):
    names, at = {}, []
    for category in document["categories"]:
        names[int(category["id"])] = str(category.get("name") or "").strip()
        if int(category["id"]) not in at:
            at.append(int(category["id"]))
    new = {i: mapping.get(names[i], names[i]) for i in at}
    order = list(dict.fromkeys(n for n in new.values() if n))
    kept = [
        {k: v for k, v in a.items() if k != "category_id"} | {"category_id": order.index(new[a["category_id"]]) + 1}
        for a in document["annotations"]
        if new.get(a.get("category_id"))
    ]
    listed = [{"id": k, "name": n} for k, n in enumerate(order, 1)]
    return document | {"annotations": kept, "categories": listed}


def documents():
    draw = random.Random(8)
    out = {}
    for d in range(12):
        ids = draw.sample(range(1, 40), 8)
        categories = [{"id": i, "name": draw.choice([" run", "hit", "walk ", "jump", "", "a, \"b\""]), "supercategory": "x"} for i in ids]
        categories += [{"id": ids[2], "name": "late"}]
        notes = [{"id": n, "category_id": draw.choice([*ids, 99]), "bbox": [n, 2.5], "extra": {"k": None}} for n in range(draw.choice([0, 5, 3000 if d == 4 else 40]))]
        notes += [{"id": -1}]
        out[f"/in/s/{d}.json"] = {"info": {"y": 1}, "images": [{"file_name": "é.jpg"}], "annotations": notes, "categories": categories}
    out["/in/s/only.json"] = {"annotations": [{"id": 1, "category_id": 3}], "categories": []}
    return out


@pytest.mark.parametrize("piece", [7, 1024])
def test_category_documents(spark, piece):
    mapping = {"run": "move", "walk": "move", "hit": "", "late": "jump"}
    given = documents()
    texts = spark.createDataFrame([(n, json.dumps(d)) for n, d in given.items()], "path string, value string").repartition(3)
    names = spark.createDataFrame(list(mapping.items()), "label string, label2 string")
    got = {r["path"]: r for r in coco.relabel_documents(texts, names, piece=piece).collect()}
    assert got.keys() == given.keys()
    for name, document in given.items():
        want = relabel_loop(document, mapping)
        assert json.loads(got[name]["value"]) == want
        assert (got[name]["n_before"], got[name]["n_after"]) == (len(document["annotations"]), len(want["annotations"]))


def test_convert_job_takes_both_formats(spark, tmp_path):
    folder = tmp_path / "d" / "s"
    folder.mkdir(parents=True)
    some = {n.rsplit("/", 1)[1]: d for n, d in documents().items()}
    frames = {"f1.json": record(1, ["run", "hit"]), "f2.json": record(2, ["hit"]), "f3.json": record(3, []), "other.json": {"a": 1}}
    for name, text in (some | frames).items():
        (folder / name).write_text(json.dumps(text))
    (folder / "broken.json").write_text('{"shapes": [')
    (tmp_path / "map.csv").write_text("label,label2\nhit,\nrun,move\n")
    out = J.convert_records(J.Dataset(spark, str(tmp_path / "d"), from_json=True), str(tmp_path / "map.csv"))
    W.write_record_files(out["records"], str(tmp_path / "o"))
    got = {n: json.loads(t) for n, t in tree(tmp_path / "o").items()}
    want = {f"s/{n}": relabel_loop(d, {"hit": "", "run": "move"}) for n, d in some.items()}
    want |= {"s/f1.json": record(1, ["move"]), "s/other.json": {"a": 1}}
    assert got == want
    summary = out["summary"].first()
    assert (summary["files"], summary["files_deleted"]) == (len(some) + 4, 1)
    assert summary["annotations_before"] == 3 + sum(len(d["annotations"]) for d in some.values())


def test_category_documents_are_parsed_once(spark):
    from trackloom.operators import coco

    texts = spark.createDataFrame([("a", '{"annotations":[],"categories":[]}')], "path string, value string")
    names = spark.createDataFrame([("a", "A")], "label string, label2 string")
    plan = coco.relabel_documents(texts, names)._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("from_json("), plan.count("Join ")) == (1, 0)
