"""Alignment search statuses, contiguous runs and endings."""

from trackloom.operators import align as A

PIXELS = "video_id string, frame_idx bigint, file string, pixels array<double>"


def test_search_statuses(spark):
    ms = [
        ("ok", 3, "3.jpg", [9.0, 9.0]), ("ok", 4, "4.jpg", [1.0, 1.5]), ("ok", 5, "5.jpg", [1.0, 1.0]),
        ("far", 3, "3.jpg", [9.0]), ("far", 4, "4.jpg", [7.0]),
        ("size", 3, "3.jpg", [1.0, 2.0, 3.0]),
        ("apart", 1, "1.jpg", [1.0]), ("unread", 1, "1.jpg", [1.0]), ("ms_only", 1, "1.jpg", [1.0]),
    ]
    sh = [
        ("ok", 3, "3.jpg", [1.0, 1.0]), ("far", 3, "3.jpg", [1.0]), ("size", 3, "3.jpg", [1.0]),
        ("apart", 2, "2.jpg", [1.0]), ("unread", 1, "1.jpg", None),
    ]
    got = {r["video_id"]: r for r in A.align_search(*(spark.createDataFrame(x, PIXELS) for x in (ms, sh)), 0.5).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "ok": "ok", "far": "no_below_threshold", "size": "no_match", "apart": "no_common_index",
        "unread": "sh_read_fail", "ms_only": "missing_frames",
    }
    # The first hit wins although a later frame is closer.
    assert (got["ok"]["ms_index"], got["ok"]["k"], got["ok"]["mean"]) == (4, 1, 0.25)
    assert (got["far"]["ms_index"], got["far"]["k"]) == (4, 1)
    two = [("far", 3, "3.jpg", [9.0]), ("far", 5, "5.jpg", [7.0])]
    for max_k, want in ((1, 3), (2, 5), (0, 5), (None, 5)):
        sides = (spark.createDataFrame(x, PIXELS) for x in (two, sh[1:2]))
        assert A.align_search(*sides, 0.5, max_k=max_k).first()["ms_index"] == want


def test_runs_and_endings(spark):
    frames = "video_id string, frame_idx bigint"
    ms = spark.createDataFrame([("a", f) for f in (3, 4, 5, 7)] + [("b", f) for f in (3, 4)] + [("c", 9)], frames)
    sh = spark.createDataFrame([("a", f) for f in (1, 2, 3, 4, 5)] + [("b", f) for f in (1, 2)] + [("c", 9)], frames)
    alignment = spark.createDataFrame(
        [(v, 1, 3, "ok") for v in "abcd"], "video_id string, sh_index bigint, ms_index bigint, status string"
    )
    run = A.common_run(alignment, ms, sh)
    assert sorted(tuple(r) for r in run.collect()) == [
        ("a", 0, 3, 1), ("a", 1, 4, 2), ("a", 2, 5, 3), ("b", 0, 3, 1), ("b", 1, 4, 2),
    ]
    assert A.common_run(alignment, ms, sh, max_frames=1).count() == 2
    got = {r["video_id"]: tuple(r)[1:] for r in A.endings(alignment, ms, sh).collect()}
    assert got == {"a": ("ms", 3, 3, 5, 0, 2), "b": ("tie", 2, 2, 2, 0, 0), "c": ("unknown", 0, 0, 0, 0, 0)}
