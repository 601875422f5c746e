"""Registered queries against their SQL on the smallest data; all of them with TRACKLOOM_ALL=1."""

import os

import pytest

from trackloom.plans import registry
from comparison import compare, connect

SF = os.environ.get("TRACKLOOM_SF", "/root/testdata/sf0.001")
CORE = (
    "pair_iou overlap_by_action iou_summary overlap_degree sudden_changes bbox_quantiles analyze_dirs "
    "majority_label tubes_fixed tubes_dedup tubes_annotated tube_outliers gap_report fpswin_mask "
    "fpswin_shapes crop_plan context_frames clean_json split_std merge_datasets coco_remap xds_summary "
    "endings align_search merge_aligned hhi_bbox balanced tube_explode tube_ids scan_labelme find_frame"
).split()
NAMES = list(registry.queries()) if os.environ.get("TRACKLOOM_ALL") else CORE


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    ok, message = compare(spark, duck, SF, name, registry.queries()[name], registry.oracle_sql().get(name))
    assert ok, message


def test_every_sql_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()
