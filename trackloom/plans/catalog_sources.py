"""Registered reader, discovery and writer queries and their SQL.

File contents are derived from the tables as texts, so the parsing runs over all of their rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.functions.fields import pad_number
from trackloom.functions.rows import once
from trackloom.operators import align as A
from trackloom.operators import clean as C
from trackloom.operators import datasets as D
from trackloom.operators import profile as P
from trackloom.operators import relabel as E
from trackloom.operators.quantiles import five_numbers
from trackloom.plans.catalog_align import ALIGNED, Pair
from trackloom.plans.catalog_datasets import JUDGED, KEPT, MAX_LEN, REMOVE, SIGMA
from trackloom.plans.catalog_overlap import summary_sql
from trackloom.plans.catalog_profile import SIZES
from trackloom.plans.fixtures import Views, ctes
from trackloom.sources import files as S
from trackloom.sources import labelme as L
from trackloom.sources import sinks as K
from trackloom.sources import tables as R

PADDED = "printf('%06d', frame_idx)"


def record_texts(v: Views):
    """Record of every frame as a JSON text with its path, and beside one in seven a copy that breaks off."""
    records = L.frame_records(v.boxes())
    path = F.concat(
        F.lit("/data/videos/"),
        F.col("video_id"),
        F.lit("/"),
        pad_number(F.col("frame_idx"), 6),
        F.lit(".json"),
    )
    text = F.to_json(F.struct("imagePath", "imageWidth", "imageHeight", "shapes"))
    whole = once(records, path=path, value=text).withColumn("_broken", F.col("frame_idx") % 7 == 3)
    cut = F.struct(F.replace("path", F.lit(".json"), F.lit("_cut.json")).alias("path"), F.left("value", F.lit(20)).alias("value"))
    files = whole.select(F.inline(F.array(F.struct("path", "value"), F.when(F.col("_broken"), cut))))
    return files.where(F.col("path").isNotNull())


def _scan(v: Views):
    boxes = L.to_boxes(L.parse_text(record_texts(v)))
    return boxes.select("video_id", "frame_idx", "pos", "track_id", "action", "x1", "y1", "x2", "y2", "img_w", "img_h")


def _raw(v: Views):
    raw = record_texts(v).select("path", F.try_parse_json("value").alias("raw"))
    image = F.try_variant_get("raw", "$.imagePath", "string")
    return raw.where(F.col("raw").isNotNull()).select(
        "path", image.alias("image"), F.try_variant_get("raw", "$.shapes[0].group_id", "string").alias("first_track")
    )


def _paths(v: Views):
    """Files of several layouts, one image and one record path per order."""
    n = F.col("o_orderkey")
    sample = F.concat(F.lit("s"), (n % 60).cast("string"))
    deep = F.when(n % 60 < 20, F.lit("")).when(n % 60 < 40, F.lit("a/")).otherwise(
        F.when(n % 2 == 0, F.lit("b/c/")).otherwise(F.lit("b/"))
    )
    folder = F.concat(F.lit("/r/videos/"), sample, F.lit("/"), deep)
    ext = F.when(n % 3 == 0, ".jpg").when(n % 3 == 1, ".PNG").otherwise(".txt")
    return v.table("orders").select(
        F.explode(
            F.array(
                F.concat(folder, n.cast("string"), ext),
                F.when(n % 5 != 0, F.concat(folder, n.cast("string"), F.lit(".json"))),
            )
        ).alias("path")
    ).where(F.col("path").isNotNull())


PATHS = (
    "paths",
    """SELECT unnest([concat(folder, n, CASE n % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' ELSE '.txt' END), CASE WHEN n % 5 <> 0 THEN concat(folder, n, '.json') END]) AS path
 FROM (SELECT o_orderkey AS n, concat('/r/videos/s', o_orderkey % 60, '/', CASE WHEN o_orderkey % 60 < 20 THEN '' WHEN o_orderkey % 60 < 40 THEN 'a/'
 WHEN o_orderkey % 2 = 0 THEN 'b/c/' ELSE 'b/' END) AS folder FROM orders)""",
)
DIRS = "SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM paths WHERE {}"
IS_IMAGE = "lower(path) LIKE '%.jpg' OR lower(path) LIKE '%.png'"


def _images(v: Views):
    """Images of the frame view under three names: plain, prefixed, and with another extension."""
    n = F.col("frame_idx")
    name = (
        F.when(n % 3 == 0, F.col("image_name"))
        .when(n % 3 == 1, F.concat(F.lit("img_"), pad_number(n, 5), F.lit(".JPG")))
        .otherwise(F.concat(F.lit("x"), pad_number(n, 6), F.lit("_a.jpeg")))
    )
    return v.frames().select("video_id", "frame_idx", name.alias("image_name"))


def _find(v: Views):
    wanted = v.interactions().select("video_id", "frame_id")
    # Ids of two or more digits never occur inside another frame's padded number.
    return S.find_frames(wanted, _images(v))


def _records(v: Views):
    """Records whose image path is right, stale or blank."""
    n = F.col("frame_idx")
    path = F.when(n % 4 == 0, F.concat(pad_number(n, 6), F.lit(".jpg"))).when(
        n % 4 == 1, F.lit("gone.jpg")
    ).otherwise(F.lit(""))
    return v.bare_boxes().select("video_id", "frame_idx").distinct().select(
        "video_id",
        F.concat(pad_number(n, 6), F.lit(".json")).alias("record_name"),
        path.alias("image_path"),
    )


def _index(v: Views):
    records = v.bare_boxes().select("video_id", "frame_idx").distinct().withColumn(
        "record_name", F.concat(F.lit("r"), F.col("frame_idx").cast("string"), F.lit(".json"))
    )
    return S.frames_index(v.frames(), records)


def _split_lines(v: Views):
    n = F.col("doc_id")
    number = n.cast("string")
    line = (
        F.when(n % 10 == 0, F.lit(" Tube ,label"))
        .when(n % 10 == 1, F.concat(F.lit("  videos/d"), number))
        .when(n % 10 == 2, F.lit(""))
        .when(n % 10 == 3, F.concat(F.lit('"videos/a,'), number, F.lit('", x ,9')))
        .otherwise(F.concat(F.lit("videos/d"), number, F.lit(" , "), F.col("quality").cast("string")))
    )
    return v.table("labels").select("doc_id", line.alias("value"))


def _label_texts(v: Views):
    """A dictionary text per order, in its three forms."""
    n, status = F.col("o_orderkey"), F.col("o_orderstatus")
    quote = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    text = (
        F.when(n % 3 == 0, F.concat(F.lit('["a", '), quote(status), F.lit("]")))
        .when(n % 3 == 1, F.concat(F.lit("{"), quote(n % 50), F.lit(": "), quote(status), F.lit(', "7": "z"}')))
        .otherwise(F.concat(F.lit("{"), quote(F.concat(F.lit("n"), status)), F.lit(": "), (n % 50).cast("string"), F.lit("}")))
    )
    return v.table("orders").select("o_orderkey", text.alias("value"))


def _action_texts(v: Views):
    n = F.col("p_partkey")
    text = F.concat(
        F.lit("item {\n  name: "),
        F.when(n % 2 == 0, F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))).otherwise(F.col("p_name")),
        F.lit("\n  label_id: "),
        n.cast("string"),
        F.lit("\n  label_type: T"),
        F.col("p_size").cast("string"),
        F.lit("\n}\nitem {\n  label_id: 5\n}\nitem {\n name: \"last\"\n label_id: "),
        (n + 1).cast("string"),
    )
    return R.action_blocks(v.table("part").select("p_partkey", text.alias("value")))


def _removals(v: Views):
    n = F.col("o_orderkey")
    video = F.concat(F.lit("v"), (n % 40).cast("string"))
    track = (n % 9).cast("string")
    line = (
        F.when(n % 6 == 0, F.concat(F.lit("# "), video, F.lit(","), track))
        .when(n % 6 == 1, F.concat(video, F.lit("\t"), track))
        .when(n % 6 == 2, video)
        .otherwise(F.concat(F.lit(" "), video, F.lit(" ,, "), track, F.lit(",x")))
    )
    return R.removal_lines(v.table("orders").select(line.alias("value")))


def _classified(v: Views):
    n = F.col("o_orderkey")
    name = F.concat_ws("_", F.lit("v_a"), (n % 40).cast("string"), n.cast("string"))
    line = F.when(n % 8 == 0, F.lit("# none")).when(n % 8 == 1, F.lit("a_b,0")).otherwise(
        F.concat(name, F.lit(" , "), (n % 2).cast("string"))
    )
    return R.classifier_lines(v.table("orders").select("o_orderkey", line.alias("value")))


def _interaction_texts(v: Views):
    from trackloom import schema

    rows = v.table("lineitem").select(
        F.concat(F.lit("v"), F.col("l_orderkey").cast("string")).alias("video_id"),
        pad_number(F.col("l_linenumber"), 4).alias("frame_id"),
        *[
            F.when(F.col("l_linenumber") == 7, F.lit("bad")).otherwise(F.col("l_tax").cast("string")).alias(c)
            for c in schema.INTERACTION_COLUMNS[2:10]
        ],
        F.concat(F.col("l_partkey").cast("string"), F.lit(".0")).alias("action_id"),
        F.col("l_suppkey").cast("string").alias("person_id"),
        F.lit("").alias("instance_id"),
    )
    return R.typed_interactions(rows).select(
        "video_id", "frame_id", "x1", "y2_2", "action_id", "person_id", "instance_id"
    )


def _pair_texts(v: Views):
    p = Pair(v)
    texts = K.pair_records(A.pairs_over(p.ms, p.sh, 0.5), 0.5)
    back = F.from_json("value", "ms_action string, sh_action string, iou double, ms_box array<double>, threshold double")
    return texts.withColumn("_r", back).select(
        "video_id",
        "t",
        "a_pos",
        "b_pos",
        "_r.ms_action",
        "_r.sh_action",
        F.round("_r.iou", 6).alias("iou"),
        "_r.ms_box",
        "_r.threshold",
    )


def _segments(v: Views):
    return v.table("customer").select(F.col("c_mktsegment").alias("label_name"))


def _relabelled(v: Views):
    texts = record_texts(v).where(F.try_parse_json("value").isNotNull())
    changed = E.relabel_records(texts, E.clean_mapping(v.label_map())).where("n_after > 0")
    return L.to_boxes(L.parse_text(changed)).select("video_id", "frame_idx", "track_id", "action", "x1", "y1")


def _one_track(v: Views):
    texts = record_texts(v).where(F.try_parse_json("value").isNotNull())
    return L.to_boxes(L.parse_text(E.keep_track(texts, F.lit("1")))).select(
        "video_id", "frame_idx", "track_id", "action", "x1", "y1"
    )


def _whole_texts(v: Views):
    """The record of every frame with a key and a shape field that no operator reads; none is broken."""
    texts = L.frame_records(v.boxes())
    path = F.concat(F.lit("/data/videos/"), "video_id", F.lit("/"), pad_number(F.col("frame_idx"), 6), F.lit(".json"))
    shapes = F.transform("shapes", lambda s: s.withField("note", F.lit("n")))
    text = F.to_json(F.struct("imagePath", "imageWidth", "imageHeight", shapes.alias("shapes"), F.col("frame_idx").alias("extra")))
    return once(texts, path=path, value=text).select("path", "value")


def _with_path(boxes):
    path = F.concat(F.lit("/data/videos/"), "video_id", F.lit("/"), pad_number(F.col("frame_idx"), 6), F.lit(".json"))
    return boxes.withColumn("path", path)


def _clean_records(v: Views):
    kept = C.clean_boxes(_with_path(v.boxes()), SIGMA, MAX_LEN, bare=v.bare_boxes())
    return L.keep_shapes(_whole_texts(v), kept)


def _remove_records(v: Views):
    kept = C.remove_tubes(_with_path(v.boxes()), v.remove_list())
    return L.keep_shapes(_whole_texts(v), kept, emptied=False)


def record_sql(start: str, kept: str, emptied: bool) -> str:
    """Whole texts of the records of all boxes with the shapes of ``kept`` only."""
    number = "CAST({0}::BIGINT AS VARCHAR)"
    points = "concat('[', " + ", ',', ".join(f"'[', {number.format(x)}, ',', {number.format(y)}, ']'" for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))) + ", ']')"
    shape = (
        "concat('{\"attributes\":{\"action\":\"', action, '\",\"track_id\":\"', track_id, '\"},\"flags\":{},\"group_id\":\"', track_id, '\",\"label\":\"',"
        " CASE WHEN action = '' THEN 'player' ELSE action END, '\",\"note\":\"n\",\"points\":', " + points + ", ',\"shape_type\":\"rectangle\"}')"
    )
    return (
        start
        + f""", left_over AS (SELECT video_id, frame_idx, pos FROM {kept}),
 marked AS (SELECT b.*, l.pos IS NOT NULL AS stays FROM fx_boxes b LEFT JOIN left_over l USING (video_id, frame_idx, pos))
 SELECT concat('/data/videos/', video_id, '/', {PADDED}, '.json') AS path,
 concat('{{"imagePath":"', {PADDED}, '.jpg","imageWidth":1280,"imageHeight":720,"extra":', frame_idx, ',"shapes":[',
 coalesce(string_agg({shape}, ',' ORDER BY pos) FILTER (stays), ''), ']}}') AS value,
 count(*)::INTEGER AS n_before, count(*) FILTER (stays)::INTEGER AS n_after FROM marked GROUP BY video_id, frame_idx"""
        + ("" if emptied else " HAVING count(*) FILTER (stays) > 0")
    )


QUERIES = {
    "clean_records": (_clean_records, record_sql(JUDGED, "kept", True)),
    "remove_records": (_remove_records, record_sql(REMOVE, KEPT, False)),
    "scan_labelme": (
        _scan,
        ctes("fx_boxes")
        + " SELECT video_id, frame_idx, pos, track_id, action, x1, y1, x2, y2, img_w, img_h FROM fx_boxes",
    ),
    "scan_raw": (
        _raw,
        ctes("fx_boxes")
        + f""" SELECT concat('/data/videos/', video_id, '/', {PADDED}, '.json') AS path, concat({PADDED}, '.jpg') AS image, track_id AS first_track
 FROM fx_boxes WHERE pos = 1""",
    ),
    "relabel_records": (
        _relabelled,
        ctes("fx_boxes", "fx_label_map")
        + """ SELECT video_id, frame_idx, track_id, coalesce(label2, action) AS action, x1, y1 FROM fx_boxes LEFT JOIN fx_label_map ON label = action
 WHERE coalesce(label2, 'x') <> ''""",
    ),
    "keep_track": (
        _one_track,
        ctes("fx_boxes")
        + " SELECT video_id, frame_idx, track_id, action, x1, y1 FROM fx_boxes WHERE track_id = '1'",
    ),
    "frame_records": (
        lambda v: L.frame_records(v.boxes()).select(
            "video_id", "frame_idx", "imagePath", F.size("shapes").cast("bigint").alias("n_shapes")
        ),
        ctes("fx_boxes")
        + f" SELECT video_id, frame_idx, concat({PADDED}, '.jpg') AS imagePath, count(*) AS n_shapes FROM fx_boxes GROUP BY ALL",
    ),
    "frame_texts": (
        lambda v: L.frame_records(v.boxes()).select(
            "video_id", "frame_idx", F.to_json(F.struct("imagePath", "imageWidth", "imageHeight", "shapes")).alias("value")
        ),
        ctes("fx_boxes")
        + f""", p AS (SELECT *, concat(x1::BIGINT, '.0') AS a, concat(y1::BIGINT, '.0') AS b, concat(x2::BIGINT, '.0') AS c, concat(y2::BIGINT, '.0') AS d FROM fx_boxes)
 SELECT video_id, frame_idx, concat('{{"imagePath":"', {PADDED}, '.jpg","imageWidth":1280,"imageHeight":720,"shapes":[', string_agg(concat(
 '{{"label":"', CASE WHEN action = '' THEN 'player' ELSE action END, '","points":[[', a, ',', b, '],[', c, ',', b, '],[', c, ',', d, '],[', a, ',', d, ']],"group_id":"', track_id,
 '","shape_type":"rectangle","flags":{{}},"attributes":{{"action":"', action, '","track_id":"', track_id, '"}}}}'), ',' ORDER BY pos), ']}}') AS value FROM p GROUP BY video_id, frame_idx""",
    ),
    "list_samples": (
        lambda v: S.list_samples(_paths(v)),
        ctes(extra=[PATHS])
        + " SELECT DISTINCT regexp_extract(path, '/videos/([^/]+)/', 1) AS video_id FROM paths WHERE path LIKE '%.json'",
    ),
    "leaf_dirs": (
        lambda v: S.leaf_dirs(_paths(v)),
        ctes(extra=[PATHS])
        + ", d AS ("
        + DIRS.format("path LIKE '%.json'")
        + ") SELECT dir FROM d WHERE NOT EXISTS (SELECT 1 FROM d u WHERE starts_with(d.dir, concat(u.dir, '/')))",
    ),
    "sample_dirs": (
        lambda v: S.sample_dirs(_paths(v)),
        ctes(extra=[PATHS])
        + ", d AS ("
        + DIRS.format(IS_IMAGE)
        + ") SELECT dir FROM d WHERE NOT EXISTS (SELECT 1 FROM d u WHERE starts_with(u.dir, concat(d.dir, '/')))",
    ),
    "second_level_dirs": (
        lambda v: S.second_level_dirs(_paths(v), "/r/videos"),
        ctes(extra=[PATHS])
        + """, s AS (SELECT *, string_split(path, '/') AS p FROM paths WHERE path IS NOT NULL),
 deep AS (SELECT DISTINCT concat(p[4], '/', p[5]) AS dir, p[4] AS a FROM s WHERE len(p) > 5)
 SELECT dir FROM deep UNION ALL SELECT DISTINCT p[4] FROM s WHERE len(p) = 5 AND (lower(path) LIKE '%.jpg' OR lower(path) LIKE '%.png') AND p[4] NOT IN (SELECT a FROM deep)""",
    ),
    "frame_manifest": (
        lambda v: S.frame_manifest(_paths(v)),
        ctes(extra=[PATHS])
        + f""" SELECT string_split(path, '/')[-2] AS video_id, string_split(path, '/')[-1] AS image_name,
 CAST(regexp_extract(path, '([0-9]+)[.][^.]*$', 1) AS BIGINT) AS frame_idx FROM paths WHERE {IS_IMAGE}""",
    ),
    "frames_index": (
        _index,
        ctes("fx_boxes", "fx_frames")
        + f""" SELECT f.video_id, f.frame_idx, f.image_name, CASE WHEN b.frame_idx IS NULL THEN concat(printf('%06d', f.frame_idx), '.json') ELSE concat('r', f.frame_idx, '.json') END AS record_name,
 b.frame_idx IS NOT NULL AS has_record FROM fx_frames f LEFT JOIN (SELECT DISTINCT video_id, frame_idx FROM fx_boxes) b USING (video_id, frame_idx)""",
    ),
    "pair_images": (
        lambda v: S.pair_images(_records(v), v.frames().select("video_id", "image_name")),
        ctes("fx_boxes", "fx_frames")
        + f""" SELECT b.video_id, concat({PADDED.replace('frame_idx', 'b.frame_idx')}, '.json') AS record_name, image_name
 FROM (SELECT DISTINCT video_id, frame_idx FROM fx_boxes) b LEFT JOIN fx_frames f USING (video_id, frame_idx)""",
    ),
    "find_frame": (
        _find,
        ctes("fx_interactions", "fx_frames")
        + """, w AS (SELECT DISTINCT video_id, frame_id, frame_id::BIGINT AS n FROM fx_interactions),
 i AS (SELECT video_id, frame_idx, CASE frame_idx % 3 WHEN 0 THEN image_name WHEN 1 THEN concat('img_', printf('%05d', frame_idx), '.JPG')
 ELSE concat('x', printf('%06d', frame_idx), '_a.jpeg') END AS name FROM fx_frames),
 e AS (SELECT w.video_id, w.frame_id, min(name) AS name FROM w JOIN i ON i.video_id = w.video_id AND frame_idx = n AND frame_idx % 3 < 2 GROUP BY ALL),
 l AS (SELECT w.video_id, w.frame_id, min(name) AS name FROM (SELECT * FROM w ANTI JOIN e USING (video_id, frame_id)) w JOIN i ON i.video_id = w.video_id
 AND (contains(name, n::VARCHAR) OR contains(name, frame_id)) GROUP BY ALL)
 SELECT w.video_id, w.frame_id, coalesce(e.name, l.name) AS image_name FROM w LEFT JOIN e USING (video_id, frame_id) LEFT JOIN l USING (video_id, frame_id)""",
    ),
    "split_scan": (
        lambda v: R.split_lines(_split_lines(v)),
        """SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN concat('videos/a,', doc_id) ELSE concat('videos/d', doc_id) END AS path,
 CASE doc_id % 10 WHEN 1 THEN 'unknown' WHEN 3 THEN 'x' ELSE quality::VARCHAR END AS label FROM labels WHERE doc_id % 10 NOT IN (0, 2)""",
    ),
    "label_dim": (
        lambda v: R.label_entries(_label_texts(v)),
        """SELECT o_orderkey, unnest(CASE o_orderkey % 3 WHEN 0 THEN [0, 1] WHEN 1 THEN [o_orderkey % 50, 7] ELSE [o_orderkey % 50] END)::BIGINT AS label_id,
 unnest(CASE o_orderkey % 3 WHEN 0 THEN ['a', o_orderstatus] WHEN 1 THEN [o_orderstatus, 'z'] ELSE [concat('n', o_orderstatus)] END) AS label_name FROM orders
 WHERE NOT (o_orderkey % 3 = 1 AND o_orderkey % 50 = 7)
 UNION ALL SELECT o_orderkey, 7, 'z' FROM orders WHERE o_orderkey % 3 = 1 AND o_orderkey % 50 = 7""",
    ),
    "action_dim": (
        _action_texts,
        """SELECT p_partkey, p_partkey AS action_id, p_name AS action_name, concat('T', p_size) AS label_type FROM part
 UNION ALL SELECT p_partkey, p_partkey + 1, 'last', NULL FROM part""",
    ),
    "remove_list": (
        _removals,
        "SELECT DISTINCT concat('v', o_orderkey % 40) AS video_id, (o_orderkey % 9)::VARCHAR AS track_id FROM orders WHERE o_orderkey % 6 NOT IN (0, 2)",
    ),
    "classifier_lines": (
        _classified,
        """SELECT o_orderkey, 'v_a' AS video_id, (o_orderkey % 40)::VARCHAR AS track_id, o_orderkey::VARCHAR AS frame_id, (o_orderkey % 2)::VARCHAR AS label
 FROM orders WHERE o_orderkey % 8 > 1""",
    ),
    "zero_pairs": (
        lambda v: R.zero_pairs(_classified(v)),
        "SELECT 'v_a' AS video_id, (o_orderkey % 40)::VARCHAR AS track_id FROM orders WHERE o_orderkey % 8 > 1 AND o_orderkey % 2 = 0",
    ),
    "hhi_scan": (
        _interaction_texts,
        """SELECT concat('v', l_orderkey) AS video_id, printf('%04d', l_linenumber::BIGINT) AS frame_id, CASE WHEN l_linenumber <> 7 THEN l_tax END AS x1,
 CASE WHEN l_linenumber <> 7 THEN l_tax END AS y2_2, l_partkey AS action_id, l_suppkey AS person_id, NULL::BIGINT AS instance_id FROM lineitem""",
    ),
    "labels_text": (
        lambda v: K.labels_text(D.label_names(_segments(v))),
        """SELECT concat('{', string_agg(concat('"', n, '":"', label_name, '"'), ',' ORDER BY n), '}') AS value
 FROM (SELECT label_name, row_number() OVER (ORDER BY label_name) - 1 AS n FROM (SELECT DISTINCT c_mktsegment AS label_name FROM customer))""",
    ),
    "action_text": (
        lambda v: K.action_text(
            v.table("part").select(
                F.col("p_partkey").alias("action_id"),
                F.col("p_name").alias("action_name"),
                F.when(F.col("p_size") > 25, F.lit("BIG")).alias("label_type"),
            )
        ),
        """SELECT p_partkey AS action_id, concat('item {', chr(10), '  name: "', p_name, '"', chr(10), '  label_id: ', p_partkey, chr(10), '  label_type: ',
 CASE WHEN p_size > 25 THEN 'BIG' ELSE 'PERSON_INTERACTION' END, chr(10), '}') AS value FROM part""",
    ),
    "pairs_jsonl": (
        _pair_texts,
        ALIGNED
        + """ SELECT p.video_id, p.t, a_pos, b_pos, a_action AS ms_action, b_action AS sh_action, round(iou, 6) AS iou, [m.x1, m.y1, m.x2, m.y2] AS ms_box, 0.5::DOUBLE AS threshold
 FROM cross_pairs p JOIN ms m ON m.video_id = p.video_id AND m.t = p.t AND m.pos = p.a_pos WHERE iou > 0.5""",
    ),
    "report_actions": (
        lambda v: K.list_report(P.action_distribution(v.bare_boxes()), "Actions", "action").select("line"),
        ctes("fx_boxes")
        + " SELECT '## Actions' AS line UNION ALL SELECT concat('- ', CASE WHEN action = '' THEN '__unknown__' ELSE action END, ': ', count(*)) FROM fx_boxes GROUP BY action",
    ),
    "report_sizes": (
        lambda v: K.quantile_lines(five_numbers(v.bare_boxes(), [], P.box_sizes())),
        ctes("fx_boxes")
        + ", s AS ("
        + " UNION ALL ".join(f"SELECT {summary_sql(e, n)} FROM fx_boxes" for n, e in SIZES.items())
        + ") SELECT metric, printf('- %s: min=%.4f, p25=%.4f, mean=%.4f, p75=%.4f, max=%.4f', metric, min, p25, mean, p75, max) AS line FROM s",
    ),
}
