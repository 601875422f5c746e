"""Registered cleaning, relabelling, split and merge queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.functions.rows import once
from trackloom.operators import clean as C
from trackloom.operators import coco as Q
from trackloom.operators import datasets as D
from trackloom.operators import relabel as R
from trackloom.operators.ordering import frame_chunk
from trackloom.operators.tubes import KEY as TUBE
from trackloom.plans.catalog_tubes import DEDUP, KEY
from trackloom.plans.fixtures import Views, ctes

SIGMA, MAX_LEN = 1.5, 6
JUDGED = (
    DEDUP
    + f""", lim AS (SELECT avg(x2 - x1) + {SIGMA} * stddev_pop(x2 - x1) AS wt, avg(y2 - y1) + {SIGMA} * stddev_pop(y2 - y1) AS ht
 FROM fx_boxes WHERE x2 > x1 AND y2 > y1),
 judged AS (SELECT s.*, CASE WHEN s.length > {MAX_LEN} AND lower(action) NOT IN ('hold', 'noball') THEN 'length'
 WHEN EXISTS (SELECT 1 FROM fx_boxes b, lim WHERE b.video_id = s.video_id AND b.track_id = s.track_id AND b.action = s.action
 AND b.frame_idx BETWEEN s.start_f AND s.end_f AND (b.x2 - b.x1 > wt OR b.y2 - b.y1 > ht)) THEN 'bigbox' END AS reason FROM seg s),
 kept AS (SELECT b.* FROM fx_boxes b WHERE NOT EXISTS (SELECT 1 FROM judged s WHERE reason IS NOT NULL AND s.video_id = b.video_id
 AND s.track_id = b.track_id AND s.action = b.action AND b.frame_idx BETWEEN s.start_f AND s.end_f))"""
)
REMOVE = ctes("fx_boxes", "fx_remove_list")
KEPT = "(SELECT b.* FROM fx_boxes b ANTI JOIN fx_remove_list USING (video_id, track_id))"
MAP = ctes("fx_boxes", "fx_label_map")
RELABELLED = """(SELECT b.video_id, b.frame_idx, b.pos, CASE WHEN b.action <> '' THEN coalesce(m.label2, b.action) ELSE '' END AS action,
 'player' AS label FROM fx_boxes b LEFT JOIN fx_label_map m ON m.label = b.action
 WHERE NOT (b.action <> '' AND coalesce(m.label2, b.action) = ''))"""


def _labelled(v: Views):
    return v.boxes().withColumn("label", F.lit("player")).select(
        "video_id", "frame_idx", "pos", "action", "label"
    )


def _judged(v: Views):
    _frames, segments = C.judged_segments(v.bare_boxes(), SIGMA, MAX_LEN)
    return segments.select(*TUBE, "start_f", "end_f", "length", "reason")


def _categories(v: Views):
    """Category tables per video: one category per (action, track), so names repeat."""
    found = v.bare_boxes().select("video_id", "action", "track_id").distinct()
    code = F.ascii("action").cast("bigint") * 10 + F.col("track_id").cast("bigint")
    return found.select(
        F.col("video_id").alias("doc_id"),
        code.alias("pos"),
        code.alias("category_id"),
        F.concat(F.lit(" "), F.col("action")).alias("name"),
    )


CATEGORIES = (
    "cats",
    "SELECT DISTINCT video_id AS doc_id, CASE WHEN action = '' THEN 0 ELSE ascii(action) END * 10 + track_id::BIGINT AS category_id, action AS name FROM fx_boxes",
)
REMAPPED = (
    "remapped",
    """SELECT doc_id, category_id, new_name, dense_rank() OVER (PARTITION BY doc_id ORDER BY first_at) AS new_id FROM
 (SELECT c.doc_id, c.category_id, coalesce(m.label2, c.name) AS new_name,
 min(c.category_id) OVER (PARTITION BY c.doc_id, coalesce(m.label2, c.name)) AS first_at
 FROM cats c LEFT JOIN fx_label_map m ON m.label = c.name WHERE coalesce(m.label2, c.name) <> '')""",
)


def _remap(v: Views):
    return R.remap_categories(_categories(v), R.clean_mapping(v.label_map()))


def _remap_boxes(v: Views):
    code = F.ascii("action").cast("bigint") * 10 + F.col("track_id").cast("bigint")
    annotations = v.boxes().select(
        F.col("video_id").alias("doc_id"), "frame_idx", "pos", code.alias("category_id")
    )
    return R.remap_annotations(annotations, _remap(v))


# Categories of the document of a frame, in two orders; "shoot" is there twice, one name is blank.
EVEN = '[{"id":3,"name":"shoot"},{"id":1,"name":" hold "},{"id":7,"name":"pass"},{"id":9,"name":"shoot"},{"id":5,"name":""}]'
ODD = '[{"id":7,"name":"pass","x":1},{"id":9,"name":"shoot"},{"id":5,"name":" "},{"id":1,"name":"hold"},{"id":3,"name":"shoot"}]'
CODE = "CASE action WHEN 'shoot' THEN 3 + 6 * (track_id::BIGINT % 2) WHEN 'hold' THEN 1 WHEN 'pass' THEN 7 ELSE 5 + 94 * (track_id::BIGINT % 2) END"


def _category_documents(v: Views):
    """A category document for every frame."""
    odd = F.col("track_id").cast("bigint") % 2
    code = (
        F.when(F.col("action") == "shoot", 3 + 6 * odd).when(F.col("action") == "hold", 1).when(F.col("action") == "pass", 7).otherwise(5 + 94 * odd)
    )
    note = F.struct(F.col("pos").alias("id"), code.alias("category_id"), F.array(*[F.col(c).cast("bigint") for c in ("x1", "y1", "x2", "y2")]).alias("bbox"))
    # Grouped by chunk as well, so the boxes stay where they were dealt.
    notes = v.boxes().groupBy("video_id", frame_chunk("frame_idx"), "frame_idx").agg(F.sort_array(F.collect_list(note)).alias("_notes"))
    categories = F.when(F.col("frame_idx") % 2 == 0, EVEN).otherwise(ODD)
    text = F.concat(F.lit('{"info":{"n":'), F.col("frame_idx").cast("string"), F.lit('},"annotations":'), F.to_json("_notes"), F.lit(',"categories":'), categories, F.lit("}"))
    return once(notes, path=F.concat_ws("/", "video_id", F.col("frame_idx").cast("string")), value=text).select("path", "value")


def _formats(v: Views):
    """JSON texts of several forms made from the documents."""
    n = F.col("doc_id") % 5
    body = F.to_json(F.struct(F.col("text").alias("note")))
    text = (
        F.when(n == 0, F.concat(F.lit('{"shapes": [], "x": '), body, F.lit("}")))
        .when(n == 1, F.concat(F.lit('{"annotations": [1], "categories": [], "x": '), body, F.lit("}")))
        .when(n == 2, F.concat(F.lit('{"shapes": 3, "x": '), body, F.lit("}")))
        .when(n == 3, body)
        .otherwise(F.col("text"))
    )
    return v.table("documents").select("doc_id", R.detect_format(text).alias("format"))


def _mapping_rows(v: Views):
    """Mapping rows from the order table: repeated labels, blanks and spaces."""
    n = F.col("o_orderkey")
    return v.table("orders").select(
        n.alias("row_no"),
        F.when(n % 11 == 0, F.lit(" "))
        .when(n % 13 == 0, F.lit("nan"))
        .otherwise(F.concat(F.lit(" k"), (n % 97).cast("string"), F.lit(" ")))
        .alias("label"),
        F.when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("t"), n.cast("string"))).alias("label2"),
    )


MAPPING_ROWS = (
    "rows",
    """SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'nan' ELSE concat('k', o_orderkey % 97) END AS label,
 CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat('t', o_orderkey) END AS label2 FROM orders""",
)

# Two inputs whose label spaces differ; the second repeats a part of the first.
PART = "CAST(regexp_extract(path, '([0-9]+)$', 1) AS BIGINT) % 3 <> 0"
LISTINGS = (
    "listings",
    f"""SELECT 1 AS input_no, split, path, label FROM fx_splits
 UNION ALL SELECT 2, split, replace(path, 'doc', CASE WHEN label = '1' THEN 'two' ELSE 'doc' END), CASE WHEN label = '1' THEN 'tox' ELSE '5' END FROM fx_splits WHERE {PART}
 UNION ALL SELECT 2, 'test', concat('other/', path), '99' FROM fx_splits""",
)
DIMS = (
    "dims",
    "SELECT 1 AS input_no, label_id, label_name FROM fx_labels_dict UNION ALL SELECT * FROM (VALUES (2, 5, 'low'), (2, 6, 'tox')) AS t(input_no, label_id, label_name)",
)


def _listings(v: Views):
    one = v.splits()
    number = F.regexp_extract("path", "([0-9]+)$", 1).cast("bigint")
    toxic = F.col("label") == "1"
    two = one.where(number % 3 != 0).select(
        "split",
        F.replace("path", F.lit("doc"), F.when(toxic, "two").otherwise("doc")).alias("path"),
        F.when(toxic, "tox").otherwise("5").alias("label"),
    )
    odd = one.select(
        F.lit("test").alias("split"),
        F.concat(F.lit("other/"), F.col("path")).alias("path"),
        F.lit("99").alias("label"),
    )
    parts = [d.withColumn("input_no", F.lit(n)) for n, d in ((1, one), (2, two), (2, odd))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.withColumn("row_no", F.concat_ws("|", "path", "label"))


def _dims(v: Views):
    two = v.spark.sql(
        "SELECT * FROM VALUES (2, 5, 'low'), (2, 6, 'tox') AS t(input_no, label_id, label_name)"
    )
    return v.labels_dict().withColumn("input_no", F.lit(1)).unionByName(two)


NORM = "concat('videos/', regexp_extract(path, '([^/]*)$', 1))"
SHARES = "round_even(0.8::DOUBLE * n, 0) AS a, round_even(0.8::DOUBLE * n, 0) + round_even(0.1::DOUBLE * n, 0) AS b"


def ranked_split(rows: str, key: str, columns: str) -> str:
    return (
        f" SELECT {columns}, CASE WHEN rk <= a THEN 'train' WHEN rk <= b THEN 'val' ELSE 'test' END AS split FROM"
        f" (SELECT *, {SHARES} FROM (SELECT *, row_number() OVER (ORDER BY md5(concat({key}, '#42')), {key}) AS rk, count(*) OVER () AS n FROM ({rows})))"
    )


def _files(v: Views):
    """File names per action and sample: an image and a record per frame, some names repeated."""
    base = v.frames().select(
        F.when(F.col("frame_idx") % 2 == 0, "a").otherwise("a__b").alias("dataset"),
        F.when(F.col("frame_idx") % 2 == 0, "b__c").otherwise("c").alias("action"),
        F.col("video_id").alias("sample"),
        (F.col("frame_idx") - F.col("frame_idx") % 2).alias("n"),
    )
    image = F.concat(F.col("n").cast("string"), F.when(F.col("n") % 3 == 0, ".png").otherwise(".jpg"))
    record = F.concat(F.col("n").cast("string"), F.lit(".json"))
    return base.select("dataset", "action", "sample", F.explode(F.array(image, record)).alias("file")).distinct()


FLAT = (
    "files",
    """SELECT DISTINCT dataset, action, sample, unnest([concat(n, CASE WHEN n % 3 = 0 THEN '.png' ELSE '.jpg' END), concat(n, '.json')]) AS file FROM
 (SELECT CASE WHEN frame_idx % 2 = 0 THEN 'a' ELSE 'a__b' END AS dataset, CASE WHEN frame_idx % 2 = 0 THEN 'b__c' ELSE 'c' END AS action,
 video_id AS sample, frame_idx - frame_idx % 2 AS n FROM fx_frames)""",
)


def _subset(v: Views):
    """Coverage subset over small samples (one per order), whose action sets differ."""
    samples = v.bare_boxes().select(
        F.concat(F.col("video_id"), F.lit("_"), F.col("frame_idx").cast("string")).alias("video_id"),
        F.concat_ws("_", F.nullif(F.col("action"), F.lit("")), "track_id").alias("action"),
    )
    picked = D.cover_subset(samples, 4)
    rows = [(i, name) for i, name in enumerate(picked, 1)]
    chosen = v.spark.createDataFrame(rows, "pick int, sample string")
    actions = samples.groupBy(F.col("video_id").alias("sample")).agg(
        F.count_distinct("action").alias("actions"), F.count(F.lit(1)).alias("boxes")
    )
    return chosen.join(actions, "sample")


# One pick per step; ``had`` has the actions of all picks, ``done`` those that four picks have.
COVER = (
    ctes("fx_boxes").replace("WITH ", "WITH RECURSIVE ", 1)
    + """, c AS (SELECT sample, list_distinct(list(act)) AS acts, count(*) AS boxes FROM
 (SELECT concat(video_id, '_', frame_idx) AS sample, concat_ws('_', nullif(action, ''), track_id) AS act FROM fx_boxes) GROUP BY 1),
 g(pick, sample, picked, had, done) AS (SELECT 0, '', []::VARCHAR[], []::VARCHAR[], []::VARCHAR[] UNION ALL
 SELECT pick + 1, sample, list_append(picked, sample), had, list_filter(had, lambda a: len(list_filter(had, lambda h: h = a)) >= 4) FROM
 (SELECT g.pick, g.picked, c.sample, list_concat(g.had, c.acts) AS had FROM g JOIN c ON NOT list_contains(g.picked, c.sample)
 WHERE len(list_filter(c.acts, lambda a: NOT list_contains(g.done, a))) > 0
 QUALIFY row_number() OVER (ORDER BY len(list_filter(c.acts, lambda a: NOT list_contains(g.done, a))) DESC, len(c.acts) DESC, c.sample) = 1))
 SELECT g.pick, g.sample, len(acts) AS actions, boxes FROM g JOIN c USING (sample)"""
)


def _flat(v: Views):
    return D.flatten_names(_files(v))


QUERIES = {
    "clean_segments": (
        _judged,
        JUDGED + f" SELECT {KEY}, start_f, end_f, length, reason FROM judged",
    ),
    "clean_json": (
        lambda v: C.clean_boxes(v.boxes(), SIGMA, MAX_LEN).select("video_id", "frame_idx", "pos", *TUBE[1:]),
        JUDGED + " SELECT video_id, frame_idx, pos, track_id, action FROM kept",
    ),
    "clean_summary": (
        lambda v: C.clean_summary(v.bare_boxes(), SIGMA, MAX_LEN),
        JUDGED
        + """ SELECT count(*) AS num_segments_total, count(*) FILTER (reason = 'length') AS removed_by_length,
 count(*) FILTER (reason = 'bigbox') AS removed_by_bigbox, count(*) FILTER (reason IS NULL) AS kept_segments,
 (SELECT count(*) FROM fx_boxes) AS shapes_before, (SELECT count(*) FROM kept) AS shapes_after FROM judged""",
    ),
    "remove_tubes": (
        lambda v: C.remove_tubes(v.boxes(), v.remove_list()).select("video_id", "frame_idx", "pos", "track_id"),
        REMOVE + f" SELECT video_id, frame_idx, pos, track_id FROM {KEPT}",
    ),
    "remove_tubes_summary": (
        lambda v: C.remove_tubes_summary(v.bare_boxes(), v.remove_list()),
        REMOVE
        + f""" SELECT count(DISTINCT (video_id, frame_idx)) AS frames_before, count(*) AS shapes_before,
 (SELECT count(DISTINCT (video_id, frame_idx)) FROM {KEPT}) AS frames_after, (SELECT count(*) FROM {KEPT}) AS shapes_after,
 count(DISTINCT video_id) AS samples, (SELECT count(DISTINCT video_id) FROM fx_remove_list) AS affected_samples FROM fx_boxes""",
    ),
    "filter_std": (
        lambda v: C.filter_samples(
            v.frames().select("video_id").distinct(), ["v00", "v03"], ["v007"]
        ),
        ctes("fx_frames")
        + """ SELECT DISTINCT video_id, (video_id LIKE 'v00%' OR video_id LIKE 'v03%') AND video_id NOT LIKE 'v007%' AS kept FROM fx_frames""",
    ),
    "label_map": (
        lambda v: R.clean_mapping(_mapping_rows(v), "row_no"),
        ctes(extra=[MAPPING_ROWS])
        + " SELECT label, arg_max(label2, row_no) AS label2 FROM rows WHERE label NOT IN ('', 'nan', 'None') GROUP BY 1",
    ),
    "label_rewrite": (
        lambda v: R.relabel(_labelled(v), R.clean_mapping(v.label_map())),
        MAP + f" SELECT * FROM {RELABELLED}",
    ),
    "convert_std": (
        lambda v: R.relabel_summary(_labelled(v), R.clean_mapping(v.label_map())),
        MAP
        + f""", b AS (SELECT video_id, frame_idx, count(*) AS n FROM fx_boxes GROUP BY ALL),
 a AS (SELECT video_id, frame_idx, count(*) AS m FROM {RELABELLED} GROUP BY ALL),
 v AS (SELECT video_id, count(*) AS files, count(*) FILTER (m IS NULL) AS deleted, sum(n) AS n, sum(m) AS m FROM b LEFT JOIN a USING (video_id, frame_idx) GROUP BY 1)
 SELECT count(*) AS samples_total, count(*) FILTER (deleted < files) AS samples_converted, count(*) FILTER (deleted = files) AS samples_deleted_after,
 sum(files)::BIGINT AS json_files_total, sum(deleted)::BIGINT AS json_files_deleted, sum(n)::BIGINT AS annotations_before, sum(m)::BIGINT AS annotations_after FROM v""",
    ),
    "coco_categories": (
        _remap,
        ctes("fx_boxes", "fx_label_map", extra=[CATEGORIES, REMAPPED]) + " SELECT * FROM remapped",
    ),
    "coco_remap": (
        _remap_boxes,
        ctes("fx_boxes", "fx_label_map", extra=[CATEGORIES, REMAPPED])
        + """ SELECT b.video_id AS doc_id, b.frame_idx, b.pos, r.new_id AS category_id FROM fx_boxes b JOIN remapped r
 ON r.doc_id = b.video_id AND r.category_id = CASE WHEN action = '' THEN 0 ELSE ascii(action) END * 10 + track_id::BIGINT""",
    ),
    "coco_records": (
        lambda v: Q.relabel_documents(_category_documents(v), R.clean_mapping(v.label_map())),
        ctes("fx_boxes")
        + f""", notes AS (SELECT video_id, frame_idx, pos, x1, y1, x2, y2, CASE WHEN code IN (3, 9) THEN CASE WHEN frame_idx % 2 = 0 THEN 1 ELSE 2 END
 WHEN code = 7 THEN CASE WHEN frame_idx % 2 = 0 THEN 2 ELSE 1 END END AS new FROM (SELECT *, {CODE} AS code FROM fx_boxes))
 SELECT concat(video_id, '/', frame_idx) AS path, concat('{{"info":{{"n":', frame_idx, '}},"annotations":[', coalesce(string_agg(concat('{{"bbox":[', x1::BIGINT, ',', y1::BIGINT, ',',
 x2::BIGINT, ',', y2::BIGINT, '],"id":', pos, ',"category_id":', new, '}}'), ',' ORDER BY pos) FILTER (new IS NOT NULL), ''), '],"categories":[',
 CASE WHEN frame_idx % 2 = 0 THEN '{{"id":1,"name":"shot"}},{{"id":2,"name":"pass"}}' ELSE '{{"id":1,"name":"pass"}},{{"id":2,"name":"shot"}}' END, ']}}') AS value,
 count(*)::INTEGER AS n_before, count(new)::INTEGER AS n_after FROM notes GROUP BY video_id, frame_idx""",
    ),
    "detect_format": (
        _formats,
        "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'labelme' WHEN 1 THEN 'coco' ELSE 'unknown' END AS format FROM documents",
    ),
    "split_std": (
        lambda v: D.split_samples(v.frames(), v.frames(), v.labels_dict(), v.boxes()),
        ctes("fx_boxes", "fx_frames")
        + """, c AS (SELECT video_id, CASE WHEN action = '' THEN 'unknown' ELSE action END AS label, count(*) AS n, min(frame_idx * 1000 + pos) AS met FROM fx_boxes GROUP BY ALL),
 m AS (SELECT video_id, label FROM c QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY n DESC, met) = 1),
 t AS (SELECT concat('videos/', video_id) AS tube, coalesce(label, 'unknown') AS label, frames FROM (SELECT video_id, max(frame_idx) AS frames FROM fx_frames GROUP BY 1) LEFT JOIN m USING (video_id))"""
        + ranked_split("SELECT * FROM t", "tube", "tube, label, frames"),
    ),
    "split_gt": (
        lambda v: D.split_listing(
            v.table("documents").select(
                F.concat(F.when(F.col("doc_id") % 2 == 0, "videos/").otherwise(""), F.lit("d"), F.col("doc_id").cast("string")).alias("path"),
                F.col("lang").alias("label"),
                F.col("n_chars").alias("frames"),
            )
        ),
        ranked_split(
            "SELECT concat('videos/d', doc_id) AS path, lang AS label FROM documents", "path", "path, label"
        ),
    ),
    "subset_cover": (_subset, COVER),
    "merge_labels": (
        lambda v: D.label_names(v.table("part").select(F.col("p_type").alias("label_name"))),
        "SELECT row_number() OVER (ORDER BY label_name) - 1 AS label_id, label_name FROM (SELECT DISTINCT p_type AS label_name FROM part)",
    ),
    "merge_datasets": (
        lambda v: D.merge_listings(_listings(v), _dims(v)),
        ctes("fx_splits", "fx_labels_dict", extra=[LISTINGS, DIMS])
        + f""", u AS (SELECT row_number() OVER (ORDER BY label_name) - 1 AS new_id, label_name FROM (SELECT DISTINCT label_name FROM dims)),
 n AS (SELECT l.*, CASE WHEN try_cast(label AS BIGINT) IS NULL THEN label ELSE d.label_name END AS label_name FROM listings l
 LEFT JOIN dims d ON d.input_no = l.input_no AND d.label_id = try_cast(l.label AS BIGINT))
 SELECT split, {NORM} AS path, new_id::VARCHAR AS label FROM n JOIN u USING (label_name)
 QUALIFY row_number() OVER (PARTITION BY split, {NORM} ORDER BY input_no, path, label) = 1""",
    ),
    "merge_summary": (
        lambda v: D.merge_summary(_listings(v), _dims(v)),
        ctes("fx_splits", "fx_labels_dict", extra=[LISTINGS, DIMS])
        + f""", n AS (SELECT l.*, CASE WHEN try_cast(label AS BIGINT) IS NULL THEN label ELSE d.label_name END AS label_name FROM listings l
 LEFT JOIN dims d ON d.input_no = l.input_no AND d.label_id = try_cast(l.label AS BIGINT)),
 k AS (SELECT split, count(*) AS rows_known, count(DISTINCT {NORM}) AS paths FROM n WHERE label_name IN (SELECT label_name FROM dims) GROUP BY split)
 SELECT split, count(*) AS rows_read, coalesce(any_value(rows_known), 0) AS rows_known, coalesce(any_value(paths), 0) AS paths,
 coalesce(any_value(rows_known) - any_value(paths), 0) AS collisions FROM listings LEFT JOIN k USING (split) GROUP BY split""",
    ),
    "label_lookup": (
        lambda v: D.listing_labels(v.splits(), v.labels_dict().where("label_id = 1")),
        ctes("fx_splits")
        + f" SELECT split, {NORM} AS path, label, CASE label WHEN '1' THEN 'high' ELSE label END AS label_name FROM fx_splits",
    ),
    "tube_stats": (
        lambda v: D.listing_stats(v.splits(), v.labels_dict()),
        ctes("fx_splits", "fx_labels_dict")
        + " SELECT split, label, label_name, count(*) AS count FROM fx_splits JOIN fx_labels_dict ON label_id::VARCHAR = label GROUP BY ALL",
    ),
    "tube_totals": (
        lambda v: D.listing_totals(v.splits()),
        ctes("fx_splits")
        + f" SELECT coalesce(split, '__all__') AS split, count(*) AS num_samples, count(DISTINCT {NORM}) AS unique_samples FROM fx_splits GROUP BY ROLLUP (split)",
    ),
    "missing_paths": (
        lambda v: D.missing_paths(
            v.splits(),
            v.table("documents")
            .where("lang = 'en'")
            .select(F.concat(F.lit("videos/doc"), F.col("doc_id").cast("string")).alias("path")),
        ),
        ctes("fx_splits")
        + f" SELECT DISTINCT {NORM} AS path FROM fx_splits WHERE {NORM} NOT IN (SELECT concat('videos/doc', doc_id) FROM documents WHERE lang = 'en')",
    ),
    "split_audit": (
        lambda v: D.split_audit(v.splits()),
        ctes("fx_splits")
        + ", p AS (SELECT split, count(*)::DOUBLE AS n, count(DISTINCT path)::DOUBLE AS u FROM fx_splits GROUP BY 1)"
        + "".join(
            f" SELECT '{s}_size' AS measure, n AS value FROM p WHERE split = '{s}' UNION ALL SELECT '{s}_unique', u FROM p WHERE split = '{s}'"
            f" UNION ALL SELECT '{s}_duplicates', n - u FROM p WHERE split = '{s}' UNION ALL"
            for s in D.SPLITS
        )
        + "".join(
            f" SELECT '{a}_{b}_shared', (SELECT count(*)::DOUBLE FROM (SELECT path FROM fx_splits WHERE split = '{a}' INTERSECT SELECT path FROM fx_splits WHERE split = '{b}')) UNION ALL"
            for a, b in (("train", "val"), ("train", "test"), ("val", "test"))
        )
        + " SELECT 'imbalance', round(max(c) / min(c), 6) FROM (SELECT count(*)::DOUBLE AS c FROM fx_splits GROUP BY label)",
    ),
    "label_dist": (
        lambda v: D.label_distribution(v.splits(), v.labels_dict()),
        ctes("fx_splits", "fx_labels_dict")
        + """, c AS (SELECT split, label, count(*) AS count FROM fx_splits GROUP BY ALL UNION ALL SELECT 'overall', label, count(*) FROM fx_splits GROUP BY ALL)
 SELECT split, label AS label_id, label_name, count, round(count / sum(count) OVER (PARTITION BY split), 6) AS proportion
 FROM c JOIN fx_labels_dict d ON d.label_id::VARCHAR = label""",
    ),
    "merge_flatten": (
        _flat,
        ctes("fx_frames", extra=[FLAT])
        + """, n AS (SELECT *, concat(dataset, '__', action, '__', sample, '__', file) AS flat FROM files),
 r AS (SELECT *, row_number() OVER (PARTITION BY flat ORDER BY dataset, action, sample, file) - 1 AS k FROM n)
 SELECT dataset, action, sample, file, CASE WHEN k = 0 THEN flat ELSE concat(regexp_replace(flat, '\\.[^.]*$', ''), '_dup', k, regexp_extract(flat, '(\\.[^.]*)$', 1)) END AS new_name,
 CASE WHEN file LIKE '%.json' THEN concat(dataset, '__', action, '__', sample, '__', replace(file, '.json', CASE WHEN split_part(file, '.', 1)::BIGINT % 3 = 0 THEN '.png' ELSE '.jpg' END)) END AS image_path FROM r""",
    ),
    "merge_single": (
        lambda v: D.merge_single(v.frames().select("video_id", F.col("image_name").alias("file"))),
        ctes("fx_frames")
        + " SELECT concat('videos/', video_id, '/', image_name) AS src_path, concat('videos/merged_all/', video_id, '__', image_name) AS dst_path FROM fx_frames",
    ),
    "rename_by_action": (
        lambda v: D.rename_by_action(v.boxes()),
        ctes("fx_boxes")
        + """, c AS (SELECT video_id, CASE WHEN action = '' THEN 'unknown' ELSE action END AS label, count(*) AS n, min(frame_idx * 1000 + pos) AS met FROM fx_boxes GROUP BY ALL)
 SELECT video_id, concat(label, '__', video_id) AS new_name FROM c QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY n DESC, met) = 1""",
    ),
    "copy_manifest": (
        lambda v: D.sample_manifest(v.frames().select("video_id").distinct(), "/out"),
        ctes("fx_frames")
        + " SELECT DISTINCT concat('videos/', video_id) AS src_path, concat('/out/videos/', video_id) AS dst_path FROM fx_frames",
    ),
    "common_videos": (
        lambda v: v.frames()
        .select("video_id")
        .intersect(v.predictions().where("label_name = 'non_tactical'").select(F.split_part("id", F.lit("/"), F.lit(1)).alias("video_id"))),
        ctes("fx_frames", "fx_predictions")
        + " SELECT video_id FROM fx_frames INTERSECT SELECT split_part(id, '/', 1) FROM fx_predictions WHERE label_name = 'non_tactical'",
    ),
}
