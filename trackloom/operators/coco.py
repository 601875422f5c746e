"""Category documents (``images``, ``annotations``, ``categories`` in one JSON text) with mapped category names.

A document's annotations are rewritten in pieces of bounded length, one row each, and put together again, so that no expression
holds all annotations of a large document beside their rewritten form. Every key that is not about categories stays as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.rows import once
from trackloom.operators.relabel import RECORD, detect_format, relabel_records

LISTED = "array<map<string,variant>>"
#: Annotations of a piece.
PIECE = 1024


def _listed(record: Column, key: str) -> Column:
    return F.coalesce(F.try_variant_get(record[key], "$", LISTED), F.array().cast(LISTED))


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "bigint")


def split_documents(texts: DataFrame, mapping: DataFrame, text: str = "value") -> DataFrame:
    """Documents with ``_record`` (all keys), ``_names`` (the new categories in order) and ``_ids`` (old id to new id).

    Of categories with one id the last name counts, at the place of the first. Mapped names that are equal become one
    category; ids run from 1 in the order in which old names are first met. A name that is mapped to nothing, and one that is
    blank, goes. The mapping is a small vocabulary and enters as one map value, a document's categories are one too.
    """
    targets = mapping.agg(F.map_from_entries(F.collect_list(F.struct("label", "label2")))).scalar()
    parsed = once(texts, _record=F.from_json(text, RECORD)).withColumn("_targets", targets)
    pairs = F.transform(
        _listed(F.col("_record"), "categories"),
        lambda c: F.struct(
            _number(c["id"]).alias("id"), F.trim(F.coalesce(F.try_variant_get(c["name"], "$", "string"), F.lit(""))).alias("name")
        ),
    )
    with_pairs = once(parsed, _pairs=F.filter(pairs, lambda p: p["id"].isNotNull()))
    old = F.transform(F.array_distinct(F.transform("_pairs", lambda p: p["id"])), lambda i: F.struct(i.alias("id"), F.element_at(F.filter("_pairs", lambda p: p["id"] == i), -1)["name"].alias("name")))
    new = F.transform("_old", lambda o: F.struct(o["id"].alias("id"), F.coalesce(F.col("_targets")[o["name"]], o["name"]).alias("name")))
    kept = F.filter(new, lambda o: o["name"] != "")
    renamed = once(once(with_pairs, _old=old), _new=kept)
    named = once(renamed, _names=F.array_distinct(F.transform("_new", lambda o: o["name"])))
    ids = F.transform("_new", lambda o: F.struct(o["id"], F.array_position(F.col("_names"), o["name"]).cast("bigint")))
    return once(named, _ids=F.map_from_entries(ids)).drop("_targets", "_pairs", "_old", "_new")


def _piece_texts(documents: DataFrame, keys: list[str], piece: int) -> DataFrame:
    """(keys, _piece, value, n): the annotations that stay of every piece, as JSON texts with their new category.

    A document without annotations has one piece; ``value`` is null where none stays.
    """
    listed = once(documents, _all=_listed(F.col("_record"), "annotations"))
    places = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("_all") / piece).cast("int") - 1, F.lit(0)))
    cut = F.transform(places, lambda i: F.slice("_all", i * piece + 1, F.lit(piece)))
    rows = listed.select(*keys, "_ids", F.posexplode(cut).alias("_piece", "_part"))
    read = F.transform("_part", lambda a: F.struct(a.alias("a"), F.col("_ids")[_number(a["category_id"])].alias("new")))
    left = F.transform(
        F.filter(read, lambda r: r["new"].isNotNull()),
        lambda r: F.map_concat(F.map_filter(r["a"], lambda k, _v: k != "category_id"), F.create_map(F.lit("category_id"), r["new"].cast("variant"))),
    )
    texts = once(once(rows, _left=left), value=F.to_json("_left"), n=F.size("_left"))
    inner = F.substring(F.col("value"), F.lit(2), F.length("value") - 2)
    return texts.select(*keys, "_piece", F.when(F.col("n") > 0, inner).alias("value"), "n")


def relabel_documents(texts: DataFrame, mapping: DataFrame, key: str = "path", text: str = "value", piece: int = PIECE) -> DataFrame:
    """(key, text, n_before, n_after) for category documents; ``key`` names each document.

    A document without annotations, or none of whose annotations stay, is still written.
    """
    documents = split_documents(texts, mapping, text)
    categories = F.to_json(
        F.transform("_names", lambda n: F.struct(F.array_position(F.col("_names"), n).cast("bigint").alias("id"), n.alias("name")))
    )
    rest = F.to_json(F.map_filter("_record", lambda k, _v: ~k.isin("annotations", "categories")))
    before = F.size(_listed(F.col("_record"), "annotations"))
    heads = once(documents, _head=F.struct(rest.alias("rest"), categories.alias("categories"), before.alias("before")))
    # The other keys go with the first piece only.
    pieces = _piece_texts(heads, [key, "_head"], piece).withColumn("_head", F.when(F.col("_piece") == 0, F.col("_head")))
    in_order = F.array_sort(F.collect_list(F.struct("_piece", "value")))
    whole = pieces.groupBy(key).agg(F.max("_head").alias("_head"), in_order.alias("_pieces"), F.sum("n").cast("int").alias("n_after"))
    parts = whole.select(
        key,
        F.col("_head.rest").alias("_rest"),
        F.col("_head.categories").alias("_categories"),
        F.col("_head.before").alias("n_before"),
        "n_after",
        F.array_join(F.transform("_pieces", lambda e: e["value"]), ",").alias("_annotations"),
    )
    # The closing brace of the other keys makes way for the two that were rebuilt.
    opening = F.when(F.length("_rest") > 2, F.concat(F.substring(F.col("_rest"), F.lit(1), F.length("_rest") - 1), F.lit(","))).otherwise("{")
    body = F.concat(opening, F.lit('"annotations":['), "_annotations", F.lit('],"categories":'), "_categories", F.lit("}"))
    return parts.select(key, body.alias(text), "n_before", "n_after")


def relabel_any(texts: DataFrame, mapping: DataFrame, key: str = "path", text: str = "value") -> DataFrame:
    """(key, text, n_before, n_after, emptied) of texts in either format; others pass as they are, unreadable ones go.

    ``emptied`` marks per-frame records that have no shape left.
    """
    read = texts.where(F.try_parse_json(text).isNotNull()).select(key, text).withColumn("_kind", detect_format(F.col(text)))
    frames = relabel_records(read.where("_kind <> 'coco'"), mapping, text)
    frames = frames.withColumn("emptied", (F.col("_kind") == "labelme") & (F.col("n_after") == 0)).drop("_kind")
    documents = relabel_documents(read.where("_kind = 'coco'").drop("_kind"), mapping, key, text)
    return frames.unionByName(documents.withColumn("emptied", F.lit(False)))
