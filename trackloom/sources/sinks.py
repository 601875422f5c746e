"""Writers of result files. Results written as one file are small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_csv(df: DataFrame, out: str, header: bool = True, quote_all: bool = False) -> None:
    """Small result as one CSV file."""
    df.coalesce(1).write.option("header", header).option("quoteAll", quote_all).csv(out)


def stats_json(df: DataFrame, out: str) -> None:
    """Small result as one file of JSON rows."""
    df.coalesce(1).write.json(out)


def split_csv(listing: DataFrame, out: str, header: bool) -> None:
    """Split lists, one folder per split."""
    listing.write.partitionBy("split").option("header", header).csv(out)


def mask_csv(masks: DataFrame, out: str) -> None:
    """Window masks, every field quoted."""
    masks.write.option("header", True).option("quoteAll", True).csv(out)


def json_lines(df: DataFrame, out: str) -> None:
    df.write.json(out)


def labels_text(labels: DataFrame) -> DataFrame:
    """Label dictionary ``{"0": name}`` as one text row (the vocabulary is small)."""
    entries = F.sort_array(F.collect_list(F.struct(F.col("label_id").cast("bigint").alias("label_id"), "label_name")))
    pairs = F.transform(
        entries, lambda e: F.struct(e["label_id"].cast("string").alias("key"), e["label_name"].alias("value"))
    )
    return labels.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))


def action_text(actions: DataFrame) -> DataFrame:
    """Action list as block texts, one per action."""
    block = F.format_string(
        'item {\n  name: "%s"\n  label_id: %d\n  label_type: %s\n}',
        "action_name",
        F.col("action_id").cast("bigint"),
        F.coalesce("label_type", F.lit("PERSON_INTERACTION")),
    )
    return actions.select("action_id", block.alias("value"))


def pair_records(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs as JSON texts, one per pair."""
    fields = {
        "ms_action": F.col("a_action"),
        "sh_action": F.col("b_action"),
        "iou": F.col("iou"),
        "ms_box": F.array(*[F.col(f"a_{c}") for c in ("x1", "y1", "x2", "y2")]),
        "sh_box": F.array(*[F.col(f"b_{c}") for c in ("x1", "y1", "x2", "y2")]),
    }
    record = F.struct(
        "video_id", "t", F.lit(threshold).alias("threshold"), *[c.alias(n) for n, c in fields.items()]
    )
    return pairs.select("video_id", "t", "a_pos", "b_pos", F.to_json(record).alias("value"))


def list_report(counts: DataFrame, title: str, name: str, k: int = 50) -> DataFrame:
    """Text lines of the ``k`` largest counts under a title, with their order."""
    top = counts.orderBy(F.desc("count"), name).limit(k)
    body = top.select(
        F.lit(1).alias("section"),
        (-F.col("count")).alias("place"),
        F.format_string("- %s: %d", F.col(name), F.col("count")).alias("line"),
    )
    spark = counts.sparkSession
    head = spark.createDataFrame([(0, 0, f"## {title}")], "section int, place bigint, line string")
    return head.unionByName(body).orderBy("section", "place", "line")


def quantile_lines(summary: DataFrame) -> DataFrame:
    """Text lines of five-number summaries with four decimals."""
    text = F.format_string(
        "- %s: min=%.4f, p25=%.4f, mean=%.4f, p75=%.4f, max=%.4f",
        "metric",
        "min",
        "p25",
        "mean",
        "p75",
        "max",
    )
    return summary.select("metric", text.alias("line"))


def write_lines(lines: DataFrame, out: str) -> None:
    """Report lines in order as one text file."""
    lines.select("line").coalesce(1).write.text(out)
