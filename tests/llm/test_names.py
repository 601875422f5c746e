"""Extra columns named like helper columns and results change nothing and stay as they were."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackloom.llm import decision_list, mixing, names, near_dedup, sharding

ROWS = [
    (i, None if i == 7 else "" if i == 8 else " ".join(random.Random(i // 3).choices("abcdefgh", k=60 + i)), None if i % 11 == 0 else f"s{i % 4}")
    for i in range(60)
]
CLASHES = (
    "_gone _row _slot _shard _words _lines _windows _twice _name _size _hash _source _block _times _parts _again _r _id _text kept rule "
    "n_words n_lines base_failed comp key rep c0 c1 c2 size target"
).split()


@pytest.fixture(scope="module")
def tables(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return plain, plain.select(*[F.concat(F.lit(f"{c}:"), "doc_id").alias(c) for c in CLASHES], "*")


def stays(df, columns):
    """The clashing columns still belong to their row."""
    for r in df.select("doc_id", *columns).collect():
        assert [r[c] for c in columns] == [f"{c}:{r['doc_id']}" for c in columns]


def test_names(spark):
    df, name = names.positional(spark.createDataFrame([(1, 2)], "`a.b` int, C int"))
    assert df.columns == ["c0", "c1"] and name == {"a.b": "c0", "c": "c1"}
    assert names.free_name("_x", ["_X", "__x", "y"]) == "___x"


def test_placing(tables, rows_of):
    plain, wide = tables
    got = sharding.place(wide, "doc_id", ["a", "b", "c"], 101)
    assert rows_of(got, "doc_id", "slot", "shard") == rows_of(sharding.place(plain, "doc_id", ["a", "b", "c"], 101), "doc_id", "slot", "shard")
    stays(got, CLASHES)
    again = sharding.place(got.withColumnRenamed("slot", "SLOT"), "doc_id", ["a"], 101)
    assert {r["shard"] for r in again.collect()} == {"a"} and "SLOT" not in again.columns
    assert sharding.place(wide.limit(0), "doc_id", ["a"], 101).count() == 0


def test_quality(spark, tables, rows_of):
    plain, wide = tables
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    made = ["doc_id", *decision_list.STATISTICS, "base_failed", "kept", "rule"]
    got = decision_list.quality_verdicts(wide, labels)
    assert rows_of(got, *made) == rows_of(decision_list.quality_verdicts(plain, labels), *made)
    stays(got, [c for c in CLASHES if c not in made])


def test_mixing(tables, rows_of):
    plain, wide = tables
    assert rows_of(mixing.mix_report(wide.coalesce(1))) == rows_of(mixing.mix_report(plain.coalesce(1)))
    got = mixing.mixed_documents(wide)
    assert got.columns == wide.columns and got.count() > 0
    stays(got, CLASHES)


def test_near_duplicates_and_the_first_stage(spark, tables, rows_of, tmp_path):
    plain, wide = tables
    got = near_dedup.without_near_duplicates(wide)
    assert got.columns == wide.columns
    assert rows_of(got, "doc_id") == rows_of(near_dedup.without_near_duplicates(plain), "doc_id")
    spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    first = corpus_pipeline.quality(spark, wide, str(tmp_path))
    assert first.columns == wide.columns
    assert rows_of(first, "doc_id") == rows_of(corpus_pipeline.quality(spark, plain, str(tmp_path)), "doc_id")
    stays(first, CLASHES)
