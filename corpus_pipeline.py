"""A pipeline over the documents table: five stages, each of them an operator of ``trackloom.llm``.

Every stage takes the columns of documents and returns them, but the last, which returns token ids. What a stage writes
is the next one's input; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.bpe import encode_texts
from trackloom.llm.decision_list import quality_verdicts
from trackloom.llm.mixing import mixed_documents
from trackloom.llm.names import positional
from trackloom.llm.near_dedup import without_near_duplicates
from trackloom.llm.storage import stored, table
from trackloom.llm.substring_dedup import remove_repeated_spans


def _like(columns: list[str], docs: DataFrame) -> DataFrame:
    """The columns of the input, with the length of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned list keep."""
    renamed, name = positional(docs)
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", name["doc_id"])
    judged = quality_verdicts(renamed, labels, name["doc_id"], name["text"])
    return judged.where("kept").select(*renamed.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return without_near_duplicates(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of 20 words and more that occur before."""
    return _like(docs.columns, remove_repeated_spans(docs, keep=docs.columns, with_text=True))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document; a document comes again with the words that are taken twice."""
    return _like(docs.columns, mixed_documents(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text."""
    return encode_texts(docs, with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_copies),
    ("substring dedup", repeated_spans),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The learned rules and the token ids can't be written in SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs)
    return docs
