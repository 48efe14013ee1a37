"""A corpus from raw documents to tokens: each stage works on all that the one before kept.

run(spark, sf_dir) writes each stage's rows as Parquet into the shared folder and rereads them for the next. A stage takes
documents with more columns too, whatever their names, and returns the columns of documents. Null columns, empty tables,
texts of any length and repeated rows have a defined result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm._common import DOCUMENT, documents, materialise
from spanloom.llm.bpe import encode_documents, public_path
from spanloom.llm.mixing import take_mix
from spanloom.llm.nearcopies import drop_near_copies
from spanloom.llm.quality import keep_good
from spanloom.llm.suffix import drop_repeats

#: SQL can't express the classifier, the components and the tokenizer.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts. Equal texts are judged alike; a null text counts as empty."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*DOCUMENT)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, likeness of 0.8 or more; candidates by the covering masks of
    SimHash and, beyond their three bits, by MinHash): that of the smallest doc_id, a null one behind all others, ties by a
    hash of the text. All texts without a word are one group."""
    return drop_near_copies(docs).select(*DOCUMENT)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one, or it itself earlier, has. No row goes: a text may become
    empty, a null one stays null."""
    return drop_repeats(docs).select(*DOCUMENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, once or twice; one without a word is never taken. A null source is a
    source."""
    return take_mix(docs).select(*DOCUMENT)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document of the mix, a row for each of its rows."""
    return encode_documents(docs, public_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages), ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
