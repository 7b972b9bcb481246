"""Cleaning pipeline over ``documents``: quality rules, quality classifier,
near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it as the next
stage's ``docs``.  All stages but the last return the columns of documents;
the last returns the packed pieces.  A document whose doc_id is null can't
be told from others and goes in the first stage; rows that repeat a doc_id
share its fate.  The stages keep clean documents and whole texts: nothing
is sampled or cut but the boilerplate lines that the first removes and the
repeated strings that the fourth removes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import classifier, dedup, neardup, packing, rules
from quarry.llm.common import table, written
from quarry.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids``."""
    return docs.join(ids.select("doc_id").hint("merge"), "doc_id", "left_semi")


def recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line frequencies keep, without the
    boilerplate lines of their source; n_chars is counted anew."""
    return recounted(rules.cleaned(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of what is left,
    doesn't take for low quality."""
    return only(docs, classifier.quality(docs, table(spark, sf_dir, "labels")).where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near-duplicates."""
    return only(docs, neardup.near_duplicates(docs).where("doc_id = class_id")).dropDuplicates(["doc_id"])


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings that a smaller doc_id has; n_chars
    is counted anew.  A text that is nothing but such strings is empty then."""
    return recounted(dedup.rewritten(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, with their ids, packed into sequences of 1024
    tokens."""
    return packing.pack(docs, tokenizer(), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup), ("packing", pack),
]

#: Training, sketches and suffix arrays aren't SQL; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
