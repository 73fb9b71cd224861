"""Corpus preparation as five stages; each applies one operator and its decisions take effect.

Every stage takes ``(spark, docs, sf_dir)`` and returns rows that are written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``docs``, extra ones and ones named like an operator's results included.

For all stages: a null text counts as empty; an empty table gives an empty one;
repeated rows are rows of their own (the two de-duplications keep one of them); a
null ``doc_id`` is allowed. No stage reads a text in part.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.bpe import bpe_round_trip
from quillmark.llm.exact_dedup import exact_dedup
from quillmark.llm.language_id import identify, train
from quillmark.llm.mixing import mix
from quillmark.llm.near_dedup import near_classes
from quillmark.llm.queries import MIX_KEEP, MIX_WEIGHTS, domain_labels
from quillmark.llm.shared import documents, keyed, shared_dir

#: Below this score an ambiguous text counts as of no language.
LEAST_SCORE = 0.4


def _private(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and every column under a name of its own, so that none clashes with an operator's."""
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(docs.columns)])


def _public(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with their values."""
    return rows.select(*[F.col(f"_p{i}").alias(c) for i, c in enumerate(docs.columns)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language: no letters (null and empty ones too), or ambiguous with a low score.

    With no labelled language in the table nothing can be told apart, and all texts
    with letters are dropped as ``und``.
    """
    found = identify(_private(docs), train(docs), carry=[f"_p{i}" for i in range(len(docs.columns))])
    keep = (F.col("lang_pred") != "und") & ~(F.col("ambiguous") & (F.col("score") < LEAST_SCORE))
    return _public(found.filter(keep), docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null and empty ones are equal) the row with the smallest id stays, of rows with that id any one."""
    return _public(exact_dedup(_private(docs), carry=[f"_p{i}" for i in range(len(docs.columns))]).filter("kept"), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates one row stays, that of the smallest id; texts without a word are no near-duplicates and stay.

    Rows are told apart by a key of their own, so that rows with one id and
    different texts are judged by their texts.
    """
    rows = keyed(docs, docs.columns)
    gone = near_classes(rows.select("key", "doc_id", "text")).filter(~F.col("first")).select("key")
    return rows.join(gone, "key", "left_anti").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says; one of a rate of 0 goes.

    Rows with one id share the largest number of copies among them; rows without
    an id are kept once. Without labels every rate is 1.
    """
    rates = mix(docs.select("doc_id", "text"), domain_labels(spark, sf_dir), MIX_WEIGHTS, MIX_KEEP).groupBy("doc_id").agg(F.max("copies").alias("copies"))
    rows = _private(docs).join(rates, "doc_id", "left").withColumn("copies", F.coalesce("copies", F.lit(1))).filter("copies > 0")
    return _public(rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each kept document, as count and digests: a row for each row, empty texts with no ids."""
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("language ID", language), ("exact dedup", exact), ("MinHash near-dedup", near), ("mixing to target weights", mixed), ("byte-level BPE", encoded)]

#: The classifier and the rates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
