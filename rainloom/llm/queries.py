"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rainloom.llm import encode, leak, subject
from rainloom.sources.tables import read


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_corpus(read(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Each text after encoding and decoding."""
    return encode.decode_corpus(encode.encode_corpus(read(spark, d, "documents")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(read(spark, d, "documents"), read(spark, d, "test_items")).select("doc_id", "item_id")


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """The documents without a leak."""
    return leak.without_leaks(read(spark, d, "documents"), read(spark, d, "test_items")).select("doc_id", F.length("text").cast("long").alias("chars"))


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    """The stretches of text that hold passages."""
    spans = leak.leaked_spans(read(spark, d, "documents"), read(spark, d, "test_items"))
    return spans.select("doc_id", "item_id", F.inline("spans"))


def p8_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """All documents without those stretches."""
    return leak.without_spans(read(spark, d, "documents"), read(spark, d, "test_items")).select("doc_id", F.length("text").cast("long").alias("chars"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subject.subjects_of(read(spark, d, "documents"), read(spark, d, "subjects"), read(spark, d, "doc_labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p7_ids, p7_decoded, p8_found, p8_kept, p8_spans, p8_cleaned, p9_found)}

ORACLE: dict[str, str] = {
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
