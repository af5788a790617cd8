"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import residue
from packetloom.session import table


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold residue or filler, or consist of error messages or script notices."""
    return residue.found_records(table(spark, sf_dir, "documents")).select("doc_id")


def p9_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents found per kind of junk and source."""
    docs = table(spark, sf_dir, "documents")
    found = residue.found_records(docs).select("doc_id", "kind")
    return docs.select("doc_id", "source").join(found, "doc_id").groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n_documents"))


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids, languages and sources of the corpus without the documents found."""
    return residue.without_residue(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


QUERIES = {"p9_found": p9_found, "p9_by_kind": p9_by_kind, "p9_clean": p9_clean}
ORACLE: dict[str, str] = {}
