"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packetloom.llm import ocr
from packetloom.session import table

LINE_COLUMNS = ("line_id", "case_id", "page_index", "line_seq", "text", "block_num", "paragraph_num")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "ocr_lines").select(*LINE_COLUMNS), table(spark, sf_dir, "ocr_tokens").select("text", "confidence")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The noise of each line."""
    return ocr.findings(*_tables(spark, sf_dir))


def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packets' paragraphs as continuous text."""
    return ocr.paragraphs(*_tables(spark, sf_dir))


QUERIES = {"p6_found": p6_found, "p6_paragraphs": p6_paragraphs}
ORACLE: dict[str, str] = {}
