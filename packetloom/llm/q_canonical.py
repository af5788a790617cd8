"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import canonical as op
from packetloom.session import table

FIELDS = ("species_code", "home_world", "visa_class")


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = table(spark, sf_dir, "candidate_evidence").select("cand_id", "field_name", "value")
    predictions = table(spark, sf_dir, "predictions").select("pred_id", *FIELDS)
    return op.with_terms(op.free_entered(evidence, predictions, FIELDS), table(spark, sf_dir, "reference_terms"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry meant by each value that is not spelled like an entry, 0 for none."""
    return _mapped(spark, sf_dir).where(~F.col("canonical")).select("src", "row_id", "field_name", "term_id")


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that mean no entry, with the number of their rows."""
    unmatched = _mapped(spark, sf_dir).where(F.col("term_id") == 0)
    return unmatched.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {"p2_found": p2_found, "p2_unmatched": p2_unmatched}
ORACLE: dict[str, str] = {}
