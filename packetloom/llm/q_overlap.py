"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import overlap
from packetloom.session import table


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlaps(table(spark, sf_dir, "eval_labels"), table(spark, sf_dir, "train_labels"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a training and an evaluation record of one filing."""
    pair = F.array_sort(F.array("eval_id", "train_id"))
    return _pairs(spark, sf_dir).select(pair[0].alias("record_id_a"), pair[1].alias("record_id_b"))


def p5_overlap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping evaluation records and pairs per split and source of the evaluation record."""
    labels = table(spark, sf_dir, "eval_labels").select(F.col("record_id").alias("eval_id"), "split_name", "source")
    per = _pairs(spark, sf_dir).groupBy("eval_id").agg(F.count(F.lit(1)).alias("n"), F.min("edits").alias("least"))
    joined = labels.join(per, "eval_id", "left")
    return joined.groupBy("split_name", "source").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count("n").alias("n_overlapping"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"),
        F.count_if(F.col("least") == 0).alias("n_equal_visits"),
    )


QUERIES = {"p5_found": p5_found, "p5_overlap_report": p5_overlap_report}
ORACLE: dict[str, str] = {}
