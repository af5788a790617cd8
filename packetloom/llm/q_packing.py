"""Queries of problems 7 and 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import containers, mixture, tokens
from packetloom.session import cut, table


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.fill_containers(_sized(spark, sf_dir), table(spark, sf_dir, "container_sizes"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every container of each kind with its documents, filling and unused space."""
    held = F.array_sort(F.collect_list(F.struct("doc_id", "part", "n_tokens")))
    grouped = _placed(spark, sf_dir).groupBy("container_kind", "container_no").agg(held.alias("documents"), F.sum("n_tokens").alias("filled"), F.max("capacity").alias("capacity"))
    return grouped.select("container_kind", "container_no", "documents", "filled", (F.col("capacity") - F.col("filled")).alias("unused"))


def p7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and unused share per kind."""
    per = _placed(spark, sf_dir).groupBy("container_kind", "container_no").agg(F.sum("n_tokens").alias("filled"), F.max("capacity").alias("capacity"))
    return per.groupBy("container_kind").agg(
        F.count(F.lit(1)).alias("n_containers"), F.sum("filled").alias("tokens"), F.round(1 - F.sum("filled") / F.sum("capacity"), 6).alias("unused_share")
    )


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture: how often each document is used."""
    return mixture.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of the sources."""
    return mixture.shares(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


QUERIES = {"p7_containers": p7_containers, "p7_summary": p7_summary, "p8_mixture": p8_mixture, "p8_shares": p8_shares}
ORACLE: dict[str, str] = {}
