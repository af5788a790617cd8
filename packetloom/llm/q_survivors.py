"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import survivors as op
from packetloom.session import table

COLUMNS = ("case_id", "field_name", "cand_id", "value", "evidence_type", "ocr_confidence", "legible", "superseded")


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_evidence").select(*COLUMNS)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving row of each group, as the fusion operator chooses it."""
    return op.fuse(_evidence(spark, sf_dir)).select("case_id", "field_name", "cand_id")


def p4_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that the model keeps for each group, all true ones for risk flags, beside the survivor's own."""
    rows = _evidence(spark, sf_dir)
    return op.fuse(rows).join(rows.select("cand_id", "value"), "cand_id").select(
        "case_id", "field_name", "cand_id", "value", F.array_join("kept", "|").alias("kept"), F.round("probability", 6).alias("probability"), F.round("kept_probability", 6).alias("kept_probability")
    )


def p4_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred sensitivity and specificity of each evidence type."""
    _, model = op.judged_claims(op.prepared(_evidence(spark, sf_dir)))
    rows = [(s, float(a), float(b)) for s, a, b in zip(op.SOURCES, model["sensitivity"], model["specificity"], strict=True)]
    return spark.createDataFrame(rows, "source string, sensitivity double, specificity double")


def p4_against_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per field: survivors whose value equals the latest resolved value, and the mean probability of either kind."""
    resolved = table(spark, sf_dir, "resolved_fields")
    latest = resolved.groupBy("case_id", "field_name").agg(F.max_by("value", F.struct("pass_no", "resolved_at", "resolved_id")).alias("resolved"))
    rows = _evidence(spark, sf_dir)
    fused = op.fuse(rows).join(rows.select("cand_id", "value"), "cand_id").join(latest, ["case_id", "field_name"], "left")
    agree = F.coalesce(F.lower(F.trim("resolved")) == F.lower(F.trim("value")), F.lit(False))
    return fused.groupBy("field_name").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(agree).alias("n_agree"),
        F.round(F.avg(F.when(agree, F.col("probability"))), 4).alias("p_agree"),
        F.round(F.avg(F.when(~agree, F.col("probability"))), 4).alias("p_differ"),
    )


QUERIES = {"p4_found": p4_found, "p4_fused": p4_fused, "p4_sources": p4_sources, "p4_against_resolved": p4_against_resolved}
ORACLE = {
    "p4_found": r"""
WITH rows AS (
  SELECT case_id, field_name, cand_id,
    coalesce(legible AND NOT coalesce(superseded, false) AND value IS NOT NULL
      AND NOT regexp_full_match(regexp_replace(lower(value), '^\s+|\s+$', '', 'g'), '[\[({<]?\s*(unknown|n/a|illegible|-|\?)?\s*[\])}>]?'), false) AS eligible,
    CASE regexp_replace(lower(evidence_type), '[^a-z]', '', 'g')
      WHEN 'adjudicatorstamp' THEN 1 WHEN 'signedmanualnote' THEN 1 WHEN 'intakeform' THEN 2 WHEN 'biometricslip' THEN 3
      WHEN 'sponsorattestation' THEN 4 WHEN 'registryextract' THEN 5 WHEN 'textlayer' THEN 6 ELSE 99 END AS trust,
    round(CASE WHEN ocr_confidence > 1 THEN ocr_confidence / 100 ELSE ocr_confidence END, 3) AS conf
  FROM candidate_evidence),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY case_id, field_name ORDER BY eligible DESC, trust, conf DESC NULLS LAST, cand_id) AS place,
    count(*) OVER (PARTITION BY case_id, field_name) AS n
  FROM rows)
SELECT case_id, field_name, cand_id FROM ranked WHERE place = 1 AND eligible AND n >= 2"""
}
