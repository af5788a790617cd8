"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import canonical, variants
from packetloom.operators.skew import salted_join
from packetloom.session import cut, table

KEPT = ("species_code", "home_world")


def case_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_id, words, species and world (terms) as the intake form and the predictions name them.

    Both tables are read once and folded to distinct values of a case.
    """
    intake = F.regexp_replace(F.lower("evidence_type"), "[^a-z]", "") == "intakeform"
    evidence = table(spark, sf_dir, "candidate_evidence").where(F.col("field_name").isin("applicant_name", *KEPT))
    seen = evidence.select("case_id", "field_name", "value", F.coalesce(intake, F.lit(False)).alias("trusted"))
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in ("applicant_name", *KEPT)))
    read = table(spark, sf_dir, "predictions").select("case_id", F.inline(pairs), F.lit(True).alias("trusted"))
    rows = seen.unionByName(read).where(F.col("value").isNotNull())
    folded = cut(rows.groupBy("case_id", "field_name", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("trusted").alias("t")))
    forms = variants.best_forms(folded.where("field_name = 'applicant_name'").select("case_id", F.col("value").alias("name"), "n", "t"), "case_id")
    values = folded.where(F.col("field_name").isin(*KEPT) & (F.col("t") > 0) & F.col("value").rlike(r"\S"))
    terms = canonical.with_terms(values, table(spark, sf_dir, "reference_terms")).where(F.col("term_id") > 0)
    votes = terms.groupBy("case_id", "field_name", "term_id").agg(F.sum("t").alias("n"))
    kept = votes.groupBy("case_id").agg(
        *(F.max_by("term_id", F.when(F.col("field_name") == f, F.struct("n", -F.col("term_id")))).alias(c) for f, c in zip(KEPT, ("species", "world"), strict=True))
    )
    return forms.join(kept, "case_id", "left").select("case_id", "words", F.coalesce("species", F.lit(0)).alias("species"), F.coalesce("world", F.lit(0)).alias("world"))


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_id, applicant: the cases' applicants as cluster ids."""
    cases = cut(case_profiles(spark, sf_dir).withColumn("id", F.xxhash64("species", "world", F.array_join("words", " "))))
    records = cases.groupBy("id", "species", "world", "words").agg(F.count(F.lit(1)).alias("n"))
    # a full given name leads an initial or nickname, however frequent
    full = F.aggregate("words", F.lit(0), lambda acc, w: acc + F.when(F.length(w) > 5, 1).otherwise(0))
    records = cut(records.withColumn("weight", F.struct(F.least(full, F.lit(2)).alias("full"), "n")))
    edges = variants.link_names(records.select("id", "words", "species", "world"), ["species", "world"])
    clusters = variants.star_clusters(records.select("id", "weight"), edges)
    return cases.join(clusters, "id").select("case_id", F.col("centre").alias("applicant"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of cases filed by one applicant, smaller id first."""
    of = cut(applicants(spark, sf_dir))
    left, right = of.withColumnRenamed("case_id", "case_id_a"), of.withColumnRenamed("case_id", "case_id_b")
    # every pair of an applicant's cases is a row of the result; an applicant of very many cases is split
    sizes = of.groupBy("applicant").agg(F.count(F.lit(1)).alias("n"))
    return salted_join(left, right, ["applicant"], counts=(sizes, sizes)).where(F.col("case_id_a") < F.col("case_id_b")).select("case_id_a", "case_id_b")


def p3_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per case with its applicant and the number of the applicant's cases."""
    of = cut(applicants(spark, sf_dir))
    n = of.groupBy("applicant").agg(F.count(F.lit(1)).alias("n_cases"))
    return of.join(n, "applicant")


QUERIES = {"p3_found": p3_found, "p3_applicants": p3_applicants}
ORACLE: dict[str, str] = {}
