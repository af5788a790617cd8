"""Scoring predictions against truth, and validating them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import text as tx

#: Weights of the scored fields; fixed values.
WEIGHTS = {"applicant_name": 5, "species_code": 6, "home_world": 5, "visa_class": 5, "sponsor_id": 5, "arrival_date": 4, "declared_purpose": 3, "risk_flags": 8, "fee_status": 4}
#: The decisions and the fee states; fixed values.
DECISIONS = ("APPROVED", "DENIED", "NEEDS_REVIEW")
FEES = ("paid", "waived", "unpaid", "unknown")


def _one_per_case(rows: DataFrame, order: Column, pick) -> DataFrame:
    """One row a case by an aggregate that combines before the shuffle, so a case delivered very often is no hot group."""
    named = rows.where(F.col("case_id").rlike(r"\S"))
    return named.groupBy("case_id").agg(pick(F.struct(*(F.col(c) for c in rows.columns)), order).alias("__row")).select("__row.*")


def last_truth(labels: DataFrame) -> DataFrame:
    """One row a case: the last delivered; rows without an id are dropped."""
    return _one_per_case(labels, F.struct("labelled_at", "record_id"), F.max_by)


def first_predictions(predictions: DataFrame) -> DataFrame:
    """One row a case: the first submitted."""
    return _one_per_case(predictions, F.col("pred_id"), F.min_by)


def _same(field: str, a: Column, b: Column) -> Column:
    if field == "risk_flags":
        return tx.flag_text(a) == tx.flag_text(b)
    return tx.collapse(a) == tx.collapse(b)


def scored(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row a truth case: match of every field, points, decision outcome and Brier term."""
    t = truth.select(F.col("case_id"), *(F.col(f).alias(f"t_{f}") for f in (*WEIGHTS, "adjudication")))
    p = predictions.select("case_id", F.lit(True).alias("present"), "confidence", *(F.col(f).alias(f"p_{f}") for f in (*WEIGHTS, "adjudication")))
    both = t.join(p, "case_id", "left").withColumn("present", F.coalesce("present", F.lit(False)))
    for f in WEIGHTS:
        both = both.withColumn(f"m_{f}", F.col("present") & _same(f, F.col(f"t_{f}"), F.col(f"p_{f}")))
    want, got = F.upper(tx.strip(F.coalesce("t_adjudication", F.lit("")))), F.upper(tx.strip(F.coalesce("p_adjudication", F.lit(""))))
    outcome = (
        F.when(~F.col("present"), "missing_case")
        .when(~got.isin(*DECISIONS), "invalid_or_blank")
        .when(want == got, "correct")
        .when((want == "DENIED") & (got == "APPROVED"), "catastrophic_false_approval")
        .when(got == "NEEDS_REVIEW", "conservative_review")
        .when(want == "NEEDS_REVIEW", "missed_review")
        .otherwise("wrong_decision")
    )
    both = both.withColumn("outcome", outcome).withColumn("decided", F.when(F.col("present"), got).otherwise("MISSING")).withColumn("wanted", want)
    points = F.create_map(*(F.lit(x) for pair in {"correct": 8.0, "catastrophic_false_approval": -4.0, "conservative_review": 2.0, "missed_review": 1.0}.items() for x in pair))
    valid = F.col("confidence").between(0, 1) & ~F.isnan("confidence")
    hit = (F.col("outcome") == "correct").cast("double")
    brier = F.when(F.col("present"), F.when(F.coalesce(valid, F.lit(False)), F.pow(F.col("confidence") - hit, F.lit(2))).otherwise(1.0))
    total = F.lit(0)
    for f, w in WEIGHTS.items():
        total = total + F.when(F.col(f"m_{f}"), w).otherwise(0)
    return both.select(
        "case_id", "present", "wanted", "decided", "outcome", *(f"m_{f}" for f in WEIGHTS), total.alias("field_points"), F.coalesce(F.try_element_at(points, "outcome"), F.lit(0.0)).alias("decision_points"), brier.alias("brier")
    )


def totals(cases: DataFrame) -> DataFrame:
    """One row: the section scores of 50 extraction, 80 classification, 20 calibration, less up to 10 for missing cases."""
    most = sum(WEIGHTS.values())
    sums = cases.agg(
        F.count(F.lit(1)).alias("n_cases"), F.count_if(~F.col("present")).alias("n_missing"), F.sum("field_points").alias("fp"), F.sum("decision_points").alias("dp"), F.avg("brier").alias("mean_brier")
    )
    n = F.col("n_cases")
    extraction = 50 * tx.safe_divide(F.col("fp"), n * most)
    decisions = 80 * tx.safe_divide(F.col("dp"), n * 8)
    calibration = F.coalesce(20 * F.greatest(F.lit(0.0), 1 - 2 * F.col("mean_brier")), F.lit(0.0))
    penalty = 10 * tx.safe_divide(F.col("n_missing"), n)
    return sums.select(
        "n_cases", "n_missing", F.round(extraction, 6).alias("extraction"), F.round(decisions, 6).alias("classification"), F.round(calibration, 6).alias("calibration"), F.round(penalty, 6).alias("missing_penalty"),
        F.round(extraction + decisions + calibration - penalty, 6).alias("total"), F.round("mean_brier", 6).alias("mean_brier"),
    )


def confusion(cases: DataFrame) -> DataFrame:
    return cases.groupBy("wanted", "decided").agg(F.count(F.lit(1)).alias("n_cases"))


def field_rates(cases: DataFrame) -> DataFrame:
    """field_name, n_matched, match_rate over all cases."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"m_{f}").cast("int").alias("m")) for f in WEIGHTS))
    return cases.select(F.inline(pairs)).groupBy("field_name").agg(F.sum("m").alias("n_matched"), F.round(F.avg("m"), 6).alias("match_rate"))


def error_groups(cases: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Counts of wrong cases by each key alone, in one pass of grouping sets."""
    wrong = cases.where(F.col("outcome") != "correct")
    named = wrong.select(*(F.coalesce(k, F.lit("unspecified")).alias(k) for k in keys))
    sets = named.groupingSets([[k] for k in keys], *keys).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n_cases"))
    n = len(keys)
    label = F.lit(keys[-1])
    for i, k in enumerate(keys[:-1]):
        label = F.when(F.col("g") == (2**n - 1) - 2 ** (n - 1 - i), k).otherwise(label)
    return sets.select(label.alias("dimension"), F.coalesce(*keys).alias("member"), "n_cases")


def regressions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cases that were right before and are not right after."""
    right = before.where(F.col("outcome") == "correct").select("case_id")
    return after.where(F.col("outcome") != "correct").join(right, "case_id", "left_semi").select("case_id", "outcome", "wanted", "decided")


def row_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``errors``: what a submitted row violates, in field order."""
    day = F.coalesce(tx.strip(F.col("arrival_date")).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(tx.strip(F.col("arrival_date")), "yyyy-MM-dd").isNotNull(), F.lit(False))
    checks = {
        "case_id": ~F.coalesce(F.col("case_id").rlike(tx.CASE_ID), F.lit(False)),
        "sponsor_id": ~F.coalesce(F.col("sponsor_id").rlike(tx.SPONSOR_ID), F.lit(False)),
        "arrival_date": ~day,
        "fee_status": ~F.coalesce(F.col("fee_status").isin(*FEES), F.lit(False)),
        "adjudication": ~F.coalesce(F.col("adjudication").isin(*DECISIONS), F.lit(False)),
        "confidence": ~F.coalesce(F.col("confidence").between(0, 1) & ~F.isnan("confidence"), F.lit(False)),
        **{f: ~F.coalesce(F.col(f).rlike(r"\S"), F.lit(False)) for f in ("applicant_name", "species_code", "home_world", "visa_class", "declared_purpose", "risk_flags")},
    }
    return rows.withColumn("errors", F.array_compact(F.array(*(F.when(bad, F.lit(k)) for k, bad in checks.items()))))


def id_report(truth: DataFrame, predictions: DataFrame, examples: int = 20) -> DataFrame:
    """kind (duplicate, extra, missing, scored), n_ids, example ids (the first ``examples``, which is the report's feature)."""
    t = truth.select("case_id").where(F.col("case_id").rlike(r"\S")).distinct()
    counted = predictions.where(F.col("case_id").rlike(r"\S")).groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    parts = {
        "duplicate": counted.where("n > 1").select("case_id"),
        "extra": counted.join(t, "case_id", "left_anti").select("case_id"),
        "missing": t.join(counted, "case_id", "left_anti"),
        "scored": t.join(counted, "case_id", "left_semi"),
    }
    out = None
    for kind, ids in parts.items():
        first = ids.orderBy("case_id").limit(examples).agg(F.array_join(F.array_sort(F.collect_list("case_id")), " ").alias("examples"))
        part = ids.agg(F.count(F.lit(1)).alias("n_ids")).crossJoin(first).select(F.lit(kind).alias("kind"), "n_ids", "examples")
        out = part if out is None else out.unionByName(part)
    return out
