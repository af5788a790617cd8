"""Decision traces: their signature, bucket, signal, and confidences looked up by them.

A trace is a row with decision, authoritative (boolean) and the arrays
denial_reasons, review_reasons and approval_facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import text as tx
from packetloom.session import maybe_broadcast

#: Categories of denials in the order of their test; fixed values.
DENIALS = (
    "disqualifying_flag:", "barred_sponsor:", "embargoed_home_world:", "transit_work_authorization", "biohazard_red", "unpaid_without_valid_waiver", "stale_application", "stay_limit_exceeded:", "required_sponsor_absent",
    "validated_generalizable_exception",
)
#: Denials that are no matter of judgement; fixed values.
HARD = DENIALS[:-1]
#: Prefixes of review reasons by class, in the order of their test; fixed values.
CONFLICTS = ("contested_field:", "unresolved_linkage:", "conflicting_generalizable_exceptions")
GAPS = ("required_output_", "visa_class_", "risk_flags_", "fee_status_", "arrival_date_", "required_sponsor_")
CLEARED = "strict_approval_bar_cleared"
#: Prefixes whose suffix may be shown; fixed values.
SHOWN = ("contested_field", "disqualifying_flag", "required_output_not_visible", "required_output_unknown", "review_flag")


def _any_starts(reasons: str, prefixes: tuple[str, ...]) -> Column:
    def one(r: Column) -> Column:
        out = F.lit(False)
        for p in prefixes:
            out = out | r.startswith(p)
        return out

    return F.exists(F.coalesce(reasons, F.array().cast("array<string>")), one)


def _size(column: str) -> Column:
    return F.coalesce(F.size(column), F.lit(0))


def _facts() -> Column:
    return F.size(F.filter(F.coalesce("approval_facts", F.array().cast("array<string>")), lambda f: f != CLEARED))


def features(reasons: str, bare: tuple[str, ...], shown: tuple[str, ...] = SHOWN) -> Column:
    """The sorted distinct reasons without values of a case: bare tokens of the list, ``prefix:suffix`` of shown prefixes, ``prefix:*`` of others."""

    def one(reason: Column) -> Column:
        r = F.lower(tx.strip(reason))
        head, tail = F.substring_index(r, ":", 1), F.regexp_replace(r, "^[^:]*:", "")
        safe = r"^[a-z][a-z0-9_]*$"
        named = F.when(~head.rlike(safe), "other").when(head.isin(*shown) & tail.rlike(safe), r).otherwise(F.concat(head, F.lit(":*")))
        return F.when(r.contains(":"), named).when(r.isin(*bare), r).otherwise("other")

    return F.array_sort(F.array_distinct(F.transform(F.coalesce(reasons, F.array().cast("array<string>")), one)))


def signature(bare: tuple[str, ...]) -> Column:
    """decision|source=|denial=|review=|approval= of a trace, without values of the case."""
    parts = [F.concat(F.lit(f"{name}="), F.array_join(features(c, bare), ",")) for name, c in (("denial", "denial_reasons"), ("review", "review_reasons"), ("approval", "approval_facts"))]
    source = F.when(F.col("authoritative"), "source=authoritative").otherwise("source=rules")
    return F.concat_ws("|", "decision", source, *parts)


def bucket() -> Column:
    """The first category of the trace's decision that applies."""
    denial = F.lit("other")
    for p in reversed(DENIALS):
        denial = F.when(_any_starts("denial_reasons", (p,)), p.rstrip(":")).otherwise(denial)
    hidden = F.exists(F.coalesce("review_reasons", F.array().cast("array<string>")), lambda r: r.contains("not_visible"))
    review = F.when(_any_starts("review_reasons", ("review_flag:",)), "review_flag").when(_any_starts("review_reasons", CONFLICTS), "conflict").when(_any_starts("review_reasons", GAPS) | hidden, "core_gap").otherwise("policy_only")
    rest = F.when(F.col("decision") == "DENIED", F.concat(F.lit("reason="), denial)).when(F.col("decision") == "APPROVED", F.concat(F.lit("support="), F.least(F.lit(6), _facts()).cast("string"))).otherwise(F.concat(F.lit("class="), review))
    return F.concat_ws("|", "decision", F.when(F.col("authoritative"), "authoritative").otherwise(rest))


def raw_signal() -> Column:
    """How strong the decision is by the kind and number of its reasons; the constants are fixed values."""
    hard = _any_starts("denial_reasons", HARD)
    denied = F.least(F.lit(0.99), F.when(hard, 0.93).otherwise(0.84) + F.least(F.lit(0.05), F.greatest(F.lit(0), _size("denial_reasons") - 1) * 0.015))
    hidden = F.exists(F.coalesce("review_reasons", F.array().cast("array<string>")), lambda r: r.contains("not_visible"))
    base = F.when(_any_starts("review_reasons", ("contested_field:",)), 0.94).when(_any_starts("review_reasons", ("unresolved_linkage:",)), 0.92).when(_any_starts("review_reasons", ("review_flag:",)), 0.88).when(hidden, 0.83).otherwise(0.74)
    review = F.least(F.lit(0.98), base + F.least(F.lit(0.06), F.greatest(F.lit(0), _size("review_reasons") - 1) * 0.01))
    approved = F.least(F.lit(0.93), F.lit(0.78) + F.least(F.lit(6), _facts()) * 0.025)
    return F.when(F.col("authoritative"), 0.98).when(F.col("decision") == "DENIED", denied).when(F.col("decision") == "NEEDS_REVIEW", review).when(F.col("decision") == "APPROVED", approved)


def fallback_lookup(rows: DataFrame, levels: list[tuple[str, DataFrame, float]], overall: float, low: float, high: float) -> DataFrame:
    """``rows`` with ``probability``: (good + s * parent) / (n + s) from the whole down, a level that is not known inherits.

    ``levels``: (key column, table of key, good, n; strength s).
    """
    out = rows.withColumn("probability", F.lit(float(overall)))
    for key, table, strength in levels:
        known = maybe_broadcast(table.select(key, F.col("good").alias("__good"), F.col("n").alias("__n")))
        smoothed = (F.col("__good") + strength * F.col("probability")) / (F.col("__n") + strength)
        out = out.join(known, key, "left").withColumn("probability", F.when(F.col("__n").isNotNull(), smoothed).otherwise(F.col("probability"))).drop("__good", "__n")
    return out.withColumn("probability", tx.clip(F.col("probability"), low, high))


def recalibrated(predictions: DataFrame, new: Column, decision: str = "NEEDS_REVIEW", below: float = 0.9) -> DataFrame:
    """``predictions`` with another confidence where the decision and the old confidence call for it; no other column changes."""
    changes = F.coalesce((F.col("adjudication") == decision) & (F.col("confidence") < below), F.lit(False))
    return predictions.withColumn("confidence", F.when(changes, new).otherwise(F.col("confidence")))
