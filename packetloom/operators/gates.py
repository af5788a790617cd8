"""Release gates and leakage scans over scored results and artifacts."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys and value shapes that identify a case; fixed values.
IDENTITY_KEYS = frozenset({"case_id", "case_ids", "filename", "filenames", "pdf_hash", "pdf_hashes", "file_hash", "sha256"})
IDENTITY_VALUES = {"file name": r"(?i)^.*\.pdf$", "case id": r"(?i)^MIB-[0-9]+$", "hash": r"^[0-9A-Fa-f]{32,64}$"}


def release_gate(candidate: DataFrame, baseline: DataFrame, guarded: DataFrame | None = None) -> DataFrame:
    """One row: decision, blocking, warnings (joined by "; ") and the change of false approvals.

    Both are results of ``scoring.scored``.  Other cases than the baseline's, or
    more false approvals, block; newly missing, invalid or (among the
    ``guarded`` case ids) wrong cases warn.
    """
    left = candidate.select("case_id", F.col("outcome").alias("after"), F.lit(1).alias("a"))
    right = baseline.select("case_id", F.col("outcome").alias("before"), F.lit(1).alias("b"))
    both = left.join(right, "case_id", "full")
    watched = both.withColumn("guarded", F.lit(True)) if guarded is None else both.join(guarded.select("case_id", F.lit(True).alias("guarded")).distinct(), "case_id", "left")
    def of(column: str, outcome: str):
        return F.count_if(F.col(column) == outcome)

    sums = watched.agg(
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("uncovered"),
        (of("after", "catastrophic_false_approval") - of("before", "catastrophic_false_approval")).alias("false_approvals"),
        (of("after", "missing_case") - of("before", "missing_case")).alias("missing"),
        (of("after", "invalid_or_blank") - of("before", "invalid_or_blank")).alias("invalid"),
        F.count_if((F.col("before") == "correct") & (F.col("after") != "correct") & F.coalesce("guarded", F.lit(False))).alias("regressions"),
    )
    blocking = F.array_compact(F.array(F.when(F.col("uncovered") > 0, "different cases"), F.when(F.col("false_approvals") > 0, "more false approvals")))
    warnings = F.array_compact(F.array(F.when(F.col("regressions") > 0, "regressions"), F.when(F.col("invalid") > 0, "more invalid rows"), F.when(F.col("missing") > 0, "more missing rows")))
    decided = sums.withColumn("blocking", blocking).withColumn("warnings", warnings)
    decision = F.when(F.size("blocking") > 0, "BLOCKED").when(F.size("warnings") > 0, "PASS_WITH_WARNINGS").otherwise("PASS")
    return decided.select(decision.alias("decision"), F.array_join("blocking", "; ").alias("blocking"), F.array_join("warnings", "; ").alias("warnings"), "false_approvals", "regressions")


def identity_leaks(value: Any, path: str = "$") -> list[tuple[str, str]]:
    """(path, finding) of identifying keys and values anywhere in an artifact's JSON."""
    import re

    out = []
    if isinstance(value, dict):
        for key, child in value.items():
            here = f"{path}.{key}"
            if str(key).strip().lower() in IDENTITY_KEYS:
                out.append((here, "identity key"))
            out += identity_leaks(child, here)
    elif isinstance(value, (list, tuple)):
        for i, child in enumerate(value):
            out += identity_leaks(child, f"{path}[{i}]")
    elif isinstance(value, str):
        out += [(path, name) for name, p in IDENTITY_VALUES.items() if re.match(p, value.strip())]
    return out


def column_leaks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, finding, n_rows of table columns that hold identifying values; one scan for all columns."""
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.regexp_replace(F.col(c).cast("string"), r"^\s+|\s+$", "").alias("v")) for c in columns))
    hits = F.array_compact(F.array(*(F.when(F.col("v").rlike(p), F.lit(n)) for n, p in IDENTITY_VALUES.items())))
    found = rows.select(F.inline(cells)).select("column_name", F.explode(hits).alias("finding"))
    return found.groupBy("column_name", "finding").agg(F.count(F.lit(1)).alias("n_rows"))


def rule_support(rules: DataFrame, facts: DataFrame) -> DataFrame:
    """rule_id, case_id of the rules all of whose (key, value) conditions a case meets: relational division by counts.

    ``rules``: rule_id, key, value; ``facts``: case_id, key, value.
    """
    wanted = rules.distinct()
    need = wanted.groupBy("rule_id").agg(F.count(F.lit(1)).alias("need"))
    met = facts.distinct().join(wanted, ["key", "value"]).groupBy("rule_id", "case_id").agg(F.count(F.lit(1)).alias("met"))
    return met.join(need, "rule_id").where(F.col("met") == F.col("need")).select("rule_id", "case_id")


#: Roles of splits that nothing is tuned on; fixed values.
HOLDOUT_ROLES = ("calibration", "release", "golden", "adversarial")
SCORES = ("total_score", "extraction_score", "classification_score", "calibration_score")
COUNTS = ("catastrophic_false_approvals", "missing_rows", "invalid_rows")


def honest_holdout(name, role, tuned_on):
    """Whether a split (columns: name, role, array of the splits tuned on) is measured honestly; nulls are not."""
    return F.coalesce(role.isin(*HOLDOUT_ROLES) & ~F.array_contains(F.coalesce(tuned_on, F.array().cast("array<string>")), name), F.lit(False))


def sample_faults(samples: DataFrame, manifest: DataFrame, tuning: DataFrame, split_name: str) -> DataFrame:
    """fault, n_samples of calibration samples (case_id, split_name, raw_signal, correct) that may not be fitted on.

    ``manifest`` and ``tuning``: case_id of the calibration and of the tuning cases.
    """
    tidy = samples.withColumn("id", F.regexp_replace(F.coalesce("case_id", F.lit("")), r"^\s+|\s+$", ""))
    known, tuned = (m.select(F.col("case_id").alias("id"), F.lit(True).alias(flag)).distinct() for m, flag in ((manifest, "known"), (tuning, "tuned")))
    often = tidy.groupBy("id").agg(F.count(F.lit(1)).alias("often"))
    joined = tidy.join(often, "id").join(known, "id", "left").join(tuned, "id", "left")
    bad = {
        "no case id": F.col("id") == "", "repeated case id": (F.col("id") != "") & (F.col("often") > 1), "wrong split": ~F.col("split_name").eqNullSafe(F.lit(split_name)), "not in the manifest": F.col("known").isNull(),
        "tuned on": F.col("tuned").isNotNull(), "signal out of range": ~F.coalesce(F.col("raw_signal").between(0, 1) & ~F.isnan("raw_signal"), F.lit(False)), "no outcome": F.col("correct").isNull(),
    }
    faults = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in bad.items())))
    return joined.select(F.explode(faults).alias("fault")).groupBy("fault").agg(F.count(F.lit(1)).alias("n_samples"))


def proof_faults(rules: DataFrame, visible: DataFrame, heldout: DataFrame, tuning: DataFrame, least: int = 2) -> DataFrame:
    """rule_id, faults (joined by "; ", empty for a sound rule) of rules by the cases that support them.

    ``visible``, ``heldout``: rule_id, case_id; ``tuning``: case_id.
    """
    seen, held = visible.select("rule_id", "case_id").distinct(), heldout.select("rule_id", "case_id").distinct()
    n_seen = seen.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_seen"))
    marked = held.join(seen.withColumn("seen", F.lit(1)), ["rule_id", "case_id"], "left").join(tuning.select("case_id", F.lit(1).alias("tuned")).distinct(), "case_id", "left")
    n_held = marked.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_held"), F.count("seen").alias("n_both"), F.count("tuned").alias("n_tuned"))
    joined = rules.select("rule_id").distinct().join(n_seen, "rule_id", "left").join(n_held, "rule_id", "left").na.fill(0)
    bad = {"no visible support": F.col("n_seen") == 0, "too little held-out support": F.col("n_held") < least, "held-out support is not visible": F.col("n_both") < F.col("n_held"), "held-out support was tuned on": F.col("n_tuned") > 0}
    return joined.select("rule_id", F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in bad.items()))), "; ").alias("faults"))


def decide(candidate: DataFrame, baseline: DataFrame, regressions: DataFrame) -> DataFrame:
    """One row: decision, adopt, blocking, warnings and the deltas of the scores.

    ``candidate`` and ``baseline`` are one row each: split_name, role,
    tuned_splits, the SCORES and COUNTS, runtime_seconds, peak_memory_mib,
    source, n_leaks, n_cases; a measurement that is null is missing.
    ``regressions``: one row: n_other_cases (in one result alone), n_golden and
    n_adversarial (right before, wrong now).
    """
    c, b = candidate.select(F.struct("*").alias("c")), baseline.select(F.struct("*").alias("b"))
    row = c.crossJoin(b).crossJoin(regressions)  # one row each
    honest = {k: honest_holdout(F.col(f"{k}.split_name"), F.col(f"{k}.role"), F.col(f"{k}.tuned_splits")) for k in "cb"}

    def worse(name: str):
        return F.coalesce(F.col(f"c.{name}"), F.lit(0)) > F.coalesce(F.col(f"b.{name}"), F.lit(0))

    blocks = {
        "candidate split is no honest holdout": ~honest["c"], "baseline split is no honest holdout": ~honest["b"], "different splits": ~F.col("c.split_name").eqNullSafe(F.col("b.split_name")), "different cases": F.col("n_other_cases") > 0,
        **{f"{m} is missing": F.col(f"c.{m}").isNull() for m in ("runtime_seconds", "peak_memory_mib", "source")},
        "no runtime measured": F.coalesce("c.runtime_seconds", F.lit(0.0)) <= 0, "no peak memory measured": F.coalesce("c.peak_memory_mib", F.lit(0.0)) <= 0, "only the evaluator was measured": F.col("c.source").eqNullSafe(F.lit("official_evaluator_process_only")),
        "leakage": F.coalesce("c.n_leaks", F.lit(0)) > 0, **{f"{m} is missing": F.col(f"c.{m}").isNull() for m in (*SCORES, *COUNTS)},
        "more false approvals": F.coalesce("c.catastrophic_false_approvals", F.coalesce("b.catastrophic_false_approvals", F.lit(0)) + 1) > F.coalesce("b.catastrophic_false_approvals", F.lit(0)),
    }
    warns = {"golden regressions": F.col("n_golden") > 0, "adversarial regressions": F.col("n_adversarial") > 0, "more invalid rows": worse("invalid_rows"), "more missing rows": worse("missing_rows")}
    blocking, warnings = (F.array_compact(F.array(*(F.when(cond, F.lit(k)) for k, cond in table.items()))) for table in (blocks, warns))
    out = row.withColumn("blocking", blocking).withColumn("warnings", warnings)
    decision = F.when(F.size("blocking") > 0, "BLOCKED").when(F.size("warnings") > 0, "PASS_WITH_WARNINGS").otherwise("PASS")
    deltas = [(F.coalesce(F.col(f"c.{s}"), F.lit(0.0)) - F.coalesce(F.col(f"b.{s}"), F.lit(0.0))).alias(f"{s}_delta") for s in SCORES]
    return out.select(decision.alias("decision"), (F.size("blocking") == 0).alias("adopt"), F.array_join("blocking", "; ").alias("blocking"), F.array_join("warnings", "; ").alias("warnings"), *deltas)
