"""Queries of traces, confidences by trace, result rows and release decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import text as tx
from packetloom.operators import gates, scoring, traces
from packetloom.plans import evaluation
from packetloom.plans.evaluation import _FL, scored_sql
from packetloom.session import table

#: Bare reasons of the traces made here.
BARE = ("fee_paid", "required_sponsor_unknown", "sponsor_present_and_not_publicly_barred", "strict_approval_bar_cleared", "unpaid_without_valid_waiver", "visa_class_unknown")
SECTIONS = ("extraction", "classification", "calibration", "missing_penalty", "total", "mean_brier")
LEAST_BUCKET = 20
RULES = [("r1", "fee_status", "paid"), ("r1", "visa_class", "KX-1"), ("r2", "fee_status", "unpaid"), ("r2", "visa_class", "KX-2"), ("r3", "fee_status", "waived"), ("r3", "risk_flags", "none")]


def _traces(spark: SparkSession, d: str) -> DataFrame:
    """A decision trace of each prediction with a decision: flags, fee, sponsor and visa as its reasons."""
    flags = tx.flag_set(F.col("risk_flags"))
    none = F.array().cast("array<string>")

    def part(condition, name: str):
        return F.when(condition, F.array(F.lit(name))).otherwise(none)

    fee, decision = F.coalesce("fee_status", F.lit("")), F.col("adjudication")
    denial = F.concat(F.transform(flags, lambda f: F.concat(F.lit("disqualifying_flag:"), f)), part(fee == "unpaid", "unpaid_without_valid_waiver"))
    review = F.concat(F.transform(flags, lambda f: F.concat(F.lit("review_flag:"), f)), part(F.col("sponsor_id").isNull(), "required_sponsor_unknown"), part(F.col("visa_class").isNull(), "visa_class_unknown"))
    facts = F.concat(F.array(F.lit("strict_approval_bar_cleared")), part(fee == "paid", "fee_paid"), part(F.col("sponsor_id").isNotNull(), "sponsor_present_and_not_publicly_barred"))
    rows = table(spark, d, "predictions").where(decision.isin(*scoring.DECISIONS))
    return rows.select(
        "pred_id", "case_id", decision.alias("decision"), F.coalesce(F.col("confidence") >= 0.97, F.lit(False)).alias("authoritative"), F.when(decision == "DENIED", denial).otherwise(none).alias("denial_reasons"),
        F.when(decision == "NEEDS_REVIEW", review).otherwise(none).alias("review_reasons"), F.when(decision == "APPROVED", facts).otherwise(none).alias("approval_facts"),
    )


def signatures(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).groupBy(traces.signature(BARE).alias("signature")).agg(F.count(F.lit(1)).alias("n_rows"))


def buckets(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).groupBy(traces.bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


def raw_signals(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).select("pred_id", F.round(traces.raw_signal(), 6).alias("signal"))


def trace_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The share of right decisions by decision and bucket, smoothed from the whole down; rare buckets inherit."""
    truth = scoring.last_truth(table(spark, d, "train_labels")).select("case_id", F.col("adjudication").alias("truth"))
    rows = _traces(spark, d).withColumn("bucket", traces.bucket())
    judged = rows.join(truth, "case_id").withColumn("right", (F.col("decision") == F.col("truth")).cast("int")).where("right IS NOT NULL")
    per = {k: judged.groupBy(k).agg(F.sum("right").alias("good"), F.count(F.lit(1)).alias("n")) for k in ("decision", "bucket")}
    whole = judged.agg(F.avg("right")).first()[0] or 0.0
    out = traces.fallback_lookup(rows, [("decision", per["decision"], 8.0), ("bucket", per["bucket"].where(F.col("n") >= LEAST_BUCKET), 4.0)], whole, 0.02, 0.98)
    return out.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.max("probability"), 6).alias("probability"))


def recalibrated(spark: SparkSession, d: str) -> DataFrame:
    """Per run and decision the rows whose confidence changed, with the sum of the changes; no other column may change."""
    old = table(spark, d, "predictions")
    new = traces.recalibrated(old, tx.clip(F.col("confidence") * 0.5 + 0.125, 0.02, 0.98))
    others = [c for c in old.columns if c != "confidence"]
    both = new.select("pred_id", F.col("confidence").alias("new"), F.xxhash64(*others).alias("after")).join(old.select("pred_id", "run_id", "adjudication", "confidence", F.xxhash64(*others).alias("before")), "pred_id")
    return both.groupBy("run_id", "adjudication").agg(F.count_if(~F.col("new").eqNullSafe(F.col("confidence"))).alias("n_changed"), F.count_if(F.col("after") != F.col("before")).alias("n_touched"), F.round(F.sum(F.col("new") - F.col("confidence")), 4).alias("change"))


def result_rows(spark: SparkSession, d: str) -> DataFrame:
    """The whole result of a run as section, key and value: scores, outcomes and match rates."""
    cases = evaluation._cases(spark, d)
    scores = scoring.totals(cases).select(F.lit("score").alias("section"), F.explode(F.create_map(*(x for s in SECTIONS for x in (F.lit(s), F.col(s).cast("double"))))).alias("key", "value"))
    outcomes = cases.groupBy(F.lit("outcome").alias("section"), F.col("outcome").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    rates = scoring.field_rates(cases).select(F.lit("field").alias("section"), F.col("field_name").alias("key"), F.col("match_rate").alias("value"))
    return scores.unionByName(outcomes).unionByName(rates)


def honest_splits(spark: SparkSession, d: str) -> DataFrame:
    """The evaluation splits, when something was tuned on the validation and the release split."""
    splits = table(spark, d, "eval_labels").groupBy("split_name").agg(F.count(F.lit(1)).alias("n_records"))
    tuned = F.array(F.lit("validation"), F.lit("release"))
    return splits.select("split_name", "n_records", gates.honest_holdout(F.col("split_name"), F.col("split_name"), tuned).alias("honest"))


def sample_faults(spark: SparkSession, d: str) -> DataFrame:
    """What forbids to fit on the evaluation rows as calibration samples."""
    held = table(spark, d, "eval_labels")
    read = scoring.first_predictions(table(spark, d, "predictions").where("run_id = 'run_001'")).select("case_id", "confidence", F.col("adjudication").alias("decided"))
    samples = held.join(read, "case_id", "left").select("case_id", "split_name", F.col("confidence").alias("raw_signal"), (F.col("decided") == F.col("adjudication")).alias("correct"))
    return gates.sample_faults(samples, held.where("split_name = 'calibration'").select("case_id"), table(spark, d, "train_labels").select("case_id"), "calibration")


def rule_proofs(spark: SparkSession, d: str) -> DataFrame:
    """Three rules by the cases that support them: visible in the resolved fields, held out in the evaluation labels."""
    rules = spark.createDataFrame(RULES, "rule_id string, key string, value string")
    seen = table(spark, d, "resolved_fields").where("state = 'resolved'").select("case_id", F.col("field_name").alias("key"), "value")
    cells = F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in ("fee_status", "visa_class", "risk_flags")))
    held = table(spark, d, "eval_labels").select("case_id", F.inline(cells))
    return gates.proof_faults(rules, gates.rule_support(rules, seen), gates.rule_support(rules, held), table(spark, d, "train_labels").select("case_id"))


def release_decision(spark: SparkSession, d: str) -> DataFrame:
    """Run 2 against run 1 as candidate and baseline; cases without flags are the golden ones, those with several the adversarial ones."""
    truth = scoring.last_truth(table(spark, d, "train_labels")).select("case_id", F.size(tx.flag_set(F.col("risk_flags"))).alias("n_flags"))
    runs = {r: evaluation._cases(spark, d, r) for r in ("run_002", "run_001")}

    def summary(cases: DataFrame) -> DataFrame:
        counts = cases.agg(*(F.count_if(F.col("outcome") == o).alias(n) for o, n in zip(("catastrophic_false_approval", "missing_case", "invalid_or_blank"), gates.COUNTS, strict=True)))
        scores = scoring.totals(cases).select(*(F.col(s.removesuffix("_score")).alias(s) for s in gates.SCORES))
        fixed = {"split_name": F.lit("release"), "role": F.lit("release"), "tuned_splits": F.array(F.lit("calibration")), "runtime_seconds": F.lit(1.0), "peak_memory_mib": F.lit(1.0), "source": F.lit("spark"), "n_leaks": F.lit(0)}
        return counts.crossJoin(scores).select("*", *(c.alias(n) for n, c in fixed.items()))  # one row each

    both = runs["run_001"].select("case_id", F.col("outcome").alias("before")).join(runs["run_002"].select("case_id", F.col("outcome").alias("after")), "case_id", "full").join(truth, "case_id", "left")
    worse = (F.col("before") == "correct") & (F.col("after") != "correct")
    moved = both.agg(F.count_if(F.col("before").isNull() | F.col("after").isNull()).alias("n_other_cases"), F.count_if(worse & (F.col("n_flags") == 0)).alias("n_golden"), F.count_if(worse & (F.col("n_flags") > 1)).alias("n_adversarial"))
    out = gates.decide(summary(runs["run_002"]), summary(runs["run_001"]), moved)
    return out.select("decision", F.col("adopt").cast("int").alias("adopt"), "blocking", "warnings", *(F.round(f"{s}_delta", 6).alias(f"{s}_delta") for s in gates.SCORES))


QUERIES = {
    "f19_signatures": signatures, "f20_buckets": buckets, "k1_raw_signals": raw_signals, "j10_trace_confidence": trace_confidence, "k6_recalibrated": recalibrated, "e6_result_rows": result_rows, "ps2_honest_splits": honest_splits,
    "ps4_sample_faults": sample_faults, "ps6_rule_proofs": rule_proofs, "e9_release_decision": release_decision,
}

_F = _FL("risk_flags")
_TRACES = f"""tr AS (SELECT pred_id, case_id, adjudication AS decision, coalesce(confidence >= 0.97, false) AS auth,
  CASE WHEN adjudication = 'DENIED' THEN list_concat(list_transform({_F}, lambda f: 'disqualifying_flag:' || f), CASE WHEN fee_status = 'unpaid' THEN ['unpaid_without_valid_waiver'] ELSE []::VARCHAR[] END) ELSE []::VARCHAR[] END AS den,
  CASE WHEN adjudication = 'NEEDS_REVIEW' THEN list_concat(list_concat(list_transform({_F}, lambda f: 'review_flag:' || f), CASE WHEN sponsor_id IS NULL THEN ['required_sponsor_unknown'] ELSE []::VARCHAR[] END), CASE WHEN visa_class IS NULL THEN ['visa_class_unknown'] ELSE []::VARCHAR[] END) ELSE []::VARCHAR[] END AS rev,
  CASE WHEN adjudication = 'APPROVED' THEN list_concat(list_concat(['strict_approval_bar_cleared'], CASE WHEN fee_status = 'paid' THEN ['fee_paid'] ELSE []::VARCHAR[] END), CASE WHEN sponsor_id IS NOT NULL THEN ['sponsor_present_and_not_publicly_barred'] ELSE []::VARCHAR[] END) ELSE []::VARCHAR[] END AS app
  FROM predictions WHERE adjudication IN ('APPROVED', 'DENIED', 'NEEDS_REVIEW')),
b AS (SELECT *, decision || '|' || CASE WHEN auth THEN 'authoritative' WHEN decision = 'DENIED' THEN 'reason=' || CASE WHEN len(list_filter(den, lambda x: starts_with(x, 'disqualifying_flag:'))) > 0 THEN 'disqualifying_flag' WHEN list_contains(den, 'unpaid_without_valid_waiver') THEN 'unpaid_without_valid_waiver' ELSE 'other' END
  WHEN decision = 'APPROVED' THEN 'support=' || (len(app) - 1) ELSE 'class=' || CASE WHEN len(list_filter(rev, lambda x: starts_with(x, 'review_flag:'))) > 0 THEN 'review_flag' WHEN len(rev) > 0 THEN 'core_gap' ELSE 'policy_only' END END AS bucket FROM tr)"""
_SAFE = lambda c: f"array_to_string(list_sort(list_distinct(list_transform({c}, lambda x: CASE WHEN contains(x, ':') AND NOT regexp_full_match(x, '[a-z_]+:[a-z][a-z0-9_]*') THEN split_part(x, ':', 1) || ':*' ELSE x END))), ',')"
_TRUTH = evaluation._TRUTH
_RULES = "rules(rule_id, key, value) AS (VALUES " + ", ".join(map(str, RULES)) + ")"
_E5, _A3 = evaluation.ORACLE["e5_section_scores"], evaluation.ORACLE["a3_field_rates"]
_SUM = lambda run: f"""SELECT count(CASE WHEN outcome = 'catastrophic_false_approval' THEN 1 END) AS fa, count(CASE WHEN outcome = 'missing_case' THEN 1 END) AS mi, count(CASE WHEN outcome = 'invalid_or_blank' THEN 1 END) AS inv, count(*) AS n, 50.0 * sum(field_points) / (count(*) * {sum(scoring.WEIGHTS.values())}) AS ex,
  80.0 * sum(decision_points) / (count(*) * 8) AS cl, coalesce(20 * greatest(0.0, 1 - 2 * avg(brier)), 0) AS ca FROM {run}"""  # noqa: E731
ORACLE = {
    "f19_signatures": f"WITH {_TRACES} SELECT decision || '|source=' || CASE WHEN auth THEN 'authoritative' ELSE 'rules' END || '|denial=' || {_SAFE('den')} || '|review=' || {_SAFE('rev')} || '|approval=' || {_SAFE('app')} AS signature, count(*) AS n_rows FROM tr GROUP BY 1",
    "f20_buckets": f"WITH {_TRACES} SELECT bucket, count(*) AS n_rows FROM b GROUP BY 1",
    "k1_raw_signals": f"""WITH {_TRACES} SELECT pred_id, round((CASE WHEN auth THEN 0.98 WHEN decision = 'DENIED' THEN least(0.99, CASE WHEN len(den) > 0 THEN 0.93 ELSE 0.84 END + least(0.05, greatest(0, len(den) - 1) * 0.015))
        WHEN decision = 'NEEDS_REVIEW' THEN least(0.98, CASE WHEN contains(array_to_string(rev, ','), 'review_flag:') THEN 0.88 ELSE 0.74 END + least(0.06, greatest(0, len(rev) - 1) * 0.01)) ELSE least(0.93, 0.78 + (len(app) - 1) * 0.025) END)::DOUBLE, 6) AS signal FROM b""",
    "j10_trace_confidence": f"""WITH {_TRUTH}, {_TRACES}, j AS (SELECT b.decision, b.bucket, (b.decision = t.adjudication)::INT AS ok FROM b JOIN truth t USING (case_id) WHERE t.adjudication IS NOT NULL), g AS (SELECT coalesce(avg(ok), 0) AS p FROM j),
        de AS (SELECT decision, (sum(ok) + 8 * any_value(g.p)) / (count(*) + 8) AS p FROM j, g GROUP BY 1), bu AS (SELECT bucket, sum(ok) AS good, count(*) AS n FROM j GROUP BY 1 HAVING count(*) >= {LEAST_BUCKET}),
        r AS (SELECT b.bucket, coalesce(de.p, g.p) AS pd, bu.good, bu.n FROM b CROSS JOIN g LEFT JOIN de USING (decision) LEFT JOIN bu ON bu.bucket = b.bucket)
        SELECT bucket, count(*) AS n_rows, round(max(greatest(0.02, least(0.98, CASE WHEN n IS NULL THEN pd ELSE (good + 4 * pd) / (n + 4) END))), 6) AS probability FROM r GROUP BY 1""",
    "k6_recalibrated": """WITH n AS (SELECT *, CASE WHEN adjudication = 'NEEDS_REVIEW' AND confidence < 0.9 THEN greatest(0.02::DOUBLE, least(0.98::DOUBLE, confidence * 0.5::DOUBLE + 0.125::DOUBLE)) ELSE confidence END AS new FROM predictions)
        SELECT run_id, adjudication, count(CASE WHEN new IS DISTINCT FROM confidence THEN 1 END) AS n_changed, 0 AS n_touched, round(sum(new - confidence), 4) AS change FROM n GROUP BY 1, 2""",
    "e6_result_rows": " UNION ALL ".join(f"SELECT 'score' AS section, '{s}' AS key, {s}::DOUBLE AS value FROM ({_E5})" for s in SECTIONS)
    + f" UNION ALL SELECT 'outcome', outcome, count(*)::DOUBLE FROM (WITH {scored_sql('a', 'run_001')} SELECT * FROM a) GROUP BY outcome UNION ALL SELECT 'field', field_name, match_rate FROM ({_A3})",
    "ps2_honest_splits": "SELECT split_name, count(*) AS n_records, coalesce(split_name IN ('calibration', 'golden', 'adversarial'), false) AS honest FROM eval_labels GROUP BY 1",
    "ps4_sample_faults": """WITH p AS (SELECT * FROM predictions WHERE run_id = 'run_001' AND regexp_matches(case_id, '\\S') QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY pred_id) = 1),
        s AS (SELECT regexp_replace(coalesce(e.case_id, ''), '^\\s+|\\s+$', '', 'g') AS id, e.split_name, p.confidence AS sig, p.adjudication = e.adjudication AS ok FROM eval_labels e LEFT JOIN p USING (case_id)), c AS (SELECT id, count(*) AS n FROM s GROUP BY 1),
        f AS (SELECT 'no case id' AS fault FROM s WHERE id = '' UNION ALL SELECT 'repeated case id' FROM s JOIN c USING (id) WHERE id <> '' AND n > 1 UNION ALL SELECT 'wrong split' FROM s WHERE split_name IS DISTINCT FROM 'calibration'
          UNION ALL SELECT 'not in the manifest' FROM s WHERE NOT EXISTS (SELECT 1 FROM eval_labels m WHERE m.split_name = 'calibration' AND m.case_id = s.id) UNION ALL SELECT 'tuned on' FROM s WHERE EXISTS (SELECT 1 FROM train_labels t WHERE t.case_id = s.id)
          UNION ALL SELECT 'signal out of range' FROM s WHERE NOT coalesce(sig BETWEEN 0 AND 1, false) UNION ALL SELECT 'no outcome' FROM s WHERE ok IS NULL) SELECT fault, count(*) AS n_samples FROM f GROUP BY 1""",
    "ps6_rule_proofs": f"""WITH {_RULES}, v AS (SELECT rule_id, case_id FROM rules JOIN (SELECT DISTINCT case_id, field_name AS key, value FROM resolved_fields WHERE state = 'resolved') USING (key, value) GROUP BY 1, 2 HAVING count(*) = 2),
        hf AS (SELECT DISTINCT case_id, key, value FROM (SELECT case_id, 'fee_status' AS key, fee_status AS value FROM eval_labels UNION ALL SELECT case_id, 'visa_class', visa_class FROM eval_labels UNION ALL SELECT case_id, 'risk_flags', risk_flags FROM eval_labels)),
        h AS (SELECT rule_id, case_id FROM rules JOIN hf USING (key, value) GROUP BY 1, 2 HAVING count(*) = 2),
        x AS (SELECT rule_id, (SELECT count(*) FROM v WHERE v.rule_id = r.rule_id) AS ns, (SELECT count(*) FROM h WHERE h.rule_id = r.rule_id) AS nh, (SELECT count(*) FROM h WHERE h.rule_id = r.rule_id AND EXISTS (SELECT 1 FROM v WHERE v.rule_id = h.rule_id AND v.case_id = h.case_id)) AS nb,
          (SELECT count(*) FROM h WHERE h.rule_id = r.rule_id AND h.case_id IN (SELECT case_id FROM train_labels WHERE case_id IS NOT NULL)) AS nt FROM (SELECT DISTINCT rule_id FROM rules) r)
        SELECT rule_id, concat_ws('; ', CASE WHEN ns = 0 THEN 'no visible support' END, CASE WHEN nh < 2 THEN 'too little held-out support' END, CASE WHEN nb < nh THEN 'held-out support is not visible' END, CASE WHEN nt > 0 THEN 'held-out support was tuned on' END) AS faults FROM x""",
    "e9_release_decision": f"""WITH {scored_sql("a", "run_001", "b", "run_002")}, sa AS ({_SUM('a')}), sb AS ({_SUM('b')}),
        m AS (SELECT count(CASE WHEN a.outcome = 'correct' AND b.outcome <> 'correct' AND len({_FL('t.risk_flags')}) = 0 THEN 1 END) AS g, count(CASE WHEN a.outcome = 'correct' AND b.outcome <> 'correct' AND len({_FL('t.risk_flags')}) > 1 THEN 1 END) AS adv FROM a JOIN b USING (case_id) JOIN truth t USING (case_id)),
        z AS (SELECT concat_ws('; ', CASE WHEN sb.fa > sa.fa THEN 'more false approvals' END) AS bl, concat_ws('; ', CASE WHEN g > 0 THEN 'golden regressions' END, CASE WHEN adv > 0 THEN 'adversarial regressions' END, CASE WHEN sb.inv > sa.inv THEN 'more invalid rows' END, CASE WHEN sb.mi > sa.mi THEN 'more missing rows' END) AS wa,
          round(sb.ex, 6) - round(sa.ex, 6) AS dx, round(sb.cl, 6) - round(sa.cl, 6) AS dc, round(sb.ca, 6) - round(sa.ca, 6) AS dk, round(sb.ex + sb.cl + sb.ca - 10.0 * sb.mi / sb.n, 6) - round(sa.ex + sa.cl + sa.ca - 10.0 * sa.mi / sa.n, 6) AS dt FROM sa, sb, m)
        SELECT CASE WHEN bl <> '' THEN 'BLOCKED' WHEN wa <> '' THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS decision, (bl = '')::INT AS adopt, bl AS blocking, wa AS warnings, round(dt, 6) AS total_score_delta, round(dx, 6) AS extraction_score_delta, round(dc, 6) AS classification_score_delta, round(dk, 6) AS calibration_score_delta FROM z""",
}
