"""Queries of scoring, validation, splits and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import text as tx
from packetloom.operators import calibration, scoring, splits
from packetloom.session import table

SEED = "packet-split"
STEPS = [(0.0, 0.2), (0.5, 0.55), (0.75, 0.8), (1.0, 0.95)]


def _truth(spark: SparkSession, d: str) -> DataFrame:
    return scoring.last_truth(table(spark, d, "train_labels"))


def _cases(spark: SparkSession, d: str, run: str = "run_001") -> DataFrame:
    predictions = table(spark, d, "predictions").where(F.col("run_id") == run)
    return scoring.scored(_truth(spark, d), scoring.first_predictions(predictions))


def case_scores(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, d).select("case_id", "outcome", "field_points", "decision_points", F.round("brier", 6).alias("brier"))


def section_scores(spark: SparkSession, d: str) -> DataFrame:
    return scoring.totals(_cases(spark, d))


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return scoring.confusion(_cases(spark, d))


def field_rates(spark: SparkSession, d: str) -> DataFrame:
    return scoring.field_rates(_cases(spark, d))


def error_groups(spark: SparkSession, d: str) -> DataFrame:
    return scoring.error_groups(_cases(spark, d), ("outcome", "wanted", "decided"))


def regressions(spark: SparkSession, d: str) -> DataFrame:
    return scoring.regressions(_cases(spark, d), _cases(spark, d, "run_002"))


def row_errors(spark: SparkSession, d: str) -> DataFrame:
    bad = scoring.row_errors(table(spark, d, "predictions")).select("run_id", F.explode("errors").alias("error"))
    return bad.groupBy("run_id", "error").agg(F.count(F.lit(1)).alias("n_rows"))


def id_report(spark: SparkSession, d: str) -> DataFrame:
    return scoring.id_report(table(spark, d, "train_labels"), table(spark, d, "predictions").where("run_id = 'run_001'"))


def split(spark: SparkSession, d: str) -> DataFrame:
    return splits.stratified_split(_truth(spark, d), "adjudication", SEED)


def split_overlap(spark: SparkSession, d: str) -> DataFrame:
    train = table(spark, d, "train_labels").select("case_id", F.lit("train").alias("role"))
    held = table(spark, d, "eval_labels").select("case_id", F.col("split_name").alias("role"))
    return splits.role_conflicts(train.unionByName(held).where("case_id IS NOT NULL"))


def _samples(spark: SparkSession, d: str) -> DataFrame:
    labels = _truth(spark, d).select("case_id", F.col("adjudication").alias("truth"))
    rows = table(spark, d, "predictions").where(F.col("confidence").between(0, 1)).join(labels, "case_id")
    return rows.select("run_id", "adjudication", "fee_status", "confidence", (F.col("adjudication") == F.col("truth")).alias("correct"))


def isotonic(spark: SparkSession, d: str) -> DataFrame:
    """The steps of the isotonic fit of correctness on the confidence as given: breakpoint, probability."""
    steps = calibration.isotonic_steps(_samples(spark, d), "confidence", "correct")
    return spark.createDataFrame(steps, "signal double, probability double").select("signal", F.round("probability", 6).alias("probability"))


def mapped_confidence(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "predictions")
    return p.groupBy(calibration.step_lookup(F.col("confidence"), STEPS).alias("probability")).agg(F.count(F.lit(1)).alias("n_rows"))


def smoothed_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = _samples(spark, d).where("fee_status IS NOT NULL")
    out = calibration.hierarchical(rows, ["adjudication", "fee_status"], "correct", [8.0, 2.0])
    return out.select("adjudication", "fee_status", F.round("p_adjudication", 6).alias("p_adjudication"), F.round("p_fee_status", 6).alias("p_fee_status"))


def linear_map(spark: SparkSession, d: str) -> DataFrame:
    confidence = tx.safe_share(F.col("confidence"))  # no usable confidence counts as 0
    features = {"confidence": confidence, "review": (F.col("adjudication") == "NEEDS_REVIEW").cast("double"), "paid": F.coalesce((F.col("fee_status") == "paid").cast("double"), F.lit(0.0))}
    new = calibration.linear_recalibration(features, {"confidence": 0.5, "review": -0.125, "paid": 0.0625}, 0.25, confidence, 0.75)
    return table(spark, d, "predictions").select("pred_id", F.round(new + 1e-9, 6).alias("confidence"))


QUERIES = {
    "e3_case_scores": case_scores, "e5_section_scores": section_scores, "a2_confusion": confusion, "a3_field_rates": field_rates, "a4_error_groups": error_groups, "j11_regressions": regressions, "e1_row_errors": row_errors,
    "j1_id_report": id_report, "ps1_split_roles": split, "j12_split_overlap": split_overlap, "k2_mapped_confidence": mapped_confidence, "k3_smoothed_rates": smoothed_rates, "k5_linear_map": linear_map, "ps3_isotonic_fit": isotonic,
}

_COL = lambda c: f"regexp_replace(regexp_replace(lower(coalesce({c}, '')), '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
_FL = lambda c: f"list_sort(list_distinct(list_filter(list_transform(string_split(lower(coalesce({c}, '')), '|'), lambda p: regexp_replace(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g')), lambda p: p NOT IN ('', 'none', 'null', 'unknown'))))"
_TRUTH = "truth AS (SELECT * FROM train_labels WHERE regexp_matches(case_id, '\\S') QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY labelled_at DESC, record_id DESC) = 1)"
_MATCH = {f: (f"{_FL('t.' + f)} = {_FL('p.' + f)}" if f == "risk_flags" else f"{_COL('t.' + f)} = {_COL('p.' + f)}") for f in scoring.WEIGHTS}


def _scored(name: str, run: str) -> str:
    got, want = "upper(regexp_replace(coalesce(p.adjudication, ''), '^\\s+|\\s+$', '', 'g'))", "upper(regexp_replace(coalesce(t.adjudication, ''), '^\\s+|\\s+$', '', 'g'))"
    points = " + ".join(f"CASE WHEN p.pred_id IS NOT NULL AND {m} THEN {scoring.WEIGHTS[f]} ELSE 0 END" for f, m in _MATCH.items())
    matches = ", ".join(f"(p.pred_id IS NOT NULL AND {m})::INT AS m_{f}" for f, m in _MATCH.items())
    return f"""pred_{name} AS (SELECT * FROM predictions WHERE run_id = '{run}' AND regexp_matches(case_id, '\\S') QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY pred_id) = 1),
    raw_{name} AS (SELECT t.case_id, p.pred_id IS NOT NULL AS present, {want} AS wanted, CASE WHEN p.pred_id IS NULL THEN 'MISSING' ELSE {got} END AS decided, p.confidence, {points} AS field_points, {matches} FROM truth t LEFT JOIN pred_{name} p USING (case_id)),
    out_{name} AS (SELECT *, CASE WHEN NOT present THEN 'missing_case' WHEN decided NOT IN ('APPROVED', 'DENIED', 'NEEDS_REVIEW') THEN 'invalid_or_blank' WHEN wanted = decided THEN 'correct' WHEN wanted = 'DENIED' AND decided = 'APPROVED' THEN 'catastrophic_false_approval'
        WHEN decided = 'NEEDS_REVIEW' THEN 'conservative_review' WHEN wanted = 'NEEDS_REVIEW' THEN 'missed_review' ELSE 'wrong_decision' END AS outcome FROM raw_{name}),
    {name} AS (SELECT *, CASE outcome WHEN 'correct' THEN 8.0 WHEN 'catastrophic_false_approval' THEN -4.0 WHEN 'conservative_review' THEN 2.0 WHEN 'missed_review' THEN 1.0 ELSE 0.0 END::DOUBLE AS decision_points,
        CASE WHEN present THEN CASE WHEN coalesce(confidence BETWEEN 0 AND 1, false) THEN pow(confidence - (outcome = 'correct')::INT, 2) ELSE 1.0 END END AS brier FROM out_{name})"""


def scored_sql(*names_and_runs: str) -> str:
    """Common table expressions of scored cases: name, run, name, run, ..."""
    pairs = zip(names_and_runs[::2], names_and_runs[1::2], strict=True)
    return ", ".join([_TRUTH, *(_scored(name, run) for name, run in pairs)])


_W = f"WITH {_TRUTH}, {_scored('a', 'run_001')}"
_GOOD_DAY = "coalesce(regexp_full_match(d, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND strftime(try_strptime(d, '%Y-%m-%d'), '%Y-%m-%d') = d, false)"
_CHECKS = {
    "case_id": "NOT coalesce(regexp_full_match(case_id, 'MIB-[0-9]{6}'), false)", "sponsor_id": "NOT coalesce(regexp_full_match(sponsor_id, 'SPN-[0-9]{4}'), false)", "arrival_date": f"NOT {_GOOD_DAY}",
    "fee_status": "NOT coalesce(fee_status IN ('paid', 'waived', 'unpaid', 'unknown'), false)", "adjudication": "NOT coalesce(adjudication IN ('APPROVED', 'DENIED', 'NEEDS_REVIEW'), false)", "confidence": "NOT coalesce(confidence BETWEEN 0 AND 1, false)",
    **{f: f"NOT coalesce(regexp_matches({f}, '\\S'), false)" for f in ("applicant_name", "species_code", "home_world", "visa_class", "declared_purpose", "risk_flags")},
}
_SAMPLES = f"{_TRUTH}, samples AS (SELECT p.run_id, p.adjudication, p.fee_status, p.confidence, p.adjudication = t.adjudication AS correct FROM predictions p JOIN truth t USING (case_id) WHERE p.confidence BETWEEN 0 AND 1)"
_IDS = "t AS (SELECT DISTINCT case_id FROM train_labels WHERE regexp_matches(case_id, '\\S')), c AS (SELECT case_id, count(*) AS n FROM predictions WHERE run_id = 'run_001' AND regexp_matches(case_id, '\\S') GROUP BY 1)"
_KINDS = {"duplicate": "SELECT case_id FROM c WHERE n > 1", "extra": "SELECT case_id FROM c ANTI JOIN t USING (case_id)", "missing": "SELECT case_id FROM t ANTI JOIN c USING (case_id)", "scored": "SELECT case_id FROM t SEMI JOIN c USING (case_id)"}

ORACLE = {
    "e3_case_scores": f"{_W} SELECT case_id, outcome, field_points, decision_points, round(brier, 6) AS brier FROM a",
    "e5_section_scores": f"""{_W}, s AS (SELECT count(*) AS n, count(CASE WHEN NOT present THEN 1 END) AS miss, sum(field_points) AS fp, sum(decision_points) AS dp, avg(brier) AS mb FROM a),
        x AS (SELECT *, 50.0 * fp / (n * {sum(scoring.WEIGHTS.values())}) AS ex, 80.0 * dp / (n * 8) AS cl, coalesce(20 * greatest(0.0, 1 - 2 * mb), 0) AS ca, 10.0 * miss / n AS pe FROM s)
        SELECT n AS n_cases, miss AS n_missing, round(ex::DOUBLE, 6) AS extraction, round(cl::DOUBLE, 6) AS classification, round(ca::DOUBLE, 6) AS calibration, round(pe::DOUBLE, 6) AS missing_penalty, round((ex + cl + ca - pe)::DOUBLE, 6) AS total, round(mb, 6) AS mean_brier FROM x""",
    "a2_confusion": f"{_W} SELECT wanted, decided, count(*) AS n_cases FROM a GROUP BY 1, 2",
    "a3_field_rates": _W + " " + " UNION ALL ".join(f"SELECT '{f}' AS field_name, sum(m_{f}) AS n_matched, round(avg(m_{f}), 6) AS match_rate FROM a" for f in scoring.WEIGHTS),
    "a4_error_groups": _W + " " + " UNION ALL ".join(f"SELECT '{k}' AS dimension, {k} AS member, count(*) AS n_cases FROM a WHERE outcome <> 'correct' GROUP BY {k}" for k in ("outcome", "wanted", "decided")),
    "j11_regressions": f"WITH {_TRUTH}, {_scored('a', 'run_001')}, {_scored('b', 'run_002')} SELECT b.case_id, b.outcome, b.wanted, b.decided FROM b JOIN a USING (case_id) WHERE a.outcome = 'correct' AND b.outcome <> 'correct'",
    "e1_row_errors": "WITH r AS (SELECT *, regexp_replace(arrival_date, '^\\s+|\\s+$', '', 'g') AS d FROM predictions) " + " UNION ALL ".join(f"SELECT run_id, '{k}' AS error, count(*) AS n_rows FROM r WHERE {v} GROUP BY 1" for k, v in _CHECKS.items()),
    "j1_id_report": f"WITH {_IDS} " + " UNION ALL ".join(f"SELECT '{k}' AS kind, (SELECT count(*) FROM ({q})) AS n_ids, coalesce((SELECT string_agg(case_id, ' ' ORDER BY case_id) FROM (SELECT case_id FROM ({q}) ORDER BY case_id LIMIT 20)), '') AS examples" for k, q in _KINDS.items()),
    "ps1_split_roles": f"""WITH {_TRUTH}, o AS (SELECT case_id, adjudication AS stratum, row_number() OVER (PARTITION BY adjudication ORDER BY sha256('{SEED}' || chr(0) || case_id)) AS pos, count(*) OVER (PARTITION BY adjudication) AS n FROM truth)
        SELECT case_id, stratum, CASE WHEN pos <= round_even(n * 0.7, 0) THEN 'tuning' WHEN pos <= round_even(n * 0.7, 0) + round_even(n * 0.15, 0) THEN 'calibration' ELSE 'release' END AS role FROM o""",
    "j12_split_overlap": "WITH m AS (SELECT case_id, 'train' AS role FROM train_labels UNION ALL SELECT case_id, split_name FROM eval_labels) SELECT case_id, count(DISTINCT role) AS n_roles FROM m WHERE case_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT role) > 1",
    "k2_mapped_confidence": "SELECT CASE WHEN confidence IS NULL THEN NULL WHEN confidence >= 1 THEN 0.95 WHEN confidence >= 0.75 THEN 0.8 WHEN confidence >= 0.5 THEN 0.55 ELSE 0.2 END::DOUBLE AS probability, count(*) AS n_rows FROM predictions GROUP BY 1",
    "k3_smoothed_rates": f"""WITH {_SAMPLES}, b AS (SELECT * FROM samples WHERE fee_status IS NOT NULL), g AS (SELECT avg(correct::INT) AS p FROM b),
        l AS (SELECT adjudication, (sum(correct::INT) + 8 * any_value(g.p)) / (count(*) + 8) AS pa FROM b, g GROUP BY 1)
        SELECT adjudication, fee_status, round(any_value(pa), 6) AS p_adjudication, round((sum(correct::INT) + 2 * any_value(pa)) / (count(*) + 2), 6) AS p_fee_status FROM b JOIN l USING (adjudication) GROUP BY 1, 2""",
    "k5_linear_map": """WITH p AS (SELECT pred_id, adjudication, fee_status, CASE WHEN NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 THEN confidence ELSE 0.0::DOUBLE END AS c FROM predictions)
        SELECT pred_id, round(greatest(0.02::DOUBLE, least(0.98::DOUBLE, 0.75::DOUBLE * (0.25::DOUBLE + c * 0.5::DOUBLE + (CASE WHEN adjudication = 'NEEDS_REVIEW' THEN 1.0 ELSE 0.0 END)::DOUBLE * -0.125::DOUBLE
        + (CASE WHEN fee_status = 'paid' THEN 1.0 ELSE 0.0 END)::DOUBLE * 0.0625::DOUBLE) + 0.25::DOUBLE * c)) + 1e-9, 6) AS confidence FROM p""",
}
