import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import calibration, scoring, splits
from packetloom.plans import evaluation

FIELDS = [*scoring.WEIGHTS, "adjudication"]
GOOD = {"applicant_name": "Zed", "species_code": "S", "home_world": "H", "visa_class": "V", "sponsor_id": "SPN-0001", "arrival_date": "2026-01-01", "declared_purpose": "p", "risk_flags": "b|a", "fee_status": "paid", "adjudication": "DENIED"}


def frame(spark, rows, extra):
    schema = ", ".join(["case_id string", *(f"{f} string" for f in FIELDS), *extra])
    return spark.createDataFrame(rows, schema)


def truth(spark, *changes):
    return frame(spark, [(f"MIB-00000{i}", *(GOOD | c).values(), i, None) for i, c in enumerate(changes)], ["record_id long", "labelled_at timestamp"])


def predicted(spark, *changes):
    return frame(spark, [(c.pop("case_id", f"MIB-00000{i}"), *(GOOD | {k: v for k, v in c.items() if k != "confidence"}).values(), c.get("confidence", 1.0), i) for i, c in enumerate(map(dict, changes))], ["confidence double", "pred_id long"])


def test_perfect_predictions_score_150(spark):
    out = scoring.totals(scoring.scored(truth(spark, {}, {}), predicted(spark, {}, {"risk_flags": "A | b"}))).first()
    assert (out["total"], out["mean_brier"], out["n_missing"]) == (150.0, 0.0, 0)


@pytest.mark.parametrize(
    ("want", "got", "points", "outcome"),
    [("DENIED", "APPROVED", -4.0, "catastrophic_false_approval"), ("APPROVED", "NEEDS_REVIEW", 2.0, "conservative_review"), ("NEEDS_REVIEW", "DENIED", 1.0, "missed_review"), ("APPROVED", "DENIED", 0.0, "wrong_decision"), ("DENIED", "?", 0.0, "invalid_or_blank"), ("DENIED", None, 0.0, "invalid_or_blank"), ("DENIED", " denied ", 8.0, "correct")],
)
def test_decision_points(spark, want, got, points, outcome):
    out = scoring.scored(truth(spark, {"adjudication": want}), predicted(spark, {"adjudication": got})).first()
    assert (out["decision_points"], out["outcome"]) == (points, outcome)


def test_missing_and_invalid_confidence(spark):
    cases = scoring.scored(truth(spark, {}, {}, {}), predicted(spark, {"confidence": 2.0}, {"confidence": None}))
    got = {r["case_id"]: (r["outcome"], r["brier"]) for r in cases.collect()}
    assert got == {"MIB-000000": ("correct", 1.0), "MIB-000001": ("correct", 1.0), "MIB-000002": ("missing_case", None)}
    assert scoring.totals(cases.limit(0)).first()["n_cases"] == 0


def test_duplicates_truth_last_prediction_first(spark):
    labels = truth(spark, {}, {}).withColumn("case_id", F.lit("MIB-000001"))
    assert scoring.last_truth(labels).first()["record_id"] == 1
    p = predicted(spark, {}, {}).withColumn("case_id", F.lit("MIB-000001"))
    assert scoring.first_predictions(p).first()["pred_id"] == 0


def test_row_errors(spark):
    p = predicted(spark, {}, {"case_id": "x", "arrival_date": "2026-02-30", "fee_status": None, "confidence": -1.0})
    got = [r["errors"] for r in scoring.row_errors(p).orderBy("pred_id").collect()]
    assert got == [[], ["case_id", "arrival_date", "fee_status", "confidence"]]


def test_split_counts_order_and_forced(spark):
    base = spark.createDataFrame([(f"MIB-{i:06d}", "ABC"[i % 3]) for i in range(90)], "case_id string, kind string")
    one = {tuple(r) for r in splits.stratified_split(base, "kind", "s").collect()}
    two = {tuple(r) for r in splits.stratified_split(base.orderBy(F.desc("case_id")).repartition(7), "kind", "s").collect()}
    assert one == two
    sizes = {k: sum(r[2] == k for r in one) for k in splits.ROLES}
    assert sizes == {"tuning": 63, "calibration": 12, "release": 15}  # per stratum 21, bround(4.5) = 4, 5
    forced = spark.createDataFrame([("MIB-000000",), ("MIB-000003",)], "case_id string")
    out = {r["case_id"]: r["role"] for r in splits.stratified_split(base, "kind", "s", forced=forced).collect()}
    assert out["MIB-000000"] == out["MIB-000003"] == "tuning" and list(out.values()).count("tuning") == 63


def brute_isotonic(points):
    xs = sorted({x for x, _ in points})
    sums = {x: (sum(y for a, y in points if a == x), sum(a == x for a, _ in points)) for x in xs}

    def mean(i, j):
        return sum(sums[x][0] for x in xs[i : j + 1]) / sum(sums[x][1] for x in xs[i : j + 1])

    return {x: max(min(mean(i, j) for j in range(k, len(xs))) for i in range(k + 1)) for k, x in enumerate(xs)}


@pytest.mark.parametrize("block_rows", [100_000, 4])
def test_isotonic_equals_minimax(spark, block_rows):
    rng = random.Random(block_rows)
    points = [(rng.randint(0, 20) / 20, int(rng.random() < 0.5)) for _ in range(150)]
    df = spark.createDataFrame([(x, bool(y)) for x, y in points], "x double, y boolean")
    steps = calibration.isotonic_steps(df, "x", "y", block_rows)
    got = {r["x"]: r["p"] for r in df.select("x", calibration.step_lookup(F.col("x"), steps).alias("p")).distinct().collect()}
    for x, p in brute_isotonic(points).items():
        assert got[x] == pytest.approx(p)


def test_isotonic_query_returns_the_steps_of_the_raw_confidence(spark, tmp_path):
    rng = random.Random(5)
    right = [rng.random() < 0.6 for _ in range(300)]
    confidence = [rng.choice([0.031, 0.712, 0.713, 0.7149, 0.9, rng.random()]) for _ in right]
    truth(spark, *({} for _ in right)).withColumn("case_id", F.format_string("MIB-%06d", "record_id")).write.parquet(str(tmp_path / "train_labels.parquet"))
    p = predicted(spark, *({"confidence": c, "adjudication": "DENIED" if ok else "APPROVED"} for c, ok in zip(confidence, right)))
    p.withColumn("case_id", F.format_string("MIB-%06d", "pred_id")).withColumn("run_id", F.lit("run_001")).write.parquet(str(tmp_path / "predictions.parquet"))
    blocks = []
    for x in sorted(set(confidence)):
        hits = [ok for c, ok in zip(confidence, right) if c == x]
        blocks.append([x, sum(hits), len(hits)])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] > blocks[-1][1] / blocks[-1][2]:
            _, good, n = blocks.pop()
            blocks[-1] = [blocks[-1][0], blocks[-1][1] + good, blocks[-1][2] + n]
    want = [(x, good / n) for x, good, n in blocks]
    want = [(0.0, want[0][1]), *want, (1.0, want[-1][1])]
    got = evaluation.isotonic(spark, str(tmp_path)).orderBy("signal").collect()
    assert [r["signal"] for r in got] == [x for x, _ in want] and len(want) > 5
    assert [r["probability"] for r in got] == pytest.approx([p for _, p in want], abs=1e-6)


def test_step_lookup_bounds(spark):
    steps = [(0.0, 0.2), (0.5, 0.55), (1.0, 0.95)]
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.4999,), (0.5,), (7.0,), (None,)], "x double")
    assert [r[0] for r in df.select(calibration.step_lookup(F.col("x"), steps)).collect()] == [0.2, 0.2, 0.2, 0.55, 0.95, None]
    assert calibration.isotonic_steps(spark.createDataFrame([], "x double, y boolean"), "x", "y") == [(0.0, 0.0), (1.0, 0.0)]


def test_hierarchical_and_reconcile(spark):
    df = spark.createDataFrame([("A", "x", True), ("A", "x", False), ("A", "y", True), ("B", "x", False)], "a string, b string, ok boolean")
    got = {(r["a"], r["b"]): r["p_b"] for r in calibration.hierarchical(df, ["a", "b"], "ok", [2.0, 1.0]).collect()}
    pa = (2 + 2 * 0.5) / (3 + 2)
    assert got["A", "y"] == pytest.approx((1 + pa) / 2)
    parents = spark.createDataFrame([("A", 3), ("B", 1)], "k string, n long")
    children = spark.createDataFrame([("A", 2), ("A", 1), ("B", 2)], "k string, n long")
    assert [r["k"] for r in calibration.reconcile(parents, children, "k", "n").collect()] == ["B"]
