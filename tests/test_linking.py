import difflib
import json

import pytest
from pyspark.sql import functions as F

from packetloom.functions import fuzzy
from packetloom.operators import gates, linking, traces
from packetloom.operators import lines as op
from packetloom.sources import files

BOX = "box struct<left:double,bottom:double,right:double,top:double>"
SCHEMA = f"cand_id long, case_id string, seq long, field_name string, value string, evidence_type string, page_index int, {BOX}, legible boolean, superseded boolean, ocr_confidence double, visual_cues array<string>, case_id_hint string, applicant_hint string, extra string"


def row(i, field, value, kind="intake_form", conf=0.95, page=0, cues=(), hint="A B", case="c", own=True, legible=True):
    return (i, case, i, field, value, kind, page, (0.0, 0.0, 1.0, 1.0), legible, None, conf, list(cues), case if own else None, hint, "x")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def sponsored(spark, *rows):
    return [tuple(r) for r in linking.sponsored_applicants(frame(spark, *rows)).collect()]


def test_sponsored_applicant_needs_every_safeguard(spark):
    good = [row(1, "applicant_name", "Quentabel Fon", "sponsor_attestation"), row(2, "applicant_name", "Quentabel Fom", "registry_extract", 0.8), row(3, "applicant_name", "Zzz Qqq", conf=0.5)]
    assert sponsored(spark, *good) == [("c", "Quentabel Fon")]
    assert sponsored(spark, row(1, "applicant_name", "Quentabel Fon", "sponsor_attestation", 0.89), *good[1:]) == []
    assert sponsored(spark, good[0], row(2, "applicant_name", "Quentabel Fom", "registry_extract", 0.74), good[2]) == []
    assert sponsored(spark, *good[:2], row(3, "applicant_name", "Zzz Qqq", conf=0.72)) == []
    assert sponsored(spark, *good[:2]) == [] and sponsored(spark, *good, row(4, "applicant_name", "Other One", "sponsor_attestation")) == []
    assert sponsored(spark, row(1, "applicant_name", None)) == []


def test_sponsor_repairs(spark, rows):
    good = [row(1, "visa_class", "KX-1", hint="Quentabel Fon"), row(2, "visa_class", "KX-2", "sponsor_attestation", hint="Quentabel Fom")]
    assert rows(linking.sponsor_repairs(frame(spark, *good))) == [("c", "visa_class", "KX-2", 2)]
    bad = [
        [row(1, "visa_class", "KX-1", hint="Quentabel Fon", cues=["correction"]), good[1]], [good[0], row(2, "visa_class", "KX-2", "sponsor_attestation", 0.8, hint="Quentabel Fom")],
        [good[0], row(2, "visa_class", "KX-2", "sponsor_attestation", hint="Zzz")], [good[0], row(2, "visa_class", "KX-1", "sponsor_attestation", hint="Quentabel Fom")], [*good, row(3, "visa_class", "KX-3", hint="Quentabel Fon")],
        [good[0], row(2, "visa_class", "KX-2", "sponsor_attestation", hint="Quentabel Fom", own=False)], good[:1],
    ]
    for case in bad:
        assert rows(linking.sponsor_repairs(frame(spark, *case))) == []


def test_scope_anchor_and_veto(spark, rows):
    ev = frame(spark, row(1, "applicant_name", "A B", page=1), row(2, "visa_class", "KX-1", page=1), row(3, "visa_class", "KX-2", page=2, hint="X Y"), row(4, "fee_status", "paid", page=2, hint="X Y"), row(5, "fee_status", "paid", page=3, hint=None), row(6, "sponsor_id", None, hint="X Y", case="d"))
    aliases = spark.createDataFrame([("c", "A B"), ("c", "A B"), ("c", None)], "case_id string, alias string")
    assert rows(linking.applicant_scoped(ev, aliases), "cand_id") == [(1,), (2,), (4,), (5,), (6,)]
    assert linking.applicant_scoped(ev, aliases).columns == ev.columns
    assert rows(linking.anchored(ev), "cand_id") == [(1,), (2,)]
    expected = spark.createDataFrame([("c", "visa_class", "KX-1"), ("c", "fee_status", "paid"), ("e", "fee_status", "paid")], "case_id string, field_name string, value string")
    assert rows(linking.disputed(expected, ev)) == [("c", "visa_class", "KX-1")]
    assert rows(linking.forced_identity(expected, ev)) == [("c", "fee_status", "paid", 4), ("c", "visa_class", "KX-1", 2), ("e", "fee_status", "paid", None)]
    assert linking.anchored(ev.limit(0)).count() == linking.sponsor_repairs(ev.limit(0)).count() == 0


FLAGS = ["sealed_warrant", "spore_alert", "name_clash"]


def test_close_terms_are_difflibs(spark, rows):
    values = ["sealdwarant", "spore", "sporealert", "nameclash", "zzz", "", None, "sealed_warrant", "name_clash_x"]
    got = dict(rows(fuzzy.close_terms(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(f,) for f in FLAGS], "term string"))))
    assert got == {v: m[0] for v in values if v is not None and (m := difflib.get_close_matches(v, FLAGS, n=1, cutoff=0.72))}


def test_phrases_equal_brute_force(spark, rows):
    texts = ["a seal ed warrent was seen", "spore-alrt; name clash", "", None, "nothing of note", "sealed_warrant", "x " * 400 + "spore alert"]
    got = rows(fuzzy.phrase_terms(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t", spark.createDataFrame([(f,) for f in FLAGS], "term string")))
    want = set()
    for k, t in enumerate(texts):
        words = __import__("re").findall("[a-z0-9]+", (t or "").lower())
        spans = {"".join(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1)}
        want |= {(k, f) for f in FLAGS for s in spans if difflib.SequenceMatcher(None, s, f.replace("_", "")).ratio() >= 0.75}
    assert got == sorted(want, key=repr) and len(got) >= 5


def test_first_heading_and_medians(spark, rows):
    text = ["nothing", "Registry Extract", "Sponsor Letter", "x", "Fee Receipt"]
    lines = spark.createDataFrame([(i, "c", 0, i, t, 0.1 * (i + 1), (0.0, float(i), 9.0, i + 1.0)) for i, t in enumerate(text)] + [(9, "c", 1, 0, "--", None, None)], f"line_id long, case_id string, page_index int, line_seq int, text string, confidence double, {BOX}")
    assert rows(op.first_heading(lines)) == [("c", 0, "registry_extract"), ("c", 1, "intake_form")]
    marks = op.page_markers(lines, op.PAGE_HEADINGS, ("sponsor_attestation", "other")).collect()
    assert {(r["page_index"], r["page_type"], round(r["confidence"], 1)) for r in marks} == {(0, "sponsor_attestation", 0.1), (1, "other", 1.0)}
    four = lines.where("line_id < 4")
    got = op.page_medians(four).first()
    assert got["n_lines"] == 4 and got["median"] == pytest.approx(0.25) and got["upper_median"] == pytest.approx(0.3)


TRACE = "decision string, authoritative boolean, denial_reasons array<string>, review_reasons array<string>, approval_facts array<string>"


@pytest.mark.parametrize(
    ("trace", "signal", "bucket"),
    [
        (("DENIED", False, ["barred_sponsor:SPN-1", "x", "y"], [], []), 0.96, "DENIED|reason=barred_sponsor"), (("DENIED", False, ["x"], None, None), 0.84, "DENIED|reason=other"), (("DENIED", True, ["x"], [], []), 0.98, "DENIED|authoritative"),
        (("DENIED", False, ["stale_application"] * 9, [], []), 0.98, "DENIED|reason=stale_application"), (("NEEDS_REVIEW", False, [], ["contested_field:x", "a"], []), 0.95, "NEEDS_REVIEW|class=conflict"), (("NEEDS_REVIEW", False, [], ["arrival_date_not_visible"], []), 0.83, "NEEDS_REVIEW|class=core_gap"),
        (("NEEDS_REVIEW", False, [], [], []), 0.74, "NEEDS_REVIEW|class=policy_only"), (("APPROVED", False, [], [], ["strict_approval_bar_cleared", "fee_paid"]), 0.805, "APPROVED|support=1"), (("APPROVED", False, [], [], [f"f{i}" for i in range(9)]), 0.93, "APPROVED|support=6"),
    ],
)
def test_signals_and_buckets(spark, trace, signal, bucket):
    got = spark.createDataFrame([trace], TRACE).select(traces.raw_signal(), traces.bucket()).first()
    assert got[0] == pytest.approx(signal) and got[1] == bucket


def test_signature_hides_values(spark):
    df = spark.createDataFrame([("DENIED", False, ["barred_sponsor:SPN-1", "Fee_Paid", "disqualifying_flag:spore", "SPN-1", "9x:y"], None, [])], TRACE)
    assert df.select(traces.signature(("fee_paid",))).first()[0] == "DENIED|source=rules|denial=barred_sponsor:*,disqualifying_flag:spore,fee_paid,other|review=|approval="


def test_fallback_inherits(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y")], "d string, b string")
    d = spark.createDataFrame([("a", 6, 8)], "d string, good long, n long")
    b = spark.createDataFrame([("x", 1, 1)], "b string, good long, n long")
    got = {(r["d"], r["b"]): r["probability"] for r in traces.fallback_lookup(rows, [("d", d, 2.0), ("b", b, 1.0)], 0.5, 0.02, 0.8).collect()}
    assert got == {("a", "x"): 0.8, ("a", "y"): pytest.approx(0.7), ("b", "y"): 0.5}


SUMMARY = "split_name string, role string, tuned_splits array<string>, total_score double, extraction_score double, classification_score double, calibration_score double, catastrophic_false_approvals long, missing_rows long, invalid_rows long, runtime_seconds double, peak_memory_mib double, source string, n_leaks long"
GOOD = dict(zip([c.split()[0] for c in SUMMARY.split(", ")], ("release", "release", ["tuning"], 100.0, 30.0, 50.0, 20.0, 1, 0, 0, 5.0, 9.0, "run", 0), strict=True))


def decided(spark, moved=(0, 0, 0), baseline=None, **changes):
    c, b = (spark.createDataFrame([tuple({**GOOD, **x}.values())], SUMMARY) for x in (changes, baseline or {}))
    return gates.decide(c, b, spark.createDataFrame([moved], "n_other_cases long, n_golden long, n_adversarial long")).first()


def test_release_decisions(spark):
    assert decided(spark)["decision"] == "PASS" and decided(spark)["adopt"]
    assert decided(spark, moved=(0, 1, 2))["warnings"] == "golden regressions; adversarial regressions"
    assert decided(spark, invalid_rows=1, missing_rows=1)["decision"] == "PASS_WITH_WARNINGS"
    got = decided(spark, total_score=101.5)
    assert got["total_score_delta"] == 1.5 and got["extraction_score_delta"] == 0
    for changes in (
        {"role": "tuning"}, {"tuned_splits": ["release"]}, {"baseline": {"role": "tuning"}}, {"split_name": "other"}, {"moved": (1, 0, 0)}, {"runtime_seconds": None}, {"peak_memory_mib": 0.0}, {"source": "official_evaluator_process_only"}, {"n_leaks": 2},
        {"catastrophic_false_approvals": 2}, {"catastrophic_false_approvals": None}, {"total_score": None},
    ):
        assert decided(spark, **changes)["decision"] == "BLOCKED", changes


def test_reports_and_manifests(spark, tmp_path, rows):
    files.write_report_json({"b": 1, "a": [2]}, str(tmp_path / "out" / "r.json"))
    assert json.loads((tmp_path / "out" / "r.json").read_text()) == {"a": [2], "b": 1}
    with pytest.raises(ValueError):
        files.write_report_json({}, str(tmp_path / "artifacts" / "r.json"), str(tmp_path / "artifacts"))
    df = spark.createDataFrame([(" MIB-000001", 'a "b", c'), ("MIB-000002", None), ("MIB-000002", "x"), (" ", "y")], "case_id string, t string")
    assert files.write_report_csv(df, str(tmp_path / "ids.csv")) == 4
    assert rows(files.read_ids(spark, str(tmp_path / "ids.csv"))) == [("MIB-000001",), ("MIB-000002",)]
    with pytest.raises(ValueError):
        files.write_report_csv(df.limit(0), str(tmp_path / "none.csv"))
    assert not list(tmp_path.glob("*none*")) and not list(tmp_path.glob(".*"))


@pytest.mark.parametrize("text", ['[{"case_id": "MIB-000001"}, {"case_id": "MIB-000002"}]', '{"case_id": "MIB-000001"}\n{"case_id": "MIB-000002"}\n', "case_id,fee_status\nMIB-000001,paid\nMIB-000002,unpaid\n", '{"results": [\n{"case_id": "MIB-000001"}, {"case_id": "MIB-000002"}]}'])
def test_unknown_suffixes_are_told_by_their_content(spark, tmp_path, text, rows):
    (tmp_path / "submitted.txt").write_text(text)
    assert rows(files.read_predictions(spark, str(tmp_path / "submitted.txt")), "case_id") == [("MIB-000001",), ("MIB-000002",)]


def test_sample_and_rule_faults(spark, rows):
    samples = spark.createDataFrame([("a", "cal", 0.5, True), ("a", "cal", 1.5, None), ("b", "x", float("nan"), True), (None, "cal", 0.1, False)], "case_id string, split_name string, raw_signal double, correct boolean")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "case_id string")
    got = dict(rows(gates.sample_faults(samples, ids("a"), ids("b"), "cal")))
    assert got == {"repeated case id": 2, "no case id": 1, "wrong split": 1, "not in the manifest": 2, "tuned on": 1, "signal out of range": 2, "no outcome": 1}
    of = lambda *x: spark.createDataFrame(list(x), "rule_id string, case_id string")
    rules = spark.createDataFrame([("r",), ("s",), ("t",)], "rule_id string")
    got = dict(rows(gates.proof_faults(rules, of(("r", "1"), ("r", "2"), ("s", "1")), of(("r", "1"), ("r", "2"), ("s", "1"), ("s", "9")), ids("9"))))
    assert got == {"r": "", "s": "held-out support is not visible; held-out support was tuned on", "t": "no visible support; too little held-out support"}
