import pytest

from packetloom.operators import consensus, evidence

BOX = "struct<left:double,bottom:double,right:double,top:double>"
SCHEMA = f"cand_id long, case_id string, seq long, field_name string, value string, evidence_type string, page_index int, box {BOX}, legible boolean, superseded boolean, ocr_confidence double, visual_cues array<string>, case_id_hint string"
N = iter(range(1, 10_000))


def cand(value, kind="intake_form", field="visa_class", conf=0.9, page=0, top=20.0, legible=True, superseded=False, cues=(), case="MIB-000001", hint=None):
    i = next(N)
    return (i, case, i, field, value, kind, page, (10.0, top - 10, 200.0, top), legible, superseded, conf, list(cues), hint)


def resolved(spark, *rows):
    return evidence.resolve(spark.createDataFrame(list(rows), SCHEMA)).first()


def test_rank_then_corrections_then_confidence(spark):
    assert resolved(spark, cand("A"), cand("B", "registry_extract"))["value"] == "A"
    assert resolved(spark, cand("A"), cand("B", cues=["correction"]))["value"] == "B"
    assert resolved(spark, cand("A", "IntakeForm"), cand("B", "intake form"))["state"] == "CONTESTED"
    assert resolved(spark, cand("A", "adjudicator_stamp"), cand("B", "signed_manual_note"))["state"] == "CONTESTED"
    assert resolved(spark, cand(None), cand("A", legible=False), cand("B", superseded=True), cand("C", cues=["strikethrough"]))["state"] == "UNKNOWN"


@pytest.mark.parametrize(
    ("better", "worse"),
    [({"conf": 0.91}, {"conf": 0.9}), ({"page": 1}, {"page": 0}), ({"top": 30.0}, {"top": 20.0}), ({}, {}), ({"conf": 95.0}, {"conf": 0.9}), ({"conf": 0.1}, {"conf": None})],
)
def test_winner_order(spark, better, worse):
    rows = [cand("A", **better), cand("A", **worse)]
    assert resolved(spark, *rows)["winner"] == rows[0][0]


def test_grid_adds_unknown_fields(spark, rows):
    df = spark.createDataFrame([cand("A")], SCHEMA)
    grid = spark.createDataFrame([("MIB-000001", "visa_class"), ("MIB-000001", "fee_status")], "case_id string, field_name string")
    assert rows(evidence.resolve(df, grid), "field_name", "state", "n_considered") == [("fee_status", "UNKNOWN", 0), ("visa_class", "RESOLVED", 1)]
    assert evidence.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rescission_needs_every_safeguard(spark):
    denied = dict(kind="adjudicator_stamp", field="adjudication", page=0)
    approved = dict(kind="signed_manual_note", field="adjudication", page=1, cues=["correction"])

    def kept(*rows):
        out = evidence.without_rescinded(spark.createDataFrame(list(rows), SCHEMA)).collect()
        return sorted(r["value"] for r in out), out[0]["rescinded"]

    assert kept(cand("DENIED", **denied), cand("APPROVED", **approved)) == (["APPROVED"], True)
    for change in ({"cues": []}, {"kind": "intake_form"}, {"page": 0, "top": 5.0}):
        assert kept(cand("DENIED", **denied), cand("APPROVED", **(approved | change))) == (["APPROVED", "DENIED"], False)
    assert kept(cand("DENIED", cues=["sample_denial_watermark"], **denied), cand("APPROVED", **approved)) == (["APPROVED"], False)


def test_scope_and_unanimity(spark, rows):
    df = spark.createDataFrame([cand("A", hint="mib 000001"), cand("A", hint="MIB-000002"), cand("B", field="fee_status"), cand("C", field="fee_status")], SCHEMA)
    assert evidence.scoped(df).count() == 3
    assert rows(evidence.unanimous(df), "field_name", "value", "n_rows") == [("visa_class", "A", 2)]


def test_names_join_the_first_like_cluster(spark, rows):
    names = ["Zed Zarnax", "Zed Zarnaks", "Quill Orto", "Zed Zarnak", "ZED ZARNAX"]
    df = spark.createDataFrame([cand(n, field="applicant_name") for n in names] + [cand("Lone", field="applicant_name", case="MIB-000002"), cand("Other Two", field="applicant_name", case="MIB-000002")], SCHEMA)
    got = {(c, v): k for c, v, k in rows(evidence.name_clusters(df))}
    assert len({got["MIB-000001", n] for n in names if n.startswith(("Z", "z"))}) == 1 and got["MIB-000001", "Quill Orto"] == 1
    best = dict(rows(evidence.active_applicants(df)))
    assert best["MIB-000001"] in names and best["MIB-000002"] is None  # an exact tie


def test_agreement(spark, rows):
    schema = "case_id string, view string, field_name string, value string"
    views = spark.createDataFrame([("c", f"v{i}", "f", "A") for i in range(3)] + [("c", "v0", "g", "A"), ("c", "v1", "g", "B"), ("d", "v0", "f", "A")], schema)
    assert rows(consensus.agreed(views, 3)) == [("c", "f", "A", 3)]
    assert rows(consensus.agreed(views, 1, 2)) == [("c", "f", "A", 3), ("c", "g", "B", 1), ("d", "f", "A", 1)]
    assert rows(consensus.two_pass(views, "v0", "v1")) == [("c", "f", "A")]
    assert rows(consensus.lead(views, 2)) == [("c", "f", "A", 3)]
    assert consensus.agreed(views.limit(0), 1).count() == 0


def test_maximal_sets(spark, rows):
    sets = spark.createDataFrame([("c", ["a"]), ("c", ["b", "a"]), ("c", ["d"]), ("e", [])], "k string, m array<string>")
    assert [(k, tuple(m)) for k, m in rows(consensus.maximal_sets(sets, "k", "m"))] == [("c", ("a", "b")), ("c", ("d",)), ("e", ())]
