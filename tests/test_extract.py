import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import extract, gates
from packetloom.plans import extraction

BOX = "struct<left:double,bottom:double,right:double,top:double>"


def test_longest_label_wins(spark):
    texts = ["Species Code : ORION", "species  match- X", "Name: Zed", "Named after", "Applicant", "nothing", None, "Fee status. paid"]
    df = spark.createDataFrame(list(enumerate(texts)), "line_id long, text string")
    got = {r["line_id"]: (r["field_name"], r["value"]) for r in extract.labelled_fields(df).collect()}
    assert got == {0: ("species_code", "ORION"), 1: ("species_code", "X"), 2: ("applicant_name", "Zed"), 4: ("applicant_name", None), 7: ("fee_status", "paid")}


@pytest.mark.parametrize(
    ("field", "value", "want"),
    [("fee_status", "UNPAID", "unpaid"), ("fee_status", "pa1d", "paid"), ("fee_status", "prepaid?", None), ("adjudication", "Needs  Review", "NEEDS_REVIEW"), ("adjudication", "denied", "DENIED"), ("case_id", "mib 00000I", "MIB-000001"), ("arrival_date", "4/17/2026", "2026-04-17"), ("risk_flags", "B|a", "a|b"), ("home_world", " A  b ", "A b"), ("home_world", " ", None), ("fee_status", None, None)],
)
def test_normalised_values(spark, field, value, want):
    df = spark.createDataFrame([(field, value)], "f string, v string")
    assert df.select(extract.normalised_value(F.col("f"), F.col("v"))).first()[0] == want


def test_cues_and_facts(spark, rows):
    df = spark.createDataFrame([(1, "Amended by the adjudicator stamp. Sponsor SPN-0001 confirmed the stay of 7 days at dawn."), (2, None), (3, "")], "k long, t string")
    assert df.where("k = 1").select(extract.text_cues(F.col("t"))).first()[0] == ["adjudicator_stamp", "correction"]
    assert rows(extract.narrative_facts(df, "k", "t")) == [(1, "sponsor_id", "SPN-0001"), (1, "stay_days", "7")]


def test_cells_of_one_row(spark, rows):
    schema = f"case_id string, page_index int, cell_id string, text string, box {BOX}"
    labels = spark.createDataFrame([("c", 0, "l", "Fee", (0.0, 0.0, 40.0, 20.0)), ("c", 1, "m", "Fee", (0.0, 0.0, 40.0, 20.0))], schema)
    values = spark.createDataFrame([("c", 0, "far", "b", (200.0, 0.0, 240.0, 20.0)), ("c", 0, "near", "a", (50.0, 5.0, 90.0, 25.0)), ("c", 0, "below", "x", (50.0, 30.0, 90.0, 50.0)), ("c", 0, "before", "y", (10.0, 0.0, 30.0, 20.0))], schema)
    assert rows(extract.same_row_pairs(labels, values), "label_id", "value_id", "value") == [("l", "near", "a")]


def test_class_cells_of_all_packets_equal_brute_force(spark, rows, tmp_path):
    schema = f"case_id string, page_index int, block_num int, paragraph_num int, line_num int, word_num int, text string, box {BOX}"
    rng, tokens = random.Random(7), []
    for case, pages in (("MIB-000000", 6), ("MIB-000001", 2)):
        for page in range(pages):
            for line in range(5):
                for word in range(6):
                    x, y = 60.0 * word + rng.randint(0, 20), 16.0 * line + rng.randint(0, 6)
                    tokens.append((case, page, 1, 1, line, word, rng.choice(["class", "KX-1", "DR-2.", "form"]), (x, y, x + 50, y + 14)))
    spark.createDataFrame(tokens, schema).write.parquet(str(tmp_path / "ocr_tokens.parquet"))
    want = {}
    for label in tokens:
        lx, ly = label[7][2], label[7][1::2]
        right = [("/".join(map(str, v[:6])), v) for v in tokens if v[:2] == label[:2] and v[6][-1] in "12." and v[7][0] >= lx - 8 and min(ly[1], v[7][3]) - max(ly[0], v[7][1]) >= 7]
        if label[6] == "class" and right:
            best, value = min(right, key=lambda r: (r[1][7][0], r[0]))
            want["/".join(map(str, label[:6]))] = (label[0], label[1], best, value[6])
    got = rows(extraction.class_cells(spark, str(tmp_path)), "label_id", "case_id", "page_index", "value_id", "value")
    assert got == sorted(((k, *v) for k, v in want.items()), key=repr) and sum(r[1] == "MIB-000000" for r in got) > 20


def test_refinement_needs_gain_alignment_and_agreement(spark, rows):
    schema = f"line_id long, case_id string, page_index int, text string, confidence double, box {BOX}"
    box, off = (0.0, 0.0, 100.0, 20.0), (60.0, 0.0, 160.0, 20.0)
    lines = spark.createDataFrame([(i, "c", i, "t", c, box) for i, c in enumerate([0.5, 0.5, 0.5, 0.5, 0.8])], schema)
    second = spark.createDataFrame([(0, "c", 0, "A", 0.7, box), (0, "c", 1, "A", 0.7, off), (0, "c", 2, "A", 0.55, box), (0, "c", 3, "A", 0.7, box), (0, "c", 3, "B", 0.9, box), (0, "c", 4, "A", 0.99, box)], schema)
    assert rows(extract.refined(lines, second), "line_id", "text") == [(0, "A")]


CASE = "case_id string, outcome string"


def gate(spark, before, after, guarded=None):
    b, a = spark.createDataFrame(before, CASE), spark.createDataFrame(after, CASE)
    g = None if guarded is None else spark.createDataFrame([(x,) for x in guarded], "case_id string")
    return gates.release_gate(a, b, g).first()


def test_gate_decisions(spark):
    base = [("a", "correct"), ("b", "wrong_decision")]
    assert gate(spark, base, base)["decision"] == "PASS"
    worse = [("a", "conservative_review"), ("b", "wrong_decision")]
    assert gate(spark, base, worse)["decision"] == "PASS_WITH_WARNINGS" and gate(spark, base, worse, ["b"])["decision"] == "PASS"
    assert gate(spark, base, [("a", "correct"), ("b", "catastrophic_false_approval")])["blocking"] == "more false approvals"
    assert gate(spark, base, base[:1])["blocking"] == "different cases"


def test_leaks():
    held = {"Case_ID": 1, "list": ["x.PDF", {"k": "MIB-000001"}], "h": "a" * 40, "fine": "text"}
    assert {f for _, f in gates.identity_leaks(held)} == {"identity key", "file name", "case id", "hash"} and gates.identity_leaks({"fine": [1, None]}) == []


def test_rule_support(spark, rows):
    rules = spark.createDataFrame([("r", "a", "1"), ("r", "b", "2"), ("s", "a", "1")], "rule_id string, key string, value string")
    facts = spark.createDataFrame([("c", "a", "1"), ("c", "b", "2"), ("d", "a", "1"), ("d", "a", "1"), ("d", "b", None)], "case_id string, key string, value string")
    assert rows(gates.rule_support(rules, facts)) == [("r", "c"), ("s", "c"), ("s", "d")]
