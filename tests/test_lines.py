import random
import re

from packetloom.operators import lines as op
from packetloom.plans import pages

SCHEMA = "line_id long, case_id string, page_index int, line_seq int, text string"


def page(spark, texts, case="MIB-000001"):
    return spark.createDataFrame([(i, case, 0, i, t) for i, t in enumerate(texts)], SCHEMA)


def test_quarantine_covers_the_next_eleven_lines(spark):
    texts = ["x"] * 3 + ["Answer key here"] + ["x"] * 15
    got = {r["line_id"] for r in op.quarantined(page(spark, texts)).where("quarantined").collect()}
    assert got == set(range(3, 15))


def test_quarantine_equals_a_sequential_reader(spark):
    rng = random.Random(3)
    texts = [rng.choice(["x"] * 9 + ["system prompt", None]) for _ in range(200)]
    left, want = 0, set()
    for i, t in enumerate(texts):
        if t == "system prompt":
            left = 12
        if left:
            want.add(i)
            left -= 1
    assert {r["line_id"] for r in op.quarantined(page(spark, texts)).where("quarantined").collect()} == want


def test_manual_correction_is_kept(spark):
    got = [r["rejected"] for r in op.rejected(page(spark, ["sample denial", "Manual correction: sample denial", "fine", None])).orderBy("line_id").collect()]
    assert got == [True, False, False, False]


def test_lines_of_tokens(spark):
    box = "struct<left:double,bottom:double,right:double,top:double>"
    schema = f"case_id string, page_index int, block_num int, paragraph_num int, line_num int, word_num int, text string, confidence double, box {box}"
    base = ("MIB-000001", 0, 1, 1, 1)
    rows = [(*base, 2, "bb", 0.5, (10.0, 0.0, 30.0, 9.0)), (*base, 1, "a", 0.8, (0.0, 1.0, 8.0, 8.0)), (*base, 1, "a", None, (0.0, 1.0, 8.0, 8.0)), (*base, 3, "c", None, (40.0, 0.0, 50.0, 9.0))]
    got = op.lines_of(op.unique_tokens(spark.createDataFrame(rows, schema))).first()
    assert got["text"] == "a bb c" and abs(got["confidence"] - (0.8 + 2 * 0.5) / 3) < 1e-12 and tuple(got["box"]) == (0.0, 0.0, 50.0, 9.0)


def test_reading_order_by_rows(spark):
    box = "struct<left:double,bottom:double,right:double,top:double>"
    data = [(1, (200.0, 12.0, 260.0, 30.0)), (2, (10.0, 10.0, 60.0, 28.0)), (3, (10.0, 60.0, 60.0, 78.0)), (4, (100.0, 8.0, 140.0, 26.0))]
    df = spark.createDataFrame([("c", 0, i, b) for i, b in data], f"case_id string, page_index int, line_id long, box {box}")
    assert [r["line_id"] for r in op.visual_order(df).orderBy("place").collect()] == [2, 4, 1, 3]


def test_labels_pair_with_the_next_good_line(spark):
    texts = ["Name:", "Zed", "Fee:", "Visa:", "KX-1", "Purpose:", "sample denial", "tail:"]
    got = {r["label"]: r["value"] for r in op.paired_labels(op.rejected(page(spark, texts)), r":\s*$").collect()}
    assert got == {"Name:": "Zed", "Visa:": "KX-1"}


def test_running_scope_resets_with_the_case(spark):
    schema = "cand_id long, case_id string, page_index int, seq long, field_name string, value string, legible boolean"
    c = "MIB-000001"
    rows = [(1, c, 0, 1, "applicant_name", "A", True), (2, c, 0, 2, "fee_status", "paid", True), (3, c, 0, 3, "case_id", "MIB-000002", True), (4, c, 0, 4, "fee_status", "paid", True), (5, c, 0, 5, "applicant_name", "B", False), (6, c, 0, 6, "fee_status", None, True)]
    got = {r["cand_id"]: (r["running_case"], r["running_applicant"]) for r in op.running_scope(spark.createDataFrame(rows, schema)).collect()}
    assert got[2] == (c, "A") and got[4] == ("MIB-000002", None) and got[6] == ("MIB-000002", None) and got[1] == (c, None)


def test_page_types_and_locks(spark, rows):
    df = page(spark, ["MIB-000001 and MIB-000009", "Sponsor Letter", "x", "y", "fee receipt"])
    assert rows(op.page_types(df), "page_type") == [("sponsor_attestation",)]
    assert rows(op.last_heading(df), "evidence_type") == [("fee_receipt",)]
    assert rows(op.page_locks(df), "n_ids", "locked_to") == [(2, "MIB-000001")]
    empty = spark.createDataFrame([], SCHEMA)
    assert op.page_types(empty).count() == 0 and op.page_locks(empty).count() == 0


def test_running_values_alike_for_any_chunking(spark):
    rng = random.Random(9)
    schema = "cand_id long, case_id string, page_index int, seq long, field_name string, value string, legible boolean"
    rows = []
    for i in range(400):
        field = rng.choice(["case_id", "applicant_name", "fee_status"])
        value = {"case_id": f"MIB-00000{rng.randint(1, 2)}", "applicant_name": rng.choice("ABC")}.get(field)
        rows.append((i, rng.choice(["MIB-000001", None]), i // 7, i, field, value, rng.random() < 0.8))
    df = spark.createDataFrame(rows, schema)
    want = {}
    state = {}
    for i, case, _, _, field, value, legible in rows:
        running, name = state.get(case, (case, None))
        want[i] = (running, name)
        if legible and field == "case_id" and value != running:
            running, name = value, None
        elif legible and field == "applicant_name":
            name = value
        state[case] = (running, name)
    for pages in (1, 5, 1000):
        got = {r["cand_id"]: (r["running_case"], r["running_applicant"]) for r in op.running_scope(df, pages).collect()}
        assert got == want


def test_text_spans_of_all_pages_equal_split(spark, rows, tmp_path):
    texts = ["Form I-8090", "", None, " two  words ", "x" * 70 + " late", "tab\tbed"]
    lines = [(10 * p + i, case, p, i, t) for case in ("MIB-000000", "MIB-000001") for p in range(3) for i, t in enumerate(texts)]
    lines = [(line[0] + 100 * (line[1] == "MIB-000000"), *line[1:]) for line in lines]
    spark.createDataFrame(lines, SCHEMA).write.parquet(str(tmp_path / "ocr_lines.parquet"))
    want = [(i, m.start(), m.group(), float(m.end()), m.end() > 61) for i, *_, t in lines for m in re.finditer(r"\S+", t or "")]
    assert rows(pages.text_spans(spark, str(tmp_path)), "page_id", "start", "text", "right", "off_crop") == sorted(want, key=repr)
