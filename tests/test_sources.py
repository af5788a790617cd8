import json

import pytest

from packetloom.operators import structural_csv as sc
from packetloom.sources import files
from packetloom.streaming import intake

ROW = {"case_id": "MIB-000001", "applicant_name": "Zed", "confidence": 0.5}


def test_case_files(spark, tmp_path):
    for name in ("case-b.pdf", "A-case.PDF", "notes.txt", "MIB-000007.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "nested").mkdir()
    (tmp_path / "nested" / "case-c.pdf").write_bytes(b"x")
    got = [(r["name"], r["case_id"]) for r in files.case_files(spark, str(tmp_path)).collect()]
    assert got == [("A-case.PDF", None), ("case-b.pdf", None), ("MIB-000007.pdf", "MIB-000007")]


@pytest.mark.parametrize(
    ("name", "text"),
    [
        ("a.csv", 'case_id,applicant_name,confidence\nMIB-000001,"Zed",0.5\n'), ("a.jsonl", json.dumps(ROW) + "\n"), ("a.json", json.dumps([ROW], indent=1)), ("b.json", json.dumps({"predictions": [ROW]})),
        ("c.json", json.dumps(ROW)), ("d.json", json.dumps({"MIB-000001": {"applicant_name": "Zed", "confidence": 0.5}})),
    ],
)
def test_prediction_shapes(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    got = files.read_predictions(spark, str(tmp_path / name)).collect()
    assert [(r["case_id"], r["applicant_name"], r["confidence"]) for r in got] == [("MIB-000001", "Zed", 0.5)]


def test_token_tsv_keeps_quotes(spark, tmp_path):
    head = "\t".join(files.TSV_COLUMNS)
    lines = [head, "5\t1\t1\t1\t1\t1\t10\t20\t30\t8\t96.5\t\"Zed", "5\t1\t1\t1\t1\t2\t50\t20\t30\t8\t-1\tx", "4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t", "5\t1\t1\t1\t1\t3\t50\t20\t0\t8\t90\ty"]
    (tmp_path / "t.tsv").write_text("\n".join(lines) + "\n")
    got = files.read_token_tsv(spark, str(tmp_path / "t.tsv")).collect()
    assert [(r["text"], r["confidence"], tuple(r["box"])) for r in got] == [('"Zed', 0.965, (10.0, 20.0, 40.0, 28.0))]
    (tmp_path / "bad.tsv").write_text("level\ttext\n5\tx\n")
    with pytest.raises(ValueError):
        files.read_token_tsv(spark, str(tmp_path / "bad.tsv"))


def test_sink_sorts_refuses_repeats_and_is_atomic(spark, tmp_path):
    rows = [{f: "x" for f in sc.SUBMISSION_FIELDS} | {"case_id": c, "confidence": 1e-05} for c in ("MIB-000002", "MIB-000001")]
    df = spark.createDataFrame(rows, files.PREDICTION)
    target = tmp_path / "out.jsonl"
    assert files.write_predictions(df, str(target)) == 2
    held = [json.loads(x) for x in target.read_text().splitlines()]
    assert [h["case_id"] for h in held] == ["MIB-000001", "MIB-000002"] and list(held[0]) == list(sc.SUBMISSION_FIELDS)
    with pytest.raises(ValueError):
        files.write_predictions(df.unionAll(df), str(target))
    assert files.write_predictions(df.limit(0), str(target)) == 0 and target.read_text() == "" and len(list(tmp_path.iterdir())) == 1


def test_artifact_checks(tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"schema_version": 1, "steps": []}))
    assert files.read_artifact(str(path), {"schema_version", "steps"}, 1)["steps"] == []
    for keys, version in (({"schema_version"}, 1), ({"schema_version", "steps"}, 2)):
        with pytest.raises(ValueError):
            files.read_artifact(str(path), keys, version)


def test_stream_loads_and_counts(spark, tmp_path):
    good = ",".join(["MIB-000001", "A", "S", "H", "V", "SPN-0001", "2025-01-01", "p", "none", "paid", "APPROVED", "0.5"])
    df = spark.createDataFrame([(1, good), (2, "a,b"), (3, 'x"y')], "line_id long, raw_line string").selectExpr("*", "timestamp'2026-01-01 00:10:00' as received_at")
    df.write.parquet(str(tmp_path / "in"))
    stream = intake.submitted_stream(spark, str(tmp_path / "in"), df.schema)
    kept = {}
    query = intake.load_stream(stream, str(tmp_path / "cp"), lambda d, n: kept.update(valid=d.count()), lambda d, n: kept.update(rejected=d.count()))
    query.awaitTermination()
    assert kept == {"valid": 1, "rejected": 2}
    counted = intake.reject_rates(intake.submitted_stream(spark, str(tmp_path / "in"), df.schema)).writeStream.outputMode("complete").format("memory").queryName("rates").trigger(availableNow=True).start()
    counted.awaitTermination()
    assert {(r["reason"], r["n_records"]) for r in spark.sql("select * from rates").collect()} == {("column_count", 1), ("quoting", 1)}
