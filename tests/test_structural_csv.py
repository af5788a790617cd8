import random

import numpy as np
from pyspark.sql import functions as F

from packetloom.operators import structural_csv as sc


def parse(line):
    """A sequential reader of one record: fields, or None when a quote is out of place."""
    fields, i, n = [], 0, len(line)
    while True:
        value = ""
        if i < n and line[i] == '"':
            i += 1
            while True:
                if i >= n:
                    return None
                if line[i] == '"':
                    if i + 1 < n and line[i + 1] == '"':
                        value, i = value + '"', i + 2
                        continue
                    i += 1
                    break
                value, i = value + line[i], i + 1
            if i < n and line[i] != ",":
                return None
        else:
            while i < n and line[i] != ",":
                if line[i] == '"':
                    return None
                value, i = value + line[i], i + 1
        fields.append(value)
        if i >= n:
            return fields
        i += 1


def test_random_records_equal_a_sequential_reader(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choice('ab",\n é') for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, raw_line string").repartition(3)
    out = sc.split_columns(df, "raw_line", ("a", "b", "c")).collect()
    for r in out:
        want = parse(lines[r["line_id"]])
        assert r["__badly_quoted"] == (want is None), lines[r["line_id"]]
        if want is not None:
            assert r["__n_fields"] == len(want)
            assert (list(r["__fields"]) if r["__fields"] else None) == (want if len(want) == 3 else None)


def record(**changes):
    base = dict(zip(sc.SUBMISSION_FIELDS, ["MIB-000001", "A B", "S", "H", "V", "SPN-0001", "2025-02-28", "p", "none", "paid", "APPROVED", "0.5"], strict=True))
    return ",".join((base | changes).values())


def test_reasons_and_types(spark, rows):
    lines = [
        record(), record(case_id=" MIB-000002 "), record(case_id="MIB-12"), record(sponsor_id="SPN-12345", fee_status="Paid"), record(arrival_date="2025-02-30"), record(arrival_date="0000-01-01"),
        record() + ",x", 'a"b' + record(), None, "", record(declared_purpose='"x, y"'), record(confidence="?"),
    ]
    df = spark.createDataFrame([(i, x, "extra") for i, x in enumerate(lines)], "line_id long, raw_line string, case_id string")
    found = {(r["line_id"], r["reason"]) for r in sc.judge_submissions(df).select("line_id", F.explode("reasons").alias("reason")).collect()}
    assert found == {(2, "case_id"), (3, "sponsor_id"), (3, "fee_status"), (4, "arrival_date"), (5, "arrival_date"), (6, "column_count"), (7, "quoting"), (8, "column_count"), (9, "column_count")}
    valid, rejected = sc.load_submissions(df)
    got = {r["line_id"]: r for r in valid.collect()}
    assert set(got) == {0, 1, 10, 11} and rejected.count() == 8
    assert got[1]["case_id"] == "MIB-000002" and got[1]["case_id_raw"] == "extra"
    assert got[10]["declared_purpose"] == "x, y" and got[0]["confidence"] == 0.5 and got[11]["confidence"] is None


def test_empty_table_and_long_record(spark):
    empty = spark.createDataFrame([], "line_id long, raw_line string")
    assert sc.judge_submissions(empty).count() == 0
    long = spark.createDataFrame([(1, record(declared_purpose='"' + "x," * 200_000 + '"'))], "line_id long, raw_line string")
    assert sc.load_submissions(long)[0].count() == 1


def test_record_ends_outside_quotes():
    data = np.frombuffer(b'a,"x\ny"\r\nb,c\n\nd', np.uint8)
    assert [bytes(data[a:b]) for a, b in sc.record_bounds(data)] == [b'a,"x\ny"', b"b,c", b"", b"d"]
    assert len(sc.record_bounds(np.zeros(0, np.uint8))) == 0


def test_whole_files(spark, tmp_path):
    (tmp_path / "one.csv").write_bytes(b'1,"a\nb"\n2,c\n')
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = [(r["line_no"], r["raw_line"]) for r in sc.read_delimited_files(files, ("a", "b")).orderBy("line_no").collect()]
    assert got == [(1, '1,"a\nb"'), (2, "2,c")]
