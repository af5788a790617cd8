import difflib

import pytest
from pyspark.sql import functions as F

from packetloom.functions import fuzzy, geometry
from packetloom.functions import text as tx


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("2026-2-3", "2026-02-03"), ("2026-02-30", None), ("2/3/2026", "2026-02-03"), ("13/2/2026", "2026-02-13"), ("", None), (None, None), ("3 Feb 2026", None)],
)
def test_written_day(spark, text, want):
    assert one(spark, F.date_format(tx.written_day(F.col("t")), "yyyy-MM-dd"), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("SPN-0I2S", "SPN-0125"), ("spn 1234", "SPN-1234"), ("SPN-12345", None), ("SPN-O00B", "SPN-0008"), (None, None), ("SPN-1o34", None)])
def test_repaired_digits(spark, text, want):
    assert one(spark, tx.repaired_digits(F.col("t"), "SPN", 4), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("b| A c |b", "a_c|b"), ("none", "none"), ("", "none"), (None, "none"), ("|x|", "x")])
def test_flag_text(spark, text, want):
    assert one(spark, tx.flag_text(F.col("t")), t=text) == want


def test_small_helpers(spark):
    assert one(spark, tx.collapse(F.col("t")), t="\t A \n B ") == "a b"
    assert one(spark, tx.clip(F.col("t"), 0.0, 1.0), t=2.0) == 1.0
    assert spark.sql("select cast(null as double) t").select(tx.clip(F.col("t"), 0.0, 1.0)).first()[0] is None
    assert one(spark, tx.digits_apart(F.col("a"), F.col("b")), a="SPN-1234", b="SPN-1934") == 1
    assert one(spark, tx.redacted(F.col("t"), ("ok",), ("page",)), t="page:fee_receipt") == "page:fee_receipt"
    assert one(spark, tx.redacted(F.col("t"), ("ok",), ("page",)), t="page:John 7") == "page:*"
    assert one(spark, tx.redacted(F.col("t"), ("ok",), ("page",)), t="name:x") == "other"


def test_ratio_is_difflibs_and_asymmetric(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("abc", "abc"), ("", "x"), (None, "x")]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(fuzzy.ratio("a", "b")).collect()]
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() if a is not None else None for a, b in pairs]
    assert got[0] != got[1]


def test_canonical_by_ratio(spark, rows):
    values = spark.createDataFrame([("Alpha Beta",), ("alpha_bet",), ("gamma",), ("zzz",), (None,), ("--",)], "value string")
    terms = spark.createDataFrame([("ALPHA_BETA",), ("GAMMA",), ("GAMMB",)], "term string")
    assert dict(rows(fuzzy.canonical_by_ratio(values, terms, 0.66))) == {"Alpha Beta": "ALPHA_BETA", "alpha_bet": "ALPHA_BETA", "gamma": "GAMMA", "zzz": None, None: None, "--": None}


def test_boxes(spark):
    df = spark.sql("select named_struct('left', 0d, 'bottom', 0d, 'right', 10d, 'top', 10d) a, named_struct('left', 5d, 'bottom', 0d, 'right', 15d, 'top', 10d) b, named_struct('left', 3d, 'bottom', 3d, 'right', 1d, 'top', 1d) c")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    got = df.select(geometry.iou(a, b), geometry.area(c), geometry.contains(a, b), geometry.aligned(a, a)).first()
    assert got[0] == pytest.approx(1 / 3) and tuple(got)[1:] == (0.0, False, True)


@pytest.mark.parametrize(
    ("value", "same"),
    [((5.0, 0.0, 15.0, 10.0), True), ((2.0, 0.0, 15.0, 10.0), True), ((1.9, 0.0, 15.0, 10.0), False), ((12.0, 5.0, 20.0, 15.0), True), ((12.0, 5.1, 20.0, 15.1), False), ((12.0, 5.0, 20.0, 5.0), False), ((12.0, 7.0, 20.0, 5.0), False)],
)
def test_rows_of_boxes(spark, value, same):
    box = "struct<left:double,bottom:double,right:double,top:double>"
    df = spark.createDataFrame([((0.0, 0.0, 10.0, 10.0), value)], f"a {box}, b {box}")
    assert df.select(geometry.same_row(F.col("a"), F.col("b"))).first()[0] == same
