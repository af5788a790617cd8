import random
from collections import Counter

import pytest

from packetloom.operators import skew


@pytest.mark.parametrize("heavy", [5, 40, 10_000])
def test_salted_join_equals_a_plain_join(spark, heavy):
    rng = random.Random(heavy)
    pick = lambda: rng.choice(["hot"] * 6 + ["warm", "cold", None, "x", "y"])
    left = spark.createDataFrame([(pick(), i % 3, i) for i in range(300)], "k string, j int, a int")
    right = spark.createDataFrame([(pick(), i % 3, i) for i in range(120)] + [("hot", 1, 7)] * 3, "k string, j int, b int")
    got, want = (Counter(map(tuple, df.select("k", "j", "a", "b").collect())) for df in (skew.salted_join(left, right, ["k", "j"], heavy), left.join(right, ["k", "j"])))
    assert got == want and want


def test_salted_join_of_empty_tables(spark):
    left = spark.createDataFrame([("k", 1)], "k string, a int")
    right = spark.createDataFrame([], "k string, b int")
    assert skew.salted_join(left, right, ["k"], 1).count() == skew.salted_join(right, left, ["k"]).count() == 0
