import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.llm import containers, mixture, tokens


def test_least_squares_is_nonnegative_and_optimal():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((6, 10)), rng.random(6)
        x = containers.nonnegative_least_squares(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-6


def test_combinations_fill_the_window():
    got = containers.combinations_filling([10, 30, 40, 60, 100], 100, 5)
    assert set(got) == {(100,), (40, 60), (10, 30, 60), (30, 30, 40)}


@pytest.mark.parametrize("capacity", [64, 1000])
def test_plan_holds_every_item_and_nothing_more(capacity):
    rng = random.Random(capacity)
    histogram = Counter(containers.planned_size(min(capacity, int(rng.expovariate(6 / capacity)) + 1), capacity) for _ in range(3000))
    plan = containers.plan_for(dict(histogram), capacity)
    placed = Counter()
    for pattern, times in plan.items():
        assert sum(s * m for s, m in pattern) <= capacity and times > 0
        for s, m in pattern:
            placed[s] += m * times
    assert placed == histogram
    total = sum(s * n for s, n in histogram.items())
    assert sum(plan.values()) <= 1.02 * total / capacity + 1


def test_every_text_in_a_container_of_each_kind(spark):
    rng = random.Random(8)
    sizes = [0, 1, 1, 100, 101, 250, 99, *(rng.randint(1, 60) for _ in range(300)), *([33] * 200)]
    docs = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "doc_id long, n_tokens long, container_kind string")
    kinds = spark.createDataFrame([("box", 100), ("bin", 40)], "container_kind string, capacity_tokens int")
    out = containers.fill_containers(docs, kinds).collect()
    for kind, capacity in (("box", 100), ("bin", 40)):
        held, parts = Counter(), defaultdict(list)
        for r in out:
            if r["container_kind"] == kind:
                held[r["container_no"]] += r["n_tokens"]
                parts[r["doc_id"]].append((r["part"], r["n_tokens"]))
        assert max(held.values()) <= capacity and set(held) == set(range(len(held)))
        for i, n in enumerate(sizes):
            got = sorted(parts.get(i, []))
            assert sum(x for _, x in got) == n and [p for p, _ in got] == list(range(1, len(got) + 1))
            assert len(got) == -(-n // capacity)  # whole unless above the capacity
    assert containers.fill_containers(docs.limit(0), kinds).count() == 0
    with pytest.raises(ValueError):
        containers.fill_containers(docs, kinds.withColumn("capacity_tokens", F.lit(0)))
    with pytest.raises(ValueError):
        containers.fill_containers(docs, spark.range(containers.MAX_KINDS + 1).selectExpr("cast(id as string) container_kind", "5 capacity_tokens"))
    assert containers.fill_containers(docs, kinds.limit(0)).count() == 0


def test_every_kind_of_a_long_list_is_filled(spark):
    docs = spark.createDataFrame([(1, 3), (2, 4)], "doc_id long, n_tokens long")
    kinds = spark.range(1, 1202).selectExpr("concat('k', id) container_kind", "cast(10 as int) capacity_tokens")
    assert containers.fill_containers(docs, kinds).groupBy("container_kind").agg(F.sum("n_tokens").alias("n")).where("n = 7").count() == 1201


def test_too_many_combinations_raise():
    with pytest.raises(ValueError):
        containers.combinations_filling(list(range(1, 60)), 100, 90, limit=50)


def test_ranks_are_gapless(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(500)], "k int, doc_id long")
    ranks = defaultdict(set)
    for r in containers.ranked(df, ["k"], ["doc_id"], buckets=16).collect():
        ranks[r["k"]].add(r["rank"])
    assert all(v == set(range(len(v))) for v in ranks.values())


def sized(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("aaaaaabbc"), rng.randint(1, 50)) for i in range(2000)] + [(9001, None, 5), (9002, "other", 5), (9003, "a", 0)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").cache()


def test_mixture_meets_the_shares(spark):
    docs = sized(spark)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    out = mixture.mix(docs, targets).collect()
    caps = {"a": 1, "b": 2, "c": 3}
    assert all(0 < r["repeats"] <= caps[r["source"]] for r in out) and len({r["doc_id"] for r in out}) == len(out)
    tokens_of = Counter()
    for r in out:
        tokens_of[r["source"]] += r["repeats"] * r["n_tokens"]
    total = sum(tokens_of.values())
    for r in mixture.shares(docs, targets).collect():
        assert abs(tokens_of[r["source"]] - r["budget"]) <= 25 and abs(r["actual_share"] - r["target_share"]) < 0.005 and r["tokens"] == tokens_of[r["source"]]
    # one source is used up: no larger total exists
    available = {r["source"]: r["available"] for r in mixture.shares(docs, targets).collect()}
    assert any(available[s] * caps[s] <= t + 50 for s, t in tokens_of.items()) and total > 0


def test_mixture_is_deterministic_and_cut_in_key_order(spark):
    docs = sized(spark)
    targets = spark.createDataFrame([("a", 1.0, 1), ("missing", 0.0, 1)], "source string, target_share double, max_repeats int")
    one = {tuple(r) for r in mixture.mix(docs, targets).collect()}
    assert one == {tuple(r) for r in mixture.mix(docs.repartition(7), targets).collect()}
    report = {r["source"]: r["tokens"] for r in mixture.shares(docs, targets).collect()}
    assert report["missing"] == 0
    assert mixture.mix(docs.limit(0), targets).count() == 0


def test_token_counts(spark):
    encode = tokens.encoder(tokens.RANKS).encode_ordinary
    texts = ["Hello, world!", "", None, "été <|endoftext|>", "a " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df).collect()}
    assert got == {i: len(encode(t)) if t else 0 for i, t in enumerate(texts)}
    assert tokens.encoder(tokens.RANKS).decode(encode(texts[3])) == texts[3]
