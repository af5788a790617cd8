"""Confidence maps: isotonic steps, hierarchical smoothing and linear recalibration."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import text as tx
from packetloom.session import cut, small_rows

BLOCK_ROWS = 100_000


def pool(blocks: list[tuple[float, float, float]]) -> list[tuple[float, float, float]]:
    """Pool adjacent violators: (start, successes, n) blocks merged while the mean before is larger."""
    out: list[list[float]] = []
    for start, good, n in blocks:
        out.append([start, good, n])
        while len(out) > 1 and out[-2][1] * out[-1][2] > out[-1][1] * out[-2][2]:
            _, g, m = out.pop()
            out[-1][1] += g
            out[-1][2] += m
    return [tuple(b) for b in out]


def isotonic_steps(samples: DataFrame, signal: str, outcome: str, block_rows: int = BLOCK_ROWS) -> list[tuple[float, float]]:
    """(breakpoint, probability) of the isotonic fit of ``outcome`` (boolean) on ``signal``.

    Samples are summed per signal first.  Pooling is associative: ranges of the
    signal are pooled on their own until few enough blocks are left for one
    pass, and the result is that of a single pass.
    """
    summed = samples.where(F.col(signal).isNotNull() & F.col(outcome).isNotNull())
    blocks = cut(summed.groupBy(F.col(signal).cast("double").alias("start")).agg(F.sum(F.col(outcome).cast("double")).alias("good"), F.count(F.lit(1)).cast("double").alias("n")))

    def pool_range(batches):
        rows = [r for b in batches for r in b.itertuples(index=False)]
        yield pd.DataFrame(pool([tuple(r) for r in rows]), columns=["start", "good", "n"])

    while (listed := small_rows(blocks, block_rows)) is None:
        parts = max(2, blocks.count() // (block_rows // 2))
        pooled = cut(blocks.repartitionByRange(parts, "start").sortWithinPartitions("start").mapInPandas(pool_range, "start double, good double, n double"))
        if pooled.count() == blocks.count():  # already isotonic: nothing to pool
            listed = blocks.collect()
            break
        blocks = pooled
    steps = [(start, good / n) for start, good, n in pool(sorted(tuple(r) for r in listed))]
    if not steps:
        return [(0.0, 0.0), (1.0, 0.0)]
    padded = ([(0.0, steps[0][1])] if steps[0][0] > 0 else []) + steps
    return padded + ([(1.0, padded[-1][1])] if padded[-1][0] < 1 else [])


def step_lookup(signal: Column, steps: list[tuple[float, float]]) -> Column:
    """The probability at the greatest breakpoint not above the signal, which is clamped to [0, 1]."""
    table = F.array(*(F.struct(F.lit(float(a)).alias("at"), F.lit(float(p)).alias("p")) for a, p in sorted(steps)))
    x = tx.clip(signal, 0.0, 1.0)
    below = F.filter(table, lambda s: s["at"] <= x)
    return F.try_element_at(below, F.lit(-1))["p"]


def hierarchical(samples: DataFrame, levels: list[str], outcome: str, strengths: list[float]) -> DataFrame:
    """Smoothed rate of ``outcome`` per combination of ``levels``: p = (good + s * parent) / (n + s), from the whole down.

    One row per deepest combination, with a column p_<level> for each depth;
    each level is one small aggregate joined to its parent.
    """
    base = samples.groupBy(*levels).agg(F.sum(F.col(outcome).cast("double")).alias("good"), F.count(F.lit(1)).alias("n"))
    top = base.agg((F.sum("good") / F.sum("n")).alias("p_all"))
    out = base.crossJoin(F.broadcast(top)).drop("good", "n")
    parent = "p_all"
    for depth, (level, strength) in enumerate(zip(levels, strengths, strict=True)):
        keys = levels[: depth + 1]
        sums = base.groupBy(*keys).agg(F.sum("good").alias("__g"), F.sum("n").alias("__n"))
        joined = out.join(sums, keys)
        out = joined.withColumn(f"p_{level}", (F.col("__g") + strength * F.col(parent)) / (F.col("__n") + strength)).drop("__g", "__n")
        parent = f"p_{level}"
    return out


def reconcile(parents: DataFrame, children: DataFrame, key: str, count: str) -> DataFrame:
    """Keys whose children's counts do not add up to the parent's."""
    sums = children.groupBy(key).agg(F.sum(count).alias("children"))
    joined = parents.select(key, F.col(count).alias("parent")).join(sums, key, "full")
    return joined.where(~F.col("parent").eqNullSafe(F.col("children")))


def linear_recalibration(features: dict[str, Column], coefficients: dict[str, float], intercept: float, old: Column, blend: float, low: float = 0.02, high: float = 0.98) -> Column:
    """clip(blend * linear score + (1 - blend) * old)."""
    score = F.lit(float(intercept))
    for name, column in features.items():
        score = score + column * F.lit(float(coefficients[name]))
    return tx.clip(blend * score + (1 - blend) * old, low, high)


def brier(probability: Column, outcome: Column) -> Column:
    return F.avg(F.pow(probability - outcome.cast("double"), F.lit(2)))
