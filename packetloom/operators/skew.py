"""Equal joins whose keys may be hot on either side.

A key that more than ``heavy`` rows of a side share is cut into parts: each row
of that side gets one part, the other side's rows are repeated for all parts.
Every pair of rows meets exactly once, in a task of about ``heavy`` rows a side.
Keys below that are joined as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.session import cut, small_rows

HEAVY, HOT_KEYS = 20_000, 100_000


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], heavy: int = HEAVY, counts: tuple[DataFrame | None, DataFrame | None] = (None, None)) -> DataFrame:
    """Inner join on ``keys`` (null keys meet nothing); columns of both sides, the keys once.

    The hot keys are found by an aggregate that combines before its shuffle;
    there is at most one to ``heavy`` rows, and they are broadcast only when
    ``HOT_KEYS`` or fewer.  ``counts`` (keys, n) saves that where the sides'
    rows a key are known; counts that are too high cost nothing but parts.
    """
    sizes = None
    for side, known, n in ((left, counts[0], "__nl"), (right, counts[1], "__nr")):
        sized = side.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) if known is None else known.select(*keys, F.col("n").alias(n))
        hot = sized.where(F.col(n) > heavy)
        sizes = hot if sizes is None else sizes.join(hot, keys, "full")
    sizes = cut(sizes)
    listed = small_rows(sizes.select(F.lit(1)), HOT_KEYS)
    if listed is not None and not listed:
        return left.join(right, keys)
    parts = sizes.select(*keys, *(F.ceil(F.coalesce(n, F.lit(1)) / heavy).cast("int").alias(p) for n, p in (("__nl", "__pl"), ("__nr", "__pr"))))
    parts = F.broadcast(parts) if listed is not None else parts

    def spread(side: DataFrame, own: str, other: str, a: str, b: str) -> DataFrame:
        known = side.join(parts, keys, "left").withColumn(own, F.coalesce(own, F.lit(1))).withColumn(other, F.coalesce(other, F.lit(1)))
        # the part is a function of the row, so that a task run again gives the same rows
        salted = known.withColumn(a, F.pmod(F.xxhash64(*side.columns), F.col(own)).cast("int"))
        return salted.withColumn(b, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(own, other)

    return spread(left, "__pl", "__pr", "__a", "__b").join(spread(right, "__pr", "__pl", "__b", "__a"), [*keys, "__a", "__b"]).drop("__a", "__b")
