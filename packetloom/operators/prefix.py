"""Running values inside a key that may hold most of the rows.

The order of a key is cut into chunks.  One window runs inside a (key, chunk),
another over one row a chunk, and the chunk's start is joined back, so no task
sees all rows of a key.  The chunk expression must follow the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _join_null_safe(rows: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    renamed = starts.select(*(F.col(k).alias(f"__j{i}") for i, k in enumerate(keys)), "__start")
    match = [rows[k].eqNullSafe(renamed[f"__j{i}"]) for i, k in enumerate(keys)]
    return rows.join(renamed, match, "left").drop(*(f"__j{i}" for i in range(len(keys))))


def total_before(df: DataFrame, keys: list[str], order: list[str], chunk: Column, value: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows before this one within ``keys``."""
    at = df.withColumn("__chunk", chunk).withColumn("__value", value)
    sums = at.groupBy(*keys, "__chunk").agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "__chunk", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = at.withColumn("__in", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    joined = _join_null_safe(summed, starts, [*keys, "__chunk"])
    return joined.withColumn(out, F.col("__in") + F.coalesce("__start", F.lit(0))).drop("__chunk", "__value", "__in", "__start")


def last_before(df: DataFrame, keys: list[str], order: list[str], chunk: Column, value: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the last ``value`` that is not null in the rows before this one within ``keys``."""
    at = df.withColumn("__chunk", chunk).withColumn("__value", value)
    rank = F.struct(*order)
    held = at.groupBy(*keys, "__chunk").agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), rank)).alias("__held"))
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(*keys, "__chunk", F.last("__held", ignorenulls=True).over(earlier).alias("__start"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = at.withColumn("__in", F.last("__value", ignorenulls=True).over(inside))
    joined = _join_null_safe(carried, starts, [*keys, "__chunk"])
    return joined.withColumn(out, F.coalesce("__in", "__start")).drop("__chunk", "__value", "__in", "__start")
