"""Problem 8: mixing sources to target weights.

The total is the largest at which every source can give its share without
exceeding its repeats.  Within a source, records are ordered by a hash-random
key.  The key's upper bits are order-preserving ranges: token sums of the
ranges give each range its start, a window inside one range the rest, so the
prefix sum of a source that holds most rows is spread over all tasks.  A source
is taken whole as often as its budget allows, then cut at the exact budget; the
record on the cut goes where it leaves the smaller error.

Defined results: records of sources without a target, without tokens or with a
null source are not used; a target without records is reported with 0 tokens
and does not limit the total; repeated rows are records of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packetloom.session import cut, maybe_broadcast


def budgets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, available, budget (tokens) of every target."""
    held = sized.where(F.col("n_tokens") > 0).groupBy("source").agg(F.sum("n_tokens").alias("available"))
    goal = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    joined = goal.join(held, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    # as many rows as targets
    usable = (F.col("available") > 0) & (F.col("target_share") > 0)
    reach = F.when(usable, F.col("available") * F.col("max_repeats") / F.col("target_share"))
    total = joined.agg(F.min(reach).alias("total"))
    budget = F.when(usable, F.least(F.floor(F.col("target_share") * F.col("total") + 1e-6), F.col("available") * F.col("max_repeats"))).otherwise(0)
    return joined.crossJoin(F.broadcast(total)).withColumn("budget", F.coalesce(budget, F.lit(0)).cast("long")).drop("total")


def mix(sized: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """source, doc_id, n_tokens, repeats of the records used (``sized``: doc_id, source, n_tokens)."""
    plan = maybe_broadcast(cut(budgets(sized, targets).select("source", "available", "budget")))
    key = F.xxhash64(F.lit(seed), "doc_id")
    rows = sized.where(F.col("n_tokens") > 0).select("source", "doc_id", "n_tokens", key.alias("key"))
    rows = rows.withColumn("range", F.shiftright("key", 54).cast("int"))  # 1024 ranges in key order
    sums = rows.groupBy("source", "range").agg(F.sum("n_tokens").alias("in_range"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "range", F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("upto", F.sum("n_tokens").over(inside)).join(starts, ["source", "range"]).join(plan, "source")
    end = F.col("start") + F.col("upto")
    whole = F.floor(F.col("budget") / F.col("available"))
    rest = F.col("budget") - whole * F.col("available")
    repeats = whole + (2 * end - F.col("n_tokens") <= 2 * rest).cast("long")
    return summed.select("source", "doc_id", "n_tokens", repeats.cast("int").alias("repeats")).where(F.col("repeats") > 0)


def shares(sized: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """Per target: tokens and share aimed at and reached, records used and the most repeats."""
    goal = budgets(sized, targets)
    used = mix(sized, targets, seed).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("n_records"), F.max("repeats").alias("most_repeats"))
    joined = goal.join(used, "source", "left").na.fill(0, ["tokens", "n_records", "most_repeats"])
    total = joined.agg(F.sum("tokens").alias("total"))
    share = F.when(F.col("total") > 0, F.col("tokens") / F.col("total")).otherwise(0.0)
    return joined.crossJoin(F.broadcast(total)).select("source", "target_share", share.alias("actual_share"), "budget", "tokens", "n_records", "most_repeats", "max_repeats", "available")
