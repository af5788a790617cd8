"""Agreement of independent readings: k of n, unanimity with veto, and maximal sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEYS = ("case_id", "field_name")


def unpivot(predictions: DataFrame, fields: tuple[str, ...], view: str) -> DataFrame:
    """case_id, view, field_name, value (not blank) of wide reading rows, one distinct value a view."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields))
    long = predictions.select("case_id", F.col(view).alias("view"), F.inline(pairs)).where(F.col("value").rlike(r"\S"))
    return long.distinct()


def agreed(views: DataFrame, at_least: int, max_values: int = 1) -> DataFrame:
    """case_id, field_name, value, n_views where at least ``at_least`` views name it and no more than ``max_values`` values are named."""
    votes = views.groupBy(*KEYS, "value").agg(F.countDistinct("view").alias("n_views"))
    named = votes.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_values"), F.max_by("value", F.struct("n_views", "value")).alias("value"), F.max("n_views").alias("n_views"))
    return named.where((F.col("n_views") >= at_least) & (F.col("n_values") <= max_values)).select(*KEYS, "value", "n_views")


def two_pass(views: DataFrame, first: str, second: str) -> DataFrame:
    """case_id, field_name, value on which two single-valued passes agree."""
    single = views.where(F.col("view").isin(first, second)).groupBy(*KEYS, "view").agg(F.min("value").alias("value"), F.max("value").alias("high")).where(F.col("value") == F.col("high"))
    both = single.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value"), F.max("value").alias("high"))
    return both.where((F.col("n") == 2) & (F.col("value") == F.col("high"))).select(*KEYS, "value")


def lead(views: DataFrame, margin: int = 2) -> DataFrame:
    """case_id, field_name, value whose votes lead the runner-up by at least ``margin``."""
    votes = views.groupBy(*KEYS, "value").agg(F.countDistinct("view").alias("n"))
    # two rows a group are enough; Spark limits each group before the shuffle
    order = Window.partitionBy(*KEYS).orderBy(F.desc("n"), F.desc("value"))
    top = votes.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= 2)
    pair = top.groupBy(*KEYS).agg(F.max_by("value", -F.col("rn")).alias("value"), F.max("n").alias("first"), F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("n"))), F.lit(0)).alias("second"))
    return pair.where(F.col("first") - F.col("second") >= margin).select(*KEYS, "value", (F.col("first") - F.col("second")).alias("lead"))


def set_union(rows: DataFrame, key: str, members: str) -> DataFrame:
    """key, members: the sorted union of the sets of a group, built from distinct members."""
    distinct = rows.select(key, F.explode(members).alias("m")).distinct()
    return distinct.groupBy(key).agg(F.array_sort(F.collect_list("m")).alias(members))


def maximal_sets(rows: DataFrame, key: str, members: str) -> DataFrame:
    """The distinct sets of each key that no other set of the key strictly contains."""
    sets = rows.select(key, F.array_sort(F.array_distinct(members)).alias(members)).distinct()
    other = sets.select(F.col(key).alias("__k"), F.col(members).alias("__m"))
    inside = (F.col(key) == F.col("__k")) & (F.size(members) < F.size("__m")) & (F.size(F.array_except(members, "__m")) == 0)
    return sets.join(other, inside, "left_anti")
