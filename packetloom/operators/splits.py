"""Stratified hash splits, overlap checks and leakage scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packetloom.functions import text as tx

ROLES = ("tuning", "calibration", "release")


def stratified_split(rows: DataFrame, stratum: str, seed: str, shares: tuple[float, float] = (0.7, 0.15), forced: DataFrame | None = None) -> DataFrame:
    """case_id, stratum, role: per stratum the first share in hash order tunes, the next calibrates, the rest releases.

    ``forced`` (case_id) goes to tuning whatever its hash and counts towards
    the tuning share.  Counts are rounded half to even.  Positions come from
    ranges of the hash: each range's size gives the next one's start, so a
    stratum of any size is numbered in parallel.
    """
    base = rows.select("case_id", F.col(stratum).alias("stratum")).distinct()
    base = base.withColumn("forced", F.lit(False)) if forced is None else base.join(forced.select("case_id", F.lit(True).alias("forced")).distinct(), "case_id", "left").withColumn("forced", F.coalesce("forced", F.lit(False)))
    keyed = base.withColumn("key", F.concat(F.when(F.col("forced"), "0").otherwise("1"), tx.hash_key(F.col("case_id"), seed)))
    keyed = keyed.withColumn("__range", F.substring("key", 1, 3))
    sizes = keyed.groupBy("stratum", "__range").agg(F.count(F.lit(1)).alias("n"), F.count_if("forced").alias("f"))
    before = Window.partitionBy("stratum").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("stratum")
    starts = sizes.select("stratum", "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(all_of).alias("total"), F.sum("f").over(all_of).alias("n_forced"))
    inside = Window.partitionBy("stratum", "__range").orderBy("key", "case_id")
    placed = keyed.withColumn("rn", F.row_number().over(inside)).join(starts, ["stratum", "__range"]).withColumn("position", F.col("rn") + F.col("start"))
    tuning = F.greatest(F.bround(F.col("total") * shares[0]), F.col("n_forced"))
    calibration = F.bround(F.col("total") * shares[1])
    role = F.when(F.col("position") <= tuning, ROLES[0]).when(F.col("position") <= tuning + calibration, ROLES[1]).otherwise(ROLES[2])
    return placed.select("case_id", "stratum", role.alias("role"))


def role_conflicts(manifest: DataFrame) -> DataFrame:
    """case_id, n_roles of ids that have more than one role."""
    return manifest.groupBy("case_id").agg(F.countDistinct("role").alias("n_roles")).where("n_roles > 1")


def sensitive(rows: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """``rows`` exploded by the names of the patterns that their text holds."""
    hits = F.array_compact(F.array(*(F.when(F.col(text).rlike(p), F.lit(name)) for name, p in patterns.items())))
    return rows.withColumn("pattern", F.explode(hits))
