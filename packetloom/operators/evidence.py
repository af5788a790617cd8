"""Linking and resolving evidence: scoping, name clusters, ranked precedence."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Precedence of the evidence types; fixed values.
RANKS = {"adjudicatorstamp": 1, "signedmanualnote": 1, "intakeform": 2, "biometricslip": 3, "sponsorattestation": 4, "registryextract": 5, "textlayer": 6}


def rank_of(evidence_type: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in RANKS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.regexp_replace(F.lower(evidence_type), "[^a-z]", "")), F.lit(9))


def confidence_of(column: Column) -> Column:
    return F.coalesce(F.when(column > 1, column / 100).otherwise(column), F.lit(0.0))


def has_cue(cue: str) -> Column:
    return F.coalesce(F.array_contains("visual_cues", cue), F.lit(False))


def scoped(evidence: DataFrame) -> DataFrame:
    """Rows whose hint names no other case: a missing hint or the packet's own."""
    hint = F.regexp_replace(F.upper(F.coalesce("case_id_hint", F.lit(""))), "[^A-Z0-9]", "")
    return evidence.where((hint == "") | (hint == F.regexp_replace("case_id", "[^A-Z0-9]", "")))


def eligible(evidence: DataFrame) -> DataFrame:
    """Legible rows with a value that are neither superseded nor struck out."""
    return evidence.where(F.col("legible") & F.col("value").rlike(r"\S") & ~F.coalesce("superseded", F.lit(False)) & ~has_cue("strikethrough"))


def without_rescinded(evidence: DataFrame) -> DataFrame:
    """Drops watermarked rows, and stamped denials before the latest signed approval that corrects them.

    ``rescinded`` tells whether the packet lost a denial that way.
    """
    kind = F.regexp_replace(F.lower("evidence_type"), "[^a-z]", "")
    place = F.struct("page_index", F.col("box.top").alias("y_end"))
    decision = F.col("field_name") == "adjudication"
    approval = decision & (F.col("value") == "APPROVED") & (kind == "signedmanualnote") & has_cue("correction")
    live = evidence.where(~has_cue("sample_denial_watermark"))
    latest = live.where(approval).groupBy("case_id").agg(F.max(place).alias("__latest"))
    marked = live.join(latest, "case_id", "left")
    overturned = decision & (F.col("value") == "DENIED") & (kind == "adjudicatorstamp") & F.coalesce(place < F.col("__latest"), F.lit(False))
    marked = marked.withColumn("__overturned", overturned)
    flagged = marked.groupBy("case_id").agg(F.max("__overturned").alias("rescinded"))
    return marked.where(~F.col("__overturned")).drop("__latest", "__overturned").join(flagged, "case_id")


def resolve(evidence: DataFrame, grid: DataFrame | None = None) -> DataFrame:
    """case_id, field_name, state, reason, value, winner (cand_id), rank, n_considered of each field.

    The best rank speaks; corrections among it, if any, speak alone; one value
    is RESOLVED, several are CONTESTED, none is UNKNOWN.  The winner is the
    most confident row, later on the page first, then the earliest observed.
    ``grid`` (case_id, field_name) adds fields that nobody observed.  Only
    aggregates and joins on (case_id, field_name) are used, no group is held.
    """
    keys = ["case_id", "field_name"]
    rows = eligible(evidence).withColumn("rank", rank_of(F.col("evidence_type"))).withColumn("corr", has_cue("correction").cast("int"))
    # the best (rank, corrections first) of each field
    tier = F.struct("rank", (-F.col("corr")).alias("c"))
    best = rows.groupBy(*keys).agg(F.min(tier).alias("tier"))
    finalists = rows.join(best, keys).where(tier == F.col("tier"))
    order = F.struct(confidence_of(F.col("ocr_confidence")).alias("a"), "page_index", F.col("box.top").alias("y"), (-F.col("seq")).alias("s"), (-F.col("cand_id")).alias("i"))
    spoken = finalists.groupBy(*keys).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.max_by("cand_id", order).alias("winner"), F.min("rank").alias("rank"), F.count(F.lit(1)).alias("n_finalists")
    )
    considered = evidence.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_considered"))
    base = considered if grid is None else grid.select(*keys).distinct().join(considered, keys, "full")
    joined = base.join(spoken, keys, "left")
    one = F.col("low") == F.col("high")
    state = F.when(F.col("low").isNull(), "UNKNOWN").when(one, "RESOLVED").otherwise("CONTESTED")
    at_rank = F.concat(F.when(one, "resolved at precedence rank ").otherwise("same-rank conflict at precedence rank "), F.col("rank").cast("string"))
    reason = F.when(F.col("low").isNull(), "no eligible evidence").otherwise(at_rank)
    return joined.select(
        *keys, state.alias("state"), reason.alias("reason"), F.when(one, F.col("low")).alias("value"), F.when(one, F.col("winner")).alias("winner"), "rank", F.coalesce("n_considered", F.lit(0)).alias("n_considered")
    )


def unanimous(evidence: DataFrame) -> DataFrame:
    """case_id, field_name, value of the fields whose eligible rows all agree."""
    agreed = eligible(evidence).groupBy("case_id", "field_name").agg(F.min("value").alias("value"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n_rows"))
    return agreed.where(F.col("value") == F.col("high")).drop("high")


def corroborated(evidence: DataFrame, pages: int = 2, types: int = 2) -> DataFrame:
    """case_id, field_name, value seen on several pages and by several evidence types, where it is the only such value."""
    kind = F.regexp_replace(F.lower("evidence_type"), "[^a-z]", "")
    seen = eligible(evidence).groupBy("case_id", "field_name", "value").agg(F.countDistinct("page_index").alias("p"), F.countDistinct(kind).alias("t"))
    strong = seen.where((F.col("p") >= pages) & (F.col("t") >= types))
    return strong.groupBy("case_id", "field_name").agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("n")).where(F.col("n") == 1).drop("n")


def name_key(name: str) -> str:
    return "".join(c for c in name.lower() if c.isascii() and c.isalnum())


def name_clusters(evidence: DataFrame, similarity: float = 0.8) -> DataFrame:
    """case_id, value, cluster: each spelling joins the first cluster with a like member.

    The order of observation decides and clusters never merge, so this is one
    grouped pass per packet over its distinct spellings.
    """
    names = eligible(evidence).where(F.col("field_name") == "applicant_name")
    distinct = names.groupBy("case_id", "value").agg(F.min(F.struct("page_index", "seq", "cand_id")).alias("first"))

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        clusters: list[list[str]] = []
        numbers = []
        for value in pdf.sort_values(["p", "s", "c"])["value"]:
            key = name_key(value)
            at = next((i for i, c in enumerate(clusters) if any(difflib.SequenceMatcher(None, key, k).ratio() >= similarity for k in c)), None)
            if at is None:
                at = len(clusters)
                clusters.append([])
            clusters[at].append(key)
            numbers.append((pdf["case_id"].iloc[0], value, at))
        return pd.DataFrame(numbers, columns=["case_id", "value", "cluster"])

    flat = distinct.select("case_id", "value", F.col("first.page_index").alias("p"), F.col("first.seq").alias("s"), F.col("first.cand_id").alias("c"))
    return flat.groupBy("case_id").applyInPandas(cluster, "case_id string, value string, cluster int")


def active_applicants(evidence: DataFrame, similarity: float = 0.8) -> DataFrame:
    """case_id, applicant: the strongest cluster's most confident spelling, null on an exact tie."""
    names = eligible(evidence).where(F.col("field_name") == "applicant_name").withColumn("rank", rank_of(F.col("evidence_type")))
    names = names.withColumn("conf", confidence_of(F.col("ocr_confidence"))).join(name_clusters(evidence, similarity), ["case_id", "value"])
    best = names.groupBy("case_id", "cluster").agg(F.min("rank").alias("best"))
    sized = names.join(best, ["case_id", "cluster"]).groupBy("case_id", "cluster").agg(
        F.struct((-F.min("rank")).alias("r"), F.count_if(F.col("rank") == F.col("best")).alias("at_best"), F.count(F.lit(1)).alias("size"), F.max("conf").alias("conf")).alias("strength"),
        F.max_by("value", F.struct("conf", -F.col("rank"), -F.col("seq"), -F.col("cand_id"))).alias("applicant"),
    )
    top = Window.partitionBy("case_id").orderBy(F.desc("strength"))
    ranked = sized.withColumn("place", F.rank().over(top)).where(F.col("place") == 1)
    out = ranked.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.min("applicant").alias("applicant"))
    return out.select("case_id", F.when(F.col("n") == 1, F.col("applicant")).alias("applicant"))
