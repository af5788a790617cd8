"""Scoping to the active applicant, anchored facts, vetoes and repairs of single fields.

All are aggregates and semi joins on (case, field); only the similarity of
names runs in Python, on distinct pairs of names of one case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.fuzzy import ratio
from packetloom.functions.text import ocr_key
from packetloom.operators import evidence as ev

#: Thresholds of the applicant that a sponsor's sentence names; fixed values.
SPONSOR_SURE, SUPPORT_SURE, SUPPORT_LIKE, INTAKE_WEAK, INTAKE_LIKE = 0.90, 0.75, 0.65, 0.72, 0.90
#: Fields that a sponsor's sentence may repair, and the likeness of the names that this needs; fixed values.
REPAIRED, REPAIR_LIKE = ("sponsor_id", "visa_class"), 0.80


def kind_of(evidence_type: Column) -> Column:
    return F.regexp_replace(F.lower(evidence_type), "[^a-z]", "")


def applicant_scoped(evidence: DataFrame, aliases: DataFrame) -> DataFrame:
    """``evidence`` without the rows that belong to somebody else.

    ``aliases``: case_id, alias, the names of the active applicant.  A row stays
    when it has no applicant hint or one of the aliases, when its case has no
    alias at all, or when all live rows of its field agree (a value that no
    other person's row disputes).
    """
    names = aliases.where(F.col("alias").isNotNull()).select(F.col("case_id").alias("__case"), F.col("alias").alias("__alias")).distinct()
    known = names.select(F.col("__case").alias("case_id"), F.lit(True).alias("__known")).distinct()
    agreed = ev.unanimous(evidence).select("case_id", "field_name", F.lit(True).alias("__agreed"))
    hint = F.col("applicant_hint").rlike(r"\S")
    marked = evidence.join(known, "case_id", "left").join(agreed, ["case_id", "field_name"], "left")
    own = (F.col("case_id") == F.col("__case")) & (F.col("applicant_hint") == F.col("__alias"))
    joined = marked.join(names.withColumn("__own", F.lit(True)), own, "left").drop("__case")
    stays = ~F.coalesce(hint, F.lit(False)) | F.col("__known").isNull() | F.col("__own").isNotNull() | (F.coalesce("__agreed", F.lit(False)) & F.col("legible") & ~F.coalesce("superseded", F.lit(False)))
    return joined.where(F.coalesce(stays, F.lit(False))).select(*evidence.columns)


def anchored(evidence: DataFrame, anchor: str = "applicant_name") -> DataFrame:
    """``evidence`` of live rows on whose page a live row of the same type names the anchor field: a semi join."""
    live = ev.eligible(evidence).withColumn("__kind", kind_of(F.col("evidence_type")))
    pages = live.where(F.col("field_name") == anchor).select("case_id", "page_index", "__kind").distinct()
    return live.join(pages, ["case_id", "page_index", "__kind"], "left_semi").drop("__kind")


def disputed(expected: DataFrame, evidence: DataFrame) -> DataFrame:
    """The rows of ``expected`` (case_id, field_name, value) that any live row of the case disagrees with."""
    live = ev.eligible(evidence).groupBy("case_id", "field_name").agg(F.min("value").alias("__low"), F.max("value").alias("__high"))
    return expected.join(live, ["case_id", "field_name"]).where((F.col("__low") != F.col("value")) | (F.col("__high") != F.col("value"))).drop("__low", "__high")


def forced_identity(identity: DataFrame, evidence: DataFrame) -> DataFrame:
    """case_id, field_name, value, winner: values set by the linkage, with the first row that has the value, or null.

    ``identity``: case_id, field_name, value.
    """
    first = evidence.groupBy("case_id", "field_name", "value").agg(F.min(F.struct("page_index", "seq", "cand_id")).alias("__first"))
    return identity.join(first, ["case_id", "field_name", "value"], "left").select("case_id", "field_name", "value", F.col("__first.cand_id").alias("winner"))


def _like(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with ``like``: the ratio of the keys of ``a`` and ``b``, worked out once a distinct pair."""
    keyed = pairs.withColumn("__a", ocr_key(F.col(a))).withColumn("__b", ocr_key(F.col(b)))
    scored = keyed.select("__a", "__b").distinct().withColumn("like", ratio("__a", "__b"))
    return keyed.join(scored, ["__a", "__b"]).drop("__a", "__b")


def sponsored_applicants(evidence: DataFrame) -> DataFrame:
    """case_id, applicant: the one name that sponsors are sure of, where a second source supports it and every conflicting intake is weak.

    At least one intake row must conflict; a case without one needs no rescue.
    """
    names = evidence.where((F.col("field_name") == "applicant_name") & F.col("value").rlike(r"\S"))
    names = names.select("case_id", "value", kind_of(F.col("evidence_type")).alias("kind"), ev.confidence_of(F.col("ocr_confidence")).alias("sure"))
    folded = names.groupBy("case_id", "value", "kind").agg(F.max("sure").alias("sure"))
    sponsor = folded.where((F.col("kind") == "sponsorattestation") & (F.col("sure") >= SPONSOR_SURE)).groupBy("case_id").agg(F.min("value").alias("applicant"), F.max("value").alias("high"))
    sponsor = sponsor.where(F.col("applicant") == F.col("high")).drop("high")
    others = folded.where(F.col("kind").isin("biometricslip", "registryextract", "intakeform")).join(sponsor, "case_id")
    scored = _like(others, "applicant", "value")
    supports = F.col("kind").isin("biometricslip", "registryextract") & (F.col("sure") >= SUPPORT_SURE) & (F.col("like") >= SUPPORT_LIKE)
    against = (F.col("kind") == "intakeform") & (F.col("like") < INTAKE_LIKE)
    judged = scored.groupBy("case_id", "applicant").agg(F.max(supports).alias("supported"), F.max(against).alias("against"), F.max(against & (F.col("sure") >= INTAKE_WEAK)).alias("firm"))
    return judged.where(F.col("supported") & F.col("against") & ~F.col("firm")).select("case_id", "applicant")


def sponsor_repairs(evidence: DataFrame, fields: tuple[str, ...] = REPAIRED) -> DataFrame:
    """case_id, field_name, value, winner: the sponsor's single value in place of a different single value of the intake form.

    Both sides' live rows must be of the case itself, name an applicant, and the
    names must be alike; a corrected intake is never overruled.
    """
    own = ev.eligible(evidence).where(F.col("field_name").isin(*fields) & (F.col("case_id_hint") == F.col("case_id")) & F.col("applicant_hint").rlike(r"\S") & ~ev.has_cue("sample_denial_watermark"))
    own = own.withColumn("kind", kind_of(F.col("evidence_type"))).withColumn("sure", ev.confidence_of(F.col("ocr_confidence"))).withColumn("corrected", ev.has_cue("correction"))
    keys = ["case_id", "field_name"]
    order = F.struct("sure", "page_index", F.col("box.top").alias("y"), (-F.col("seq")).alias("s"), (-F.col("cand_id")).alias("i"))
    intake = own.where("kind = 'intakeform'").groupBy(*keys).agg(F.min("value").alias("a"), F.max("value").alias("az"), F.max("corrected").alias("corrected"))
    sponsor = own.where((F.col("kind") == "sponsorattestation") & (F.col("sure") >= SPONSOR_SURE)).groupBy(*keys).agg(F.min("value").alias("b"), F.max("value").alias("bz"), F.max_by("cand_id", order).alias("winner"))
    both = intake.join(sponsor, keys).where((F.col("a") == F.col("az")) & (F.col("b") == F.col("bz")) & (F.col("a") != F.col("b")) & ~F.col("corrected"))
    hints = own.select(*keys, "kind", "applicant_hint", "sure").where((F.col("kind") == "intakeform") | (F.col("kind") == "sponsorattestation") & (F.col("sure") >= SPONSOR_SURE)).drop("sure").distinct()
    left = hints.where("kind = 'intakeform'").select(*keys, F.col("applicant_hint").alias("x"))
    right = hints.where("kind = 'sponsorattestation'").select(*keys, F.col("applicant_hint").alias("y"))
    # distinct names of one field of one case; the worst pair decides
    worst = _like(both.select(*keys).join(left, keys).join(right, keys), "x", "y").groupBy(*keys).agg(F.min("like").alias("like"))
    return both.join(worst.where(F.col("like") >= REPAIR_LIKE), keys).select(*keys, F.col("b").alias("value"), "winner")
