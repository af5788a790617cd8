"""Queries of scoping, anchors, vetoes, repairs, close terms and page routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import fuzzy
from packetloom.operators import lines as op
from packetloom.operators import linking
from packetloom.plans.evidence import _ELIGIBLE, _KIND
from packetloom.plans.pages import HEADINGS
from packetloom.plans.pages import text_spans as spans_of_lines
from packetloom.session import table

MARKED = ("interview_summary", "sponsor_attestation", "other")
#: The driver's flags, and wordings that name one of them in other words.
FLAGS = ("memory_gap", "name_clash", "sealed_warrant", "smeared_biometrics", "sponsor_gap", "spore_alert")
DERIVED = {"smeared_biometrics": r"(?i)biometric.*(?:illegible|unreadable|failed)", "name_clash": r"(?i)identity.*(?:mismatch|conflict|failed)"}


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidate_evidence")


def _latest(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "resolved_fields").groupBy("case_id", "field_name").agg(F.max_by(F.struct("state", "value"), F.struct("pass_no", "resolved_at", "resolved_id")).alias("r"))
    return last.where("r.state = 'resolved' AND r.value IS NOT NULL").select("case_id", "field_name", F.col("r.value").alias("value"))


def applicant_scope(spark: SparkSession, d: str) -> DataFrame:
    """Rows that stay when the packet belongs to the applicants that the predictions name, per case."""
    aliases = table(spark, d, "predictions").select("case_id", F.col("applicant_name").alias("alias"))
    return linking.applicant_scoped(_evidence(spark, d), aliases).groupBy("case_id").agg(F.count(F.lit(1)).alias("n_rows"))


def anchored_facts(spark: SparkSession, d: str) -> DataFrame:
    return linking.anchored(_evidence(spark, d)).select("cand_id")


def disputed_values(spark: SparkSession, d: str) -> DataFrame:
    """Resolved values of the latest pass that a live row disagrees with."""
    return linking.disputed(_latest(spark, d), _evidence(spark, d))


def forced_identities(spark: SparkSession, d: str) -> DataFrame:
    return linking.forced_identity(_latest(spark, d).where(F.col("field_name").isin("case_id", "applicant_name")), _evidence(spark, d))


def sponsored_applicants(spark: SparkSession, d: str) -> DataFrame:
    return linking.sponsored_applicants(_evidence(spark, d))


def sponsor_repairs(spark: SparkSession, d: str) -> DataFrame:
    return linking.sponsor_repairs(_evidence(spark, d))


def close_species(spark: SparkSession, d: str) -> DataFrame:
    """The closest species for each distinct species value as written."""
    terms = table(spark, d, "reference_terms").where("field_name = 'species_code'").select(F.col("canonical").alias("term"))
    return fuzzy.close_terms(_evidence(spark, d).where("field_name = 'species_code'").select("value"), terms)


def flag_phrases(spark: SparkSession, d: str) -> DataFrame:
    """The flags that a span of each risk value is like."""
    terms = spark.createDataFrame([(f,) for f in FLAGS], "term string")
    return fuzzy.phrase_terms(_evidence(spark, d).where("field_name = 'risk_flags'").select("cand_id", "value"), "cand_id", "value", terms)


def risk_wordings(spark: SparkSession, d: str) -> DataFrame:
    """The flags that each risk value names in its own words or by a pattern."""
    rows = _evidence(spark, d).where("field_name = 'risk_flags'")
    return rows.select("cand_id", F.array_join(fuzzy.named_flags(F.col("value"), FLAGS, DERIVED), "|").alias("flags")).where("flags <> ''")


def first_headings(spark: SparkSession, d: str) -> DataFrame:
    return op.first_heading(table(spark, d, "ocr_lines"), HEADINGS, default="statement")


def page_markers(spark: SparkSession, d: str) -> DataFrame:
    marked = op.page_markers(table(spark, d, "ocr_lines"), HEADINGS, MARKED)
    return marked.select("case_id", "page_index", "page_type", "confidence", F.col("box.left").alias("left"), F.col("box.top").alias("y_end"))


def page_medians(spark: SparkSession, d: str) -> DataFrame:
    return op.page_medians(table(spark, d, "ocr_lines")).withColumn("median", F.round("median", 6))


def retry_pages(spark: SparkSession, d: str) -> DataFrame:
    return op.retry_pages(table(spark, d, "ocr_lines"), _evidence(spark, d))


def trusted_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans of each line that lie on the visible part, every second line's layer being authoritative."""
    spans = spans_of_lines(spark, d).withColumn("authoritative", F.col("page_id") % 2 == 0)
    return op.trusted_spans(spans).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_spans"))


QUERIES = {
    "l6_sponsored_applicants": sponsored_applicants, "l8_applicant_scope": applicant_scope, "j7_anchored_facts": anchored_facts, "j8_disputed_values": disputed_values, "r6_forced_identities": forced_identities, "r5_sponsor_repairs": sponsor_repairs,
    "f4_close_species": close_species, "f5_flag_phrases": flag_phrases, "f6_risk_wordings": risk_wordings, "x10_first_headings": first_headings, "x12_page_markers": page_markers, "f26_page_medians": page_medians, "o3_retry_pages": retry_pages,
    "x26_trusted_spans": trusted_spans,
}

_LATEST = """latest AS (SELECT case_id, field_name, value FROM (SELECT *, row_number() OVER (PARTITION BY case_id, field_name ORDER BY pass_no DESC, resolved_at DESC, resolved_id DESC) AS rn FROM resolved_fields) WHERE rn = 1 AND state = 'resolved' AND value IS NOT NULL)"""
_LIVE = f"live AS (SELECT *, {_KIND} AS kind FROM candidate_evidence WHERE {_ELIGIBLE})"
_TOP = "n AS (SELECT *, row_number() OVER (PARTITION BY case_id, page_index ORDER BY line_seq, line_id) AS rn FROM ocr_lines)"
_TYPE = lambda text, names: "CASE " + " ".join(f"WHEN contains(lower({text}), '{p}') THEN '{n}'" for n, ps in HEADINGS for p in ps if n in names) + " END"
_ALL = {n for n, _ in HEADINGS}
_MEDIANS = """m AS (SELECT case_id, page_index, count(*) AS n_lines, round(quantile_cont(confidence, 0.5), 6) AS median, list_sort(list(confidence))[(count(*) // 2 + 1)::BIGINT] AS upper_median
  FROM ocr_lines WHERE confidence IS NOT NULL AND regexp_matches(text, '[A-Za-z0-9]') GROUP BY 1, 2)"""
ORACLE = {
    "l8_applicant_scope": f"""WITH a AS (SELECT DISTINCT case_id, applicant_name AS alias FROM predictions WHERE applicant_name IS NOT NULL), u AS (SELECT case_id, field_name FROM candidate_evidence WHERE {_ELIGIBLE} GROUP BY 1, 2 HAVING min(value) = max(value))
        SELECT case_id, count(*) AS n_rows FROM candidate_evidence e WHERE NOT coalesce(regexp_matches(applicant_hint, '\\S'), false) OR case_id NOT IN (SELECT case_id FROM a) OR EXISTS (SELECT 1 FROM a WHERE a.case_id = e.case_id AND a.alias = e.applicant_hint)
        OR (EXISTS (SELECT 1 FROM u WHERE u.case_id = e.case_id AND u.field_name = e.field_name) AND legible AND NOT coalesce(superseded, false)) GROUP BY 1""",
    "j7_anchored_facts": f"WITH {_LIVE} SELECT cand_id FROM live l WHERE EXISTS (SELECT 1 FROM live a WHERE a.field_name = 'applicant_name' AND a.case_id = l.case_id AND a.page_index = l.page_index AND a.kind = l.kind)",
    "j8_disputed_values": f"WITH {_LATEST}, {_LIVE} SELECT case_id, field_name, value FROM latest r WHERE EXISTS (SELECT 1 FROM live l WHERE l.case_id = r.case_id AND l.field_name = r.field_name AND l.value <> r.value)",
    "r6_forced_identities": f"""WITH {_LATEST}, f AS (SELECT case_id, field_name, value, cand_id, row_number() OVER (PARTITION BY case_id, field_name, value ORDER BY page_index, seq, cand_id) AS rn FROM candidate_evidence)
        SELECT l.case_id, l.field_name, l.value, f.cand_id AS winner FROM latest l LEFT JOIN f ON f.rn = 1 AND f.case_id = l.case_id AND f.field_name = l.field_name AND f.value = l.value WHERE l.field_name IN ('case_id', 'applicant_name')""",
    "f6_risk_wordings": "WITH t AS (SELECT cand_id, '_' || regexp_replace(lower(value), '[^a-z0-9]+', '_', 'g') || '_' AS k, value FROM candidate_evidence WHERE field_name = 'risk_flags'), h AS ("
    + " UNION ".join([*(f"SELECT cand_id, '{f}' AS flag FROM t WHERE contains(k, '_{f}_')" for f in FLAGS), *(f"SELECT cand_id, '{f}' FROM t WHERE regexp_matches(value, '{p}')" for f, p in DERIVED.items())])
    + ") SELECT cand_id, string_agg(flag, '|' ORDER BY flag) AS flags FROM h GROUP BY 1",
    "x10_first_headings": f"WITH {_TOP}, k AS (SELECT *, {_TYPE('text', _ALL - {'statement'})} AS kind FROM n WHERE rn <= 4) SELECT case_id, page_index, coalesce(arg_min(kind, rn) FILTER (WHERE kind IS NOT NULL), 'statement') AS evidence_type FROM k GROUP BY 1, 2",
    "x12_page_markers": f"""WITH {_TOP}, h AS (SELECT case_id, page_index, string_agg(text, ' ' ORDER BY rn) AS h, coalesce(min(confidence), 1.0) AS confidence, min(box."left") AS "left", max(box.top) AS y_end FROM n WHERE rn <= 4 GROUP BY 1, 2),
        t AS (SELECT *, coalesce({_TYPE('h', _ALL)}, 'other') AS page_type FROM h) SELECT case_id, page_index, page_type, confidence, "left", y_end FROM t WHERE page_type IN {MARKED}""",
    "f26_page_medians": f"WITH {_MEDIANS} SELECT * FROM m",
    "o3_retry_pages": f"""WITH {_MEDIANS}, h AS (SELECT case_id, page_index, count(*) AS n_rows FROM candidate_evidence WHERE regexp_matches(value, '\\S') GROUP BY 1, 2),
        r AS (SELECT case_id, page_index, row_number() OVER (PARTITION BY case_id ORDER BY coalesce(n_rows, 0), n_lines, upper_median, page_index) AS place FROM m LEFT JOIN h USING (case_id, page_index)) SELECT * FROM r WHERE place <= 2""",
    "x26_trusted_spans": """WITH c AS (SELECT line_id AS page_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) - 1 AS pos FROM ocr_lines),
        i AS (SELECT *, sum(regexp_full_match(ch, '\\s')::INT) OVER (PARTITION BY page_id ORDER BY pos) AS island FROM c),
        s AS (SELECT page_id, island, bool_or(pos > 60) AS off_crop FROM i WHERE NOT regexp_full_match(ch, '\\s') GROUP BY 1, 2) SELECT page_id, count(*) AS n_spans FROM s WHERE page_id % 2 = 0 AND NOT off_crop GROUP BY 1""",
}
