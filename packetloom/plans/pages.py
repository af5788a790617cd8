"""Queries over lines and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators import lines as op
from packetloom.session import table

#: The driver's pages hold no injected instructions, so the queries watch for phrases that occur there.
TRIGGERS = (r"(?i)\bwatermark\s+obscured\b", r"(?i)\bupside\s+down\b")
HEADINGS = (
    ("adjudicator_remarks", ("adjudicator remarks",)), ("sponsor_attestation", ("sponsor attestation",)), ("registry_narrative", ("registry narrative",)),
    ("inspection_report", ("inspection report",)), ("interview_summary", ("interview summary",)), ("statement", ("statement of the bearer",)),
)
LINE = ("line_id", "case_id", "page_index", "line_seq", "text")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ocr_lines").select(*LINE)


def token_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = op.lines_of(op.unique_tokens(table(spark, d, "ocr_tokens")))
    return lines.select(*op.LINE_KEY, "text", F.round(F.col("confidence") + 1e-9, 6).alias("confidence"), F.col("box.left").alias("left"), F.col("box.bottom").alias("bottom"), F.col("box.right").alias("right"), F.col("box.top").alias("top"), "n_words")


def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return op.visual_order(table(spark, d, "ocr_lines"))


def quarantine(spark: SparkSession, d: str) -> DataFrame:
    return op.quarantined(_lines(spark, d), TRIGGERS).where("quarantined").select("line_id", "case_id", "page_index")


def rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    return op.rejected(_lines(spark, d), TRIGGERS).where("rejected").select("line_id")


def page_types(spark: SparkSession, d: str) -> DataFrame:
    return op.page_types(_lines(spark, d), HEADINGS)


def last_headings(spark: SparkSession, d: str) -> DataFrame:
    return op.last_heading(_lines(spark, d), HEADINGS, "none")


def page_locks(spark: SparkSession, d: str) -> DataFrame:
    return op.page_locks(_lines(spark, d))


def paired_labels(spark: SparkSession, d: str) -> DataFrame:
    return op.paired_labels(op.rejected(_lines(spark, d), TRIGGERS), r":\s*$").select("label_id", "value_id", "value")


def running_scope(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate_evidence").select("cand_id", "case_id", "page_index", "seq", "field_name", "value", "legible")
    return op.running_scope(rows).select("cand_id", "running_case", "running_applicant")


def legible_reads(spark: SparkSession, d: str) -> DataFrame:
    return op.legibility(table(spark, d, "candidate_evidence")).groupBy("field_name").agg(F.count("read").alias("n_read"), F.count(F.lit(1)).alias("n_rows"))


def text_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans of the characters of all lines, each line taken as a page of unit boxes."""
    lines = table(spark, d, "ocr_lines").select("line_id", F.posexplode(F.split("text", "")).alias("pos", "ch"))
    box = F.struct(F.col("pos").cast("double").alias("left"), F.lit(0.0).alias("bottom"), (F.col("pos") + 1).cast("double").alias("right"), F.lit(1.0).alias("top"))
    chars = lines.where("ch <> ''").select(F.col("line_id").alias("page_id"), "pos", "ch", box.alias("box"), (F.col("pos") > 60).alias("off_crop"))
    return op.text_spans(chars).select("page_id", "start", "text", F.col("box.right").alias("right"), "off_crop", "truncated")


QUERIES = {
    "x1_token_lines": token_lines, "x2_reading_order": reading_order, "x3_quarantine": quarantine, "x4_rejected_lines": rejected_lines, "x11_page_types": page_types, "x9_last_headings": last_headings,
    "x13_page_locks": page_locks, "x14_paired_labels": paired_labels, "x15_running_scope": running_scope, "x17_legible_reads": legible_reads, "s7_text_spans": text_spans,
}

_HIT = "(" + " OR ".join(f"coalesce(regexp_matches(text, '{t}'), false)" for t in TRIGGERS) + ")"
_KIND = "CASE " + " ".join(f"WHEN contains({{}}, '{p}') THEN '{n}'" for n, ps in HEADINGS for p in ps) + " END"
_KEY = ", ".join(op.LINE_KEY)
_FIRST = "ORDER BY line_seq, line_id"
ORACLE = {
    "x1_token_lines": f"""WITH u AS (SELECT {_KEY}, word_num, text, max(confidence) AS c, min(box.left) AS l, min(box.bottom) AS b, max(box.right) AS r, max(box.top) AS t FROM ocr_tokens GROUP BY ALL)
        SELECT {_KEY}, string_agg(text, ' ' ORDER BY word_num, text) AS text, round(sum(CASE WHEN c IS NOT NULL THEN greatest(1, length(text)) * c END) / sum(CASE WHEN c IS NOT NULL THEN greatest(1, length(text)) END) + 1e-9, 6) AS confidence,
        min(l) AS "left", min(b) AS bottom, max(r) AS "right", max(t) AS top, count(*) AS n_words FROM u GROUP BY {_KEY}""",
    "x3_quarantine": f"SELECT line_id, case_id, page_index FROM (SELECT *, max({_HIT}::INT) OVER (PARTITION BY case_id, page_index {_FIRST} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS q FROM ocr_lines) WHERE q = 1",
    "x4_rejected_lines": f"SELECT line_id FROM ocr_lines WHERE {_HIT} AND NOT coalesce(regexp_matches(text, '(?i)^\\s*manual\\s+correction\\s*:'), false)",
    "x11_page_types": f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY case_id, page_index {_FIRST}) AS rn FROM ocr_lines),
        h AS (SELECT case_id, page_index, lower(string_agg(text, ' ' ORDER BY rn)) AS h FROM n WHERE rn <= 4 GROUP BY 1, 2) SELECT case_id, page_index, coalesce({_KIND.format(*['h'] * 6)}, 'other') AS page_type FROM h""",
    "x9_last_headings": f"""WITH k AS (SELECT case_id, page_index, line_seq, line_id, {_KIND.format(*['lower(text)'] * 6)} AS kind FROM ocr_lines)
        SELECT case_id, page_index, coalesce(arg_max(kind, line_seq::BIGINT * 1000000000 + line_id) FILTER (WHERE kind IS NOT NULL), 'none') AS evidence_type FROM k GROUP BY 1, 2""",
    "x13_page_locks": """WITH s AS (SELECT case_id, page_index, unnest(regexp_extract_all(text, 'MIB-[0-9]{6}')) AS seen FROM ocr_lines),
        i AS (SELECT case_id, page_index, count(DISTINCT seen) AS n, min(seen) AS only_one, max((seen = case_id)::INT) AS own FROM s GROUP BY 1, 2)
        SELECT case_id, page_index, coalesce(n, 0) AS n_ids, CASE WHEN own = 1 THEN case_id WHEN n = 1 THEN only_one END AS locked_to FROM (SELECT DISTINCT case_id, page_index FROM ocr_lines) LEFT JOIN i USING (case_id, page_index)""",
    "x14_paired_labels": f"""WITH m AS (SELECT *, coalesce(regexp_matches(text, ':\\s*$'), false) AS lab, {_HIT} AND NOT coalesce(regexp_matches(text, '(?i)^\\s*manual\\s+correction\\s*:'), false) AS rej FROM ocr_lines),
        n AS (SELECT *, lead(line_id) OVER w AS nid, lead(text) OVER w AS ntext, lead(lab) OVER w AS nlab, lead(rej) OVER w AS nrej FROM m WINDOW w AS (PARTITION BY case_id, page_index {_FIRST}))
        SELECT line_id AS label_id, nid AS value_id, ntext AS value FROM n WHERE lab AND NOT rej AND nid IS NOT NULL AND NOT nlab AND NOT nrej""",
    "x15_running_scope": """WITH s AS (SELECT *, CASE WHEN field_name = 'case_id' AND legible AND regexp_full_match(value, 'MIB-[0-9]{6}') THEN value END AS seen FROM candidate_evidence),
        r AS (SELECT *, coalesce(last_value(seen IGNORE NULLS) OVER (PARTITION BY case_id ORDER BY page_index, seq, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), case_id) AS running_case FROM s),
        c AS (SELECT *, coalesce(running_case <> lag(running_case) OVER (PARTITION BY case_id ORDER BY page_index, seq, cand_id), false)::INT AS ch FROM r),
        g AS (SELECT *, sum(ch) OVER (PARTITION BY case_id ORDER BY page_index, seq, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM c)
        SELECT cand_id, running_case, last_value(CASE WHEN field_name = 'applicant_name' AND legible THEN value END IGNORE NULLS) OVER (PARTITION BY case_id, seg ORDER BY page_index, seq, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS running_applicant FROM g""",
    "x17_legible_reads": """WITH r AS (SELECT field_name, value, legible, CASE WHEN ocr_confidence > 1 THEN ocr_confidence / 100 ELSE ocr_confidence END AS c,
        field_name = 'adjudication' AND regexp_replace(lower(evidence_type), '[^a-z]', '', 'g') IN ('adjudicatorstamp', 'signedmanualnote') AS low FROM candidate_evidence)
        SELECT field_name, count(CASE WHEN legible AND coalesce(c >= CASE WHEN low THEN 0.28 ELSE 0.45 END, false) THEN value END) AS n_read, count(*) AS n_rows FROM r GROUP BY 1""",
    "s7_text_spans": """WITH c AS (SELECT line_id AS page_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) - 1 AS pos FROM ocr_lines),
        i AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, sum(regexp_full_match(ch, '\\s')::INT) OVER (PARTITION BY page_id ORDER BY pos) AS island FROM c)
        SELECT page_id, min(pos) AS start, string_agg(ch, '' ORDER BY pos) AS text, (max(pos) + 1)::DOUBLE AS "right", bool_or(pos > 60) AS off_crop, bool_or(n > 20000) AS truncated FROM i WHERE NOT regexp_full_match(ch, '\\s') GROUP BY page_id, island""",
}
