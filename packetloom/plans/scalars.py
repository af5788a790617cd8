"""Queries of the scalar functions: strings, dates, flags, keys and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import fuzzy, geometry
from packetloom.functions import text as tx
from packetloom.session import table

SNAPSHOT = "2026-07-07"
SEED = "packet-split"
PATTERNS = {"case_id": r"\bMIB-[0-9]{6}\b", "sponsor_id": r"\bSPN-[0-9]{4}\b", "iso_day": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"}


def ocr_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate_evidence").where(F.col("value").isNotNull())
    return rows.groupBy("field_name", tx.ocr_key(F.col("value")).alias("ocr_key")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("value").alias("n_spellings"))


def collapsed_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "predictions").groupBy(tx.collapse(F.col("applicant_name")).alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))


def repaired_sponsors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate_evidence").where("field_name = 'sponsor_id'")
    return rows.select("cand_id", tx.repaired_digits(F.col("value"), "SPN", 4).alias("sponsor_id"))


def safe_predictions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "predictions").where(F.col("case_id").rlike(r"\S"))
    fee = tx.strip(F.col("fee_status"))
    return p.select(
        "pred_id", tx.strip(F.col("case_id")).alias("case_id"), tx.safe_text(F.col("applicant_name"), "unknown").alias("applicant_name"), tx.safe_text(F.col("declared_purpose"), "unknown").alias("declared_purpose"),
        tx.safe_day(F.col("arrival_date")).alias("arrival_date"), F.when(fee.isin("paid", "waived", "unpaid", "unknown"), fee).otherwise("unknown").alias("fee_status"), tx.safe_share(F.col("confidence")).alias("confidence"),
    )


def flag_sets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "predictions").groupBy(tx.flag_text(F.col("risk_flags")).alias("flags")).agg(F.count(F.lit(1)).alias("n_rows"))


def written_days(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate_evidence").where("field_name = 'arrival_date'")
    day = tx.written_day(F.col("value"))
    return rows.select("cand_id", F.date_format(day, "yyyy-MM-dd").alias("day"), tx.age_days(day, SNAPSHOT).alias("age_days"))


def unknown_fields(spark: SparkSession, d: str) -> DataFrame:
    fields = ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "fee_status")
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), tx.is_unknown(F.col(f)).cast("int").alias("unknown")) for f in fields))
    return table(spark, d, "predictions").select("run_id", F.inline(pairs)).groupBy("run_id", "field_name").agg(F.sum("unknown").alias("n_unknown"), F.count(F.lit(1)).alias("n_rows"))


def hash_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_labels").where("case_id IS NOT NULL").select("case_id", tx.hash_key(F.col("case_id"), SEED).alias("key")).distinct()


def redacted_cues(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "candidate_evidence").select(F.explode("visual_cues").alias("cue"))
    return cues.groupBy(tx.redacted(F.col("cue"), ("correction", "strikethrough"), ("packet_page_type",)).alias("token")).agg(F.count(F.lit(1)).alias("n_rows"))


def sensitive_documents(spark: SparkSession, d: str) -> DataFrame:
    hits = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(n)) for n, p in PATTERNS.items())))
    rows = table(spark, d, "documents").select("source", F.explode(hits).alias("pattern"))
    return rows.groupBy("source", "pattern").agg(F.count(F.lit(1)).alias("n_documents"))


def sponsor_digit_slips(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose sponsor differs from the case's prevailing one in exactly one digit."""
    p = table(spark, d, "predictions").where(F.col("sponsor_id").rlike(tx.SPONSOR_ID)).select("pred_id", "case_id", "sponsor_id")
    votes = p.groupBy("case_id", "sponsor_id").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("case_id").agg(F.max_by("sponsor_id", F.struct("n", "sponsor_id")).alias("usual"))
    return p.join(best, "case_id").where(tx.digits_apart(F.col("sponsor_id"), F.col("usual")) == 1).select("pred_id", "sponsor_id", "usual")


def line_boxes(spark: SparkSession, d: str) -> DataFrame:
    box = F.col("box")
    lines = table(spark, d, "ocr_lines").groupBy("case_id", "page_index").agg(
        geometry.union_of("box").alias("u"), F.sum(geometry.area(box)).alias("ink"), F.count(F.lit(1)).alias("n_lines")
    )
    return lines.select("case_id", "page_index", geometry.width(F.col("u")).alias("page_width"), geometry.height(F.col("u")).alias("page_height"), F.round(F.col("ink") / geometry.area(F.col("u")), 6).alias("cover"), "n_lines")


def stray_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Words whose box leaves their line's box by more than the tolerance, per packet."""
    key = ["case_id", "page_index", "block_num", "paragraph_num", "line_num"]
    lines = table(spark, d, "ocr_lines").select(*key, F.col("box").alias("line_box"))
    tokens = table(spark, d, "ocr_tokens").select(*key, "box")
    return tokens.join(lines, key).where(~geometry.contains(F.col("line_box"), F.col("box"), 0.5)).groupBy("case_id").agg(F.count(F.lit(1)).alias("n_tokens"))


def render_scales(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "ocr_lines").groupBy("case_id", "page_index").agg(F.max("box.right").alias("w"), F.max("box.top").alias("h"))
    return pages.select("case_id", "page_index", F.round(geometry.render_scale(F.col("w"), F.col("h"), 200, 2_000_000), 9).alias("scale"))


def ratio_species(spark: SparkSession, d: str) -> DataFrame:
    """Species by the sequence ratio, as the reference's vocabulary matcher accepts them."""
    values = table(spark, d, "candidate_evidence").where("field_name = 'species_code' AND value IS NOT NULL").select("value").distinct()
    terms = table(spark, d, "reference_terms").where("field_name = 'species_code'").select(F.col("canonical").alias("term"))
    return fuzzy.canonical_by_ratio(values, terms, 0.66)


QUERIES = {
    "f1_ocr_keys": ocr_keys, "f13_collapsed_names": collapsed_names, "f8_repaired_sponsors": repaired_sponsors, "f10_safe_predictions": safe_predictions, "f11_flag_sets": flag_sets,
    "f9_written_days": written_days, "f25_unknown_fields": unknown_fields, "f22_hash_keys": hash_keys, "f18_redacted_cues": redacted_cues, "f24_sensitive_documents": sensitive_documents,
    "f14_sponsor_digit_slips": sponsor_digit_slips, "f15_line_boxes": line_boxes, "f15_stray_tokens": stray_tokens, "s3_render_scales": render_scales, "f3_ratio_species": ratio_species,
}

_S = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_COLLAPSE = lambda c: _S(f"regexp_replace(lower(coalesce({c}, '')), '\\s+', ' ', 'g')")
_UNKNOWN = ", ".join(f"sum(CASE WHEN {_COLLAPSE(f)} IN ('', 'unknown', 'null', 'spn-0000', '1900-01-01') THEN 1 ELSE 0 END) AS {f}" for f in ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "fee_status"))
_ISO = lambda c: f"(regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND strftime(try_strptime({c}, '%Y-%m-%d'), '%Y-%m-%d') = {c})"
_FLAGS = "list_sort(list_distinct(list_filter(list_transform(string_split(lower(coalesce(risk_flags, '')), '|'), lambda p: regexp_replace(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g')), lambda p: p NOT IN ('', 'none', 'null', 'unknown'))))"
_DAY = "CASE WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN try_strptime(v, '%Y-%m-%d') WHEN regexp_full_match(v, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') THEN coalesce(try_strptime(v, '%m/%d/%Y'), try_strptime(v, '%d/%m/%Y')) END"
_AREA = "greatest(0, box.right - box.left) * greatest(0, box.top - box.bottom)"

ORACLE = {
    "f1_ocr_keys": "SELECT field_name, regexp_replace(lower(value), '[^a-z0-9]+', '', 'g') AS ocr_key, count(*) AS n_rows, count(DISTINCT value) AS n_spellings FROM candidate_evidence WHERE value IS NOT NULL GROUP BY 1, 2",
    "f13_collapsed_names": f"SELECT {_COLLAPSE('applicant_name')} AS name, count(*) AS n_rows FROM predictions GROUP BY 1",
    "f8_repaired_sponsors": f"""WITH r AS (SELECT cand_id, regexp_extract({_S('value')}, '(?i)^SPN[\\s._-]*([0-9OQCDILSB]{{4}})$', 1) AS m FROM candidate_evidence WHERE field_name = 'sponsor_id'),
        t AS (SELECT cand_id, translate(m, 'OQCDILSB', '00001158') AS m FROM r)
        SELECT cand_id, CASE WHEN regexp_full_match(m, '[0-9]{{4}}') THEN 'SPN-' || m END AS sponsor_id FROM t""",
    "f10_safe_predictions": f"""SELECT pred_id, {_S('case_id')} AS case_id, coalesce(nullif({_S('applicant_name')}, ''), 'unknown') AS applicant_name, coalesce(nullif({_S('declared_purpose')}, ''), 'unknown') AS declared_purpose,
        CASE WHEN {_ISO(_S('arrival_date'))} THEN {_S('arrival_date')} ELSE '1900-01-01' END AS arrival_date,
        CASE WHEN {_S('fee_status')} IN ('paid', 'waived', 'unpaid', 'unknown') THEN {_S('fee_status')} ELSE 'unknown' END AS fee_status,
        CASE WHEN NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 THEN confidence ELSE 0.0::DOUBLE END AS confidence
        FROM predictions WHERE regexp_matches(case_id, '\\S')""",
    "f11_flag_sets": f"SELECT CASE WHEN len(f) = 0 THEN 'none' ELSE array_to_string(f, '|') END AS flags, count(*) AS n_rows FROM (SELECT {_FLAGS} AS f FROM predictions) GROUP BY 1",
    "f9_written_days": f"WITH r AS (SELECT cand_id, {_S('value')} AS v FROM candidate_evidence WHERE field_name = 'arrival_date'), d AS (SELECT cand_id, {_DAY} AS d FROM r) SELECT cand_id, strftime(d, '%Y-%m-%d') AS day, date_diff('day', d::DATE, DATE '{SNAPSHOT}') AS age_days FROM d",
    "f25_unknown_fields": f"WITH w AS (SELECT run_id, count(*) AS n_rows, {_UNKNOWN} FROM predictions GROUP BY run_id) UNPIVOT w ON applicant_name, species_code, home_world, visa_class, sponsor_id, arrival_date, declared_purpose, fee_status INTO NAME field_name VALUE n_unknown",
    "f22_hash_keys": f"SELECT DISTINCT case_id, sha256('{SEED}' || chr(0) || case_id) AS key FROM train_labels WHERE case_id IS NOT NULL",
    "f18_redacted_cues": """WITH c AS (SELECT unnest(visual_cues) AS cue FROM candidate_evidence)
        SELECT CASE WHEN contains(cue, ':') THEN CASE WHEN split_part(cue, ':', 1) <> 'packet_page_type' THEN 'other' WHEN regexp_full_match(regexp_replace(cue, '^[^:]*:', ''), '[a-z_]{1,40}') THEN cue ELSE split_part(cue, ':', 1) || ':*' END
        WHEN cue IN ('correction', 'strikethrough') THEN cue ELSE 'other' END AS token, count(*) AS n_rows FROM c GROUP BY 1""",
    "f24_sensitive_documents": " UNION ALL ".join(f"SELECT source, '{n}' AS pattern, count(*) AS n_documents FROM documents WHERE regexp_matches(text, '{p}') GROUP BY 1" for n, p in PATTERNS.items()),
    "f14_sponsor_digit_slips": """WITH p AS (SELECT pred_id, case_id, sponsor_id FROM predictions WHERE regexp_full_match(sponsor_id, 'SPN-[0-9]{4}')),
        v AS (SELECT case_id, sponsor_id, count(*) AS n FROM p GROUP BY 1, 2),
        b AS (SELECT case_id, sponsor_id AS usual FROM v QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY n DESC, sponsor_id DESC) = 1)
        SELECT pred_id, sponsor_id, usual FROM p JOIN b USING (case_id) WHERE hamming(sponsor_id, usual) = 1""",
    "f15_line_boxes": f"""WITH u AS (SELECT case_id, page_index, max(box.right) - min(box.left) AS w, max(box.top) - min(box.bottom) AS h, sum({_AREA}) AS ink, count(*) AS n_lines FROM ocr_lines GROUP BY 1, 2)
        SELECT case_id, page_index, w AS page_width, h AS page_height, round(ink / (w * h), 6) AS cover, n_lines FROM u""",
    "f15_stray_tokens": """SELECT t.case_id, count(*) AS n_tokens FROM ocr_tokens t JOIN ocr_lines l USING (case_id, page_index, block_num, paragraph_num, line_num)
        WHERE NOT (t.box.left >= l.box.left - 0.5 AND t.box.bottom >= l.box.bottom - 0.5 AND t.box.right <= l.box.right + 0.5 AND t.box.top <= l.box.top + 0.5) GROUP BY 1""",
    "s3_render_scales": """WITH p AS (SELECT case_id, page_index, max(box.right) AS w, max(box.top) AS h FROM ocr_lines GROUP BY 1, 2)
        SELECT case_id, page_index, round(CASE WHEN w * h * (200.0::DOUBLE / 72) * (200.0::DOUBLE / 72) <= 2000000 THEN 200.0::DOUBLE / 72 ELSE sqrt(2000000 / (w * h)) END, 9) AS scale FROM p""",
}
