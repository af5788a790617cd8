"""Queries of extraction, gates and rule support."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators import extract, gates, scoring
from packetloom.plans.evaluation import scored_sql
from packetloom.session import table

LABELS = {"applicant_name": "Applicant Name", "sponsor_id": "SPONSOR ID", "arrival_date": "Date of arrival", "fee_status": "Fee", "adjudication": "Final  status", "visa_class": "Visa class"}


def labelled_fields(spark: SparkSession, d: str) -> DataFrame:
    """Label rows printed as form lines and read back through labels and notations."""
    cells = F.array(*(F.struct(F.lit(i).alias("k"), F.concat(F.lit(label + ": "), F.coalesce(F.col(f), F.lit(""))).alias("text")) for i, (f, label) in enumerate(LABELS.items())))
    lines = table(spark, d, "train_labels").select("record_id", F.inline(cells)).select((F.col("record_id") * 10 + F.col("k")).alias("line_id"), "text")
    found = extract.labelled_fields(lines)
    return found.select("line_id", "field_name", extract.normalised_value(F.col("field_name"), F.col("value")).alias("value"))


def narrative_facts(spark: SparkSession, d: str) -> DataFrame:
    return extract.narrative_facts(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


def line_cues(spark: SparkSession, d: str) -> DataFrame:
    cued = table(spark, d, "ocr_lines").select(F.explode(extract.text_cues(F.col("text"), extract.CUES)).alias("cue"))
    return cued.groupBy("cue").agg(F.count(F.lit(1)).alias("n_lines"))


def class_cells(spark: SparkSession, d: str) -> DataFrame:
    """The code printed to the right of the word "class" on the same row, in all packets."""
    words = table(spark, d, "ocr_tokens").groupBy("case_id", "page_index", "block_num", "paragraph_num", "line_num", "word_num", "text").agg(F.min("box").alias("box"))
    words = words.withColumn("cell_id", F.concat_ws("/", "case_id", "page_index", "block_num", "paragraph_num", "line_num", "word_num"))
    pairs = extract.same_row_pairs(words.where("text = 'class'"), words.where(F.col("text").rlike(r"^[A-Z]+-[0-9][.,]?$")))
    return pairs.select("label_id", "case_id", "page_index", "value_id", "value")


def _cases(spark: SparkSession, d: str, run: str) -> DataFrame:
    truth = scoring.last_truth(table(spark, d, "train_labels"))
    return scoring.scored(truth, scoring.first_predictions(table(spark, d, "predictions").where(F.col("run_id") == run)))


def release_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.release_gate(_cases(spark, d, "run_002"), _cases(spark, d, "run_001"))


def column_leaks(spark: SparkSession, d: str) -> DataFrame:
    return gates.column_leaks(table(spark, d, "raw_predictions"), ["file_name", "raw_line"]).unionByName(gates.column_leaks(table(spark, d, "candidate_evidence"), ["value", "case_id_hint", "source"]))


def rule_support(spark: SparkSession, d: str) -> DataFrame:
    """Three rules of two conditions over resolved facts, matched by relational division."""
    rules = spark.createDataFrame([("r1", "fee_status", "paid"), ("r1", "visa_class", "KX-1"), ("r2", "fee_status", "unpaid"), ("r2", "visa_class", "KX-2"), ("r3", "fee_status", "waived"), ("r3", "risk_flags", "none")], "rule_id string, key string, value string")
    facts = table(spark, d, "resolved_fields").where("state = 'resolved'").select("case_id", F.col("field_name").alias("key"), "value")
    return gates.rule_support(rules, facts)


QUERIES = {"x7_labelled_fields": labelled_fields, "x23_narrative_facts": narrative_facts, "x5_line_cues": line_cues, "j5_class_cells": class_cells, "e9_release_gate": release_gate, "ps5_column_leaks": column_leaks, "r13_rule_support": rule_support}

_S = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_T = lambda c: f"nullif(regexp_replace({_S(c)}, '\\s+', ' ', 'g'), '')"
_DAY = f"strftime(CASE WHEN regexp_full_match({_S('arrival_date')}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN try_strptime({_S('arrival_date')}, '%Y-%m-%d') WHEN regexp_full_match({_S('arrival_date')}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN coalesce(try_strptime({_S('arrival_date')}, '%m/%d/%Y'), try_strptime({_S('arrival_date')}, '%d/%m/%Y')) END, '%Y-%m-%d')"
_SPN = f"(SELECT CASE WHEN regexp_full_match(m, '[0-9]{{4}}') THEN 'SPN-' || m END FROM (SELECT translate(regexp_extract({_S('sponsor_id')}, '(?i)^SPN[\\s._-]*([0-9OQCDILSB]{{4}})$', 1), 'OQCDILSB', '00001158') AS m))"
_LEAK = lambda t, c: " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{n}' AS finding, count(*) AS n_rows FROM {t} WHERE regexp_matches({_S(c)}, '{p.replace('.*', '[^\\n]*')}') HAVING count(*) > 0" for n, p in gates.IDENTITY_VALUES.items())
_RULES = "rules(rule_id, key, value) AS (VALUES ('r1', 'fee_status', 'paid'), ('r1', 'visa_class', 'KX-1'), ('r2', 'fee_status', 'unpaid'), ('r2', 'visa_class', 'KX-2'), ('r3', 'fee_status', 'waived'), ('r3', 'risk_flags', 'none'))"

ORACLE = {
    "x7_labelled_fields": f"""SELECT record_id * 10 + 0 AS line_id, 'applicant_name' AS field_name, {_T('applicant_name')} AS value FROM train_labels
        UNION ALL SELECT record_id * 10 + 1, 'sponsor_id', {_SPN} FROM train_labels UNION ALL SELECT record_id * 10 + 2, 'arrival_date', {_DAY} FROM train_labels
        UNION ALL SELECT record_id * 10 + 3, 'fee_status', fee_status FROM train_labels UNION ALL SELECT record_id * 10 + 4, 'adjudication', adjudication FROM train_labels UNION ALL SELECT record_id * 10 + 5, 'visa_class', {_T('visa_class')} FROM train_labels""",
    "x23_narrative_facts": " UNION ALL ".join(f"SELECT doc_id, '{n}' AS fact, regexp_extract(text, '{p}', {g}) AS value FROM documents WHERE regexp_extract(text, '{p}', {g}) <> ''" for n, (p, g) in extract.FACTS.items()),
    "x5_line_cues": " UNION ALL ".join(f"SELECT '{n}' AS cue, count(*) AS n_lines FROM ocr_lines WHERE regexp_matches(text, '{p}') HAVING count(*) > 0" for n, p in extract.CUES.items()),
    "j5_class_cells": """WITH w AS (SELECT case_id, page_index, concat_ws('/', case_id, page_index, block_num, paragraph_num, line_num, word_num) AS cell_id, text, min(box) AS box FROM ocr_tokens GROUP BY case_id, page_index, block_num, paragraph_num, line_num, word_num, text),
        p AS (SELECT l.cell_id AS label_id, l.case_id, l.page_index, v.cell_id AS value_id, v.text AS value, row_number() OVER (PARTITION BY l.cell_id ORDER BY v.box."left", v.cell_id) AS rn FROM w l JOIN w v USING (case_id, page_index)
          WHERE l.text = 'class' AND regexp_full_match(v.text, '[A-Z]+-[0-9][.,]?') AND least(l.box.top - l.box.bottom, v.box.top - v.box.bottom) > 0 AND least(l.box.top, v.box.top) - greatest(l.box.bottom, v.box.bottom) >= 0.5 * least(greatest(0, l.box.top - l.box.bottom), greatest(0, v.box.top - v.box.bottom)) AND v.box."left" >= l.box."right" - 8)
        SELECT label_id, case_id, page_index, value_id, value FROM p WHERE rn = 1""",
    "e9_release_gate": f"""WITH {scored_sql("a", "run_001", "b", "run_002")}, s AS (SELECT count(CASE WHEN a.case_id IS NULL OR b.case_id IS NULL THEN 1 END) AS unc,
          count(CASE WHEN b.outcome = 'catastrophic_false_approval' THEN 1 END) - count(CASE WHEN a.outcome = 'catastrophic_false_approval' THEN 1 END) AS fa, count(CASE WHEN b.outcome = 'missing_case' THEN 1 END) - count(CASE WHEN a.outcome = 'missing_case' THEN 1 END) AS mi,
          count(CASE WHEN b.outcome = 'invalid_or_blank' THEN 1 END) - count(CASE WHEN a.outcome = 'invalid_or_blank' THEN 1 END) AS inv, count(CASE WHEN a.outcome = 'correct' AND b.outcome <> 'correct' THEN 1 END) AS reg FROM a FULL JOIN b USING (case_id)),
        t AS (SELECT *, concat_ws('; ', CASE WHEN unc > 0 THEN 'different cases' END, CASE WHEN fa > 0 THEN 'more false approvals' END) AS bl, concat_ws('; ', CASE WHEN reg > 0 THEN 'regressions' END, CASE WHEN inv > 0 THEN 'more invalid rows' END, CASE WHEN mi > 0 THEN 'more missing rows' END) AS wa FROM s)
        SELECT CASE WHEN bl <> '' THEN 'BLOCKED' WHEN wa <> '' THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS decision, bl AS blocking, wa AS warnings, fa AS false_approvals, reg AS regressions FROM t""",
    "ps5_column_leaks": _LEAK("raw_predictions", "file_name") + " UNION ALL " + _LEAK("raw_predictions", "raw_line") + " UNION ALL " + " UNION ALL ".join(_LEAK("candidate_evidence", c) for c in ("value", "case_id_hint", "source")),
    "r13_rule_support": f"WITH {_RULES}, f AS (SELECT DISTINCT case_id, field_name AS key, value FROM resolved_fields WHERE state = 'resolved') SELECT rule_id, case_id FROM rules JOIN f USING (key, value) GROUP BY 1, 2 HAVING count(*) = 2",
}
