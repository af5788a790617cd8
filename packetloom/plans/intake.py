"""Queries of problem 1: rows that fail to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators import structural_csv as sc
from packetloom.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per rejected line and reason."""
    raw = table(spark, sf_dir, "raw_predictions").select("line_id", "raw_line")
    return sc.judge_submissions(raw).select("line_id", F.explode("reasons").alias("reason"))


def p1_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sound lines as typed prediction rows."""
    raw = table(spark, sf_dir, "raw_predictions").select("line_id", "raw_line")
    return sc.load_submissions(raw)[0]


def p1_rejects_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each file were rejected for each reason."""
    raw = table(spark, sf_dir, "raw_predictions").select("line_id", "file_name", "raw_line")
    found = sc.judge_submissions(raw).select("file_name", F.explode("reasons").alias("reason"))
    return found.groupBy("file_name", "reason").agg(F.count(F.lit(1)).alias("n_lines"))


QUERIES = {"p1_found": p1_found, "p1_loaded": p1_loaded, "p1_rejects_by_file": p1_rejects_by_file}

_UNIT = r'(?:"(?:[^"]|"")*"|[^",]*)'
_GROUP = r'("(?:[^"]|"")*"|[^",]*)'


def _field(k: int) -> str:
    pattern = "^" + ",".join([_UNIT] * k + [_GROUP] + [_UNIT] * (11 - k)) + "$"
    raw = f"regexp_extract(raw_line, '{pattern}', 1, 's')"
    return f"""regexp_replace(CASE WHEN {raw} LIKE '"%' THEN replace(substr({raw}, 2, length({raw}) - 2), '""', '"') ELSE {raw} END, '^\\s+|\\s+$', '', 'g')"""


_WELL = f"regexp_full_match(raw_line, '{_UNIT}(?:,{_UNIT})*', 's')"
_COMMAS = r"""length(regexp_replace(raw_line, '"(?:[^"]|"")*"', '', 'gs')) - length(replace(regexp_replace(raw_line, '"(?:[^"]|"")*"', '', 'gs'), ',', ''))"""
_SPLIT = f"""
shaped AS (SELECT *, {_WELL} AS well, {_COMMAS} + 1 AS n FROM raw_predictions),
split AS (SELECT *, {", ".join(f"{_field(k)} AS v_{f}" for k, f in enumerate(sc.SUBMISSION_FIELDS))} FROM shaped WHERE well AND n = 12),
judged AS (SELECT *,
  NOT regexp_full_match(v_case_id, 'MIB-[0-9]{{6}}') AS bad_case,
  NOT regexp_full_match(v_sponsor_id, 'SPN-[0-9]{{4}}') AS bad_sponsor,
  NOT (regexp_full_match(v_arrival_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND v_arrival_date NOT LIKE '0000%'
       AND coalesce(strftime(try_strptime(v_arrival_date, '%Y-%m-%d'), '%Y-%m-%d') = v_arrival_date, false)) AS bad_day,
  v_fee_status NOT IN ('paid', 'waived', 'unpaid', 'unknown') AS bad_fee FROM split),
reasons AS (
  SELECT line_id, file_name, 'quoting' AS reason FROM shaped WHERE NOT well
  UNION ALL SELECT line_id, file_name, 'column_count' FROM shaped WHERE well AND n <> 12
  UNION ALL SELECT line_id, file_name, 'case_id' FROM judged WHERE bad_case
  UNION ALL SELECT line_id, file_name, 'sponsor_id' FROM judged WHERE bad_sponsor
  UNION ALL SELECT line_id, file_name, 'arrival_date' FROM judged WHERE bad_day
  UNION ALL SELECT line_id, file_name, 'fee_status' FROM judged WHERE bad_fee)"""

ORACLE = {
    "p1_found": f"WITH {_SPLIT} SELECT line_id, reason FROM reasons",
    "p1_loaded": f"WITH {_SPLIT} SELECT line_id, {', '.join(f'v_{f} AS {f}' for f in sc.SUBMISSION_FIELDS[:-1])}, TRY_CAST(v_confidence AS DOUBLE) AS confidence FROM judged WHERE NOT (bad_case OR bad_sponsor OR bad_day OR bad_fee)",
    "p1_rejects_by_file": f"WITH {_SPLIT} SELECT file_name, reason, count(*) AS n_lines FROM reasons GROUP BY file_name, reason",
}
