"""Queries of linking, resolving and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import text as tx
from packetloom.operators import consensus, evidence
from packetloom.session import small_rows, table

FIELDS = ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "fee_status")


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidate_evidence")


def _views(spark: SparkSession, d: str) -> DataFrame:
    return consensus.unpivot(table(spark, d, "predictions"), FIELDS, "run_id")


def resolved_fields(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: every (case, field) resolved by ranked precedence, unobserved fields as UNKNOWN."""
    rows = _evidence(spark, d)
    fields = rows.select("field_name").distinct()
    names = small_rows(fields, 1000)  # a closed list of about twenty fields
    if names is None:
        raise ValueError("more fields than a closed list has")
    grid = rows.select("case_id").distinct().select("case_id", F.explode(F.array(*(F.lit(r["field_name"]) for r in names))).alias("field_name")) if names else rows.select("case_id", "field_name")
    return evidence.resolve(rows, grid)


def resolved_against_passes(spark: SparkSession, d: str) -> DataFrame:
    """Per field, how often the resolver agrees with the latest stored pass."""
    latest = table(spark, d, "resolved_fields").groupBy("case_id", "field_name").agg(F.max_by(F.struct("state", "value"), F.struct("pass_no", "resolved_at", "resolved_id")).alias("stored"))
    both = evidence.resolve(_evidence(spark, d)).join(latest, ["case_id", "field_name"])
    same_state = F.lower("state") == F.col("stored.state")
    return both.groupBy("field_name").agg(F.count(F.lit(1)).alias("n_fields"), F.count_if(same_state).alias("n_same_state"), F.count_if(same_state & F.col("value").eqNullSafe(F.col("stored.value"))).alias("n_same"))


def rescission(spark: SparkSession, d: str) -> DataFrame:
    return evidence.without_rescinded(_evidence(spark, d)).groupBy("case_id").agg(F.max("rescinded").cast("int").alias("rescinded"), F.count(F.lit(1)).alias("n_kept"))


def scoped_rows(spark: SparkSession, d: str) -> DataFrame:
    return evidence.scoped(_evidence(spark, d)).groupBy("case_id").agg(F.count(F.lit(1)).alias("n_rows"))


def unanimous_fields(spark: SparkSession, d: str) -> DataFrame:
    return evidence.unanimous(_evidence(spark, d))


def corroborated_values(spark: SparkSession, d: str) -> DataFrame:
    return evidence.corroborated(_evidence(spark, d))


def name_clusters(spark: SparkSession, d: str) -> DataFrame:
    return evidence.name_clusters(_evidence(spark, d))


def active_applicants(spark: SparkSession, d: str) -> DataFrame:
    return evidence.active_applicants(_evidence(spark, d))


def agreed_views(spark: SparkSession, d: str) -> DataFrame:
    return consensus.agreed(_views(spark, d), 3)


def voted_views(spark: SparkSession, d: str) -> DataFrame:
    return consensus.agreed(_views(spark, d), 2)


def two_pass(spark: SparkSession, d: str) -> DataFrame:
    return consensus.two_pass(_views(spark, d), "run_001", "run_002")


def vote_leads(spark: SparkSession, d: str) -> DataFrame:
    return consensus.lead(_views(spark, d), 2)


def flag_unions(spark: SparkSession, d: str) -> DataFrame:
    sets = table(spark, d, "predictions").select("case_id", tx.flag_set(F.col("risk_flags")).alias("flags"))
    return consensus.set_union(sets, "case_id", "flags").select("case_id", F.array_join("flags", "|").alias("flags"))


def maximal_flags(spark: SparkSession, d: str) -> DataFrame:
    sets = table(spark, d, "predictions").select("case_id", tx.flag_set(F.col("risk_flags")).alias("flags"))
    return consensus.maximal_sets(sets, "case_id", "flags").select("case_id", F.array_join("flags", "|").alias("flags"))


QUERIES = {
    "r4_resolved_fields": resolved_fields, "r4_against_passes": resolved_against_passes, "r2_rescission": rescission, "l1_scoped_rows": scoped_rows, "l9_unanimous_fields": unanimous_fields, "l7_corroborated_values": corroborated_values,
    "l3_name_clusters": name_clusters, "l4_active_applicants": active_applicants, "c3_agreed_views": agreed_views, "c6_voted_views": voted_views, "c7_two_pass": two_pass, "w2_vote_leads": vote_leads, "x24_flag_unions": flag_unions, "u3_maximal_flags": maximal_flags,
}

_ELIGIBLE = "legible AND regexp_matches(value, '\\S') AND NOT coalesce(superseded, false) AND NOT coalesce(list_contains(visual_cues, 'strikethrough'), false)"
_KIND = "regexp_replace(lower(evidence_type), '[^a-z]', '', 'g')"
_RANK = f"CASE {_KIND} WHEN 'adjudicatorstamp' THEN 1 WHEN 'signedmanualnote' THEN 1 WHEN 'intakeform' THEN 2 WHEN 'biometricslip' THEN 3 WHEN 'sponsorattestation' THEN 4 WHEN 'registryextract' THEN 5 WHEN 'textlayer' THEN 6 ELSE 9 END"
_CONF = "coalesce(CASE WHEN ocr_confidence > 1 THEN ocr_confidence / 100 ELSE ocr_confidence END, 0)"
_RESOLVE = f"""e AS (SELECT *, {_RANK} AS rk, coalesce(list_contains(visual_cues, 'correction'), false) AS corr, {_CONF} AS conf FROM candidate_evidence WHERE {_ELIGIBLE}),
  f AS (SELECT *, rank() OVER (PARTITION BY case_id, field_name ORDER BY rk, corr DESC) AS tier FROM e),
  t AS (SELECT *, row_number() OVER (PARTITION BY case_id, field_name ORDER BY conf DESC, page_index DESC, box.top DESC, seq, cand_id) AS rn FROM f WHERE tier = 1),
  w AS (SELECT case_id, field_name, min(value) AS low, max(value) AS high, max(CASE WHEN rn = 1 THEN cand_id END) AS win, min(rk) AS "rank" FROM t GROUP BY 1, 2),
  c AS (SELECT case_id, field_name, count(*) AS n FROM candidate_evidence GROUP BY 1, 2)"""
_LONG = " UNION ALL ".join(f"SELECT case_id, run_id AS view, '{f}' AS field_name, {f} AS value FROM predictions WHERE regexp_matches({f}, '\\S')" for f in FIELDS)
_VIEWS = f"v AS (SELECT DISTINCT * FROM ({_LONG})), n AS (SELECT case_id, field_name, value, count(DISTINCT view) AS k FROM v GROUP BY 1, 2, 3)"
_FLAG = "list_sort(list_distinct(list_filter(list_transform(string_split(lower(coalesce(risk_flags, '')), '|'), lambda p: regexp_replace(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g')), lambda p: p NOT IN ('', 'none', 'null', 'unknown'))))"

ORACLE = {
    "r4_resolved_fields": f"""WITH {_RESOLVE}, g AS (SELECT * FROM (SELECT DISTINCT case_id FROM candidate_evidence), (SELECT DISTINCT field_name FROM candidate_evidence))
        SELECT case_id, field_name, CASE WHEN low IS NULL THEN 'UNKNOWN' WHEN low = high THEN 'RESOLVED' ELSE 'CONTESTED' END AS state,
        CASE WHEN low IS NULL THEN 'no eligible evidence' WHEN low = high THEN 'resolved at precedence rank ' || "rank" ELSE 'same-rank conflict at precedence rank ' || "rank" END AS reason, CASE WHEN low = high THEN low END AS value, CASE WHEN low = high THEN win END AS winner, "rank", coalesce(n, 0) AS n_considered
        FROM g LEFT JOIN c USING (case_id, field_name) LEFT JOIN w USING (case_id, field_name)""",
    "r4_against_passes": f"""WITH {_RESOLVE}, s AS (SELECT * FROM resolved_fields QUALIFY row_number() OVER (PARTITION BY case_id, field_name ORDER BY pass_no DESC, resolved_at DESC, resolved_id DESC) = 1),
        r AS (SELECT case_id, field_name, CASE WHEN low IS NULL THEN 'unknown' WHEN low = high THEN 'resolved' ELSE 'contested' END AS st, CASE WHEN low = high THEN low END AS val FROM c LEFT JOIN w USING (case_id, field_name))
        SELECT field_name, count(*) AS n_fields, count(CASE WHEN st = s.state THEN 1 END) AS n_same_state, count(CASE WHEN st = s.state AND val IS NOT DISTINCT FROM s.value THEN 1 END) AS n_same FROM r JOIN s USING (case_id, field_name) GROUP BY 1""",
    "r2_rescission": f"""WITH live AS (SELECT *, {_KIND} AS kind, (page_index, box.top) AS place FROM candidate_evidence WHERE NOT coalesce(list_contains(visual_cues, 'sample_denial_watermark'), false)),
        a AS (SELECT case_id, max(place) AS latest FROM live WHERE field_name = 'adjudication' AND value = 'APPROVED' AND kind = 'signedmanualnote' AND coalesce(list_contains(visual_cues, 'correction'), false) GROUP BY 1),
        m AS (SELECT live.case_id, coalesce(field_name = 'adjudication' AND value = 'DENIED' AND kind = 'adjudicatorstamp' AND coalesce(place < latest, false), false) AS gone FROM live LEFT JOIN a USING (case_id))
        SELECT case_id, max(gone::INT) AS rescinded, count(CASE WHEN NOT gone THEN 1 END) AS n_kept FROM m GROUP BY 1 HAVING count(CASE WHEN NOT gone THEN 1 END) > 0""",
    "l1_scoped_rows": """SELECT case_id, count(*) AS n_rows FROM candidate_evidence
        WHERE regexp_replace(upper(coalesce(case_id_hint, '')), '[^A-Z0-9]', '', 'g') IN ('', regexp_replace(case_id, '[^A-Z0-9]', '', 'g')) GROUP BY 1""",
    "l9_unanimous_fields": f"SELECT case_id, field_name, min(value) AS value, count(*) AS n_rows FROM candidate_evidence WHERE {_ELIGIBLE} GROUP BY 1, 2 HAVING min(value) = max(value)",
    "l7_corroborated_values": f"""WITH s AS (SELECT case_id, field_name, value FROM candidate_evidence WHERE {_ELIGIBLE} GROUP BY 1, 2, 3 HAVING count(DISTINCT page_index) >= 2 AND count(DISTINCT {_KIND}) >= 2)
        SELECT case_id, field_name, min(value) AS value FROM s GROUP BY 1, 2 HAVING count(*) = 1""",
    "c3_agreed_views": f"WITH {_VIEWS} SELECT case_id, field_name, min(value) AS value, max(k) AS n_views FROM n GROUP BY 1, 2 HAVING count(*) = 1 AND max(k) >= 3",
    "c6_voted_views": f"WITH {_VIEWS} SELECT case_id, field_name, min(value) AS value, max(k) AS n_views FROM n GROUP BY 1, 2 HAVING count(*) = 1 AND max(k) >= 2",
    "c7_two_pass": f"""WITH {_VIEWS}, p AS (SELECT case_id, field_name, view, min(value) AS value FROM v WHERE view IN ('run_001', 'run_002') GROUP BY 1, 2, 3 HAVING min(value) = max(value))
        SELECT a.case_id, a.field_name, a.value FROM p a JOIN p b ON a.case_id = b.case_id AND a.field_name = b.field_name AND a.value = b.value AND a.view = 'run_001' AND b.view = 'run_002'""",
    "w2_vote_leads": f"""WITH {_VIEWS}, r AS (SELECT *, row_number() OVER (PARTITION BY case_id, field_name ORDER BY k DESC, value DESC) AS rn FROM n),
        t AS (SELECT case_id, field_name, max(CASE WHEN rn = 1 THEN value END) AS value, max(CASE WHEN rn = 1 THEN k END) - coalesce(max(CASE WHEN rn = 2 THEN k END), 0) AS lead FROM r GROUP BY 1, 2) SELECT case_id, field_name, value, lead FROM t WHERE lead >= 2""",
    "x24_flag_unions": f"WITH f AS (SELECT DISTINCT case_id, unnest({_FLAG}) AS flag FROM predictions) SELECT case_id, string_agg(flag, '|' ORDER BY flag) AS flags FROM f GROUP BY 1",
    "u3_maximal_flags": f"""WITH s AS (SELECT DISTINCT case_id, {_FLAG} AS f FROM predictions)
        SELECT case_id, array_to_string(f, '|') AS flags FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.case_id = s.case_id AND len(o.f) > len(s.f) AND list_has_all(o.f, s.f))""",
}
