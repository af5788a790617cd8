import numpy as np
from pyspark.sql import functions as F

from packetloom.llm import survivors as op

SCHEMA = "cand_id long, case_id string, field_name string, value string, evidence_type string, ocr_confidence double, legible boolean, superseded boolean, source string"


def row(i, value, kind="intake_form", conf=0.9, field="visa_class", case="c", legible=True, superseded=False):
    return (i, case, field, value, kind, conf, legible, superseded, "clash")


def survivor(spark, *rows):
    out = op.fuse(spark.createDataFrame(list(rows), SCHEMA)).collect()
    return [r["cand_id"] for r in out]


def test_order_of_trust(spark):
    assert survivor(spark, row(1, "A"), row(2, "B", "SignedManualNote", 0.1)) == [2]
    assert survivor(spark, row(1, "A", "signed_manual_note", 0.8), row(2, "B", "adjudicator stamp", 81.0)) == [2]
    assert survivor(spark, row(1, "A", conf=None), row(2, "B", conf=0.0)) == [2]
    assert survivor(spark, row(2, "A", conf=0.9001), row(1, "B", conf=0.9004)) == [1]
    assert survivor(spark, row(1, "A", superseded=None), row(2, "B", "registry_extract")) == [1]


def test_order_as_a_number(spark):
    for ids in ((-(2**63), 2**63 - 1), (-5, 4), (0, 7)):
        assert survivor(spark, row(ids[1], "A"), row(ids[0], "B")) == [ids[0]]
    assert survivor(spark, row(1, "A", conf=float("nan")), row(2, "B", conf=0.0)) == [2]


def test_ineligible_and_single_groups(spark):
    nothing = [row(i, v) for i, v in enumerate([None, " ", "Unknown", "[n/a]", "(ILLEGIBLE)", "-", "?"])]
    assert survivor(spark, *nothing) == []
    assert survivor(spark, *nothing, row(9, "A", "who knows")) == [9]
    assert survivor(spark, row(1, "A")) == []
    assert survivor(spark, row(1, "A"), row(2, None)) == [1]
    assert survivor(spark, row(1, "A", legible=None), row(2, None)) == []
    assert survivor(spark, row(1, "A", case=None), row(2, "B", case=None)) == [1]


def test_fuse_keeps_true_values_and_survives_empty(spark):
    rows = []
    for i in range(60):
        case = f"c{i}"
        rows += [row(10 * i, "a|b", "intake_form", field="risk_flags", case=case), row(10 * i + 1, "b | a", "biometric_slip", field="risk_flags", case=case), row(10 * i + 2, "a|b" if i % 10 else "a|z", "text_layer", field="risk_flags", case=case)]
    out = {r["case_id"]: r for r in op.fuse(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == 60 and all(r["kept"] == ["a", "b"] and r["probability"] > 0.5 for r in out.values())
    assert op.fuse(spark.createDataFrame([], SCHEMA)).count() == 0


def planted(n_cases, domain, seed):
    """Rows of sources with known rates about fields of ``domain`` values, unnamed values left out; (rows, sensitivity, specificity, truth)."""
    rng = np.random.default_rng(seed)
    s = len(op.SOURCES)
    sens, spec = np.linspace(0.95, 0.6, s), np.linspace(0.99, 0.9, s)
    rows, truth, k = [], {}, 0
    for c in range(n_cases):
        true = {f"v{x}" for x in rng.choice(domain, 2, replace=False)}
        truth[f"c{c}"] = true
        for i in np.flatnonzero(rng.random(s) < 0.7):
            named = [v for v in (f"v{x}" for x in range(domain)) if rng.random() < (sens[i] if v in true else 1 - spec[i])]
            if named:
                k += 1
                rows.append(row(k, "|".join(named), op.SOURCES[i], field="risk_flags", case=f"c{c}"))
    return rows, sens, spec, truth


def test_rates_are_inferred_from_rows(spark):
    rows, sens, spec, truth = planted(1500, 10, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    _, model = op.judged_claims(op.prepared(df))
    # a source that names nothing has not spoken, so a few silent votes are lost
    assert np.abs(model["sensitivity"] - sens).max() < 0.05 and np.abs(model["specificity"] - spec).max() < 0.03
    fused = op.fuse(df).collect()
    right = sum(set(r["kept"]) == truth[r["case_id"]] for r in fused)
    assert right > 0.85 * len(fused)
    # trust alone is worse: the survivor's own value is one source's word
    values = {r[0]: r[3] for r in rows}
    assert right > sum(set(values[r["cand_id"]].split("|")) == truth[r["case_id"]] for r in fused) + 0.1 * len(fused)


def test_kept_values_equal_a_plain_restatement(spark):
    rows, *_ = planted(60, 6, 9)
    rows += [row(10_000 + i, v, kind, field="visa_class", case=f"c{i % 20}") for i, (v, kind) in enumerate([("KX-1", "intake_form"), ("kx-1 ", "registry_extract"), ("DR-2", "text_layer"), ("?", "intake_form")] * 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    judged, model = op.judged_claims(op.prepared(df))
    said, spoke = {}, {}
    for r in rows:
        if r[3] in ("?",):
            continue
        value = r[3].lower().strip()
        bit = 1 << op.SOURCES.index(r[4].replace("_", ""))
        spoke[r[1], r[2]] = spoke.get((r[1], r[2]), 0) | bit
        for claim in value.split("|") if r[2] == "risk_flags" else [value]:
            said[r[1], r[2], claim] = said.get((r[1], r[2], claim), 0) | bit
    want = {}
    for (case, field, claim), made in said.items():
        pattern = np.array([spoke[case, field] << len(op.SOURCES) | made])
        want[case, field, claim] = float(op.posterior(pattern, np.array([model["prior"][field]]), model["sensitivity"], model["specificity"])[0])
    got = {(r["case_id"], r["field_name"], r["claim"]): r["probability"] for r in judged.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    for r in op.fuse(df).collect():
        mine = {c: p for (case, field, c), p in want.items() if (case, field) == (r["case_id"], r["field_name"])}
        true = sorted(c for c, p in mine.items() if p >= 0.5) if r["field_name"] == "risk_flags" else []
        assert r["kept"] == (true or [max(mine, key=lambda c: (mine[c], c))])


def test_em_finds_planted_rates_alike_on_driver_and_in_spark(spark):
    rng = np.random.default_rng(4)
    n, s = 4000, len(op.SOURCES)
    truth = rng.random(n) < 0.7
    sens, spec = np.linspace(0.95, 0.6, s), np.linspace(0.95, 0.7, s)
    made = np.where(truth[:, None], rng.random((n, s)) < sens, rng.random((n, s)) > spec)
    pattern = ((1 << s) - 1 << s) + (made * (1 << np.arange(s))).sum(1)
    df = spark.createDataFrame([("f", int(p)) for p in pattern], "field_name string, pattern long").groupBy("field_name", "pattern").agg(F.count(F.lit(1)).alias("n"))
    # nobody's silence is hidden here
    one, two = op.fit(df, pseudo=0.0), op.fit(df, rounds=3, pattern_rows=0)
    assert np.abs(one["sensitivity"] - sens).max() < 0.1 and np.abs(one["specificity"] - spec).max() < 0.12
    three = op.fit(df, rounds=3)
    assert np.allclose(two["sensitivity"], three["sensitivity"]) and np.allclose(two["specificity"], three["specificity"])
    for model in (one, op.fit(df)):
        p = op.posterior(pattern, np.full(n, model["prior"]["f"]), model["sensitivity"], model["specificity"])
        assert ((p > 0.5) == truth).mean() > 0.97
