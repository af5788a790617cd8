"""Problem 4: the best representative of each group of duplicate observations.

Every value observed for a (case, field) is a claim.  A source (an evidence
type) that speaks about the field either makes the claim or, by naming other
values, speaks against it.  A latent two-sided model gives each source a
sensitivity (it names a true value) and a specificity (it leaves a false one
unnamed), and each field a share of true claims; expectation-maximisation
infers all of them and the probability of every claim.  Fields that may hold
several values keep each value whose probability reaches one half.

A false value that nobody names is no row, and without such values every false
claim would have a speaker and every specificity would be too low.  A field's
domain is therefore completed: the distinct claims of the field that a group
does not hold count as values left unnamed by all sources that spoke there.
They are numbers alone, one per (field, set of speaking sources).  With them
the rates follow from the votes; the prior is worth ``PSEUDO`` votes.

The sufficient statistics are the counts of (field, pattern of votes).  With S
sources and F fields there are at most F * 3^S patterns however many rows there
are; they are counted by one pre-aggregated shuffle and fitted on the driver
when ``small_rows`` finds them few, else by partial sums in Spark, which give
the same numbers.

The survivor of a group is its first eligible row in a declared order of
trust; the model's probability comes with it.  One scan folds the rows to
distinct claims, and groups are reduced by aggregates alone, so a group of any
size stays out of a single task's memory.

Defined results: a group without an eligible row has no survivor; null keys
form a group of their own; unknown evidence types rank last and have no say in
the model; ties end at the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.session import cut, maybe_broadcast, small_rows

#: The order of trust; fixed values.
TRUST = {
    "adjudicatorstamp": 1,
    "signedmanualnote": 1,
    "intakeform": 2,
    "biometricslip": 3,
    "sponsorattestation": 4,
    "registryextract": 5,
    "textlayer": 6,
}
SOURCES = tuple(TRUST)
#: Values that say there is none, also in brackets; fixed values.
NO_VALUE = r"^[\[({<]?\s*(unknown|n/a|illegible|-|\?)?\s*[\])}>]?$"
MULTI_VALUED = ("risk_flags",)
ROUNDS, TOLERANCE, PATTERN_ROWS = 200, 1e-7, 200_000
#: Rates believed beforehand (sensitivity, specificity) and the votes that this belief is worth.
BELIEF, PSEUDO = (0.8, 0.9), 2.0


def source_of(evidence_type: Column) -> Column:
    return F.regexp_replace(F.lower(evidence_type), "[^a-z]", "")


def trust_of(source: Column) -> Column:
    ranks = F.create_map(*(F.lit(x) for pair in TRUST.items() for x in pair))
    return F.coalesce(F.try_element_at(ranks, source), F.lit(99))


def confidence_of(column: Column) -> Column:
    """On 0..1, three decimals; percentages are brought down."""
    return F.round(F.when(column > 1, column / 100).otherwise(column), 3)


def order_of(source: Column, confidence: Column, cand_id: Column) -> Column:
    """The order of trust as one decimal number, so that its minimum is kept in a hash aggregate: trust, confidence (null last), id."""
    place = F.greatest(F.lit(0.0), F.least(F.lit(999_998.0), 500_000 - F.round(confidence * 1000))).cast("long")
    sure = F.coalesce(F.when(~F.isnan(confidence), place), F.lit(999_999))  # no confidence comes last
    head = (trust_of(source) * F.lit(10**6) + sure).cast("decimal(8,0)") * F.lit(str(10**20)).cast("decimal(21,0)")
    return (head + (cand_id.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)"))).cast("decimal(30,0)")


def id_of(order: Column) -> Column:
    return ((order % F.lit(str(10**20)).cast("decimal(21,0)")) - F.lit(str(2**63)).cast("decimal(20,0)")).cast("long")


def has_value(value: Column) -> Column:
    tidy = F.regexp_replace(F.lower(value), r"^\s+|\s+$", "")
    return value.isNotNull() & ~tidy.rlike(NO_VALUE)


def claim_text(value: Column) -> Column:
    """Spellings that differ in case, blanks, underscores or end marks are one claim."""
    return F.regexp_replace(F.regexp_replace(F.lower(value), r"[\s_]+", " "), r"^[\s.,;:]+|[\s.,;:]+$", "")


def prepared(evidence: DataFrame) -> DataFrame:
    return evidence.select(
        "case_id", "field_name", "cand_id", "value",
        source_of(F.coalesce("evidence_type", F.lit(""))).alias("source"),
        confidence_of(F.col("ocr_confidence")).alias("confidence"),
        F.coalesce(F.col("legible") & ~F.coalesce("superseded", F.lit(False)) & has_value(F.col("value")), F.lit(False)).alias("eligible"),
    )


def _claims_of(field: Column, value: Column, multi_valued: tuple[str, ...]) -> Column:
    """The claims that a value makes: its members for multi-valued fields, else itself."""
    tidy = claim_text(value)
    return F.when(field.isin(*multi_valued), F.array_distinct(F.split(tidy, r"\s*\|\s*"))).otherwise(F.array(tidy))


def claimed(rows: DataFrame, multi_valued: tuple[str, ...] = MULTI_VALUED) -> DataFrame:
    """case_id, field_name, claim, made (bits of the sources that make it), n_rows, n_eligible, first.

    Ineligible rows have a null claim.  ``first`` is the place of the claim's
    first eligible row in the order of trust.  A row with several claims is
    counted at its first one.
    """
    bit = F.lit(0)
    for i, s in enumerate(SOURCES):
        bit = F.when(F.col("source") == s, F.lit(1 << i)).otherwise(bit)
    parts = F.when(F.col("eligible"), _claims_of(F.col("field_name"), F.col("value"), multi_valued)).otherwise(F.array(F.lit(None).cast("string")))
    order = F.when(F.col("eligible"), order_of(F.col("source"), F.col("confidence"), F.col("cand_id")))
    said = rows.select("case_id", "field_name", F.when(F.col("eligible"), bit).alias("bit"), order.alias("order"), F.posexplode(parts).alias("at", "claim"))
    head = F.col("at") == 0
    return said.groupBy("case_id", "field_name", "claim").agg(
        F.bit_or("bit").alias("made"), F.count_if(head).alias("n_rows"), F.count_if(head & F.col("order").isNotNull()).alias("n_eligible"), F.min("order").alias("first")
    )


def grouped(claims: DataFrame) -> DataFrame:
    """case_id, field_name, spoke, leader (place of the survivor), n_rows, n_eligible, n_claims of the groups with an eligible row."""
    out = claims.groupBy("case_id", "field_name").agg(
        F.bit_or("made").alias("spoke"), F.min("first").alias("leader"), F.sum("n_rows").alias("n_rows"), F.sum("n_eligible").alias("n_eligible"), F.count("claim").alias("n_claims")
    )
    return out.where("n_eligible >= 1")


def patterns_of(claims: DataFrame, groups: DataFrame, judged: DataFrame) -> DataFrame:
    """field_name, pattern, n: the votes of all claims and of the values of the field's domain that a group leaves unnamed."""
    seen = judged.groupBy("field_name", "pattern").agg(F.count(F.lit(1)).alias("n"))
    domain = claims.where(F.col("claim").isNotNull()).groupBy("field_name").agg(F.approx_count_distinct("claim", 0.02).alias("size"))
    spoken = groups.groupBy("field_name", "spoke").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n_claims").alias("n_claims"))
    unnamed = F.col("size") * F.col("n_groups") - F.col("n_claims")
    hidden = _match(spoken, domain, ["field_name"]).select("field_name", (F.col("spoke") * F.lit(1 << len(SOURCES))).alias("pattern"), unnamed.alias("n")).where("n > 0")
    return seen.unionByName(hidden).groupBy("field_name", "pattern").agg(F.sum("n").alias("n"))


def _votes(pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(SOURCES)
    bits = 1 << np.arange(n)
    made, spoke = pattern & ((1 << n) - 1), pattern >> n
    return (made[:, None] & bits > 0), (spoke[:, None] & bits > 0)


def posterior(pattern: np.ndarray, prior: np.ndarray, sensitivity: np.ndarray, specificity: np.ndarray) -> np.ndarray:
    """P(claim is true | votes)."""
    made, spoke = _votes(pattern)
    up = np.where(spoke, np.where(made, np.log(sensitivity), np.log1p(-sensitivity)), 0).sum(1) + np.log(prior)
    down = np.where(spoke, np.where(made, np.log1p(-specificity), np.log(specificity)), 0).sum(1) + np.log1p(-prior)
    return 1 / (1 + np.exp(np.clip(down - up, -700, 700)))


def _sums(counts: pd.DataFrame, model: dict) -> pd.DataFrame:
    """Expected counts of the M step: per source and per field, additive over partitions."""
    pattern, n = counts["pattern"].to_numpy(np.int64), counts["n"].to_numpy(float)
    prior = counts["field_name"].map(model["prior"]).fillna(0.5).to_numpy(float)
    p = posterior(pattern, prior, model["sensitivity"], model["specificity"])
    made, spoke = _votes(pattern)
    out = [(f"source:{s}", *(float((n * w * v[:, i]).sum()) for w, v in ((p, made), (p, spoke), (1 - p, spoke & ~made), (1 - p, spoke)))) for i, s in enumerate(SOURCES)]
    fields = pd.DataFrame({"f": counts["field_name"].astype(object).where(counts["field_name"].notna(), ""), "t": n * p, "n": n}).groupby("f").sum()
    out += [(f"field:{f}", float(t), float(m), 0.0, 0.0) for f, t, m in fields.itertuples()]
    return pd.DataFrame(out, columns=["key", "a", "b", "c", "d"])


def fit(patterns: DataFrame, rounds: int = ROUNDS, pattern_rows: int = PATTERN_ROWS, pseudo: float = PSEUDO) -> dict:
    """The model after EM over ``patterns`` (field_name, pattern, n).

    Both rates have Beta priors worth ``pseudo`` votes at the rates of
    ``BELIEF``; a source that is never heard keeps those rates.
    """
    model = {"sensitivity": np.full(len(SOURCES), BELIEF[0]), "specificity": np.full(len(SOURCES), BELIEF[1]), "prior": {}}
    patterns = patterns.select("field_name", F.col("pattern").cast("long").alias("pattern"), F.col("n").cast("double").alias("n"))
    listed = small_rows(patterns, pattern_rows)
    local = pd.DataFrame([tuple(r) for r in listed], columns=["field_name", "pattern", "n"]) if listed is not None else None
    if local is None:
        patterns = cut(patterns)  # each round reads it
    for _ in range(rounds):
        if local is not None:
            sums = _sums(local, model)
        else:
            shared = model

            def partial(batches, shared=shared):
                for batch in batches:
                    yield _sums(batch, shared)

            spread = patterns.mapInPandas(partial, "key string, a double, b double, c double, d double")
            sums = spread.groupBy("key").agg(*(F.sum(c).alias(c) for c in "abcd")).toPandas()
        by = {k: (a, b, c, d) for k, a, b, c, d in sums.itertuples(index=False)}
        rates = []
        for source in SOURCES:
            hits, true_votes, kept_silent, false_votes = by.get(f"source:{source}", (0, 0, 0, 0))
            rates.append(((hits + pseudo * BELIEF[0]) / (true_votes + pseudo), (kept_silent + pseudo * BELIEF[1]) / (false_votes + pseudo)))
        rates = np.clip(np.array(rates), 1e-7, 1 - 1e-7)
        prior = {k[6:]: (a + 1) / (b + 2) for k, (a, b, _, _) in by.items() if k.startswith("field:")}
        moved = max(np.abs(rates[:, 0] - model["sensitivity"]).max(), np.abs(rates[:, 1] - model["specificity"]).max())
        model = {"sensitivity": rates[:, 0], "specificity": rates[:, 1], "prior": prior}
        if moved < TOLERANCE:
            break
    return model


def probabilities(patterns: DataFrame, model: dict) -> DataFrame:
    """field_name, pattern, probability of every pattern; as few rows as there are patterns."""

    def judge(batches):
        for batch in batches:
            prior = batch["field_name"].where(batch["field_name"].notna(), "").map(model["prior"]).fillna(0.5).to_numpy(float)
            yield batch.assign(probability=posterior(batch["pattern"].to_numpy(np.int64), prior, model["sensitivity"], model["specificity"]))

    return patterns.select("field_name", F.col("pattern").cast("long").alias("pattern")).mapInPandas(judge, "field_name string, pattern long, probability double")


def judged_claims(rows: DataFrame, multi_valued: tuple[str, ...] = MULTI_VALUED) -> tuple[DataFrame, dict]:
    """(claims with their group's survivor and ``probability``, fitted model)."""
    claims = cut(claimed(rows, multi_valued))
    groups = grouped(claims)
    made = _match(claims.where(F.col("claim").isNotNull()).select("case_id", "field_name", "claim", "made", "first"), groups, ["case_id", "field_name"])
    # the survivor's own claims are those that nobody makes before it
    made = made.withColumn("own", F.col("first") == F.col("leader")).withColumn("cand_id", id_of(F.col("leader"))).drop("first", "leader")
    made = cut(made.withColumn("pattern", (F.col("spoke") * F.lit(1 << len(SOURCES)) + F.col("made")).cast("long")))
    patterns = cut(patterns_of(claims, groups, made))
    model = fit(patterns)
    listed = maybe_broadcast(cut(probabilities(patterns, model)))
    return _match(made, listed, ["field_name", "pattern"]), model


def fuse(evidence: DataFrame, multi_valued: tuple[str, ...] = MULTI_VALUED) -> DataFrame:
    """The surviving record of each group of two rows or more, field by field.

    case_id, field_name, cand_id (the survivor), probability (of the
    survivor's least likely claim), kept (for multi-valued fields every value
    judged true, else the likeliest value), kept_probability (of the least
    likely value kept), n_rows, n_eligible.
    """
    judged, _ = judged_claims(prepared(evidence), multi_valued)
    several, multi = judged.where("n_rows >= 2"), F.col("field_name").isin(*multi_valued)
    held = multi & (F.col("probability") >= 0.5)
    # only the true values of multi-valued fields are gathered; a single-valued field keeps its likeliest value
    said = several.groupBy("case_id", "field_name").agg(
        *(F.max(c).alias(c) for c in ("cand_id", "n_rows", "n_eligible")),  # one value in the whole group
        F.min(F.when(F.col("own"), F.col("probability"))).alias("probability"),
        F.array_sort(F.collect_list(F.when(held, F.col("claim")))).alias("true_values"),
        F.min(F.when(held, F.col("probability"))).alias("least"),
        F.max(F.struct("probability", "claim")).alias("likeliest"),
    )
    many = multi & (F.size("true_values") > 0)
    return said.select(
        "case_id", "field_name", "cand_id", "probability", F.when(many, F.col("true_values")).otherwise(F.array("likeliest.claim")).alias("kept"),
        F.when(many, F.col("least")).otherwise(F.col("likeliest.probability")).alias("kept_probability"), "n_rows", "n_eligible",
    )


def _match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys meet null keys; the keys of ``left`` stay."""
    renamed = right.select(*(F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns))
    return left.join(renamed, [left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]).drop(*(f"__{k}" for k in keys))
