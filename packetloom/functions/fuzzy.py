"""Fuzzy matching of short keys by the longest-matching-blocks ratio.

The ratio is asymmetric, so the order (observed, target) is part of the
contract.  It runs on distinct keys only, in Arrow batches.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from packetloom.functions.text import ocr_key
from packetloom.session import maybe_broadcast


@F.pandas_udf(T.DoubleType())
def ratio(observed: pd.Series, target: pd.Series) -> pd.Series:
    """2 * matches / total length of the matching blocks of both strings."""
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else None for a, b in zip(observed, target, strict=True)], dtype="float64")


def canonical_by_ratio(values: DataFrame, vocabulary: DataFrame, cutoff: float, margin: float = 0.04) -> DataFrame:
    """``values`` (value) with ``canonical``: an equal key, else the best ratio that clears cutoff and lead.

    ``vocabulary`` (term) is a closed list; every distinct key meets every
    term, in blocks of keys, against the broadcast list.
    """
    keyed = values.select("value", ocr_key(F.col("value")).alias("key"))
    terms = vocabulary.select("term", ocr_key(F.col("term")).alias("term_key")).distinct()
    keys = keyed.where(F.col("key") != "").select("key").distinct()
    terms = maybe_broadcast(terms)
    exact = keys.join(terms, keys["key"] == terms["term_key"]).groupBy("key").agg(F.min("term").alias("canonical"))
    open_keys = keys.join(exact, "key", "left_anti")
    # twice the shorter length over both lengths is the most that the ratio can be
    shorter, both = F.least(F.length("key"), F.length("term_key")), F.length("key") + F.length("term_key")
    scored = open_keys.join(terms, 2 * shorter >= (cutoff - margin) * both).withColumn("score", ratio("key", "term_key"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "term")
    ranked = scored.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= 2)
    best = ranked.groupBy("key").agg(
        F.max(F.when(F.col("rn") == 1, F.col("term"))).alias("canonical"),
        F.max(F.when(F.col("rn") == 1, F.col("score"))).alias("first"),
        F.max(F.when(F.col("rn") == 2, F.col("score"))).alias("second"),
    )
    near = best.where((F.col("first") >= cutoff) & (F.col("first") - F.coalesce("second", F.lit(0.0)) >= margin)).select("key", "canonical")
    return keyed.join(exact.unionByName(near), "key", "left").select("value", "canonical")


def close_terms(values: DataFrame, vocabulary: DataFrame, cutoff: float = 0.72) -> DataFrame:
    """value, term: the closest term of a closed list at ``cutoff`` or above for each distinct value; the later term wins a tie."""
    terms = maybe_broadcast(vocabulary.select("term").distinct())
    scored = values.select("value").distinct().where(F.col("value").isNotNull()).join(terms, F.length("term") > 0).withColumn("score", ratio("term", "value"))
    best = scored.where(F.col("score") >= cutoff).groupBy("value").agg(F.max(F.struct("score", "term")).alias("best"))
    return best.select("value", F.col("best.term").alias("term"))


def phrase_terms(texts: DataFrame, key: str, text: str, vocabulary: DataFrame, cutoff: float = 0.75, words: int = 4) -> DataFrame:
    """key, term of every term that a span of one to ``words`` words of the text is like, separators left out.

    Spans are folded to distinct ones before the ratio, which runs once for each
    pair of a span and a term whose lengths alone allow the cutoff.
    """
    parts = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"))
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(words)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("__w") - n + 1, F.lit(1))), lambda i: F.when(i + n - 1 <= F.size("__w"), F.array_join(F.slice("__w", i, n), "")))))
    spoken = texts.select(key, parts.alias("__w")).where(F.size("__w") > 0).select(key, F.explode(F.array_distinct(F.array_compact(spans))).alias("span"))
    terms = maybe_broadcast(vocabulary.select("term", F.regexp_replace(F.lower("term"), "[^a-z0-9]+", "").alias("term_key")).distinct())
    a, b = F.length("span"), F.length("term_key")
    may = 2 * F.least(a, b) >= cutoff * (a + b)  # the ratio is at most this
    like = spoken.select("span").distinct().join(terms, may).withColumn("score", ratio("span", "term_key")).where(F.col("score") >= cutoff).select("span", "term")
    return spoken.join(like, "span").select(key, "term").distinct()


def named_flags(text: Column, vocabulary: tuple[str, ...], derived: dict[str, str]) -> Column:
    """The sorted flags that a text names: by their own words, whatever stands between them, or by a pattern of ``derived`` (flag: pattern)."""
    tidy = F.concat(F.lit("_"), F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
    hits = [F.when(tidy.contains(f"_{v}_"), F.lit(v)) for v in vocabulary] + [F.when(text.rlike(p), F.lit(v)) for v, p in derived.items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))
