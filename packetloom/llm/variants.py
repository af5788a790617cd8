"""Problem 3: variant spellings of names, linked into entities.

Spellings are distinct (block, name) records, so copies of one spelling cost
one record however many rows carry it.  Padded bigrams of the words' skeletons
are MinHashed, bands are chosen from the collision curve so that a pair of the
wanted Jaccard similarity meets with the wanted recall, and a band's key holds
the block (what the entity is known to keep), so unlike blocks never meet.
Candidates are verified by Monge-Elkan similarity and clustered into stars:
the heaviest spelling among its neighbours is a centre, its neighbours are its
satellites, and each satellite goes to its most similar centre.

Defined results: names without letters and null names link with nothing;
a block part that is null forms a block of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from packetloom.llm import names
from packetloom.operators.skew import HEAVY, salted_join
from packetloom.session import cut

JACCARD, RECALL, BAND_ROWS = 0.4, 0.98, 2
SIMILARITY = 0.7
#: Open directed edges that one task may decide.
REST_EDGES = 200_000


def bands_for(jaccard: float = JACCARD, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """Bands needed so that 1 - (1 - s^r)^b reaches the recall at similarity s."""
    return math.ceil(math.log(1 - recall) / math.log(1 - jaccard**rows))


@F.pandas_udf(T.ArrayType(T.StringType()))
def name_words(name: pd.Series) -> pd.Series:
    return name.map(lambda x: list(names.words_of(x)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def name_grams(words: pd.Series) -> pd.Series:
    """Padded bigrams of the words' skeletons."""

    def grams(ws: list[str]) -> list[str]:
        padded = [f"#{names.skeleton(w)}#" for w in ws]
        return sorted({p[i : i + 2] for p in padded for i in range(len(p) - 1)})

    return words.map(grams)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([names.name_similarity(tuple(x), tuple(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


def _min_hash(grams: str, seed: int) -> Column:
    # a one-argument lambda: a second one would be taken for the element's index
    return F.array_min(F.transform(grams, lambda g: F.xxhash64(g, F.lit(seed))))


def candidate_pairs(records: DataFrame, block: list[str], bands: int, rows: int = BAND_ROWS, heavy: int = HEAVY) -> DataFrame:
    """(a, b) ids with a < b of records in one block that share a band; hot bands are split."""
    hashes = [_min_hash("grams", k) for k in range(bands * rows)]
    keys = F.array(*(F.xxhash64(F.lit(b), *hashes[b * rows : (b + 1) * rows]) for b in range(bands)))
    keyed = records.where(F.size("grams") > 0).select("id", *block, F.explode(keys).alias("band"))
    sizes = keyed.groupBy(*block, "band").agg(F.count(F.lit(1)).alias("n"))
    left, right = keyed.withColumnRenamed("id", "a"), keyed.withColumnRenamed("id", "b")
    return salted_join(left, right, [*block, "band"], heavy, (sizes, sizes)).where(F.col("a") < F.col("b")).select("a", "b").distinct()


def link_names(records: DataFrame, block: list[str], bands: int | None = None, heavy: int = HEAVY) -> DataFrame:
    """Verified pairs (a, b, score) of ``records`` (id, words, block columns)."""
    records = cut(records.withColumn("grams", name_grams("words")))
    pairs = candidate_pairs(records, block, bands or bands_for(), heavy=heavy)
    words = records.select("id", "words")
    sided = pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a")
    sided = sided.join(words.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
    return sided.select("a", "b", similarity("wa", "wb").alias("score")).where(F.col("score") >= SIMILARITY)


def _stars_of_rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The centres among a bounded number of open edges: nodes in falling rank, each one without a centre beside it."""
    edges = pd.concat(list(batches), ignore_index=True)
    beside: dict[int, list[int]] = {}
    place: dict[int, int] = {}
    for a, b, ra in zip(edges["a"], edges["b"], edges["place"], strict=True):
        beside.setdefault(a, []).append(b)
        place[a] = ra
    centres: set[int] = set()
    for a in sorted(place, key=place.__getitem__):
        if centres.isdisjoint(beside[a]):
            centres.add(a)
    yield pd.DataFrame({"id": pd.Series(sorted(centres), dtype="int64")})


def star_clusters(nodes: DataFrame, edges: DataFrame, rest_edges: int = REST_EDGES) -> DataFrame:
    """(id, centre) for every node; ``nodes``: id, weight (struct or number, larger leads), edges: a, b, score.

    Every round, an undecided node heavier than all its undecided neighbours
    becomes a centre and its neighbours become satellites, until no edge is
    open.  Rounds move only undecided edges, and the lineage is cut each time.
    When at most ``rest_edges`` directed edges are open, one task decides them
    in the order of weight, which gives what the rounds would give; so a path of
    falling weights takes no round a pair.
    """
    nodes = cut(nodes.select("id", F.struct("weight", "id").alias("rank")))
    both = edges.select("a", "b", "score").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    ranked = both.join(nodes.select(F.col("id").alias("a"), F.col("rank").alias("ra")), "a")
    ranked = cut(ranked.join(nodes.select(F.col("id").alias("b"), F.col("rank").alias("rb")), "b"))
    open_edges, centres = ranked.select("a", "b", "ra", "rb"), nodes.select("id").limit(0)
    while (n := open_edges.count()) > rest_edges:
        # a loses to b when some open neighbour is heavier; a centre is never beside another
        beaten = open_edges.groupBy("a").agg(F.max((F.col("rb") > F.col("ra")).cast("int")).alias("beaten"))
        won = cut(beaten.where("beaten = 0").select(F.col("a").alias("id")))
        satellites = open_edges.join(won.withColumnRenamed("id", "b"), "b", "left_semi").select(F.col("a").alias("id"))
        gone = cut(won.unionByName(satellites).distinct())
        centres = centres.unionByName(won)
        open_edges = open_edges.join(gone.withColumnRenamed("id", "a"), "a", "left_anti")
        open_edges = cut(open_edges.join(gone.withColumnRenamed("id", "b"), "b", "left_anti"))
    if n:
        heaviest = Window.orderBy(F.desc("ra"))  # at most rest_edges rows
        placed = open_edges.coalesce(1).select("a", "b", F.dense_rank().over(heaviest).alias("place"))
        centres = centres.unionByName(placed.mapInPandas(_stars_of_rest, "id long"))
    centres = cut(centres)
    led = ranked.join(centres.withColumnRenamed("id", "b"), "b", "left_semi")
    led = led.join(centres.withColumnRenamed("id", "a"), "a", "left_anti")
    best = led.groupBy("a").agg(F.max_by("b", F.struct("score", "rb")).alias("centre"))
    return nodes.join(best.withColumnRenamed("a", "id"), "id", "left").select("id", F.coalesce("centre", "id").alias("centre"))


def best_forms(readings: DataFrame, key: str) -> DataFrame:
    """One spelling a key: ``words`` of the fullest reading that fits the prevailing one.

    ``readings``: key, name, n (how often), t (how often as the key's own
    entity's).  The prevailing reading is the most frequent trusted one; other
    readings of the key may replace an initial or nickname by the full word.
    """
    counted = readings.where(F.col("name").isNotNull())
    forms = counted.withColumn("words", name_words("name")).where(F.size("words") > 0)
    forms = cut(forms.groupBy(key, "words").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))  # read twice
    core = forms.groupBy(key).agg(F.max_by("words", F.struct("t", "n", F.size("words"), "words")).alias("core"), F.max("t").alias("most"))
    full = F.aggregate("words", F.lit(0), lambda acc, w: acc + F.when(F.length(w) > 4, 1).otherwise(0))
    core_full = F.aggregate("core", F.lit(0), lambda acc, w: acc + F.when(F.length(w) > 4, 1).otherwise(0))
    scored = forms.join(core, key).where((F.col("words") == F.col("core")) | (full > core_full))
    scored = scored.withColumn("fit", F.when(F.col("words") == F.col("core"), 1.0).otherwise(similarity("words", "core")))
    rank = F.struct(F.least(full, F.lit(2)), "t", "n", "words")
    return scored.where(F.col("fit") >= SIMILARITY).groupBy(key).agg(F.max_by("words", rank).alias("words"))
