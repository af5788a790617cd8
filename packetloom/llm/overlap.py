"""Problem 5: records of evaluation splits that also lie in the training split.

A record's visit is one string of its whole normalised values, each field in a
slot of its own: species, home world, visa class, sponsor and purpose.  Two
records describe one visit when their strings are within ``k`` edits, their
days at most ``DAYS`` apart (another visit of the same applicant often differs
in nothing but a day months away) and their names can be one person's.

The edit condition is a segment join: the evaluation string is cut into k + 1
segments, so k edits leave one of them whole, and that segment must occur in
the training string at an allowed position.  A segment is matched together with
a window of days, and pieces that many records share are split over tasks
(``skew.salted_join``).  ``levenshtein`` with a threshold is banded dynamic
programming inside the JVM; it verifies a pair where the pieces meet, before
anything else is shuffled.

A field, or the day, that is missing in one record is left out of both, and
costs ``MISSING`` edits.  For that, records come under each set of missing
fields that the other table holds; there are at most 22 such sets that k edits
can pay for.

Equal records are folded first and multiplied out last, so repeated deliveries
cost one search.  Defined results: a record without a name meets only records
without one; values longer than their slot stand for themselves by a hash, so
they agree whole or not at all; empty tables give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm import variants
from packetloom.operators.skew import HEAVY, salted_join
from packetloom.session import cut

EDITS, DAYS, MISSING = 5, 10, 2
#: Slots of the string: field and width.
SLOTS = (("species_code", 24), ("home_world", 24), ("visa_class", 8), ("sponsor_id", 8), ("declared_purpose", 24))
LENGTH = sum(w for _, w in SLOTS)
DAY_BIT = 1 << len(SLOTS)


def day_of(text: Column) -> Column:
    """The day of a written date: year first, or day first when slashes or dots are used."""
    tidy = F.regexp_replace(F.regexp_replace(text, r"\s+", ""), r"[./]", "-")
    return F.coalesce(F.try_to_date(tidy, "yyyy-MM-dd"), F.try_to_date(tidy, "dd-MM-yyyy"), F.try_to_date(tidy, "MM-dd-yyyy"))


def visits(records: DataFrame) -> DataFrame:
    """record_id, name, day, slots (padded values, the pad alone for a missing one), missing (bits of missing fields and day)."""
    day = day_of(F.col("arrival_date"))
    slots, missing = [], F.when(day.isNull(), DAY_BIT).otherwise(0)
    for i, (field, width) in enumerate(SLOTS):
        tidy = F.regexp_replace(F.lower(F.coalesce(field, F.lit(""))), "[^a-z0-9]+", "")
        tidy = F.regexp_replace(tidy, "^spn(?=[0-9])", "") if field == "sponsor_id" else tidy
        tidy = F.when(F.length(tidy) > width, F.substring(F.sha2(tidy, 256), 1, width)).otherwise(tidy)
        slots.append(F.rpad(tidy, width, "_"))
        missing = missing + F.when(tidy == "", 1 << i).otherwise(0)
    return records.select("record_id", F.coalesce("applicant_name", F.lit("")).alias("name"), day.alias("day"), F.array(*slots).alias("slots"), missing.alias("missing"))


def masked_text(slots: Column, mask: Column) -> Column:
    """The slots as one string, those in the mask blank."""
    return F.concat(*(F.when(mask.bitwiseAND(1 << i) != 0, F.lit("_" * w)).otherwise(slots[i]) for i, (_, w) in enumerate(SLOTS)))


def _affordable(k: int) -> list[int]:
    """Sets of missing fields that ``k`` edits can pay for."""
    return [m for m in range(2 * DAY_BIT) if m.bit_count() * MISSING <= k]


def _masks(visits: DataFrame, k: int) -> list[int]:
    """The affordable sets of missing fields that occur; at most 22."""
    return [r["missing"] for r in visits.where(F.col("missing").isin(*_affordable(k))).select("missing").distinct().collect()]


def _segments(length: int, k: int) -> list[tuple[int, int]]:
    """(start, width) of k + 1 even segments."""
    cuts = [length * i // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def under_masks(visits: DataFrame, masks: list[int], k: int) -> DataFrame:
    """id, day, missing, mask, text: each visit under its own missing fields joined with each of ``masks``."""
    wanted = sorted({m | o for m in _affordable(k) for o in masks} & set(_affordable(k)))
    unions = F.array_distinct(F.array(*(F.col("missing").bitwiseOR(F.lit(m)) for m in sorted(masks)))) if masks else F.array().cast("array<int>")
    spread = visits.select("id", "day", "slots", "missing", F.explode(unions).alias("mask")).where(F.col("mask").isin(*wanted))
    return spread.select("id", "day", "missing", "mask", masked_text(F.col("slots"), F.col("mask")).alias("text"))


def segment_pairs(evaluation: DataFrame, training: DataFrame, length: int, k: int = EDITS, days: int = DAYS, heavy: int = HEAVY) -> DataFrame:
    """(e, t, edits) of strings within ``k`` edits and ``days`` days; both inputs: id, text, day, missing, mask.

    ``text`` has ``length`` characters.  Pairs meet under the mask that joins
    both sets of missing fields; each costs ``MISSING`` of the edits.  Edits
    before a segment shift it by at most k, and by no more than the segments on
    either side can take: segment i of k + 1 needs shifts of at most
    min(i, k - i), so positions within that distance are enough.
    """
    timeless = F.col("mask").bitwiseAND(DAY_BIT) != 0
    bucket = F.when(timeless, F.lit(None)).otherwise(F.floor(F.datediff("day", F.lit("1970-01-01")) / (days + 1)))
    segments = _segments(length, k)
    cut_up = F.array(*(F.struct(F.lit(i).alias("i"), F.substring("text", a + 1, w).alias("piece")) for i, (a, w) in enumerate(segments)))
    none = F.lit(-(10**6)).cast("long")
    wanted = evaluation.select(F.col("id").alias("e"), F.col("text").alias("te"), F.col("day").alias("de"), F.col("missing").alias("me"), "mask", F.coalesce(bucket, none).alias("bucket"), F.inline(cut_up))
    places = [
        F.struct(F.lit(i).alias("i"), F.substring("tt", p + 1, w).alias("piece"))
        for i, (a, w) in enumerate(segments)
        for p in range(max(0, a - min(i, k - i)), min(length - w, a + min(i, k - i)) + 1)
    ]
    around = F.when(timeless, F.array(none)).otherwise(F.array(bucket - 1, bucket, bucket + 1))
    offered = training.select(F.col("id").alias("t"), F.col("text").alias("tt"), F.col("day").alias("dt"), F.col("missing").alias("mt"), "mask", F.explode(around).alias("bucket"))
    offered = offered.select("t", "tt", "dt", "mt", "mask", "bucket", F.inline(F.array_distinct(F.array(*places))))
    met = salted_join(wanted, offered, ["mask", "bucket", "i", "piece"], heavy)
    met = met.where((F.col("me").bitwiseOR(F.col("mt")) == F.col("mask")) & (F.col("de").isNull() | F.col("dt").isNull() | (F.abs(F.datediff("de", "dt")) <= days)))
    edits = F.levenshtein("te", "tt", k)
    paid = F.bit_count(F.col("mask")) * MISSING
    close = met.select("e", "t", F.when(edits >= 0, edits + paid).alias("edits")).where(F.col("edits") <= k)
    return close.distinct()


def overlaps(evaluation: DataFrame, training: DataFrame, k: int = EDITS, days: int = DAYS, heavy: int = HEAVY) -> DataFrame:
    """(eval_id, train_id, edits) of the records that describe the same visit of one person."""
    sides = []
    for records in (evaluation, training):
        rows = cut(visits(records).withColumn("id", F.xxhash64("name", "slots", "day")))
        sides.append((rows.select("record_id", "id"), cut(rows.groupBy("id", "name", "slots", "day", "missing").agg(F.count(F.lit(1)).alias("copies")))))
    (eval_rows, eval_visits), (train_rows, train_visits) = sides
    eval_masks, train_masks = _masks(eval_visits, k), _masks(train_visits, k)
    close = segment_pairs(under_masks(eval_visits, train_masks, k), under_masks(train_visits, eval_masks, k), LENGTH, k, days, heavy)
    named = close.join(eval_visits.select(F.col("id").alias("e"), F.col("name").alias("ne")), "e").join(train_visits.select(F.col("id").alias("t"), F.col("name").alias("nt")), "t")
    words = named.withColumn("wa", variants.name_words("ne")).withColumn("wb", variants.name_words("nt"))
    same = cut(words.where((F.col("ne") == F.col("nt")) | (variants.similarity("wa", "wb") >= variants.SIMILARITY)).select("e", "t", "edits"))
    # every pair of copies is a row of the result; a text of very many copies is split
    copies = eval_visits.select(F.col("id").alias("e"), F.col("copies").alias("n"))
    out = salted_join(same, eval_rows.select(F.col("record_id").alias("eval_id"), F.col("id").alias("e")), ["e"], heavy, (None, copies))
    pairs = same.join(copies, "e").groupBy("t").agg(F.sum("n").alias("n"))
    copies = train_visits.select(F.col("id").alias("t"), F.col("copies").alias("n"))
    return salted_join(out, train_rows.select(F.col("record_id").alias("train_id"), F.col("id").alias("t")), ["t"], heavy, (pairs, copies)).select("eval_id", "train_id", "edits")
