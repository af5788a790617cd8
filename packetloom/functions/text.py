"""Column builders for strings, dates, flags and keys.

All of them are JVM expressions that Catalyst can push down and fold.  Blanks
are any white space, which Spark's ``trim`` alone would not remove.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CASE_ID = r"^MIB-[0-9]{6}$"
SPONSOR_ID = r"^SPN-[0-9]{4}$"
FALLBACK_DAY = "1900-01-01"
#: Letters read in place of digits, and the digits; fixed values.
READ_AS_DIGITS = ("OQCDILSB", "00001158")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """Lower case, runs of white space as one blank, null as the empty string."""
    return strip(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def ocr_key(text: Column) -> Column:
    """Only letters and digits, lower case."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def repaired_digits(text: Column, prefix: str, width: int) -> Column:
    """``prefix-digits`` from a text in which letters stand for some digits; null when it is no such id."""
    read = F.regexp_extract(strip(text), rf"(?i)^{prefix}[\s._-]*([0-9OQCDILSB]{{{width}}})$", 1)
    digits = F.translate(read, *READ_AS_DIGITS)
    return F.when(digits.rlike(rf"^[0-9]{{{width}}}$"), F.concat(F.lit(f"{prefix}-"), digits))


def safe_text(text: Column, fallback: str) -> Column:
    tidy = strip(text)
    return F.when(tidy != "", tidy).otherwise(fallback)


def safe_day(text: Column) -> Column:
    """An existing ISO day or the fallback day."""
    tidy = strip(text)
    return F.when(tidy.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(tidy, "yyyy-MM-dd").isNotNull(), tidy).otherwise(FALLBACK_DAY)


def safe_share(value: Column) -> Column:
    """A finite number in [0, 1] or 0."""
    return F.when(~F.isnan(value) & value.between(0, 1), value).otherwise(0.0)


def written_day(text: Column) -> Column:
    """A day written year first, month first or day first (tried in this order), with one- or two-digit parts."""
    tidy = strip(text)
    return F.coalesce(
        F.when(tidy.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(tidy, "yyyy-M-d")),
        F.when(tidy.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.coalesce(F.try_to_date(tidy, "M/d/yyyy"), F.try_to_date(tidy, "d/M/yyyy"))),
    )


def flag_set(text: Column) -> Column:
    """The sorted distinct members of a pipe-delimited set; blanks inside become underscores."""
    parts = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\|"), lambda p: F.regexp_replace(strip(p), r"\s+", "_"))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda p: ~p.isin("", "none", "null", "unknown"))))


def flag_text(text: Column) -> Column:
    flags = flag_set(text)
    return F.when(F.size(flags) == 0, "none").otherwise(F.array_join(flags, "|"))


def is_unknown(value: Column) -> Column:
    """Nothing, a word for it, or a placeholder id or day."""
    return collapse(value).isin("", "unknown", "null", "spn-0000", FALLBACK_DAY)


def age_days(day: Column, snapshot: str) -> Column:
    return F.datediff(F.lit(snapshot).cast("date"), day)


def hash_key(identifier: Column, seed: str) -> Column:
    """sha256 of seed, NUL and id in hex: a stable random order."""
    return F.sha2(F.concat(F.lit(seed), F.char(F.lit(0)), identifier), 256)


def redacted(token: Column, allowed: Sequence[str], prefixes: Sequence[str]) -> Column:
    """Bare tokens outside ``allowed`` become "other"; ``prefix:suffix`` keeps a plain suffix of known prefixes only."""
    head = F.substring_index(token, ":", 1)
    tail = F.regexp_replace(token, "^[^:]*:", "")
    named = F.when(~head.isin(*prefixes), "other").when(tail.rlike("^[a-z_]{1,40}$"), F.concat_ws(":", head, tail)).otherwise(F.concat(head, F.lit(":*")))
    return F.when(token.contains(":"), named).when(token.isin(*allowed), token).otherwise("other")


def safe_divide(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def clip(value: Column, low: float, high: float) -> Column:
    # greatest and least skip nulls, so a null must be kept apart
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def digits_apart(a: Column, b: Column) -> Column:
    """Positions at which two ids of equal length differ; null for other ids."""
    marks = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(marks, F.lit(0), lambda s, x: s + x))
