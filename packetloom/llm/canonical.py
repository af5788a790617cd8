"""Problem 2: free-entered values mapped to the entries of a reference list.

Distinct values meet BK-trees over the reference entries.  The metric is the
unrestricted Damerau-Levenshtein distance, which obeys the triangle
inequality (the cheaper "optimal string alignment" variant does not), so the
pruned search returns every entry within the threshold.  The tree holds two
spellings of each name: plain, and folded by glyphs that readers and scanners
confuse, where ``rn`` and ``m`` cost nothing.

A reference list of at most ``tree_entries`` entries is one tree, built once in
each Python worker from a size-checked broadcast.  A longer list is split into
shards of that many entries; distinct values are cut into blocks, each (shard,
block) pair is one bounded task, every task keeps its shard's winners, and the
winners merge in one aggregate.  Only distinct values travel, so a value that
fills a third of all rows is searched once.

Defined results: null and blank values are skipped; a value without letters or
digits maps to nothing (0); equally near entries are told apart by their bag
distance, and a tie that remains maps to nothing; an empty reference list maps
every value to 0; repeated reference rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.session import small_rows

TREE_ENTRIES = 20_000
BLOCK_VALUES = 20_000

#: Words written around a value that are not part of it; fixed values.
LEADING = ("sp", "of the", "a", "an", "from", "born on", "world of", "visa", "class", "type", "species", "planet")
TRAILING = ("colony", "home", "visa", "permit class")
#: Small words that abbreviating writers leave out; fixed values.
SMALL_WORDS = {"of", "the", "no"}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9}
#: Glyphs taken for one another, longer groups first; fixed values.
GLYPHS = (("rn", "m"), ("ri", "n"), ("li", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"))
GLYPH_FOLD = str.maketrans({"0": "o", "1": "l", "!": "l", "|": "l", "i": "l", "5": "s", "$": "s", "@": "a", "6": "b", "8": "b"})

_LEAD = re.compile(r"^(?:" + "|".join(LEADING) + r")\b[.:]?\s+")
_TRAIL = re.compile(r"[\s(]+(?:" + "|".join(TRAILING) + r")\)?$")


def _plain(text: str) -> str:
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c)).casefold().strip()


def compact(text: str) -> str:
    return re.sub(r"[^a-z0-9@!$|]+", "", text)


def folded(key: str) -> str:
    for group, single in GLYPHS:
        key = key.replace(group, single)
    return key.translate(GLYPH_FOLD)


def _code(text: str) -> str | None:
    """``letters-number`` codes in one notation: no padding, no Roman numerals; None for other text."""
    tight = re.sub(r"[^a-z0-9]+", " ", text).replace(" no ", " ").strip()
    m = re.fullmatch(r"((?:[a-z] )*[a-z]+)[ ]?0*([0-9]+)", tight) or re.fullmatch(r"([a-z]{2,})[ ]([ivx]+)", tight)
    if not m:
        return None
    number = m[2] if m[2].isdigit() else ROMAN.get(m[2])
    return None if number is None else f"{m[1].replace(' ', '')}{number}"


def bare(text: str) -> str:
    """The value without the words around it, parts swapped back at a comma."""
    text = _plain(text).strip("()[]\"' ")
    for _ in range(3):
        shorter = _LEAD.sub("", _TRAIL.sub("", text)).strip("()[] ")
        if shorter == text or not compact(shorter):
            break
        text = shorter
    m = re.fullmatch(r"([^,]+),\s*([^,]+)", text)
    return f"{m[2]} {m[1]}" if m else text


def damerau_levenshtein(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and transpositions, without the restriction to disjoint edits."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    far, last = len(a) + len(b), {}
    rows = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, match = [far, i], 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            if x == y:
                match = j
            swap = rows[k][m] + (i - k - 1) + 1 + (j - m - 1)
            row.append(min(rows[i][j] + (x != y), row[j] + 1, rows[i][j + 1] + 1, swap))
        last[x] = i
        rows.append(row)
    return rows[-1][-1]


def bag_distance(a: str, b: str) -> int:
    """A lower bound of the edit distance from character counts; orders entries at equal distance."""
    more = {}
    for c in a:
        more[c] = more.get(c, 0) + 1
    for c in b:
        more[c] = more.get(c, 0) - 1
    return max(sum(v for v in more.values() if v > 0), -sum(v for v in more.values() if v < 0))


def radius(key: str) -> int:
    """Edits allowed for a key of this length: none below five characters, three from ten on."""
    return (0, 0, 0, 0, 0, 1, 2, 2, 2, 2)[len(key)] if len(key) < 10 else 3


@lru_cache(100_000)
def letters_of(key: str) -> int:
    """The set of a key's characters as bits; folding them together only lowers the bound made of it."""
    mask = 0
    for c in key:
        mask |= 1 << (ord(c) & 127)
    return mask


class BKTree:
    """Burkhard-Keller tree: a child's subtree lies at one exact distance from its parent."""

    def __init__(self) -> None:
        self.root: tuple[str, set, dict] | None = None

    def add(self, key: str, term: int) -> None:
        if self.root is None:
            self.root = (key, {term}, {})
            return
        node = self.root
        while True:
            d = damerau_levenshtein(key, node[0])
            if d == 0:
                node[1].add(term)
                return
            child = node[2].get(d)
            if child is None:
                node[2][d] = (key, {term}, {})
                return
            node = child

    def within(self, key: str, limit: int) -> list[tuple[int, str, set]]:
        """Every (distance, key, terms) at ``limit`` or less.

        A node that lies too far by its length or letters for itself and, by the
        triangle inequality, for all its children is left without its distance.
        """
        found, open_nodes, mask, size = [], [self.root] if self.root else [], letters_of(key), len(key)
        while open_nodes:
            at, terms, children = open_nodes.pop()
            other = letters_of(at)
            least = max(abs(size - len(at)), (mask & ~other).bit_count(), (other & ~mask).bit_count())
            if least - limit > (max(children) if children else 0):
                continue
            d = damerau_levenshtein(key, at)
            if d <= limit:
                found.append((d, at, terms))
            open_nodes += [child for step, child in children.items() if d - limit <= step <= d + limit]
        return found


#: Forms that an entry is found by at distance 0, in the order of their rank.
CODE, SHORT, EXACT, NEAR = range(4)


class TermIndex:
    """One field's reference entries as BK-trees.

    Two trees hold the plain and the glyph-folded keys; a third holds the
    derived forms of an entry (its code, its abbreviations, its key), each
    marked by its kind, which are met at distance 0 only.
    """

    def __init__(self) -> None:
        self.raw, self.fold, self.forms = BKTree(), BKTree(), BKTree()

    def form(self, kind: int, text: str) -> set:
        """The terms that have the form; the tree's search with a radius of 0."""
        return next((terms for _, _, terms in self.forms.within(f"{kind}{text}", 0)), set())

    def add(self, term: int, name: str) -> None:
        text = _plain(name)
        code = _code(text.replace("_", " "))
        if code and len(code) < 8 and not re.search(r"[a-z]{5}", code):
            self.forms.add(f"{CODE}{code}", term)
        key = compact(text)
        if not key:
            return
        self.forms.add(f"{EXACT}{key}", term)
        self.raw.add(key, term)
        self.fold.add(folded(key), term)
        words = [w for w in re.split(r"[\s_]+", text) if w not in SMALL_WORDS]
        cuts = [[compact(w), *(w[:n] + "." for n in (2, 3, 4, 5) if n < len(w))] for w in words[:4]]
        for form in product(*cuts):
            if any(p.endswith(".") for p in form):
                self.forms.add(f"{SHORT}{' '.join(form)}", term)

    def search(self, value: str) -> list[tuple[int, int, int, int]]:
        """(kind, distance, bag distance, term) of the nearest entries within the radius.

        The kind is that of the match: 0 code, 1 short form, 2 exact, 3 tree.  A
        lower kind goes before a higher one whatever the distance.
        """
        text = bare(value)
        code = _code(text)
        if code and (terms := self.form(CODE, code)):
            return [(CODE, 0, 0, t) for t in terms]
        words = [w for w in re.split(r"[\s_]+", text) if w not in SMALL_WORDS]
        if any(w.endswith(".") for w in words):
            form = " ".join(w if w.endswith(".") else compact(w) for w in words)
            if terms := self.form(SHORT, form):
                return [(SHORT, 0, 0, t) for t in terms]
        key = compact(text)
        if terms := self.form(EXACT, key):
            return [(EXACT, 0, 0, t) for t in terms]
        best: dict[int, tuple[int, int]] = {}
        for tree, k in ((self.raw, key), (self.fold, folded(key))):
            for d, at, terms in tree.within(k, radius(k + "xx")):
                if radius(at) < d:  # the entry's own length decides
                    continue
                score = (d, bag_distance(k, at))
                for t in terms:
                    best[t] = min(best.get(t, score), score)
        if not best:
            return []
        top = min(best.values())
        return [(NEAR, *score, t) for t, score in best.items() if score == top]


def _build(terms: Iterable[tuple[str, int, str]]) -> dict[str, TermIndex]:
    out: dict[str, TermIndex] = {}
    for field, term, name in terms:
        if name and name.strip():
            out.setdefault(field, TermIndex()).add(term, name)
    return out


@lru_cache(2)
def _built(terms: tuple[tuple[str, int, str], ...]) -> dict[str, TermIndex]:
    """The trees of a whole list, kept by the worker for its next tasks."""
    return _build(terms)


_MATCH = "field_name string, value string, kind int, distance int, bag int, term_id int"


def _winners(index: dict[str, TermIndex], values: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for field, value in zip(values["field_name"], values["value"], strict=True):
        found = sorted(index[field].search(value)) if field in index else []
        rows += [(field, value, *hit) for hit in found[:2]]  # two suffice to see a tie
    return pd.DataFrame(rows, columns=["field_name", "value", "kind", "distance", "bag", "term_id"])


def _names(terms: DataFrame) -> DataFrame:
    """(field_name, term_id, name) of canonical spellings and other names, each once."""
    named = terms.select("field_name", "term_id", F.explode(F.array("canonical", "also_known_as")).alias("name"))
    return named.where(F.col("name").isNotNull()).distinct()


def map_to_terms(values: DataFrame, terms: DataFrame, tree_entries: int = TREE_ENTRIES, block_values: int = BLOCK_VALUES) -> DataFrame:
    """``values`` (field_name, value; distinct) with ``term_id``, 0 when no entry or no single one is nearest.

    ``terms``: term_id, field_name, canonical, also_known_as.
    """
    values = values.select("field_name", "value")
    spark, names = values.sparkSession, _names(terms)
    listed = small_rows(names, tree_entries)
    if listed is not None:
        shared = spark.sparkContext.broadcast(tuple(sorted(tuple(r) for r in listed)))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = _built(shared.value)
            for batch in batches:
                yield _winners(index, batch)

        # a given number of partitions, or adaptive execution would put all distinct values into one task
        found = values.repartition(spark.sparkContext.defaultParallelism, "field_name", "value").mapInPandas(search, _MATCH)
    else:
        shards = -(-names.count() // tree_entries)
        blocks = max(1, -(-values.count() // block_values))
        left = names.withColumn("__shard", F.pmod(F.xxhash64("field_name", "term_id", "name"), F.lit(shards)).cast("int"))
        left = left.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = values.withColumn("__block", F.pmod(F.xxhash64("field_name", "value"), F.lit(blocks)).cast("int"))
        right = right.withColumn("__shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

        def search_shard(names_pdf: pd.DataFrame, values_pdf: pd.DataFrame) -> pd.DataFrame:
            index = _build(zip(names_pdf["field_name"], names_pdf["term_id"], names_pdf["name"], strict=True))
            return _winners(index, values_pdf)

        found = left.groupBy("__shard", "__block").cogroup(right.groupBy("__shard", "__block")).applyInPandas(search_shard, _MATCH)
    hits = F.array_sort(F.collect_set(F.struct("kind", "distance", "bag", "term_id")))
    merged = found.groupBy("field_name", "value").agg(hits.alias("hits"))
    first, second = F.element_at("hits", 1), F.try_element_at("hits", F.lit(2))
    tied = second.isNotNull() & (second["kind"] == first["kind"]) & (second["distance"] == first["distance"]) & (second["bag"] == first["bag"])
    best = merged.select("field_name", "value", F.when(~tied, first["term_id"]).alias("term_id"), first["distance"].alias("distance"))
    return values.join(best, ["field_name", "value"], "left").withColumn("term_id", F.coalesce("term_id", F.lit(0)))


def free_entered(evidence: DataFrame, predictions: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(src, row_id, field_name, value) of the fields' values in both tables, blanks dropped."""
    seen = evidence.where(F.col("field_name").isin(*fields)).select(
        F.lit("candidate_evidence").alias("src"), F.col("cand_id").alias("row_id"), "field_name", "value"
    )
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields))
    read = predictions.select(F.lit("predictions").alias("src"), F.col("pred_id").alias("row_id"), F.inline(pairs))
    return seen.unionByName(read).where(F.col("value").rlike(r"\S"))


def with_terms(rows: DataFrame, terms: DataFrame, lookup_rows: int = 200_000) -> DataFrame:
    """``rows`` (field_name, value, ...) with ``canonical`` (true when spelled like an entry) and ``term_id``.

    The dictionary of distinct values is broadcast only when it has at most
    ``lookup_rows`` rows.  Beyond that both sides are salted by the row, so a
    value that fills a third of all rows is spread over many tasks.
    """
    exact = terms.groupBy("field_name", F.col("canonical").alias("value")).agg(F.min("term_id").alias("exact_id"))
    distinct = rows.select("field_name", "value").distinct()
    known = distinct.join(exact, ["field_name", "value"], "left")
    mapped = map_to_terms(known.where(F.col("exact_id").isNull()).select("field_name", "value"), terms)
    mapped = mapped.select("field_name", "value", "term_id", F.lit(False).alias("canonical"))
    spelled = known.where(F.col("exact_id").isNotNull()).select("field_name", "value", F.col("exact_id").alias("term_id"), F.lit(True).alias("canonical"))
    return lookup(rows, mapped.unionByName(spelled), ["field_name", "value"], lookup_rows)


def lookup(rows: DataFrame, dictionary: DataFrame, keys: list[str], limit: int, salts: int = 16) -> DataFrame:
    """Inner join of ``rows`` with a dictionary that has one row per key, safe against hot keys."""
    from packetloom.session import cut

    dictionary = cut(dictionary)
    if dictionary.count() <= limit:
        return rows.join(F.broadcast(dictionary), keys)
    salted: Column = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    spread = dictionary.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("__salt", salted).join(spread, [*keys, "__salt"]).drop("__salt")
