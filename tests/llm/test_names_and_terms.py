import random

import pytest
from pyspark.sql import functions as F

from packetloom.llm import canonical, names, overlap, variants

TERMS = [(1, "world", "Alder Station", "Hookhaven"), (2, "world", "Alder Landing", None), (3, "world", "Tovar-9b", None), (4, "world", "Tovar-9c", None), (5, "visa", "KX-1", "short bench permit"), (6, "visa", "KX-2", None), (7, "visa", "CARE-3", None), (8, "world", "Bastion of Reeds", None)]
SCHEMA = "term_id int, field_name string, canonical string, also_known_as string"


def osa(a, b):
    """Restricted edit distance by full dynamic programming: an upper bound of the unrestricted one."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_distance_is_a_metric_and_bounded():
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(60)]
    d = canonical.damerau_levenshtein
    assert d("ca", "abc") == 2 and osa("ca", "abc") == 3
    for _ in range(3000):
        a, b, c = (rng.choice(words) for _ in range(3))
        assert d(a, b) == d(b, a) <= osa(a, b) and (d(a, b) == 0) == (a == b) and d(a, c) <= d(a, b) + d(b, c)
        assert canonical.bag_distance(a, b) <= d(a, b)


def test_tree_returns_every_entry_within():
    rng = random.Random(2)
    words = list({"".join(rng.choice("abcd") for _ in range(rng.randint(3, 8))) for _ in range(300)})
    tree = canonical.BKTree()
    for i, w in enumerate(words):
        tree.add(w, i)
    for _ in range(100):
        q, k = "".join(rng.choice("abcd") for _ in range(5)), rng.randint(0, 3)
        assert sorted(x for _, x, _ in tree.within(q, k)) == sorted(w for w in words if canonical.damerau_levenshtein(q, w) <= k)


VALUES = {
    ("world", "alder_statoin"): 1, ("world", "from Alder Station colony"): 1, ("world", "HOOKHAVEN"): 1, ("world", "Station, Alder"): 1, ("world", "Ald. Landing"): 2, ("world", "Tovar-9"): 0, ("world", "T0var-9b"): 3, ("world", "Bastion Ree."): 8,
    ("world", "Alder St@tiori"): 1, ("world", "in transit"): 0, ("world", "???"): 0, ("visa", "kx 01"): 5, ("visa", "Kx II"): 6, ("visa", "type KX no. 2"): 6, ("visa", "C A R E-3"): 7, ("visa", "KX-9"): 0, ("visa", "Short Bench Permit"): 5, ("visa", "RQ-88"): 0, ("nofield", "x"): 0,
    ("world", "x" * 5000): 0,
}


@pytest.mark.parametrize("tree_entries", [100, 3])
def test_values_map_alike_in_one_tree_and_in_shards(spark, tree_entries):
    values = spark.createDataFrame(list(VALUES), "field_name string, value string")
    terms = spark.createDataFrame(TERMS + TERMS[:2], SCHEMA)
    out = canonical.map_to_terms(values, terms, tree_entries=tree_entries, block_values=4)
    assert {(r["field_name"], r["value"]): r["term_id"] for r in out.collect()} == VALUES


@pytest.mark.parametrize("tree_entries", [100, 1])
def test_an_exact_entry_beats_a_look_alike_of_another_shard(spark, tree_entries):
    words = ["boron", "cobalt", "orchid", "olive", "onyx", "harbor", "lotus", "falcon"]
    terms = [(2 * i + k, "world", f"{w if k == 1 else w.replace('o', '0')} gate", None) for i, w in enumerate(words) for k in (1, 2)]
    values = spark.createDataFrame([("world", f"{w.upper()} GATE") for w in words], "field_name string, value string")
    out = canonical.map_to_terms(values, spark.createDataFrame(terms, SCHEMA), tree_entries=tree_entries)
    assert {r["value"]: r["term_id"] for r in out.collect()} == {f"{w.upper()} GATE": 2 * i + 1 for i, w in enumerate(words)}


def test_terms_edge_cases(spark):
    terms = spark.createDataFrame(TERMS, SCHEMA)
    rows = spark.createDataFrame([("s", 1, "visa", "KX-1"), ("s", 2, "visa", "kx1"), ("s", 3, "world", "zz")], "src string, row_id long, field_name string, value string")
    for limit in (100, 0):  # broadcast and salted lookup
        got = {r["row_id"]: (r["canonical"], r["term_id"]) for r in _with(rows, terms, limit).collect()}
        assert got == {1: (True, 5), 2: (False, 5), 3: (False, 0)}
    assert _with(rows.limit(0), terms, 10).count() == 0
    assert {r["term_id"] for r in _with(rows, terms.limit(0), 10).collect()} == {0}


def _with(rows, terms, limit):
    return canonical.with_terms(rows, terms, lookup_rows=limit)


SAME = [
    ("Felquist Nompiknom", "NOMPIKNOM, F. Q."), ("Zephrolun Bennidgil", "Zephrolin Bennidgil"), ("Dr. Rhovenne Lit Bumfap", "Rhovenne Litbumfap"), ("Felie Nompiknom", "Felquist Nompiknom"), ("Bicsandre Refrefmak", "Bixandre Refrefmak"),
    ('Yestrovin "Yesy" Nompiknom', "Nompiknom Yestrovin"), ("Selkwith Nutdurkuf", "Selquith Nutdurkuf"), ("Orquid@n Rin'muprin", "Orquidan Rinmuprin"), ("Felquist Quenta Nompiknom", "Felquist Nompiknom"),
]
OTHER = [("Felquist Nompiknom", "Pelwisset Nompiknom"), ("J. Merdalmer", "Eltharion Jexam Merdalmer"), ("Felquist Abre Fuvkegfuv", "Felquist Quenta Fuvkegfuv"), ("Thessaroy Nompiknom", "Thessaroy Fuvkegfuv"), ("Zed", "Zed Zarnax"), ("", "A B")]


@pytest.mark.parametrize(("a", "b", "same"), [(*p, True) for p in SAME] + [(*p, False) for p in OTHER])
def test_name_similarity(a, b, same):
    x, y = names.words_of(a), names.words_of(b)
    assert (names.name_similarity(x, y) >= variants.SIMILARITY) == same == (names.name_similarity(y, x) >= variants.SIMILARITY)


def test_bands_reach_the_recall():
    for s, r in ((0.4, 0.98), (0.7, 0.9)):
        assert 1 - (1 - s**2) ** variants.bands_for(s, r, 2) >= r


def test_links_and_stars(spark):
    spellings = ["Felquist Nompiknom", "Felqiust Nompiknom", "F. Nompiknom", "Pelwisset Nompiknom", "", "Felquist Nompiknom"]
    records = spark.createDataFrame([(i, list(names.words_of(n)), b) for i, (n, b) in enumerate(zip(spellings, "aaaaab", strict=True))], "id long, words array<string>, block string")
    edges = variants.link_names(records, ["block"])
    assert {(r["a"], r["b"]) for r in edges.collect()} == {(0, 1), (0, 2), (1, 2)}
    weights = records.select("id", (10 - F.col("id")).alias("weight"))
    stars = {r["id"]: r["centre"] for r in variants.star_clusters(weights, edges).collect()}
    assert stars == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}
    assert variants.star_clusters(weights.limit(0), edges.limit(0)).count() == 0


def greedy_centres(n, weight, pairs):
    beside = {i: set() for i in range(n)}
    for a, b in pairs:
        beside[a].add(b)
        beside[b].add(a)
    centres = set()
    for i in sorted(range(n), key=lambda i: (-weight[i], -i)):
        if not beside[i] & centres:
            centres.add(i)
    return centres


@pytest.mark.parametrize(("n", "rest"), [(300, variants.REST_EDGES), (12, 0), (12, 6)])
def test_star_rounds_on_a_path(spark, n, rest):
    nodes = spark.createDataFrame([(i, n - i) for i in range(n)], "id long, weight long")
    edges = spark.createDataFrame([(i, i + 1, 0.9) for i in range(n - 1)], "a long, b long, score double")
    stars = {r["id"]: r["centre"] for r in variants.star_clusters(nodes, edges, rest).collect()}
    assert {i for i, c in stars.items() if i == c} == set(range(0, n, 2)) and all(abs(i - c) <= 1 for i, c in stars.items())


@pytest.mark.parametrize("rest", [variants.REST_EDGES, 100, 0])
def test_stars_of_a_random_graph(spark, rest):
    rng = random.Random(17)
    n = 120
    weight = [rng.randint(0, 9) for _ in range(n)]
    pairs = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(160)})
    nodes = spark.createDataFrame(list(enumerate(weight)), "id long, weight long")
    edges = spark.createDataFrame([(a, b, rng.random()) for a, b in pairs], "a long, b long, score double")
    stars = {r["id"]: r["centre"] for r in variants.star_clusters(nodes, edges, rest).collect()}
    assert {i for i, c in stars.items() if i == c} == greedy_centres(n, weight, pairs)
    assert all(i == c or tuple(sorted((i, c))) in set(pairs) for i, c in stars.items())


def test_hot_bands_lose_nothing(spark):
    rng = random.Random(3)
    forms = ["Felquist Nompiknom", "Zephrolin Bennidgil", "Rhovenne Litbumfap"]
    records = spark.createDataFrame([(i, list(names.words_of(rng.choice(forms) + rng.choice(["", "k", "n"]))), "a") for i in range(90)], "id long, words array<string>, block string")
    plain, split = ({tuple(r) for r in variants.link_names(records, ["block"], heavy=h).select("a", "b").collect()} for h in (10**6, 7))
    assert plain == split and len(plain) > 500


LABEL = "record_id long, case_id string, applicant_name string, species_code string, home_world string, visa_class string, sponsor_id string, arrival_date string, declared_purpose string, extra string"


def label(i, name="Zed Zarnax", sponsor="SPN-1234", day="2026-03-10", purpose="kiln inspection", visa="KX-1", species="ORION_GRAY", home="Low Meridian"):
    return (i, f"MIB-{i:06d}", name, species, home, visa, sponsor, day, purpose, "x")


def test_overlaps(spark, rows):
    train = spark.createDataFrame([label(1), label(2), label(3, day="2026-06-10"), label(4, name="Quill Orto"), label(5, day=None, name=None), label(6, purpose=None)], LABEL)
    held = spark.createDataFrame([label(11, sponsor="SPN-1294", day="12/03/2026"), label(12, name="ZARNAX, Z."), label(13, day=None, name=None), label(14, visa=None, sponsor=None, purpose=None, home=None)], LABEL)
    got = {(e, t) for e, t, _ in rows(overlap.overlaps(held, train))}
    assert got == {(11, 1), (11, 2), (12, 1), (12, 2), (12, 6), (11, 6), (13, 5)}
    assert overlap.overlaps(held.limit(0), train).count() == overlap.overlaps(held, train.limit(0)).count() == 0


@pytest.mark.parametrize("heavy", [20, 100_000])
def test_segment_join_equals_brute_force(spark, heavy):
    rng = random.Random(5)
    base = ["".join(rng.choice("ab") for _ in range(12)) for _ in range(30)]

    def side(start):
        out = []
        for i in range(160):
            # a third are copies of one text, so that its pieces are hot
            t = list(base[0] if i % 3 == 0 else rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(12)
                if rng.random() < 0.5:
                    t[k] = rng.choice("abc")
                else:
                    t = t[:k] + t[k + 1 :] + [rng.choice("abc")]
            out.append((start + i, "".join(t), None if rng.random() < 0.1 else rng.randint(0, 30)))
        df = spark.createDataFrame(out, "id long, text string, n int").select("id", "text", F.date_add(F.lit("2026-01-01").cast("date"), F.col("n")).alias("day"))
        missing = F.when(F.col("day").isNull(), overlap.DAY_BIT).otherwise(0)
        return df.withColumn("missing", missing).cache()

    e, t = side(0), side(1000)
    k, days = 4, 4
    masks = [0, overlap.DAY_BIT]

    def spread(df):
        return df.select("*", F.explode(F.array_distinct(F.array(*(F.col("missing").bitwiseOR(F.lit(m)) for m in masks)))).alias("mask"))

    got = {(r["e"], r["t"], r["edits"]) for r in overlap.segment_pairs(spread(e), spread(t), 12, k, days, heavy).collect()}
    a, b = e.toDF("e", "te", "de", "me"), t.toDF("t", "tt", "dt", "mt")
    blind = F.col("de").isNull() | F.col("dt").isNull()
    edits = F.levenshtein("te", "tt") + F.when(blind, overlap.MISSING).otherwise(0)
    near = (edits <= k) & (blind | (F.abs(F.datediff("de", "dt")) <= days))
    want = {(r["e"], r["t"], r["edits"]) for r in a.join(b, near).select("e", "t", edits.alias("edits")).collect()}
    assert got == want and want


def test_overlaps_of_whole_values(spark, rows):
    """Values decide by all their letters, a missing field by those left, a missing day by the rest."""
    train = spark.createDataFrame([label(1, purpose="kiln inspection"), label(2, home="Low Meridian-7b"), label(3, day="not a day"), label(4, purpose="x" * 5000)], LABEL)
    held = spark.createDataFrame([label(11, purpose="kiln inspectors of the harbour"), label(12), label(13, purpose="x" * 4999 + "y"), label(14, purpose="x" * 5000), label(15, sponsor=None, visa=None, purpose=None)], LABEL)
    got = {(e, t) for e, t, _ in rows(overlap.overlaps(held, train))}
    # home worlds two edits apart are near, 3 pays two edits for its day, 15 lacks too much
    assert got == {(12, 1), (12, 2), (12, 3), (14, 4)}
