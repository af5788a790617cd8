from packetloom.llm import ocr

LINES = "line_id long, case_id string, page_index int, line_seq int, text string, block_num int, paragraph_num int"

PAGES = {
    "MIB-000001": [
        ["Harbour Office - PACKET MIB-000001", "STATEMENT OF THE BEARER", "The quarantine officer reviewed the regi-", "stry extract before the counter-", "seal keeper left. The rnanifest was", "complete.", "- 1 -"],
        ["Harbour 0ffice - PACKET MIB-000001", "The officer kept the manifest and the decontam-", "12/40", "- 2 -"],
        ["Harbour Office - PACKET MIB-000001", "ination registry for the officer.", "— 10 —", "- 3 -"],
    ],
    "MIB-000002": [["Harbour Office - PACKET MIB-000002", "The counter-seal keeper and the quarantine", "officer saw the manifest, the manifest and the", "registry. No decontamination was done.", "Page 1 of 1"], ["  ", None, ""]],
}


def frames(spark):
    rows, tokens, i = [], [], 0
    for case, pages in PAGES.items():
        for p, lines in enumerate(pages):
            for s, text in enumerate(lines):
                i += 1
                rows.append((i, case, p, s, text, 1, 2))
                tokens += [(w, 0.9) for w in (text or "").split()] * 3
    return spark.createDataFrame(rows, LINES), spark.createDataFrame(tokens, "text string, confidence double")


def text_of(spark):
    lines, _ = frames(spark)
    return {r["line_id"]: r["text"] for r in lines.collect()}


def test_kinds_of_lines(spark):
    lines, tokens = frames(spark)
    texts = text_of(spark)
    found = {(texts[r["line_id"]], r["kind"]) for r in ocr.findings(lines, tokens).collect()}
    assert {t for t, k in found if k == "page_number"} == {"- 1 -", "- 2 -", "- 3 -", "Page 1 of 1"}
    assert {t for t, k in found if k == "running"} == {"Harbour Office - PACKET MIB-000001", "Harbour 0ffice - PACKET MIB-000001", "Harbour Office - PACKET MIB-000002"}
    assert ("STATEMENT OF THE BEARER", "running") not in found


def test_breaks_and_misreads(spark):
    lines, tokens = frames(spark)
    texts = text_of(spark)
    found = {(texts[r["line_id"]], r["kind"]) for r in ocr.findings(lines, tokens).collect()}
    assert {t for t, k in found if k == "hyphen_break"} == {"The quarantine officer reviewed the regi-"} | {t for t, k in found if k == "hyphen_break" and "decontam" in t}
    assert {t for t, k in found if k == "misread"} == {"seal keeper left. The rnanifest was"}


def test_paragraphs_are_joined(spark):
    lines, tokens = frames(spark)
    text = " ".join(r["text"] for r in ocr.paragraphs(lines, tokens).where("case_id = 'MIB-000001'").orderBy("paragraph_no").collect())
    assert "reviewed the registry extract before the counter-seal keeper left. The manifest was complete." in text


def test_first_words_of_lines_are_repaired(spark):
    pages = {
        "first": ["The officer kept the", "rnanifest, and the", "0fflcer left."],
        # the tail of a broken word goes to the line before, and only there
        "taken": ["The officer kept the mani-", "fesf here."],
        # a compound keeps its hyphen, its halves stay words of their lines
        "compound": ["The counter-", "sea1 keeper left."],
        # neither form of the two words is known together
        "apart": ["The officer-", "rnanifest was kept."],
    }
    rows = [(10 * c + i, case, 0, i, t, 1, 1) for c, (case, texts) in enumerate(pages.items()) for i, t in enumerate(texts)]
    known = "the officer kept the manifest and the counter-seal keeper left here was".split() * 50
    tokens = [(w, 0.9) for w in known] + [(w, 0.9) for *_, t, _, _ in rows for w in t.split()]
    got = {r["case_id"]: r["text"] for r in ocr.paragraphs(spark.createDataFrame(rows, LINES), spark.createDataFrame(tokens, "text string, confidence double")).collect()}
    assert got == {
        "first": "The officer kept the manifest, and the officer left.",
        "taken": "The officer kept the manifest here.",
        "compound": "The counter-seal keeper left.",
        "apart": "The officer-manifest was kept.",
    }


def test_neighbours_choose_among_forms(spark):
    # "batter" and "hatter" share a skeleton and are equally frequent; each stands beside words of its own
    known = ["the white batter bowl stood"] * 40 + ["the felt hatter shop closed"] * 40
    rare = ["the white h@tter bowl stood", "the felt h@tter shop closed", "the old haffer porter slept", "the old haffer porter slept", "the felt haffer shop closed"]
    texts = known + rare
    rows = [(i, f"c{i}", 0, 0, t, 1, 1) for i, t in enumerate(texts)]
    tokens = [(w, 0.9) for t in texts for w in t.split()]
    lines = spark.createDataFrame(rows, LINES)
    _, _, _, repairs = ocr.repair(lines, spark.createDataFrame(tokens, "text string, confidence double"))
    got = {(texts[r["line_id"]], r["right"]) for r in repairs.collect()}
    # "haffer" beside its own neighbours is a word, beside those of "hatter" it is misread
    assert got == {("the white h@tter bowl stood", "batter"), ("the felt h@tter shop closed", "hatter"), ("the felt haffer shop closed", "hatter")}


def test_skeletons_coincide(spark):
    pairs = [("manifest", "rnanifest"), ("officer", "0fflcer"), ("clerk", "(1erk"), ("under", "urider"), ("quiet", "qiiiet"), ("window", "vvinclovv"), ("the", "fhc"), ("certificate", "certiﬁcafe")]
    df = spark.createDataFrame(pairs, "a string, b string")
    from pyspark.sql import functions as F

    assert [r for r in df.select("a", "b", (ocr.skeleton(F.col("a")) == ocr.skeleton(F.col("b"))).alias("same")).collect() if not r["same"]] == []


def test_numbers(spark):
    from pyspark.sql import functions as F  # noqa: F401

    cases = {"- 3 -": 3, "Page 2 of 9": 2, "Paqe l of 3": 1, "[12]": 12, "p. 4": 4, "iv": 4, "xii": 12, "Sheet lO": 10, "3/7": 3, "— 1 —": 1, "see page 3": None, "KX-2.": None, "Form K-12": None, "": None}
    cases |= {" " * 60 + "- 12 -": 12, "- 12 -" + " " * 5000: 12, "Page" + " " * 3000 + "7": 7, " " * 20_000: None, "page " * 4000: None}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "text string")
    got = {r["text"]: r["n"] for r in ocr.with_page_number(df, "n").collect()}
    assert got == cases | {None: None}


def test_shared_heads_are_split_alike(spark):
    lines, _ = frames(spark)
    plain, split = (sorted((r["line_id"], r["kind"]) for r in ocr.line_kinds(lines, h).collect()) for h in (10**6, 1))
    assert plain == split and len({i for i, _ in plain}) == len(plain) == lines.count()


def test_empty_tables(spark):
    lines, tokens = frames(spark)
    assert ocr.findings(lines.limit(0), tokens.limit(0)).count() == 0
    assert ocr.findings(lines, tokens.limit(0)).where("kind = 'page_number'").count() == 4
