"""Problem 6: noise in text from scanned pages.

Lines are told apart first.  With digits masked and confusable glyphs folded, a
running line is a text that keeps coming back at the edges of a packet's pages,
or that does so in other packets; a page number is an edge line whose number is
the page's.  What is left is text, apart from a title above it.

Word forms are then grouped by their skeleton, in which glyphs that scanners
confuse coincide.  Within a group frequent forms are right and rare ones are
misread; forms with glyphs that no word has are misread in any case.  Counts
come from all tokens, weighted by their confidence.  Which frequent form is
meant, and whether a rare one is a word of its own, the neighbours in the line
decide: the form that the corpus has beside them most often.  A word cut at a line's end
is joined when the corpus knows the joined form better than the hyphenated one.

Everything is column expressions; windows run over one page, packets are tied
together by page numbers and two-level sums, so a packet that holds a third of
all lines is no single task's group.  Word forms are counted before they are
shuffled, and only the short list of misread forms is joined back.

Defined results: null or blank lines have no kind; a line that ends in a mark
without a following text line within two pages is no break; equal counts leave
both forms alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from packetloom.llm.canonical import lookup
from packetloom.operators.skew import HEAVY, salted_join
from packetloom.session import cut, maybe_broadcast

#: Glyph groups and single glyphs taken for one another; fixed values.
FIRST = ("l!1|(é", "iiiice")
GROUPS = (("ﬁ", "fi"), ("rn", "m"), ("ri", "n"), ("ci", "d"), ("ii", "u"), ("vv", "w"))
GROUPS_TURNED = (("ﬁ", "fi"), ("ii", "u"), ("vv", "w"), ("ci", "d"), ("ri", "n"), ("rn", "m"))
GROUPS_NONE = (("ﬁ", "fi"),)
SINGLES = ("cf@05b69vq", "etaoshhgyg")
MARKS = "-‐‑¬­–="
EDGE_LINES = 3
#: Words that may stand before a page number; fixed values.
PAGE_WORDS = ("page", "sheet", "p.", "folio", "no.")
SHORT_RATIO, LONG_RATIO = 0.04, 0.5
TITLE_WORDS = 6
_CODE = r"^[A-Za-z]+-[0-9]+[A-Za-z]?$|^[0-9][0-9.,/:-]*$"


def skeleton(text: Column, groups: tuple = GROUPS) -> Column:
    out = F.translate(F.lower(text), *FIRST)
    for a, b in groups:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, *SINGLES)


def masked(text: Column) -> Column:
    """The line's words as skeletons, words of digits as '#'."""
    words = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+")
    return F.array_join(F.transform(words, lambda w: F.when(w.rlike(r"^[^A-Za-z]*[0-9][^A-Za-z]*$") | w.rlike(r"^[A-Za-z]{1,4}-[0-9]"), F.lit("#")).otherwise(skeleton(w))), " ")


#: What a line that may be just a number looks like: marks, a word, a number in digits or Roman numerals, "of" a number.
_MAYBE_NUMBER = r"^[\s\[(—–-]*+(?:[A-Za-z]+\.?\s*)?[0-9lIOoSB|ivxIVXL]{1,7}(?:\s*(?:/|of|0f|ot)\s*[0-9lIOoSB|]{1,4})?[\s\])—–-]*+$"


def with_page_number(lines: DataFrame, out: str) -> DataFrame:
    """``lines`` with the number that a line consists of, null for other lines; blanks and marks around it do not count.

    Built in steps, so that each intermediate text is computed once.
    """
    may = F.when(F.col("text").rlike(_MAYBE_NUMBER), F.col("text"))
    around = r"^[\s\[(—–-]++|(?<![\s\])—–-])[\s\])—–-]++$"
    steps = lines.withColumn("__tidy", F.regexp_replace(F.regexp_replace(may, around, ""), r"\s+", " "))
    steps = steps.withColumn("__head", skeleton(F.regexp_extract("__tidy", r"^([A-Za-z]+\.?) ?[^ ]+( .*)?$", 1)))
    named = F.col("__head").isin(*_skeletons(PAGE_WORDS))
    steps = steps.withColumn("__rest", F.when(named, F.regexp_replace("__tidy", r"^[A-Za-z]+\.? ?", "")).otherwise(F.col("__tidy")))
    pattern = r"^([0-9lIOoSB|]{1,4}|[ivxlIVXL1]{1,7})(?: ?(?:/|of|0f|ot) ?[0-9lIOoSB|]{1,4})?$"
    steps = steps.withColumn("__first", F.regexp_extract("__rest", pattern, 1))
    steps = steps.withColumn("__digits", F.translate("__first", "lI|OoSB", "1110058")).withColumn("__roman", F.translate(F.lower("__first"), "1l", "ii"))
    value = F.lit(0)
    for letter, n in (("x", 10), ("v", 5), ("i", 1)):
        value = value + n * (F.length("__roman") - F.length(F.replace("__roman", F.lit(letter))))
    value = value - F.when(F.col("__roman").rlike("i[vx]$"), 2).otherwise(0)
    number = F.when(F.col("__digits").rlike(r"^[0-9]+$"), F.col("__digits").cast("int")).when(F.col("__roman").rlike(r"^x*(ix|iv|v?i{0,3})$"), value)
    steps = steps.withColumn(out, F.when(F.col("__first") != "", number))
    return steps.drop("__tidy", "__head", "__rest", "__first", "__digits", "__roman")


def _skeletons(words: tuple[str, ...]) -> list[str]:
    out = []
    for w in words:
        w = w.translate(str.maketrans(*FIRST))
        for a, b in GROUPS:
            w = w.replace(a, b)
        out.append(w.translate(str.maketrans(*SINGLES)))
    return out


def line_kinds(lines: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``lines`` (line_id, case_id, page_index, line_seq, text, ...) with ``kind``: running, page_number, title, text or blank.

    Marks are made of each line's text before any shuffle; only edge lines take
    part in the joins, and a head that very many lines share is split.
    """
    text = F.col("text")
    words = F.filter(F.split(text, r"[^\p{L}'’@!0-9]+"), lambda w: F.length(w) >= 4)
    short = F.size(F.split(text, r"\s+")) <= TITLE_WORDS
    titled = short & (F.size(words) > 0) & F.forall(words, lambda w: w.rlike(r"^[\p{Lu}0-9@!(]")) & ~text.rlike(rf"[.,;:{MARKS}]\s*$")
    headed = F.coalesce(text.rlike(r"^\s*[\p{Lu}0-9(@]"), F.lit(False))
    from_one = F.coalesce(~text.rlike("[/o]") | text.rlike(r"(/|of) *[1lI]\s*$"), F.lit(False))
    blank = ~F.coalesce(text.rlike(r"\S"), F.lit(False))
    page = Window.partitionBy("case_id", "page_index")
    marked = with_page_number(lines, "__number").select(
        "line_id", "case_id", "page_index", "line_seq", blank.alias("__blank"), "__number", headed.alias("__headed"), from_one.alias("__from_one"), F.xxhash64(masked(text)).alias("__key"), F.coalesce(titled, F.lit(False)).alias("__titled")
    )
    from_edge = F.least(F.col("line_seq") - F.min("line_seq").over(page), F.max("line_seq").over(page) - F.col("line_seq"))
    placed = marked.withColumn("__edge", from_edge < EDGE_LINES)
    placed = cut(placed.withColumn("__number", F.when(F.col("__edge"), F.col("__number"))))
    # one row per packet, page and key of the edges: enough for all repetition counts
    edge_keys = placed.where(F.col("__edge") & ~F.col("__blank")).groupBy("case_id", "__key", "page_index").agg(F.count(F.lit(1)).alias("n"), F.max("__headed").alias("headed"))
    edge_keys = cut(edge_keys)
    after = edge_keys.select("case_id", "__key", (F.col("page_index") - 1).alias("page_index"), F.lit(1).alias("again"))
    pages = placed.groupBy("case_id").agg(F.countDistinct("page_index").alias("__pages"), F.min("page_index").alias("page_index"))
    pages = cut(pages)
    of_case = edge_keys.join(after, ["case_id", "__key", "page_index"], "left").groupBy("case_id", "__key")
    of_case = of_case.agg(F.count(F.lit(1)).alias("__on_pages"), F.sum("n").alias("n"), F.count("again").alias("__again"), F.max("headed").alias("__headed"))
    of_case = of_case.join(pages.drop("page_index"), "case_id")
    repeated = (F.col("__on_pages") >= 2) & F.col("__headed") & ((F.col("__on_pages") >= 0.5 * (F.col("__pages") - 1)) | (F.col("__again") >= 0.4 * F.col("__on_pages")))
    of_case = cut(of_case.withColumn("__repeated", repeated))
    at_edges = of_case.groupBy("__key").agg(
        F.sum("n").alias("__edge_n"), F.count_if("__repeated").alias("__repeats"), F.count_if(F.col("__pages") >= 2).alias("__multi")
    )
    anywhere = placed.where(~F.col("__blank")).groupBy("__key").agg(F.count(F.lit(1)).alias("__all_n"))
    known = at_edges.where("__repeats >= 1").join(anywhere, "__key").where(F.col("__edge_n") >= 0.8 * F.col("__all_n"))
    # running in most of the packets long enough to show it, or in this packet
    known = cut(known.select("__key", F.col("__edge_n").alias("n"), (F.col("__repeats") >= 0.4 * F.col("__multi")).alias("__common")))
    local = of_case.where("__repeated").join(known.where(~F.col("__common")), "__key", "left_semi").select("case_id", "__key", "n")
    edges = placed.where(F.col("__edge") & ~F.col("__blank") & F.col("__number").isNull()).select("line_id", "case_id", "__key")
    common = known.where("__common")
    running = salted_join(edges.select("line_id", "__key"), common.select("__key"), ["__key"], heavy, (common, common.select("__key", F.lit(1).alias("n"))))
    running = running.select("line_id").unionByName(salted_join(edges, local.drop("n"), ["case_id", "__key"], heavy, (local, local.withColumn("n", F.lit(1)))).select("line_id"))
    # a printed number is right when it counts from one, or goes on from a page nearby
    numbered = placed.where(F.col("__number").isNotNull()).select("line_id", "case_id", "page_index", "__number", "__from_one", (F.col("__number") - F.col("page_index")).alias("__off"))
    counted = cut(numbered.select("case_id", "page_index", "__off").distinct())
    near = F.explode(F.array(*(F.col("page_index") + d for d in (-2, -1, 1, 2))))
    confirmed = counted.join(counted.select("case_id", "__off", near.alias("page_index")).distinct(), ["case_id", "page_index", "__off"], "left_semi").withColumn("__confirmed", F.lit(True))
    first = (F.col("__number") == 1) & F.col("__from_one")
    numbers = numbered.join(confirmed, ["case_id", "page_index", "__off"], "left").where((F.col("__off") == 1) | first | F.coalesce("__confirmed", F.lit(False)))
    found = cut(running.withColumn("kind", F.lit("running")).unionByName(numbers.select("line_id", F.lit("page_number").alias("kind"))))
    # a title: the first line of a packet's first page that is left, short, capitalised and without an end mark
    opening = placed.where(~F.col("__blank")).join(pages.drop("__pages"), ["case_id", "page_index"]).join(found, "line_id", "left_anti")
    opening = opening.groupBy("case_id").agg(F.min(F.struct("line_seq", "line_id", "__titled")).alias("o")).where("o.__titled")
    named = found.unionByName(opening.select(F.col("o.line_id").alias("line_id"), F.lit("title").alias("kind")))
    return lines.join(named, "line_id", "left").withColumn("kind", F.when(blank, "blank").otherwise(F.coalesce("kind", F.lit("text"))))


def bare_form(word: Column) -> Column:
    """A word without the marks around it, lower case; an unclosed bracket at the start may be a letter and stays."""
    closed = F.when(word.contains(")"), F.regexp_replace(word, r"^[(\[]+", "")).otherwise(word)
    return F.lower(F.regexp_replace(F.regexp_replace(closed, r"^[.,;:\"“”'‘’?]+", ""), r"[.,;:\"“”'‘’?)\]]+$", ""))


def raw_words(tokens: DataFrame) -> DataFrame:
    """word, form, n, support of the distinct words of all tokens; the form is worked out once a distinct word."""
    counted = tokens.where(F.col("text").rlike(r"\S")).groupBy(F.col("text").alias("word")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("confidence", F.lit(0.5))).alias("support"))
    return counted.withColumn("form", bare_form(F.col("word")))


def lexicon(words: DataFrame) -> DataFrame:
    """form, n, support (confidence-weighted count) of ``raw_words``; words cut at a line's end are left out."""
    counted = words.groupBy("form").agg(F.sum("n").alias("n"), F.sum("support").alias("support"))
    return counted.where((F.col("form") != "") & ~F.col("form").rlike(rf"[{MARKS}]$"))


def strange(form: Column) -> Column:
    """Letters mixed with glyphs that are in no word, codes apart."""
    return form.rlike(r"[a-z]") & form.rlike(r"[é@!0-9|ﬁ]") & ~form.rlike(_CODE)


def misread_forms(forms: DataFrame) -> DataFrame:
    """(form, odd, options): every form that may be misread, with the forms it may stand for.

    ``options`` are (right, support) of the strongest clean form of each skeleton
    group, and of the second one where it is no rare form itself; empty where
    none is known.  An ``odd`` form holds glyphs that no word has.
    """
    word = F.col("form")
    skeletons = F.array(*(skeleton(word, g) for g in (GROUPS, GROUPS_TURNED, GROUPS_NONE)))
    odd = strange(word) | word.contains("(")
    keyed = cut(forms.select("form", "support", odd.alias("odd"), strange(word).alias("strange"), word.rlike(_CODE).alias("code"), F.posexplode(skeletons).alias("g", "skeleton")))
    place = Window.partitionBy("g", "skeleton").orderBy(F.desc("support"), F.desc("form"))
    best = keyed.where(~F.col("odd")).withColumn("place", F.row_number().over(place)).where("place <= 2")
    rights = best.select("g", "skeleton", F.col("form").alias("right"), F.col("support").alias("most"), "place")
    ratio = F.when(F.length("form") <= 4, SHORT_RATIO).otherwise(LONG_RATIO)
    weaker = (F.col("support") < ratio * F.col("most")) | F.col("odd")
    part = keyed.where(~F.col("code")).join(rights, ["g", "skeleton"]).where((F.col("form") != F.col("right")) & weaker)
    # a form is misread for the strongest of its group; the second one is a rival of that, when strong enough
    found = part.groupBy("form", "g").agg(F.max("odd").alias("odd"), F.max(F.when(F.col("place") == 1, F.struct("most", "right"))).alias("one"), F.max(F.when(F.col("place") == 2, F.struct("most", "right"))).alias("two"))
    rival = F.when(F.col("two.most") >= LONG_RATIO * F.col("one.most"), F.struct(F.col("two.right").alias("right"), F.col("two.most").alias("most")))
    pairs = found.where(F.col("one").isNotNull()).select("form", "odd", F.explode(F.array_compact(F.array(F.struct(F.col("one.right").alias("right"), F.col("one.most").alias("most")), rival))).alias("o"))
    lone = keyed.where(F.col("strange") & (F.col("g") == 0)).select("form", F.lit(True).alias("odd"), F.lit(None).cast("struct<right:string,most:double>").alias("o"))
    return pairs.unionByName(lone).groupBy("form").agg(F.max("odd").alias("odd"), F.collect_set("o").alias("options"))


def context_word(word: Column) -> Column:
    """A word as its neighbours know it: lower case without marks."""
    return F.translate(F.lower(word), ".,;:?\"“”'‘’()[]", "")


def in_context(text_lines: DataFrame, hits: DataFrame) -> DataFrame:
    """line_id, at, right of the hits that are misread, with the option that their neighbours support most.

    ``hits``: line_id, at, form, odd, options, before, after (the neighbours in
    the line).  Support is the number of times that the corpus has the neighbour
    beside the option; among equals the frequent form is chosen.  A form without
    strange glyphs is left alone when its neighbours support it, elsewhere, more
    than every option.  Only the pairs of words asked for are counted.
    """
    own = F.when(~F.col("odd"), F.array(F.struct(F.col("form").alias("right"), F.lit(-1.0).alias("most")))).otherwise(F.array().cast("array<struct<right:string,most:double>>"))
    asked = hits.where(F.size("options") + F.when(F.col("odd"), 0).otherwise(1) > 1)
    asked = cut(asked.select("line_id", "at", "form", "before", "after", F.inline(F.concat("options", own))).withColumn("c", context_word(F.col("right"))))
    wanted = asked.select(F.inline(F.array(F.struct(F.col("before").alias("a"), F.col("c").alias("b")), F.struct(F.col("c").alias("a"), F.col("after").alias("b"))))).where("a <> '' AND b <> ''").distinct()
    words = F.transform(F.split(F.regexp_replace("text", r"^\s+|\s+$", ""), r"\s+"), context_word)
    beside = text_lines.select(F.explode(F.arrays_zip(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))).alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))).alias("p")).select("p.*")
    counts = cut(lookup(beside, wanted, ["a", "b"], 500_000).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    left = counts.select(F.col("a").alias("before"), F.col("b").alias("c"), F.col("n").alias("n_before"))
    right = counts.select(F.col("b").alias("after"), F.col("a").alias("c"), F.col("n").alias("n_after"))
    seen = asked.join(left, ["before", "c"], "left").join(right, ["after", "c"], "left")
    itself = F.col("most") < 0
    # the occurrence itself does not count for its own form
    support = F.coalesce("n_before", F.lit(0)) + F.coalesce("n_after", F.lit(0))
    alone = F.when(itself, F.when(F.col("before") != "", 1).otherwise(0) + F.when(F.col("after") != "", 1).otherwise(0)).otherwise(0)
    chosen = seen.withColumn("support", support - alone).groupBy("line_id", "at").agg(F.max(F.struct("support", "most", "right")).alias("best"), F.max(F.when(~itself, F.struct("support", "most", "right"))).alias("other"))
    kept = chosen.where((F.col("best.most") >= 0) | (F.col("best.support") <= 0)).select("line_id", "at", F.col("other.right").alias("right"))
    plain = hits.where(F.size("options") + F.when(F.col("odd"), 0).otherwise(1) <= 1)
    return kept.unionByName(plain.select("line_id", "at", F.try_element_at("options", F.lit(1))["right"].alias("right")))


def cut_words(text_lines: DataFrame) -> DataFrame:
    """Text lines that end in a mark, with the first word of the next text line.

    line_id, next_id, head (the last word without its mark), tail.
    """
    page = Window.partitionBy("case_id", "page_index").orderBy("line_seq", "line_id")
    words = F.split(F.regexp_replace("text", r"^\s+|\s+$", ""), r"\s+")
    here = text_lines.select(
        "line_id", "case_id", "page_index", F.element_at(words, -1).alias("last"), F.lead(F.struct("line_id", words[0].alias("word"))).over(page).alias("next"), F.row_number().over(page).alias("rn"), words[0].alias("first")
    )
    openings = here.where(F.col("rn") == 1).select("case_id", "page_index", F.struct("line_id", F.col("first").alias("word")).alias("opening"))
    ends = here.where(F.col("last").rlike(rf"[\p{{L}}0-9@!('][{MARKS}]$"))
    one = openings.select("case_id", (F.col("page_index") - 1).alias("page_index"), F.col("opening").alias("one"))
    two = openings.select("case_id", (F.col("page_index") - 2).alias("page_index"), F.col("opening").alias("two"))
    joined = ends.join(one, ["case_id", "page_index"], "left").join(two, ["case_id", "page_index"], "left")
    follow = F.coalesce("next", "one", "two")
    return joined.where(follow.isNotNull()).select("line_id", follow["line_id"].alias("next_id"), F.regexp_replace("last", f"[{MARKS}]$", "").alias("head"), follow["word"].alias("tail"))


def judge_cuts(cuts: DataFrame, forms: DataFrame) -> DataFrame:
    """``cuts`` with ``is_break`` (the mark is no part of the word), ``joined`` and ``right`` (the word meant)."""
    head, tail = bare_form(F.col("head")), bare_form(F.col("tail"))
    # materialised, or the nested expressions would be repeated in every use
    cuts = cut(cuts.withColumn("h", head).withColumn("t", tail)).withColumn("joined", F.concat(head, tail)).withColumn("linked", F.concat_ws("-", head, tail))
    clean = forms.where(~strange(F.col("form")) & ~F.col("form").contains("("))
    by_skeleton = clean.groupBy(skeleton(F.col("form")).alias("s")).agg(F.sum("support").alias("support"), F.max_by("form", F.struct("support", "form")).alias("right"))
    wanted = cuts.select(F.explode(F.array(*(skeleton(F.col(c)) for c in ("joined", "linked", "h", "t")))).alias("s")).distinct()
    known = maybe_broadcast(cut(by_skeleton.join(wanted, "s", "left_semi")), 200_000)
    out = cuts
    for c in ("joined", "linked", "h", "t"):
        side = known.select(F.col("s").alias(f"s_{c}"), F.col("support").alias(f"n_{c}"), F.col("right").alias(f"right_{c}"))
        out = out.withColumn(f"s_{c}", skeleton(F.col(c))).join(side, f"s_{c}", "left")
    n = {c: F.coalesce(f"n_{c}", F.lit(0.0)) for c in ("joined", "linked", "h", "t")}
    two_words = (n["h"] >= 3) & (n["t"] >= 3) & (F.length("h") > 2) & (F.length("t") > 2)
    is_break = F.when((n["joined"] > 0) | (n["linked"] > 0), n["joined"] >= n["linked"]).otherwise(~two_words)
    return out.select("line_id", "next_id", "h", "t", "joined", is_break.alias("is_break"), F.when(is_break, F.col("right_joined")).otherwise(F.col("right_linked")).alias("right"))


def words_of(text_lines: DataFrame, neighbours: bool = False) -> DataFrame:
    """line_id, at, word of the whole words of text lines, on demand with ``before`` and ``after``; the caller drops cut ones."""
    words = F.split(F.regexp_replace("text", r"^\s+|\s+$", ""), r"\s+")
    if not neighbours:
        return text_lines.select("line_id", F.posexplode(words).alias("at", "word"))
    exploded = text_lines.select("line_id", words.alias("words")).select("line_id", "words", F.posexplode("words").alias("at", "word"))
    beside = [F.coalesce(context_word(F.get("words", F.col("at") + step)), F.lit("")).alias(name) for step, name in ((-1, "before"), (1, "after"))]
    return exploded.select("line_id", "at", "word", *beside)


def repair(lines: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(typed lines, judged cuts, misread words, repairs).

    Misread words: line_id, at (null for a word cut at the line's end), right.
    Repairs: line_id, at, right of words that stand in their line by themselves,
    among them the second half of a compound cut at its own hyphen.
    """
    typed = cut(line_kinds(lines.select("line_id", "case_id", "page_index", "line_seq", "text", "block_num", "paragraph_num")))
    text_lines = typed.where(F.col("kind") == "text")
    raw = cut(raw_words(tokens))
    forms = cut(lexicon(raw))
    cuts = cut(judge_cuts(cut_words(text_lines), forms))
    # words of lines that no token carries have a form too
    whole_words = words_of(text_lines)
    unseen = whole_words.select("word").distinct().join(raw.select("word"), "word", "left_anti")
    spelled = raw.select("word", "form").unionByName(unseen.withColumn("form", bare_form(F.col("word"))))
    wrong = spelled.join(misread_forms(forms), "form").select("word", "form", "odd", "options")
    halves = cuts.select(F.col("line_id").alias("line_id"), F.lit(-1).alias("side")).unionByName(cuts.select(F.col("next_id").alias("line_id"), F.lit(0).alias("side")))
    last = F.size(F.split(F.regexp_replace("text", r"^\s+|\s+$", ""), r"\s+")) - 1
    sized = text_lines.select("line_id", "text", last.alias("last"))
    skip = halves.join(sized.select("line_id", "last"), "line_id").select("line_id", F.when(F.col("side") == 0, F.lit(0)).otherwise(F.col("last")).alias("at")).distinct()
    # cut here, or the optimizer would move the anti join below the lookup and shuffle every word
    hits = cut(lookup(words_of(text_lines, True), wrong, ["word"], 500_000).select("line_id", "at", "form", "odd", "options", "before", "after"))
    hits = cut(in_context(text_lines, hits))
    whole = hits.join(skip, ["line_id", "at"], "left_anti")
    whole = whole.select("line_id", "at", "right")
    # a cut word is compared with the word meant; the half that differs is the misread one
    meant = F.coalesce("right", F.col("joined"))
    tidy = F.replace(meant, F.lit("-"), F.lit(""))
    odd = lambda c: F.coalesce(strange(F.col(c)), F.lit(False))
    wrong_head = odd("h") | (F.col("right").isNotNull() & ~tidy.startswith(F.replace(F.col("h"), F.lit("-"), F.lit(""))))
    wrong_tail = odd("t") | (F.col("right").isNotNull() & ~tidy.endswith(F.replace(F.col("t"), F.lit("-"), F.lit(""))))
    split = cuts.where(wrong_head).select("line_id", F.lit(None).cast("int").alias("at"), "right")
    split = split.unionByName(cuts.where(wrong_tail).select(F.col("next_id").alias("line_id"), F.lit(0).alias("at"), "right"))
    # such a half is repaired as in the compound where that is known, else by itself
    own_hyphen = cuts.where(~F.col("is_break"))
    parts = F.split("right", "-")
    n_head = F.size(F.split("h", "-"))
    rest = F.array_join(F.slice(parts, n_head + 1, F.greatest(F.size(parts) - n_head, F.lit(0))), "-")
    halved = own_hyphen.where(wrong_tail & (rest != "")).select(F.col("next_id").alias("line_id"), F.lit(0).alias("at"), rest.alias("right"))
    alone = hits.where("at = 0").join(own_hyphen.where(F.col("right").isNull()).select(F.col("next_id").alias("line_id")), "line_id", "left_semi")
    cut_again = cuts.join(sized.where("last = 0"), "line_id", "left_semi").select("line_id")
    second = halved.unionByName(alone.select("line_id", "at", "right")).join(cut_again, "line_id", "left_anti")
    return typed, cuts, whole.unionByName(split), whole.unionByName(second).where(F.col("right").isNotNull())


def findings(lines: DataFrame, tokens: DataFrame) -> DataFrame:
    """line_id, kind: running, page_number, hyphen_break, misread."""
    typed, cuts, wrong, _ = repair(lines, tokens)
    edges = typed.where(F.col("kind").isin("running", "page_number")).select("line_id", "kind")
    breaks = cuts.where("is_break").select("line_id", F.lit("hyphen_break").alias("kind"))
    misread = wrong.select("line_id").distinct().withColumn("kind", F.lit("misread"))
    return edges.unionByName(breaks).unionByName(misread)


def _recased(word: Column, right: Column) -> Column:
    """``right`` in the case and between the marks of ``word``; a glyph at its start is no capital."""
    core = F.regexp_extract(word, r"^([.,;:\"“”'‘’?]*)(.*?)([.,;:\"“”'‘’?)\]]*)$", 2)
    shaped = F.when((F.upper(core) == core) & (F.length(core) > 1), F.upper(right)).when(F.lower(F.substring(core, 1, 1)) != F.substring(core, 1, 1), F.concat(F.upper(F.substring(right, 1, 1)), F.substring(right, 2, 1000))).otherwise(right)
    return F.concat(F.regexp_extract(word, r"^([.,;:\"“”'‘’?]*)", 1), shaped, F.regexp_extract(word, r"([.,;:\"“”'‘’?)\]]*)$", 1))


def running_total(df: DataFrame, key: str, order: list[str], chunk: Column, value: Column) -> DataFrame:
    """``df`` with ``total``: the sum of ``value`` up to the row within ``key``, by chunks.

    Chunks must follow the order.  A window runs inside one (key, chunk) and
    another over the chunks' sums, so no task sees all rows of a key.
    """
    at = df.withColumn("__chunk", chunk).withColumn("__value", value)
    sums = at.groupBy(key, "__chunk").agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "__chunk", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(key, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return at.withColumn("__in", F.sum("__value").over(inside)).join(sums, [key, "__chunk"]).withColumn("total", F.col("__in") + F.col("__before")).drop("__chunk", "__value", "__in", "__before")


def paragraphs(lines: DataFrame, tokens: DataFrame) -> DataFrame:
    """case_id, paragraph_no, first_page, text: repaired running paragraphs.

    A paragraph goes on over a page's end when its last line there does not end
    a sentence.
    """
    typed, cuts, _, repairs = repair(lines, tokens)
    text_lines = typed.where(F.col("kind") == "text")
    joins = cuts.select("line_id", "next_id", "is_break", "joined", "right")
    words = words_of(text_lines)
    fixes = repairs.groupBy("line_id", "at").agg(F.min("right").alias("right"))
    fixed = words.join(fixes, ["line_id", "at"], "left").withColumn("word", F.when(F.col("right").isNotNull(), _recased(F.col("word"), F.col("right"))).otherwise(F.col("word")))
    body = fixed.groupBy("line_id").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    head = joins.select("line_id", F.col("is_break").alias("cut_break"), F.coalesce("right", F.when(F.col("is_break"), F.col("joined"))).alias("whole"))
    taken = joins.where("is_break").select(F.col("next_id").alias("line_id"), F.lit(True).alias("taken"))
    shaped = text_lines.join(body, "line_id").join(head, "line_id", "left").join(taken, "line_id", "left")
    texts = F.transform("words", lambda w: w["word"])
    texts = F.when(F.coalesce("taken", F.lit(False)), F.slice(texts, 2, F.greatest(F.size(texts) - 1, F.lit(0)))).otherwise(texts)
    last = F.element_at(F.transform("words", lambda w: w["word"]), -1)
    tail = joins.where("is_break").join(body.select(F.col("line_id").alias("next_id"), F.regexp_extract(F.col("words")[0]["word"], r"([.,;:\"“”'‘’?)\]]*)$", 1).alias("marks")), "next_id").select("line_id", "marks")
    shaped = shaped.join(tail, "line_id", "left")
    mended = F.concat(F.slice(texts, 1, F.greatest(F.size(texts) - 1, F.lit(0))), F.array(F.concat(_recased(F.regexp_replace(last, f"[{MARKS}]$", ""), F.col("whole")), F.coalesce("marks", F.lit("")))))
    out = F.when(F.coalesce("cut_break", F.lit(False)) & F.col("whole").isNotNull() & (F.size(texts) > 0), mended).otherwise(texts)
    shaped = shaped.select("line_id", "case_id", "page_index", "line_seq", "block_num", "paragraph_num", "text", F.array_join(out, " ").alias("mended"))
    page = Window.partitionBy("case_id", "page_index").orderBy("line_seq", "line_id")
    previous = F.lag("paragraph_num").over(page)
    ends = shaped.withColumn("rn", F.row_number().over(page)).withColumn("left", F.row_number().over(Window.partitionBy("case_id", "page_index").orderBy(F.desc("line_seq"), F.desc("line_id"))))
    closings = ends.where(F.col("left") == 1).select("case_id", (F.col("page_index") + 1).alias("page_index"), F.col("text").rlike(r"[.!?:][\"”’)]*\s*$").alias("closed"))
    starts = shaped.withColumn("rn", F.row_number().over(page)).withColumn("changed", previous.isNull() | (previous != F.col("paragraph_num"))).join(closings, ["case_id", "page_index"], "left")
    new = F.when(F.col("rn") == 1, F.coalesce("closed", F.lit(True))).otherwise(F.col("changed"))
    numbered = running_total(starts.withColumn("new", new), "case_id", ["page_index", "line_seq", "line_id"], F.floor(F.col("page_index") / 32), F.col("new").cast("int"))
    pieces = F.array_sort(F.collect_list(F.struct("page_index", "line_seq", "line_id", "mended")))
    grouped = numbered.groupBy("case_id", F.col("total").cast(T.IntegerType()).alias("paragraph_no")).agg(F.min("page_index").alias("first_page"), pieces.alias("pieces"))
    joined = F.array_join(F.filter(F.transform("pieces", lambda p: p["mended"]), lambda t: t != ""), " ")
    # a compound cut at its own hyphen is written together again
    return grouped.select("case_id", "paragraph_no", "first_page", F.regexp_replace(joined, rf"(\p{{L}})[{MARKS}] (?=\p{{L}})", "$1-").alias("text"))
