"""Lines of pages: grouping, reading order, and scans with state as windows.

What a sequential reader would keep in variables is a window over one page or
one packet's rows: quarantine is a trailing maximum, a pending label a ``lag``,
the running case a ``last`` that skips nulls, a reset a running count of
changes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packetloom.functions import geometry
from packetloom.operators import prefix

LINE_KEY = ("case_id", "page_index", "block_num", "paragraph_num", "line_num")
#: Content that must not be taken for evidence; fixed values, case-insensitive.
CONTEXT_TRIGGERS = (
    r"(?i)\b(?:fake\s+)?(?:system\s+prompt|answer\s+key|ground\s+truth)\b",
    r"(?i)\bignore\s+(?:all\s+)?(?:previous|prior)\s+instructions?\b",
    r"(?i)\b(?:qr|bar\s*code)\b.*\b(?:instruction|policy|answer|decision)\b",
    r"(?i)\b(?:assistant|chatgpt)\s*:\s*",
)
#: Fixed values, case-insensitive.
LINE_TRIGGERS = (r"(?i)\bsample\s+denial\b", r"(?i)\bdo\s+not\s+follow\s+(?:the\s+)?(?:form|policy)\b")
QUARANTINE_LINES = 12
#: Heading phrases of the page types, in the order of their test; fixed values.
PAGE_HEADINGS = (
    ("signed_manual_note", ("manual adjudicator note", "signed manual note")),
    ("adjudicator_stamp", ("adjudicator stamp", "official stamp")),
    ("biometric_slip", ("biometric", "form b-13", "form b 13")),
    ("sponsor_attestation", ("sponsor attestation", "sponsor letter")),
    ("registry_extract", ("registry extract", "registry record")),
    ("fee_receipt", ("fee receipt",)),
    ("intake_form", ("form i-8090", "form i 8090", "work authorization intake", "primary intake record")),
)


def unique_tokens(tokens: DataFrame) -> DataFrame:
    """One row per word position and text; a copy without confidence gives way to one that has it, boxes are united."""
    return tokens.groupBy(*LINE_KEY, "word_num", "text").agg(F.max("confidence").alias("confidence"), geometry.union_of("box").alias("box"))


def lines_of(tokens: DataFrame) -> DataFrame:
    """Words joined in order, confidence weighted by length, boxes united; null confidences carry no weight."""
    weight = F.greatest(F.lit(1), F.length("text"))
    heard = F.col("confidence").isNotNull()
    words = F.array_sort(F.collect_list(F.struct("word_num", "text")))
    return tokens.groupBy(*LINE_KEY).agg(
        F.array_join(F.transform(words, lambda w: w["text"]), " ").alias("text"),
        (F.sum(F.when(heard, weight * F.col("confidence"))) / F.sum(F.when(heard, weight))).alias("confidence"),
        geometry.union_of("box").alias("box"),
        F.count(F.lit(1)).alias("n_words"),
    )


def visual_order(lines: DataFrame) -> DataFrame:
    """case_id, page_index, line_id, place: rows from top to bottom, cells from left to right.

    A row's tolerance depends on its anchor line and its lines need not be
    neighbours in the sort, so this is one grouped pass per page; a page bounds
    the group.
    """

    def order(page: pd.DataFrame) -> pd.DataFrame:
        left, bottom, top, ids = (page[c].to_numpy() for c in ("left", "bottom", "top", "line_id"))
        centre, high = (bottom + top) / 2, np.maximum(1.0, top - bottom)
        waiting, done = np.lexsort((ids, left, centre)), []
        while len(waiting):
            anchor = waiting[0]
            reach = np.maximum(4.0, 0.75 * np.minimum(high[waiting], high[anchor]))
            row = np.abs(centre[waiting] - centre[anchor]) <= reach
            row[0] = True
            cells = waiting[row]
            done.append(cells[np.argsort(left[cells], kind="stable")])
            waiting = waiting[~row]
        places = np.concatenate(done)
        return pd.DataFrame({"case_id": page["case_id"].iloc[0], "page_index": page["page_index"].iloc[0], "line_id": ids[places], "place": np.arange(len(places))})

    flat = lines.select("case_id", "page_index", "line_id", "box.left", "box.bottom", "box.top")
    return flat.groupBy("case_id", "page_index").applyInPandas(order, "case_id string, page_index int, line_id long, place int")


def any_of(text: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.coalesce(text.rlike(p), F.lit(False))
    return out


def page_window() -> Window:
    return Window.partitionBy("case_id", "page_index").orderBy("line_seq", "line_id")


def quarantined(lines: DataFrame, triggers: tuple[str, ...] = CONTEXT_TRIGGERS, length: int = QUARANTINE_LINES) -> DataFrame:
    """``lines`` with ``quarantined``: a trigger within the line itself or the ``length`` - 1 lines before it."""
    hit = any_of(F.col("text"), triggers).cast("int")
    return lines.withColumn("quarantined", F.max(hit).over(page_window().rowsBetween(-(length - 1), 0)) == 1)


def rejected(lines: DataFrame, triggers: tuple[str, ...] = CONTEXT_TRIGGERS + LINE_TRIGGERS) -> DataFrame:
    """``lines`` with ``rejected``; an explicit manual correction is never rejected."""
    anchored = F.coalesce(F.col("text").rlike(r"(?i)^\s*manual\s+correction\s*:"), F.lit(False))
    return lines.withColumn("rejected", any_of(F.col("text"), triggers) & ~anchored)


def page_types(lines: DataFrame, headings: tuple = PAGE_HEADINGS, first_lines: int = 4, default: str = "other") -> DataFrame:
    """case_id, page_index, page_type by the first lines of each page."""
    top = lines.withColumn("rn", F.row_number().over(page_window())).where(F.col("rn") <= first_lines)
    joined = top.groupBy("case_id", "page_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "text"))), lambda x: x["text"]), " ").alias("heading"))
    heading, kind = F.lower("heading"), None
    for name, phrases in headings:
        found = F.lit(False)
        for phrase in phrases:
            found = found | heading.contains(phrase)
        kind = F.when(found, name) if kind is None else kind.when(found, name)
    return joined.select("case_id", "page_index", kind.otherwise(default).alias("page_type"))


def last_heading(lines: DataFrame, headings: tuple = PAGE_HEADINGS, default: str = "intake_form") -> DataFrame:
    """case_id, page_index, evidence_type: the last line of the page that holds a heading decides."""
    text, kind = F.lower("text"), None
    for name, phrases in headings:
        found = F.lit(False)
        for phrase in phrases:
            found = found | text.contains(phrase)
        kind = F.when(found, name) if kind is None else kind.when(found, name)
    named = lines.withColumn("kind", kind)
    return named.groupBy("case_id", "page_index").agg(F.coalesce(F.max_by("kind", F.when(F.col("kind").isNotNull(), F.struct("line_seq", "line_id"))), F.lit(default)).alias("evidence_type"))


def page_locks(lines: DataFrame, pattern: str = r"MIB-[0-9]{6}") -> DataFrame:
    """case_id, page_index, n_ids, locked_to: the packet's own id when visible, else the only visible id, else null."""
    seen = lines.select("case_id", "page_index", F.explode(F.regexp_extract_all("text", F.lit(f"({pattern})"))).alias("seen"))
    ids = seen.groupBy("case_id", "page_index").agg(F.countDistinct("seen").alias("n_ids"), F.min("seen").alias("only"), F.max((F.col("seen") == F.col("case_id")).cast("int")).alias("own"))
    pages = lines.select("case_id", "page_index").distinct()
    locked = F.when(F.col("own") == 1, F.col("case_id")).when(F.col("n_ids") == 1, F.col("only"))
    return pages.join(ids, ["case_id", "page_index"], "left").select("case_id", "page_index", F.coalesce("n_ids", F.lit(0)).alias("n_ids"), locked.alias("locked_to"))


def paired_labels(lines: DataFrame, label: str) -> DataFrame:
    """Labels without a value, with the next line of the page as the value unless it is a label or rejected itself."""
    marked = lines.withColumn("__label", F.coalesce(F.col("text").rlike(label), F.lit(False)))
    order = page_window()
    out = marked.withColumn("__next", F.lead(F.struct("line_id", "text", "__label", "rejected")).over(order))
    good = F.col("__label") & ~F.col("rejected") & F.col("__next").isNotNull() & ~F.col("__next.__label") & ~F.col("__next.rejected")
    return out.where(good).select("case_id", "page_index", F.col("line_id").alias("label_id"), F.col("text").alias("label"), F.col("__next.line_id").alias("value_id"), F.col("__next.text").alias("value"))


def running_scope(evidence: DataFrame, pages_a_chunk: int = 32) -> DataFrame:
    """``evidence`` with the case and applicant in force at each observation of its packet.

    The case in force is the last legible case id seen before; the applicant in
    force is the last legible name since the case last changed.  Both are
    carried over chunks of pages, so a packet of any size is spread.
    """
    order, chunk = ["page_index", "seq", "cand_id"], F.floor(F.col("page_index") / pages_a_chunk)
    seen = F.when((F.col("field_name") == "case_id") & F.col("legible") & F.col("value").rlike(r"^MIB-[0-9]{6}$"), F.col("value"))
    out = prefix.last_before(evidence.withColumn("__seen", seen), ["case_id"], order, chunk, F.col("__seen"), "running_case")
    out = out.withColumn("running_case", F.coalesce("running_case", "case_id"))
    # a row whose id differs from the one in force switches the rows after it
    switch = F.coalesce(F.col("__seen") != F.col("running_case"), F.lit(False)).cast("int")
    out = prefix.total_before(out, ["case_id"], order, chunk, switch, "__segment")
    name = F.when((F.col("field_name") == "applicant_name") & F.col("legible"), F.col("value"))
    return prefix.last_before(out, ["case_id", "__segment"], order, chunk, name, "running_applicant").drop("__seen", "__segment")


def legibility(evidence: DataFrame, floor: float = 0.45, decision_floor: float = 0.28) -> DataFrame:
    """``evidence`` with ``read``: the value where it is legible enough, else null; decisions on notes and stamps have a lower floor."""
    kind = F.regexp_replace(F.lower("evidence_type"), "[^a-z]", "")
    confidence = F.when(F.col("ocr_confidence") > 1, F.col("ocr_confidence") / 100).otherwise(F.col("ocr_confidence"))
    low = (F.col("field_name") == "adjudication") & kind.isin("adjudicatorstamp", "signedmanualnote")
    enough = confidence >= F.when(low, decision_floor).otherwise(floor)
    return evidence.withColumn("read", F.when(F.col("legible") & F.coalesce(enough, F.lit(False)), F.col("value")))


def text_spans(chars: DataFrame, limit: int = 20_000) -> DataFrame:
    """Spans of a page's characters between blanks: text, united box, ``off_crop`` when a character leaves the crop.

    ``chars``: page_id, pos, ch, box, off_crop.  Only the first ``limit``
    characters of a page are read, as the text layer's budget; ``truncated``
    says whether there were more.
    """
    order = Window.partitionBy("page_id").orderBy("pos")
    blank = F.col("ch").rlike(r"^\s$")
    numbered = chars.withColumn("__n", F.row_number().over(order)).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy("page_id")))
    numbered = numbered.where(F.col("__n") <= limit).withColumn("__island", F.sum(blank.cast("int")).over(order))
    spans = numbered.where(~blank).groupBy("page_id", "__island").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ch"))), lambda c: c["ch"]), "").alias("text"),
        geometry.union_of("box").alias("box"), F.max("off_crop").alias("off_crop"), (F.max("__all") > limit).alias("truncated"), F.min("pos").alias("start"),
    )
    return spans.drop("__island")


def _heading_of(text: Column, headings: tuple) -> Column:
    """The first type of the list one of whose phrases the text holds, null for none."""
    low, kind = F.lower(text), F.lit(None).cast("string")
    for name, phrases in reversed(headings):
        found = F.lit(False)
        for phrase in phrases:
            found = found | low.contains(phrase)
        kind = F.when(found, name).otherwise(kind)
    return kind


def first_heading(lines: DataFrame, headings: tuple = PAGE_HEADINGS, first_lines: int = 4, default: str = "intake_form") -> DataFrame:
    """case_id, page_index, evidence_type: the first of the leading lines with a heading of another type than the default decides."""
    top = lines.withColumn("rn", F.row_number().over(page_window())).where(F.col("rn") <= first_lines)
    kind = _heading_of(F.col("text"), tuple(h for h in headings if h[0] != default))
    named = top.groupBy("case_id", "page_index").agg(F.min(F.when(kind.isNotNull(), F.struct("rn", kind.alias("kind")))).alias("first"))
    return named.select("case_id", "page_index", F.coalesce("first.kind", F.lit(default)).alias("evidence_type"))


def page_markers(lines: DataFrame, headings: tuple, marked: tuple[str, ...], first_lines: int = 4) -> DataFrame:
    """case_id, page_index, page_type, confidence (the least of the leading lines), box (around them) of the pages of the marked types."""
    top = lines.withColumn("rn", F.row_number().over(page_window())).where(F.col("rn") <= first_lines)
    around = top.groupBy("case_id", "page_index").agg(F.coalesce(F.min("confidence"), F.lit(1.0)).alias("confidence"), geometry.union_of("box").alias("box"))
    return page_types(lines, headings, first_lines).where(F.col("page_type").isin(*marked)).join(around, ["case_id", "page_index"])


def page_medians(lines: DataFrame) -> DataFrame:
    """case_id, page_index, n_lines, median (the mean of the two middle ones of an even number), upper_median (the upper of them)."""
    read = lines.where(F.col("confidence").isNotNull() & F.coalesce(F.col("text").rlike("[A-Za-z0-9]"), F.lit(False)))
    page = Window.partitionBy("case_id", "page_index")
    placed = read.withColumn("rn", F.row_number().over(page.orderBy("confidence", "line_id"))).withColumn("n", F.count(F.lit(1)).over(page))
    return placed.groupBy("case_id", "page_index").agg(
        F.max("n").alias("n_lines"), F.percentile("confidence", F.lit(0.5)).alias("median"), F.max(F.when(F.col("rn") == F.floor(F.col("n") / 2) + 1, F.col("confidence"))).alias("upper_median")
    )


def retry_pages(lines: DataFrame, evidence: DataFrame, pages: int = 2) -> DataFrame:
    """case_id, page_index, place: the packet's ``pages`` pages worth another reading.

    Pages with the fewest rows of evidence come first, then those with the
    fewest lines, the lowest upper median, the lowest index.
    """
    held = evidence.where(F.col("value").rlike(r"\S")).groupBy("case_id", "page_index").agg(F.count(F.lit(1)).alias("n_rows"))
    ranked = page_medians(lines).join(held, ["case_id", "page_index"], "left")
    order = Window.partitionBy("case_id").orderBy(F.coalesce("n_rows", F.lit(0)), "n_lines", "upper_median", "page_index")
    return ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pages).select("case_id", "page_index", "place")


def trusted_spans(spans: DataFrame) -> DataFrame:
    """Spans of an authoritative text layer that lie on the visible page; unknown marks are not trusted."""
    return spans.where(F.coalesce(F.col("authoritative") & ~F.col("off_crop"), F.lit(False)))
