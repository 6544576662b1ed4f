"""Comparing blocks with the lines of a text layer, and arbitrating between readings.

Lines are rows with document_id, page_no, line_no, text, bbox in the blocks' coordinates. Every spatial join has document and page as
equi keys. A comparison marks blocks and records what it saw; it never overwrites evidence."""

from __future__ import annotations

import functools
import html
import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from foliant.functions import geometry as G
from foliant.functions import text as T
from foliant.operators import tables as TB
from foliant.options import DEFAULT, FOOTNOTE_MARKS, TEMPLATE_TYPES
from foliant.session import cut_lineage

# Signs that count as one.
_SAME_SIGNS = str.maketrans({**dict.fromkeys("‐‑‒–—", "-"), "“": '"', "”": '"', "‘": "'", "’": "'", "﹒": ".", **dict.fromkeys(map(chr, (0xAD, 0x200B, 0xFEFF)), "")})
_MARKS = str.maketrans("", "", "$\\{}^")


def normal(text: str | None) -> str:
    """Entities resolved, compatibility forms folded, dashes and quotes unified, white space deleted."""
    return re.sub(r"\s+", "", unicodedata.normalize("NFKC", html.unescape(text or "")).translate(_SAME_SIGNS))


normal_text = F.pandas_udf(lambda t: pd.Series([normal(x) for x in t], dtype=object), StringType())
canonical_text = F.pandas_udf(lambda t: pd.Series([normal(x).translate(_MARKS) for x in t], dtype=object), StringType())
plain_text = F.pandas_udf(lambda t: pd.Series([unicodedata.normalize("NFKC", html.unescape(x or "").replace("\\%", "%")) for x in t], dtype=object), StringType())
exact_ratio = F.pandas_udf(lambda a, b: pd.Series([1.0 if x == y and x else SequenceMatcher(None, x or "", y or "", autojunk=False).ratio() if x and y else 0.0 for x, y in zip(a, b)], dtype=float), DoubleType())


def _addition_ratio(first: str, second: str, layer: str) -> float:
    """How like the layer a reading is that holds the first one literally and adds something new; else 0."""
    canonical = lambda t: normal(t).translate(_MARKS)
    at = second.find(first) if first else -1
    if at < 0 or not layer:
        return 0.0
    added = second[:at] + second[at + len(first) :]
    if not added.strip() or canonical(added) in canonical(first):
        return 0.0
    return SequenceMatcher(None, canonical(second), canonical(layer), autojunk=False).ratio()


addition_ratio = F.pandas_udf(lambda a, b, c: pd.Series([_addition_ratio(x or "", y or "", z or "") for x, y, z in zip(a, b, c)], dtype=float), DoubleType())


def covered_lines(blocks: DataFrame, lines: DataFrame) -> DataFrame:
    """block_id, document_id, page_no, line_no, text, x0 of every line that a block covers."""
    b = blocks.where(F.col("bbox").isNotNull()).select("document_id", "page_no", "block_id", F.col("bbox").alias("b"))
    both = b.join(lines.select("document_id", "page_no", "line_no", "text", F.col("bbox").alias("l")), ["document_id", "page_no"])
    return both.where(G.covers(F.col("b"), F.col("l"), DEFAULT.cover_ratio)).select("block_id", "document_id", "page_no", "line_no", "text", F.col("l.x0").alias("x0"))


def block_references(covered: DataFrame) -> DataFrame:
    """block_id, reference: the covered lines in order, joined by spaces."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "x0", "text")))  # the lines of one block
    return covered.groupBy("block_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("reference"))


def nearest_table(blocks: DataFrame, lines: DataFrame, reach: float = 90.0) -> DataFrame:
    """document_id, page_no, line_no, table_id, gap: the table with horizontal overlap within ``reach`` above or below a line; the first of equals."""
    t = blocks.where((F.col("block_type") == "table") & F.col("bbox").isNotNull()).select("document_id", "page_no", F.col("block_id").alias("table_id"), F.col("bbox").alias("t"), "position")
    pair = lines.select("document_id", "page_no", "line_no", F.col("bbox").alias("l")).join(t, ["document_id", "page_no"])
    gap = F.greatest(F.lit(0.0), F.col("t.y0") - F.col("l.y1"), F.col("l.y0") - F.col("t.y1"))
    pair = pair.withColumn("gap", gap).where((F.col("gap") <= reach) & (G.x_overlap(F.col("t"), F.col("l")) > 0))
    return pair.groupBy("document_id", "page_no", "line_no").agg(F.min_by("table_id", F.struct("gap", "position", "table_id")).alias("table_id"), F.min("gap").alias("gap"))


NOT_SEMANTIC = ("image", "chart", *TEMPLATE_TYPES)  # whose texts a line is not compared with
READ_TYPES = ("text", "title", "footnote")


def page_lines(lines: DataFrame) -> DataFrame:
    """lines with norm, the form in which they are compared; every function below takes lines like these."""
    return lines if "norm" in lines.columns else lines.withColumn("norm", normal_text("text"))


def repeated_margins(lines: DataFrame, pages: DataFrame | None = None, share: float = DEFAULT.margin_share) -> DataFrame:
    """document_id, norm, n_pages of lines in the page margins that stand on at least three pages and ``share`` of the document's pages.

    pages: document_id, page_no of all pages; without it those that have lines."""
    rows = page_lines(lines)
    edge = rows.where(((F.col("bbox.y1") <= DEFAULT.margin_top) | (F.col("bbox.y0") >= DEFAULT.margin_bottom)) & (F.length("norm") > 0))
    pages = (pages if pages is not None else rows).groupBy("document_id").agg(F.count_distinct("page_no").alias("n"))
    pages = pages.select("document_id", F.greatest(F.lit(3), F.floor(F.col("n") * share)).alias("needed"))
    return edge.groupBy("document_id", "norm").agg(F.count_distinct("page_no").alias("n_pages")).join(pages, "document_id").where("n_pages >= needed").select("document_id", "norm", "n_pages")


def much_alike(part: Column, whole: Column, least: float = 0.92) -> Column:
    """Whether a text contains another, or the F1 of their characters is at least ``least``; where the lengths rule that out, nothing is counted."""
    shorter = F.least(F.length(part), F.length(whole))
    within_reach = 2.0 * shorter >= least * (F.length(part) + F.length(whole))
    return F.when(whole.contains(part), F.lit(True)).when(within_reach, T.char_f1(part, whole) >= least).otherwise(F.lit(False))


def layer_reliability(blocks: DataFrame, lines: DataFrame, invalid: DataFrame | None = None) -> DataFrame:
    """document_id, n_words, n_invalid, n_comparable, n_matched, agreement, reliable: how well a text layer fits the blocks that cover its lines.

    A line of 4 characters and more is comparable if a semantic block with content covers it, and matched if one of them contains it or
    is much like it. invalid: document_id, n_invalid (boxes that the layer's reader dropped). Texts of blocks stay in one row each."""
    rows = page_lines(lines)
    texts = blocks.where(~F.col("block_type").isin(*NOT_SEMANTIC) & ~T.blank(F.col("content")))
    words = rows.groupBy("document_id").agg(F.sum(F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: F.length(w) > 0))).alias("n_words"))
    over = covered_lines(texts, rows.where(F.length("norm") >= 4).select("document_id", "page_no", "line_no", "bbox", F.col("norm").alias("text")))
    own = over.groupBy("block_id", "document_id", "page_no").agg(F.collect_list(F.struct("line_no", "text")).alias("l"))  # the lines of one block
    own = own.join(texts.select("block_id", normal_text(TB.flat_text("content")).alias("flat")), "block_id")
    judged = own.select("document_id", "page_no", F.explode(F.transform("l", lambda x: F.struct(x["line_no"].alias("line_no"), much_alike(x["text"], F.col("flat")).alias("m")))).alias("j"))
    per_line = judged.groupBy("document_id", "page_no", "j.line_no").agg(F.max("j.m").alias("matched"))
    out = words.join(per_line.groupBy("document_id").agg(F.count("*").alias("n_comparable"), F.count_if("matched").alias("n_matched")), "document_id", "left")
    out = out.withColumn("n_invalid", F.lit(0).cast("long")) if invalid is None else out.join(invalid.select("document_id", "n_invalid"), "document_id", "left")
    out = out.fillna(0, ["n_comparable", "n_matched", "n_invalid"])
    ratio = F.when(F.col("n_comparable") > 0, F.col("n_matched") / F.col("n_comparable")).otherwise(F.lit(0.0))
    sound = F.col("n_invalid") / F.greatest(F.lit(1), F.col("n_words") + F.col("n_invalid")) <= 0.02
    out = out.withColumn("agreement", F.round(ratio, 6)).withColumn("reliable", (F.col("n_words") >= 20) & (F.col("n_comparable") >= 20) & (ratio >= 0.72) & sound)
    return out.select("document_id", "n_words", "n_invalid", "n_comparable", "n_matched", "agreement", "reliable")


def _as_read(blocks: DataFrame, references: DataFrame) -> DataFrame:
    """Blocks with content whose reference says something, with a and b, the compared forms of both."""
    pair = blocks.where(~T.blank(F.col("content"))).join(references.select("block_id", "reference"), "block_id")
    return pair.withColumn("a", normal_text(TB.flat_text("content"))).withColumn("b", normal_text("reference")).where((F.length("a") > 0) & (F.length("b") > 0))


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def text_findings(blocks: DataFrame, references: DataFrame) -> DataFrame:
    """block_id, sequence, char_f1, numbers_differ, marks_differ, flagged (TXT-003) of text blocks that differ from their reference in more than form.

    Numbers differ where both sides have some, in number or value; marks differ where a block has a circled digit and the layer its
    letter standing alone. Texts that are equal in the compared form have no row."""
    pair = _as_read(blocks.where(F.col("block_type").isin(*READ_TYPES)), references).where("a <> b")
    pair = pair.withColumn("sequence", F.round(exact_ratio("a", "b"), 6)).withColumn("char_f1", F.round(T.char_f1(F.col("a"), F.col("b")), 6))
    ours, theirs = T.number_tokens(plain_text("content")), T.number_tokens(plain_text("reference"))
    pair = pair.withColumn("ours", ours).withColumn("theirs", theirs)
    differ = (F.size("ours") > 0) & (F.size("theirs") > 0) & ~same_multiset(F.col("ours"), F.col("theirs"))
    marks = functools.reduce(Column.__or__, [F.col("content").contains(sign) & F.col("reference").rlike(rf"(^|[^A-Za-z]){letter}([^A-Za-z]|$)") for sign, letter in FOOTNOTE_MARKS.items()])
    pair = pair.withColumn("numbers_differ", differ).withColumn("marks_differ", marks)
    flagged = ((F.col("sequence") < 0.82) & (F.col("char_f1") < 0.90)) | F.col("numbers_differ") | F.col("marks_differ")
    return pair.select("block_id", "sequence", "char_f1", "numbers_differ", "marks_differ", flagged.alias("flagged"))


def surplus(a: Column, b: Column) -> Column:
    """The multiset difference of two arrays, sorted: each value as often as a has it more than b."""
    count = lambda x, v: F.size(F.filter(x, lambda y: y == v))
    return F.flatten(F.transform(F.array_sort(F.array_distinct(a)), lambda v: F.array_repeat(v, F.greatest(F.lit(0), count(a, v) - count(b, v)))))


def table_findings(blocks: DataFrame, references: DataFrame, reliability: DataFrame | None = None) -> DataFrame:
    """block_id, missing, added (numbers) of tables whose numbers differ from a reliable text layer that has about as many (TAB-005).

    Only a difference that matters counts: a number with a point or percent sign, or of two signs and more without sign and leading
    zeros. reliability: document_id, reliable; without it every layer counts as reliable."""
    tables = blocks.where(F.col("block_type") == "table")
    if reliability is not None:
        tables = tables.join(reliability.where("reliable").select("document_id"), "document_id", "left_semi")
    pair = _as_read(tables, references).withColumn("ours", T.number_tokens(plain_text("content"))).withColumn("theirs", T.number_tokens(plain_text("reference")))
    pair = pair.where((F.size("ours") > 0) & (F.size("theirs") > 0) & (F.least(F.size("ours"), F.size("theirs")) >= 0.85 * F.greatest(F.size("ours"), F.size("theirs"))))
    pair = pair.withColumn("missing", surplus(F.col("theirs"), F.col("ours"))).withColumn("added", surplus(F.col("ours"), F.col("theirs")))
    weighty = lambda v: v.rlike("[.%]") | (F.length(F.regexp_replace(v, "^[-+0]+", "")) >= 2)
    return pair.where(F.exists("missing", weighty) | F.exists("added", weighty)).select("block_id", F.array_join("missing", " ").alias("missing"), F.array_join("added", " ").alias("added"))


# completeness: lines of the text layer that no block has


def uncovered_lines(blocks: DataFrame, lines: DataFrame, margins: DataFrame, ink: DataFrame | None = None) -> DataFrame:
    """document_id, page_no, line_no, text, bbox, norm, outcome, target_id, ink_ratio of the lines that no text of their page contains.

    outcome: visual_covered (within an image or chart), semantic_covered, invisible, fill (an empty block covers it: target_id, of several
    the one with most of the line, then the first on the page) or gap. Left out are lines under two characters, repeated margins and
    lines that stand in the page's text, its blocks put together in their order. ink: document_id, page_no, line_no, ink_ratio (share of
    dark pixels); lines without it count as visible."""
    rows = page_lines(lines).where(F.length("norm") >= 2).join(margins.select("document_id", "norm"), ["document_id", "norm"], "left_anti")
    by_page = rows.groupBy("document_id", "page_no").agg(F.collect_list(F.struct("line_no", "text", "bbox", "norm")).alias("l"))  # the lines of one page
    texts = blocks.where(~T.blank(F.col("content"))).select("document_id", "page_no", "position", "block_id", normal_text(TB.flat_text("content")).alias("flat"))
    whole = texts.groupBy("document_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "block_id", "flat"))), lambda x: x["flat"]), "").alias("whole"))  # the blocks of one page
    left = by_page.join(whole, ["document_id", "page_no"], "left").withColumn("whole", F.coalesce("whole", F.lit("")))
    todo = left.select("document_id", "page_no", F.explode(F.filter("l", lambda x: ~F.col("whole").contains(x["norm"]))).alias("x")).select("document_id", "page_no", "x.*")
    b = blocks.where(F.col("bbox").isNotNull()).select("document_id", "page_no", "block_id", "position", F.col("block_type").alias("kind"), F.col("bbox").alias("b"), T.blank(F.col("content")).alias("bare"))
    over = todo.select("document_id", "page_no", "line_no", "bbox").join(b, ["document_id", "page_no"]).where(G.covers(F.col("b"), F.col("bbox"), DEFAULT.cover_ratio))
    semantic = ~F.col("kind").isin(*NOT_SEMANTIC)
    seen = over.groupBy("document_id", "page_no", "line_no").agg(
        F.max(F.col("kind").isin("image", "chart")).alias("visual"), F.max(semantic & ~F.col("bare")).alias("semantic"),
        F.min(F.when(semantic & F.col("bare"), F.struct((-G.share_of(F.col("bbox"), F.col("b"))).alias("s"), "position", "block_id"))).alias("empty"),
    )
    out = todo.join(seen, ["document_id", "page_no", "line_no"], "left")
    out = out.withColumn("ink_ratio", F.lit(None).cast("double")) if ink is None else out.join(ink.select("document_id", "page_no", "line_no", "ink_ratio"), ["document_id", "page_no", "line_no"], "left")
    outcome = F.when(F.col("visual"), "visual_covered").when(F.col("semantic"), "semantic_covered").when(F.coalesce(F.col("ink_ratio") < 0.004, F.lit(False)), "invisible").when(F.col("empty").isNotNull(), "fill").otherwise("gap")
    return out.withColumn("outcome", outcome).select("document_id", "page_no", "line_no", "text", "bbox", "norm", "outcome", F.when(F.col("outcome") == "fill", F.col("empty.block_id")).alias("target_id"), "ink_ratio")


def _recovered(reliable: Column) -> list[Column]:
    """source, status, chunk_eligible of what a text layer gives: its text where it is reliable, else an empty block for review."""
    return [F.when(reliable, "pdf_text_layer").otherwise("page_gap_detector").alias("source"), F.when(reliable, "repaired").otherwise("review").alias("status"), reliable.alias("chunk_eligible")]


def filled_blocks(uncovered: DataFrame, reliability: DataFrame) -> DataFrame:
    """block_id, resolved_content, source, status, chunk_eligible of empty blocks that uncovered lines fill: the lines in order where the layer is reliable."""
    rows = uncovered.where("outcome = 'fill'").join(reliability.select("document_id", "reliable"), "document_id", "left")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "bbox.x0", "text"))), lambda x: x["text"]), "\n")  # the lines of one block
    got = rows.groupBy(F.col("target_id").alias("block_id")).agg(text.alias("t"), F.first(F.coalesce("reliable", F.lit(False))).alias("r"))
    return got.select("block_id", F.when(F.col("r"), F.col("t")).otherwise("").alias("resolved_content"), *_recovered(F.col("r")))


SOURCE_NOTE = r"^\s*(?:数据来源|资料来源|注[：:]|说明[：:])"
TITLE_WORDS = r"附表|表\s*\d|图\s*\d|图表"


def gap_blocks(blocks: DataFrame, uncovered: DataFrame, reliability: DataFrame) -> DataFrame:
    """A new block for each line that nothing covers: document_id, page_no, block_id, block_type, bbox, reading_order (behind the page's blocks), raw_content (''), resolved_content, source, status, issue_flags, chunk_eligible, associated_table_id.

    Notes of a source are footnotes; what names a table or figure, or stands short and narrow above a close table, is a title; the rest text."""
    gaps = uncovered.where("outcome = 'gap'")
    near = nearest_table(blocks, gaps).select("document_id", "page_no", "line_no", "table_id")
    tops = blocks.where("block_type = 'table'").select(F.col("block_id").alias("table_id"), F.col("bbox.y0").alias("table_top"))
    count = blocks.groupBy("document_id", "page_no").agg(F.count("*").alias("n_blocks"))
    rows = gaps.join(near, ["document_id", "page_no", "line_no"], "left").join(tops, "table_id", "left").join(count, ["document_id", "page_no"], "left").join(reliability.select("document_id", "reliable"), "document_id", "left")
    reliable = F.coalesce("reliable", F.lit(False))
    above = F.coalesce(F.col("bbox.y1") <= F.col("table_top") + 15, F.lit(False)) & (F.length("norm") <= 40) & (G.width(F.col("bbox")) <= 650)
    kind = F.when(F.col("text").rlike(SOURCE_NOTE), "footnote").when(F.col("text").rlike(TITLE_WORDS) | above, "title").otherwise("text")
    flags = F.when(F.col("table_id").isNotNull(), F.array(F.lit("TXT-004"), F.lit("TAB-008"))).otherwise(F.array(F.lit("TXT-004")))
    own_id = T.stable_id(F.col("document_id"), F.lit("gap"), F.col("page_no").cast("string"), F.col("line_no").cast("string"), F.col("text"))
    return rows.select(
        "document_id", "page_no", own_id.alias("block_id"), kind.alias("block_type"), "bbox", F.coalesce("n_blocks", F.lit(0)).cast("int").alias("reading_order"), F.lit("").alias("raw_content"),
        F.when(reliable, T.strip(F.col("text"))).otherwise("").alias("resolved_content"), *_recovered(reliable), flags.alias("issue_flags"), F.col("table_id").alias("associated_table_id"),
    )


def completed_blocks(blocks: DataFrame, lines: DataFrame, pages: DataFrame | None = None, ink: DataFrame | None = None) -> DataFrame:
    """blocks (of laid_out) after the completeness audit: empty blocks filled and flagged, and new blocks for the gaps. Blocks with content are never changed."""
    rows = page_lines(lines)
    reliability = layer_reliability(blocks, rows)
    uncovered = cut_lineage(uncovered_lines(blocks, rows, repeated_margins(rows, pages), ink))  # few, read twice below
    fills = filled_blocks(uncovered, reliability).select("block_id", F.struct("resolved_content", "source", "status", "chunk_eligible").alias("f"))
    kept = blocks.drop("content", "position").join(fills, "block_id", "left")
    for name in ("resolved_content", "source", "status", "chunk_eligible"):
        kept = kept.withColumn(name, F.when(F.col("f").isNotNull(), F.col(f"f.{name}")).otherwise(F.col(name)))
    flags = F.coalesce("issue_flags", F.array().cast("array<string>"))
    kept = kept.withColumn("issue_flags", F.when(F.col("f").isNotNull(), F.array_union(flags, F.array(F.lit("TXT-004")))).otherwise(F.col("issue_flags"))).drop("f")
    return kept.unionByName(gap_blocks(blocks, uncovered, reliability), allowMissingColumns=True)


# arbitration between readings


def latest_reading(readings: DataFrame) -> DataFrame:
    """The last created reading of each block; of equals, the greatest result_id."""
    cols = [c for c in readings.columns if c != "block_id"]
    return readings.groupBy("block_id").agg(F.max_by(F.struct(*cols), F.struct("created_at", "result_id")).alias("r")).select("block_id", "r.*")


def proposal(block_type: Column) -> Column:
    """What a reading offers for a block of a type: the first of its fields that isn't empty."""
    text, structured = F.col("text"), F.coalesce("structured_data", F.lit(""))
    return F.when(block_type == "table", T.either(F.col("html"), text, structured)).when(block_type == "formula", T.either(F.col("latex"), text)).when(block_type.isin("image", "chart"), T.either(F.col("summary"), text, structured)).otherwise(T.either(text, F.col("summary")))


def arbitrate(blocks: DataFrame, readings: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """block_id, outcome, new_status, new_content, new_source, eligible (null: as before), flag of blocks with a second reading.

    The first reading of text, titles and footnotes is evidence and stays, unless the second holds it literally, adds text that is not in
    it already, keeps each of its numbers as often, and is 98% like the text layer: verified_addition. agreed: equal but for form.
    conflict: the first stays and goes to review. single_source: there was no first reading, or the type takes the second one.
    unreadable and empty readings never destroy a first reading. references: block_id, reference (of blocks that differ from it)."""
    read = readings.select("block_id", "readable", "text", "html", "latex", "summary", "structured_data")
    first, second = T.strip(F.coalesce("raw_content", F.lit(""))), T.strip(proposal(F.col("block_type")))
    pair = blocks.select("block_id", "block_type", "raw_content", "resolved_content").join(read, "block_id").withColumn("first", first).withColumn("second", second)
    pair = pair.withColumn("primary", F.col("block_type").isin(*READ_TYPES) & (F.length("first") > 0))
    refs = references.select("block_id", F.substring("reference", 1, 500).alias("reference")) if references is not None else blocks.select("block_id", F.lit(None).cast("string").alias("reference")).limit(0)
    pair = pair.join(refs, "block_id", "left").withColumn("a", canonical_text("first")).withColumn("b", canonical_text("second"))
    pair = pair.withColumn("near", addition_ratio("first", "second", T.strip(F.coalesce("reference", F.lit("")))))
    pair = pair.withColumn("ours", T.number_tokens(plain_text("first"))).withColumn("theirs", T.number_tokens(plain_text("second")))
    verified = (F.col("near") >= 0.98) & (F.size(surplus(F.col("ours"), F.col("theirs"))) == 0)
    outcome = (
        F.when(~F.coalesce("readable", F.lit(False)), "unreadable").when(F.length("second") == 0, "empty").when(~F.col("primary"), "single_source")
        .when((F.length("a") > 0) & (F.col("a") == F.col("b")), "agreed").when(verified, "verified_addition").otherwise("conflict")
    )
    pair = pair.withColumn("outcome", outcome)
    o, primary = F.col("outcome"), F.col("primary")
    status = F.when(o == "agreed", "accepted").when(o.isin("verified_addition", "single_source"), "repaired").when((o == "unreadable") & ~primary, "unreadable").otherwise("review")
    content = F.when(o.isin("verified_addition", "single_source"), F.col("second")).when(o.isin("agreed", "conflict"), F.col("first")).when(primary, F.col("raw_content")).otherwise(F.col("resolved_content"))
    source = F.when(o == "agreed", "both_agreed").when(o == "verified_addition", "second+text_layer").when(primary, "first").when(o.isin("single_source", "unreadable"), "second")
    eligible = F.when(o.isin("agreed", "verified_addition"), True).when(primary, False)
    return pair.select("block_id", "outcome", status.alias("new_status"), content.alias("new_content"), source.alias("new_source"), eligible.alias("eligible"), F.when(o == "conflict", "TXT-003").alias("flag"))


def crosscheck_tables(blocks: DataFrame, readings: DataFrame) -> DataFrame:
    """block_id, comparable, agreed, n_conflicts, n_format_differences, new_status, new_content, new_flags, tag of table blocks with a second reading.

    Agreement keeps the first table, takes TAB-010 away and counts as repaired; a conflict keeps it too, for review with TAB-010. An
    unreadable or empty reading changes the status only."""
    read = readings.select("block_id", "readable", T.strip(T.either(F.col("html"), F.col("text"))).alias("second"))
    pair = blocks.where(F.col("block_type") == "table").select("block_id", T.strip(F.coalesce("raw_content", F.lit(""))).alias("first"), F.coalesce("issue_flags", F.array().cast("array<string>")).alias("flags")).join(read, "block_id")
    got = TB.compared_tables(pair, "first", "second")
    lost = ~F.coalesce("readable", F.lit(False)) | (F.length("second") == 0)
    agreed = F.col("agreed") & ~lost
    status = F.when(~F.coalesce("readable", F.lit(False)), "unreadable").when(agreed, "repaired").otherwise("review")
    flags = F.when(lost, F.col("flags")).when(agreed, F.array_remove("flags", "TAB-010")).otherwise(F.array_union("flags", F.array(F.lit("TAB-010"))))
    tag = F.when(lost, "table_crosscheck_unavailable").when(agreed & (F.col("n_format_differences") > 0), "format_normalized_agreement").when(agreed, "dual_source_agreed").when(F.length("first") == 0, "first_empty").otherwise("dual_source_conflict")
    return got.select(
        "block_id", (F.col("comparable") & ~lost).alias("comparable"), agreed.alias("agreed"), F.when(lost, 0).otherwise(F.col("n_conflicts")).cast("long").alias("n_conflicts"), F.when(lost, 0).otherwise(F.col("n_format_differences")).cast("long").alias("n_format_differences"),
        status.alias("new_status"), F.when(~lost, T.either(F.col("first"), F.col("second"))).alias("new_content"), flags.alias("new_flags"), tag.alias("tag"),
    )


def recovered_tables(blocks: DataFrame, readings: DataFrame) -> DataFrame:
    """block_id, recovered_html, agreed, new_status, new_flags of images and charts that are tables (TAB-009): a reading says structure 'table' or brings a table.

    Of several tables that readings bring, the largest is taken; a second, different one confirms it (repaired) or not (review)."""
    tables = readings.where(F.col("readable") & F.lower("html").contains("<table")).select("block_id", "html", F.length("html").alias("n"), "result_id")
    best = tables.groupBy("block_id").agg(F.max_by("html", F.struct("n", "result_id")).alias("recovered_html"), F.max_by("result_id", F.struct("n", "result_id")).alias("best"))
    visual = blocks.where(F.col("block_type").isin("image", "chart")).select("block_id", F.coalesce("issue_flags", F.array().cast("array<string>")).alias("flags"))
    found = visual.join(best, "block_id")
    others = tables.join(best.select("block_id", "best", "recovered_html"), "block_id").where("result_id <> best")
    agreed = TB.compared_tables(others, "recovered_html", "html").groupBy("block_id").agg(F.max("agreed").alias("agreed"))
    out = found.join(agreed, "block_id", "left").withColumn("agreed", F.coalesce("agreed", F.lit(False)))
    return out.select("block_id", "recovered_html", "agreed", F.when(F.col("agreed"), "repaired").otherwise("review").alias("new_status"), F.array_union("flags", F.array(F.lit("TAB-009"))).alias("new_flags"))


def revisions(blocks: DataFrame, readings: DataFrame) -> DataFrame:
    """block_id, revision_no, source, content: the primary reading, then second readings by time; blocks with one reading only are left out."""
    first = blocks.select("block_id", F.lit("primary").alias("source"), F.col("raw_content").alias("content"), F.lit(None).cast("timestamp").alias("at"), F.lit("").alias("tie"))
    second = readings.select("block_id", F.concat(F.lit("reading:"), F.coalesce("task", F.lit(""))).alias("source"), T.either(F.col("text"), F.col("html"), F.col("latex")).alias("content"), F.col("created_at").alias("at"), F.col("result_id").alias("tie"))
    both = first.join(second.select("block_id").distinct(), "block_id", "left_semi").unionByName(second.join(blocks.select("block_id"), "block_id", "left_semi"))
    w = Window.partitionBy("block_id").orderBy(F.col("at").asc_nulls_first(), "tie")
    return both.select("block_id", F.row_number().over(w).cast("long").alias("revision_no"), "source", "content")
