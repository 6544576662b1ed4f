"""Page layout: templates, context of visuals, carried-over lines, reading order and section paths.

Blocks are rows with block_id, document_id, page_no, block_type, bbox, content, reading_order, position (order on the page as delivered),
text_level, skip_chunk; pages are rows with document_id, page_no, width, height. Spatial joins have document and page as equi keys."""

from __future__ import annotations

from statistics import median

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as T
from foliant.options import DEFAULT, TEMPLATE_TYPES, VISUAL_TYPES
from foliant.sources.tables import delivered_once


# The columns of a block that the operators know; others are dropped, so that names of extra columns cannot clash.
KNOWN = (
    "block_id", "document_id", "page_no", "block_type", "bbox", "reading_order", "raw_content", "resolved_content", "source", "asset_id", "section_path", "issue_flags", "status", "text_level",
    "column_index", "skip_chunk", "chunk_eligible", "source_pages",
)


def laid_out(blocks: DataFrame) -> DataFrame:
    """One row per block_id with content ('' where there is none) and position (blocks without order come last); rows without id are dropped."""
    rows = delivered_once(blocks, "block_id").select(*KNOWN)
    return rows.withColumn("content", T.content()).withColumn("position", F.coalesce("reading_order", F.lit(1 << 20)))


def _side(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit(0.0)), F.lit(1000.0))


def templates(blocks: DataFrame, pages: DataFrame, share: float = DEFAULT.template_share) -> DataFrame:
    """block_id, template_kind (page_number, repeated_header, repeated_footer) of page furniture in documents of two pages and more."""
    placed = blocks.where(F.col("bbox").isNotNull() & ~T.blank(F.col("content"))).withColumn("key", T.template_key(F.col("content"))).where((F.length("key") > 0) & (F.length("key") <= 120))
    tall = placed.groupBy("document_id", "page_no").agg(F.max("bbox.y1").alias("max_y"))
    sizes = tall.join(pages.select("document_id", "page_no", "height"), ["document_id", "page_no"], "left")
    height = F.when((F.col("height") > 0) & (F.col("max_y") <= F.col("height") * 1.5), F.col("height")).otherwise(F.coalesce(F.nullif("max_y", F.lit(0.0)), F.nullif("height", F.lit(0.0)), F.lit(1.0)))
    sizes = sizes.select("document_id", "page_no", height.alias("h"))
    count = blocks.groupBy("document_id").agg(F.count_distinct("page_no").alias("n")).where("n >= 2").select("document_id", F.greatest(F.lit(2), F.floor(F.col("n") * share + 0.5)).alias("needed"))
    often = placed.groupBy("document_id", "key").agg(F.count_distinct("page_no").alias("on_pages")).join(count, "document_id").where("on_pages >= needed").select("document_id", "key", F.lit(True).alias("repeated"))
    judged = placed.join(sizes, ["document_id", "page_no"]).join(count.select("document_id"), "document_id", "left_semi").join(often, ["document_id", "key"], "left")
    y = (F.col("bbox.y0") + F.col("bbox.y1")) / 2 / F.col("h")
    kind = F.when(T.compact(F.col("content")).rlike(T.PAGE_NUMBER) & (y >= 0.78), "page_number").when(F.col("repeated") & (y <= 0.14), "repeated_header").when(F.col("repeated") & (y >= 0.86), "repeated_footer")
    return judged.select("block_id", kind.alias("template_kind")).where("template_kind is not null")


def _caption_like(text: Column) -> Column:
    return (F.length(T.compact(text)) <= 50) & ~text.contains("\n") & ~text.rlike("[。！？；]")


def table_context(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """context_id, table_id, kind of the blocks that belong to a table: the first table in page order that can claim a block keeps it."""
    sizes = pages.select("document_id", "page_no", _side("height").alias("ph"), _side("width").alias("pw"))
    tables = blocks.where((F.col("block_type") == "table") & F.col("bbox").isNotNull()).select("document_id", "page_no", F.col("block_id").alias("table_id"), F.col("bbox").alias("t"), F.col("position").alias("table_position"))
    allowed = F.col("block_type").isin("title", "text", "footnote") & F.col("bbox").isNotNull() & ~T.blank(F.col("content")) & ~F.coalesce(F.col("skip_chunk"), F.lit(False))
    context = blocks.where(allowed).select("document_id", "page_no", F.col("block_id").alias("context_id"), "block_type", F.col("bbox").alias("c"), "text_level", T.context_kind(F.col("content"), F.col("block_type")).alias("kind"), _caption_like(F.col("content")).alias("caption_like"))
    pair = tables.join(context, ["document_id", "page_no"]).join(sizes, ["document_id", "page_no"], "left").withColumn("ph", F.coalesce("ph", F.lit(1000.0))).withColumn("pw", F.coalesce("pw", F.lit(1000.0)))
    t, c = F.col("t"), F.col("c")
    aligned = ~((c["x1"] < t["x0"]) | (c["x0"] > t["x1"]))
    above, below = t["y0"] - c["y1"], c["y0"] - t["y1"]
    over = above.between(F.lit(0.0), F.col("ph") * 0.09) & aligned
    over_fits = (F.col("kind") != "title") | (F.col("block_type") == "title") | F.col("text_level").isNotNull() | F.col("caption_like")
    under = (F.col("kind") == "note") & below.between(F.lit(0.0), F.col("ph") * 0.08) & aligned
    tall = G.height(c) >= G.width(c) * 1.4
    beside = tall & (F.least(F.abs(t["x0"] - c["x1"]), F.abs(c["x0"] - t["x1"])) <= F.col("pw") * 0.08) & (G.y_overlap(c, t) >= F.least(G.height(c), G.height(t)) * 0.25)
    fits = F.when(over, over_fits).otherwise(under | beside)
    first = Window.partitionBy("context_id").orderBy("table_position", "table_id")  # the tables of one page
    return pair.where(fits).withColumn("n", F.row_number().over(first)).where("n = 1").select("document_id", "context_id", "table_id", "kind")


KIND_RANKS = {"title": 0, "reference": 1, "date": 2, "unit": 3, "note": 4}


def table_captions(blocks: DataFrame, context: DataFrame) -> DataFrame:
    """table_id, caption_block_id, caption: of a table's context the descriptive titles (4 characters and more) first, then the nearest, then by kind.

    A block above is as far as the gap between them, any other as far as its right edge from the table's left; without boxes it comes last."""
    c = context.join(blocks.select(F.col("block_id").alias("context_id"), "content", F.col("bbox").alias("c"), "position"), "context_id").join(blocks.select(F.col("block_id").alias("table_id"), F.col("bbox").alias("t")), "table_id")
    gap = F.when(F.col("c").isNull() | F.col("t").isNull(), F.lit(float("inf"))).when(F.col("c.y1") <= F.col("t.y0"), F.col("t.y0") - F.col("c.y1")).otherwise(F.abs(F.col("t.x0") - F.col("c.x1")))
    pairs = [x for k, v in KIND_RANKS.items() for x in (F.lit(k), F.lit(v))]
    plain = F.when((F.col("kind") == "title") & (F.length(T.compact(F.col("content"))) >= 4), 0).otherwise(1)
    score = F.struct(plain.alias("d"), gap.alias("g"), F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("kind")), F.lit(5)).alias("k"), "position", "context_id")
    return c.groupBy("table_id").agg(F.min_by(F.struct("context_id", T.strip(F.col("content")).alias("caption")), score).alias("b")).select("table_id", F.col("b.context_id").alias("caption_block_id"), "b.caption")


def visual_captions(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """block_id, caption, caption_block_id of images, charts and formulas: the nearest block that ends above, if it is close (as-of join)."""
    sizes = pages.select("document_id", "page_no", _side("height").alias("ph"))
    visual = blocks.where(F.col("block_type").isin("image", "chart", "formula") & F.col("bbox").isNotNull()).select("document_id", "page_no", "block_id", F.col("bbox").alias("v"))
    allowed = F.col("block_type").isin("title", "text", "footnote", "header") & F.col("bbox").isNotNull() & ~T.blank(F.col("content")) & ~F.coalesce(F.col("skip_chunk"), F.lit(False))
    context = blocks.where(allowed).select("document_id", "page_no", F.col("block_id").alias("caption_block_id"), F.col("bbox").alias("c"), T.strip(F.col("content")).alias("caption"), "position")
    pair = visual.join(context, ["document_id", "page_no"]).where("c.y1 <= v.y0").join(sizes, ["document_id", "page_no"], "left")
    nearest = F.max_by(F.struct("caption", "caption_block_id", F.col("c.y1").alias("y1")), F.struct(F.col("c.y1"), -F.col("position"), "caption_block_id"))
    best = pair.groupBy("block_id").agg(nearest.alias("n"), F.first("v.y0").alias("y0"), F.first(F.coalesce("ph", F.lit(1000.0))).alias("ph"))
    return best.where(F.col("y0") - F.col("n.y1") <= F.col("ph") * 0.12).select("block_id", "n.caption", "n.caption_block_id")


def carried_over(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """block_id, duplicate_of, from_page of text at a page's top that the page before has already: white space apart, contained in one of its blocks."""
    sizes = pages.select("document_id", "page_no", _side("height").alias("ph"))
    top = blocks.where((F.col("block_type") == "text") & F.col("bbox").isNotNull() & ~T.blank(F.col("content"))).join(sizes, ["document_id", "page_no"], "left")
    top = top.where(F.col("bbox.y0") <= F.coalesce("ph", F.lit(1000.0)) * 0.20)
    first = Window.partitionBy("document_id", "page_no").orderBy("bbox.y0", "bbox.x0", "position", "block_id")
    top = top.withColumn("n", F.row_number().over(first)).where("n <= 3").withColumn("flat", T.compact(F.col("content"))).where(F.length("flat").between(5, 220))
    top = top.select("document_id", (F.col("page_no") - 1).alias("page_no"), "block_id", "flat")
    before = blocks.where(~T.template_type() & ~T.blank(F.col("content"))).select("document_id", "page_no", F.col("block_id").alias("duplicate_of"), T.compact(F.col("content")).alias("other"), "position")
    pair = top.join(before, ["document_id", "page_no"]).where(F.col("other").contains(F.col("flat")) & ((F.length("flat") >= 12) | F.col("other").endswith(F.col("flat"))))
    return pair.groupBy("block_id").agg(F.max_by("duplicate_of", F.struct("position", "duplicate_of")).alias("duplicate_of"), F.max("page_no").alias("from_page"))


def neighbours(blocks: DataFrame) -> DataFrame:
    """block_id, place (0-based on the page), previous_id, next_id."""
    w = Window.partitionBy("document_id", "page_no").orderBy("position", "block_id")
    return blocks.select("block_id", (F.row_number().over(w) - 1).cast("long").alias("place"), F.lag("block_id").over(w).alias("previous_id"), F.lead("block_id").over(w).alias("next_id"))


# reading order, page by page

# What a block's text tells about its place; read in the JVM, so that texts stay where they are.
YEAR_END = r"(?:截至|自|至|到)\s*\d{4}\s*年(?:第?[一二三四1234]\s*季度)?\s*$"
YEAR_GOES_ON = r"^(?:末|初|底|以来|上半年|下半年)[，,、：:]?"
CHAPTER_BEGINS = r"^(?:第[一二三四五六七八九十百\d]+[编章节篇]|专栏|专题)"
REFERENCE_RANK, UNIT_RANK, NOTE_RANK, DATE_RANK = r"^(?:附表|表|图)\d+", r"^[（(]?(?:单位|币种)[：:]", r"^(?:[（(]?(?:注|说明|数据来源|资料来源)[：:]|[①-⑩])", r"^[（(].*(?:余额|日期).*[）)]$"


def _order_features(content: Column, block_type: Column) -> Column:
    """rank (of a line of context: references, titles, units, dates, notes), chapter, year_end, goes_on."""

    def rank(flat: Column) -> Column:
        return F.when(flat.rlike(REFERENCE_RANK), 0).when(flat.rlike(UNIT_RANK), 2).when(flat.rlike(NOTE_RANK) | (block_type == "footnote"), 4).when(flat.rlike(DATE_RANK), 3).otherwise(1)

    return T.let(T.strip(content), lambda t: F.struct(T.let(T.compact(t), rank).alias("rank"), t.rlike(CHAPTER_BEGINS).alias("chapter"), t.rlike(YEAR_END).alias("year_end"), t.rlike(YEAR_GOES_ON).alias("goes_on")))


class _Box:
    """A block of one page while its order is worked out."""

    __slots__ = ("chapter", "column", "context_rank", "flags", "goes_on", "id", "kind", "level", "order", "role", "table", "x0", "x1", "y0", "y1", "year_end")

    def __init__(self, row):
        self.id, self.kind, self.level, self.table, self.order = row.block_id, row.block_type, row.text_level, row.table_id, row.position
        self.context_rank, self.chapter, self.year_end, self.goes_on = row.rank, row.chapter, row.year_end, row.goes_on
        self.x0, self.y0, self.x1, self.y1 = row.x0, row.y0, row.x1, row.y1
        self.flags, self.column, self.role = [], None, None

    cx = property(lambda self: (self.x0 + self.x1) / 2)
    cy = property(lambda self: (self.y0 + self.y1) / 2)
    w = property(lambda self: max(0.0, self.x1 - self.x0))
    h = property(lambda self: max(0.0, self.y1 - self.y0))
    rows = property(lambda self: (self.y0, self.x0, self.order, self.id))
    context_key = property(lambda self: (self.context_rank, self.y0, self.x0))


def _by_columns(boxes: list[_Box], width: float) -> tuple[list[_Box], bool]:
    """Column by column where two or three columns of at least two blocks stand clearly apart, else row by row."""
    if len(boxes) >= 4:
        across = sorted(boxes, key=lambda b: (b.cx, b.y0, b.order, b.id))
        columns = [[across[0]]]
        for left, right in zip(across, across[1:]):
            if right.cx - left.cx >= 0.14 * width:
                columns.append([])
            columns[-1].append(right)
        if 2 <= len(columns) <= 3 and min(map(len, columns)) >= 2:
            middle = [median(b.cx for b in c) for c in columns]
            if min(b - a for a, b in zip(middle, middle[1:])) >= 0.12 * width:
                for k, column in enumerate(columns):
                    column.sort(key=lambda b: b.rows)
                    for b in column:
                        b.column = k
                        b.flags.append("LAY-001")
                return [b for column in columns for b in column], True
    return sorted(boxes, key=lambda b: b.rows), False


def _turned(boxes: list[_Box]) -> list[_Box]:
    """Tables that stand side by side on a turned page, each with its context."""
    tables = sorted((b for b in boxes if b.kind == "table"), key=lambda b: (b.x0, b.y0))
    ids = {t.id for t in tables}
    own: dict[str, list[_Box]] = {t.id: [] for t in tables}
    loose = []
    for b in boxes:
        if b.id not in ids:
            own[b.table].append(b) if b.table in own else loose.append(b)
    top = min(t.y0 for t in tables)
    out = sorted((b for b in loose if b.y1 < top), key=lambda b: (b.y0, b.x0))
    for k, t in enumerate(tables):
        context = sorted(own[t.id], key=lambda b: b.context_key)
        for b in [*(c for c in context if c.context_rank < 4), t, *(c for c in context if c.context_rank >= 4)]:
            b.column = k
            b.flags.append("LAY-002")
            out.append(b)
    return out + sorted((b for b in loose if b.y1 >= top), key=lambda b: (b.x0, b.y0, b.order))


def order_page(boxes: list[_Box], width: float) -> tuple[list[_Box], str]:
    """The placed blocks of a page in reading order and the strategy. Full-width blocks cut the page into bands; each band is read by columns."""
    tall = sum(b.kind == "table" and b.h >= 1.6 * b.w for b in boxes)
    beside = sum(b.kind not in VISUAL_TYPES and b.h >= 1.8 * b.w for b in boxes)
    if tall >= 2 or (any(b.kind == "table" for b in boxes) and beside >= 2):
        return _turned(boxes), "rotated_table_groups"
    margin = [b for b in boxes if b.kind == "text" and b.h >= 3 * b.w and (b.x0 >= 0.80 * width or b.x1 <= 0.12 * width) and not b.table]
    apart = {b.id for b in margin}
    context: dict[str, list[_Box]] = {}
    for b in boxes:
        if b.table:
            context.setdefault(b.table, []).append(b)
    bound = {b.id for group in context.values() for b in group}
    bars = []
    for b in boxes:
        if b.id in apart:
            continue
        visual = b.kind in VISUAL_TYPES
        heading = b.kind == "title" or b.level is not None or b.chapter
        wide = b.w >= 0.66 * width if visual else b.id not in bound and (b.w >= 0.72 * width or (heading and b.w >= 0.58 * width and b.h <= 0.08 * width))
        if wide:
            bars.append(b)
    begin = {b.id: min([b.y0, *(c.y0 for c in context.get(b.id, ()))]) for b in bars}
    bars.sort(key=lambda b: (begin[b.id], b.x0, b.order))
    barred = {b.id for b in bars}
    rest = [b for b in boxes if b.id not in barred | bound | apart]
    out: list[_Box] = []
    used, columns, line = set(), False, float("-inf")
    for bar in bars:
        band = [b for b in rest if b.id not in used and line <= b.cy < begin[bar.id]]
        ordered, split = _by_columns(band, width)
        own = sorted(context.get(bar.id, ()), key=lambda b: b.context_key)
        out += [*ordered, *own, bar]
        columns |= split
        used.update(b.id for b in [*band, *own, bar])
        line = max(line, bar.y1)
    ordered, split = _by_columns([b for b in rest if b.id not in used], width)
    out += ordered
    for b in sorted(margin, key=lambda b: (b.x0, b.y0)):
        b.role = "marginal_vertical"
        out.append(b)
    shown = {b.id for b in out}
    out += sorted((b for b in boxes if b.id not in shown), key=lambda b: b.rows)
    return out, "layout_columns" if columns or split else "layout_rows"


def mend_years(boxes: list[_Box]) -> tuple[list[_Box], int]:
    """A block that ends with a year goes before the block to its right whose text goes on after the year."""
    out, mended = list(boxes), 0
    for place, prefix in enumerate(boxes):
        if not prefix.year_end:
            continue
        at = next((k for k, b in enumerate(out) if b.id == prefix.id), place)
        after = [b for b in out[:at] if b.kind == "text" and b.goes_on and prefix.x0 < b.x0 and abs(prefix.y0 - b.y0) <= 100]
        if after:
            out.remove(prefix)
            out.insert(out.index(after[-1]), prefix)
            mended += 1
    return out, mended


def _order_pages(frame: pd.DataFrame) -> pd.DataFrame:
    boxes, plain, furniture = [], [], []
    for row in frame.itertuples():
        b = _Box(row)
        (furniture if b.kind in TEMPLATE_TYPES else plain if pd.isna(row.x0) else boxes).append(b)
        b.level = None if pd.isna(row.text_level) else row.text_level
        b.table = row.table_id if isinstance(row.table_id, str) else None
    page_width = frame["width"].iloc[0]
    if boxes:
        most = max(b.x1 for b in boxes)
        width = page_width if page_width and page_width > 0 and most <= 1.5 * page_width else most or 1.0
        ordered, strategy = order_page(boxes, width)
        ordered, mended = mend_years(ordered)
    else:
        ordered, strategy, mended = [], "delivered_order", 0
    if boxes:
        ordered += sorted(plain, key=lambda b: b.order) + sorted(furniture, key=lambda b: b.order)
    else:
        ordered = sorted(plain + furniture, key=lambda b: b.order)
    n = len(ordered)
    return pd.DataFrame({
        "document_id": frame["document_id"].iloc[0], "page_no": frame["page_no"].iloc[0], "block_id": [b.id for b in ordered], "place": range(n), "column_index": pd.array([b.column for b in ordered], "Int64"),
        "new_flags": [",".join(dict.fromkeys(b.flags)) for b in ordered], "strategy": strategy, "mended": mended,
    })


def reading_order(blocks: DataFrame, pages: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """document_id, page_no, block_id, place (0-based), column_index, new_flags, strategy, mended. One group is one page; of its texts only a few features go there."""
    own = (context if context is not None else table_context(blocks, pages)).select(F.col("context_id").alias("block_id"), "table_id")
    rows = blocks.join(own, "block_id", "left").join(pages.select("document_id", "page_no", "width"), ["document_id", "page_no"], "left")
    rows = rows.where("document_id is not null and page_no is not null").select("document_id", "page_no", "block_id", "block_type", _order_features(F.col("content"), F.col("block_type")).alias("f"), "text_level", "table_id", "position", "width", *[F.col(f"bbox.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    rows = rows.select("*", "f.*").drop("f")
    schema = "document_id string, page_no int, block_id string, place long, column_index long, new_flags string, strategy string, mended long"
    return rows.groupBy("document_id", "page_no").applyInPandas(_order_pages, schema)


# sections


def section_paths(blocks: DataFrame, context: DataFrame) -> DataFrame:
    """block_id, is_heading, level, section_path (levels joined by ' / ') along each document's reading order.

    The path at a block has, of each level, the last heading of that level that no later heading of a smaller level has closed. A bare
    chapter label and its name, headings on one page with no content between, count as one heading. No window holds more of a document
    than its headings, one row for each page, or the blocks of one page."""
    candidate = (F.col("block_type") == "title") | F.col("text_level").isNotNull()
    short = candidate & ~T.blank(F.col("content")) & (T.context_kind(F.col("content"), F.col("block_type")) == "title") & (F.length(T.compact(F.col("content"))) <= 100)
    # texts stay behind: only what may be a heading goes on
    slim = blocks.select("document_id", "page_no", "position", "block_id", F.when(short, T.strip(F.col("content"))).alias("title"), F.when(short, T.title_level(F.col("content"))).alias("level"), (~T.blank(F.col("content")) & ~T.template_type()).alias("solid"))
    rows = slim.join(context.select(F.col("context_id").alias("block_id"), F.lit(True).alias("bound")), "block_id", "left")
    rows = rows.withColumn("is_heading", F.col("title").isNotNull() & F.col("bound").isNull()).withColumn("at", F.struct("page_no", "position", "block_id"))
    inner = Window.partitionBy("document_id", "page_no").orderBy("at")
    w = Window.partitionBy("document_id").orderBy("at")  # over headings only
    kept = rows.where("is_heading or solid").select("document_id", "block_id", "page_no", "at", "is_heading", "title", "level")
    kept = kept.withColumn("ahead", F.lag(F.struct("is_heading", "title")).over(inner)).where("is_heading")
    label = F.coalesce(F.col("ahead.is_heading") & T.compact(F.col("ahead.title")).rlike(r"^第[一二三四五六七八九十百\d]+[编章节篇]$") & (F.col("level") == 1) & ~T.compact(F.col("title")).rlike("^(?:第|专栏|专题)"), F.lit(False))
    heads = kept.withColumn("title", F.when(label, F.concat(F.col("ahead.title"), F.lit(" "), F.col("title"))).otherwise(F.col("title")))
    for level in range(1, 6):
        heads = heads.withColumn(f"l{level}", F.last(F.when(F.col("level") == level, F.struct("at", "title")), True).over(w))
        heads = heads.withColumn(f"c{level}", F.last(F.when(F.col("level") < level, F.col("at")), True).over(w))
    part = lambda k: F.when((F.col("level") >= k) & F.col(f"l{k}").isNotNull() & (F.col(f"c{k}").isNull() | (F.col(f"l{k}.at") > F.col(f"c{k}"))), F.col(f"l{k}.title"))
    heads = heads.select("block_id", "level", F.concat_ws(" / ", *[part(k) for k in range(1, 6)]).alias("path"))
    every = rows.select("document_id", "page_no", "block_id", "at", "is_heading").join(heads, "block_id", "left")
    # a page's blocks take the last path on their page, else the one that earlier pages leave; the second window has one row a page
    pages = every.groupBy("document_id", "page_no").agg(F.max_by("path", F.when(F.col("path").isNotNull(), F.col("at"))).alias("page_path"))
    before = Window.partitionBy("document_id").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select("document_id", "page_no", F.last("page_path", True).over(before).alias("earlier"))
    every = every.withColumn("own", F.last("path", True).over(inner)).join(pages, ["document_id", "page_no"], "left")
    return every.select("block_id", "is_heading", F.when(F.col("is_heading"), F.col("level")).cast("long").alias("level"), F.coalesce("own", "earlier", F.lit("")).alias("section_path"))
