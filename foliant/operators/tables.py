"""Table operators: cells, headers, records, comparison, continuation over pages, merging and row groups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from foliant.functions import geometry as G
from foliant.functions import htmltable as H
from foliant.functions import text as T
from foliant.options import DEFAULT
from foliant.session import cut_lineage

_STRINGS = ArrayType(StringType())
GRID = StructType([StructField("cells", ArrayType(_STRINGS)), StructField("header_rows", IntegerType()), StructField("pages", ArrayType(IntegerType()))])


def _grid(text: str | None):
    try:
        g = H.parse_grid(text or "")
    except H.TableError:
        return None
    return {"cells": g.cells, "header_rows": g.header_rows, "pages": g.pages}


@F.pandas_udf(GRID)
def parsed_grid(texts: pd.Series) -> pd.DataFrame:
    """The grid of a table text; null where there is none."""
    rows = [_grid(t) for t in texts]
    return pd.DataFrame([r or {"cells": None, "header_rows": None, "pages": None} for r in rows], columns=["cells", "header_rows", "pages"])


def _shape(texts: pd.Series) -> pd.Series:
    out = []
    for t in texts:
        g = _grid(t) if t else None
        out.append(f"{len(g['cells'])}x{len(g['cells'][0])}" if g else None)
    return pd.Series(out, dtype=object)


table_shape = F.pandas_udf(_shape, StringType())
similarity = F.pandas_udf(lambda a, b: pd.Series([H.similar(x, y, True) if x and y else 0.0 for x, y in zip(a, b)], dtype=float), DoubleType())
header_text = F.pandas_udf(lambda t: pd.Series([H.header_text(x or "") for x in t], dtype=object), StringType())
column_count = F.pandas_udf(lambda t: pd.Series([H.column_count(x or "") for x in t]).astype("int64"), LongType())
flat_text = F.pandas_udf(lambda t: pd.Series([H.flatten(x) for x in t], dtype=object), StringType())


def column_names(cells: Column, header_rows: Column) -> Column:
    """Per column, its header texts from top to bottom joined by ' / ', blank cells and direct repeats left out; columns without a name get their number."""
    tops = F.slice(cells, 1, header_rows)

    def name(c: Column) -> Column:
        down = F.filter(F.transform(tops, lambda row: F.element_at(row, c)), lambda v: F.length(v) > 0)
        return F.array_join(F.filter(down, lambda v, k: (k == 0) | (F.get(down, k - 1) != v)), " / ")

    return F.transform(F.sequence(F.lit(1), F.size(F.element_at(cells, 1))), lambda c: F.coalesce(F.nullif(name(c), F.lit("")), F.concat(F.lit("第"), c.cast("string"), F.lit("列"))))


def told_apart(names: Column) -> Column:
    """Names that several columns have get the column's number behind them."""
    return F.transform(names, lambda n, k: F.when(F.size(F.filter(names, lambda m: m == n)) > 1, F.concat(n, F.lit(" [第"), (k + 1).cast("string"), F.lit("列]"))).otherwise(n))


def with_headers(df: DataFrame, grid: str = "grid") -> DataFrame:
    """df with headers: the header path of every column of a parsed grid; null where there is no grid."""
    named = df.withColumn("headers", F.when(F.col(f"{grid}.cells").isNotNull(), column_names(F.col(f"{grid}.cells"), F.col(f"{grid}.header_rows"))))
    return named.withColumn("headers", told_apart(F.col("headers")))


def with_grids(df: DataFrame, key: str, field: str) -> DataFrame:
    """key, cells, header_rows, pages, headers of the rows that hold a table."""
    rows = df.select(key, parsed_grid(F.col(field)).alias("grid")).where("grid.cells is not null")
    return with_headers(rows).select(key, "grid.cells", "grid.header_rows", "grid.pages", "headers")


def table_cells(grids: DataFrame, key: str) -> DataFrame:
    """key, row_no, column_no, value, is_header of every logical cell."""
    rows = grids.select(key, "header_rows", F.posexplode("cells").alias("row_no", "row"))
    return rows.select(key, "row_no", "header_rows", F.posexplode("row").alias("column_no", "value")).select(key, "row_no", "column_no", "value", (F.col("row_no") < F.col("header_rows")).alias("is_header"))


def table_headers(grids: DataFrame, key: str) -> DataFrame:
    """key, column_no, header path."""
    return grids.select(key, F.posexplode("headers").alias("column_no", "header"))


def table_records(grids: DataFrame, key: str) -> DataFrame:
    """key, row_index (counts blank rows too), source_page, headers, row (cell texts) of the body rows that aren't blank."""
    rows = grids.select(key, "header_rows", "headers", "pages", F.posexplode("cells").alias("r", "row")).where("r >= header_rows")
    rows = rows.where(F.exists("row", lambda v: F.length(v) > 0))
    return rows.select(key, (F.col("r") - F.col("header_rows")).alias("row_index"), F.element_at("pages", F.col("r") + 1).alias("source_page"), "headers", "row")


def record_text(headers: Column, row: Column, page: Column) -> Column:
    """A body row as text, with its page where it is known."""
    pairs = F.filter(F.arrays_zip(headers.alias("h"), row.alias("v")), lambda x: F.length(x["v"]) > 0)
    body = F.concat(F.lit("数据行："), F.array_join(F.transform(pairs, lambda x: F.concat(x["h"], F.lit("="), x["v"])), "；"))
    return F.when(page.isNotNull() & (page != 0), F.concat(F.lit("来源页："), page.cast("string"), F.lit("\n"), body)).otherwise(body)


def compared_tables(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """pairs with comparable, agreed, n_conflicts, n_format_differences."""

    @F.pandas_udf("struct<comparable:boolean,agreed:boolean,n_conflicts:long,n_format_differences:long>")
    def both(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([H.compare(x or "", y or "") for x, y in zip(a, b)], columns=["comparable", "agreed", "n_conflicts", "n_format_differences"])

    return pairs.withColumn("c", both(left, right)).select(*pairs.columns, "c.*")


# continuation over pages

REFERENCE = r"(?:附表|表)\s*([一二三四五六七八九十百\d]+(?:[-—.]\d+)?)"
EXCLUDED = r"^[（(]?\s*(?:单位|币种|注|说明|数据来源|资料来源)[：:]|^[（(]?\s*(?:截至)?\d{4}年.*[）)]?$"


def table_identities(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """block_id, references, titles (joined, compared form), words of the tables: what close blocks above them say, without units and notes.

    blocks: one row per block with document_id, page_no, block_type, bbox, content, position. The join has document and page as equi keys."""
    tables = blocks.where("block_type = 'table'").select("document_id", "page_no", F.col("block_id").alias("table_id"), F.col("bbox").alias("t"))
    others = blocks.where(~T.template_type() & ~T.blank(F.col("content"))).select("document_id", "page_no", "block_id", "bbox", "content", "position")
    near = tables.join(others, ["document_id", "page_no"]).join(pages.select("document_id", "page_no", "height"), ["document_id", "page_no"], "left").where("block_id <> table_id")
    gap = F.col("t.y0") - F.col("bbox.y1")
    near = near.where(F.col("t").isNotNull() & F.col("bbox").isNotNull() & gap.between(F.lit(0.0), F.coalesce(F.nullif("height", F.lit(0.0)), F.lit(1000.0)) * 0.09) & (G.x_overlap(F.col("t"), F.col("bbox")) > 0))
    value = T.strip(F.col("content"))
    near = near.withColumn("v", value).where(~F.col("v").rlike(EXCLUDED))
    flat = T.compact(F.col("v"))
    plain = flat.rlike(r"^(?:续)?(?:附表|表)\s*[一二三四五六七八九十百\d]+(?:[-—.]\d+)?$") | flat.rlike("^续表$")
    items = F.array_sort(F.collect_list(F.struct("position", "v", F.regexp_extract("v", REFERENCE, 1).alias("ref"), plain.alias("plain"))))  # close blocks of one page
    got = near.groupBy(F.col("table_id").alias("block_id")).agg(items.alias("x"))
    refs = F.array_distinct(F.filter(F.transform("x", lambda i: i["ref"]), lambda r: F.length(r) > 0))
    titles = F.array_distinct(F.transform(F.filter("x", lambda i: ~i["plain"]), lambda i: i["v"]))
    title = F.substring(F.regexp_replace(F.lower(T.compact(F.array_join(titles, " "))), r"[（(].*?(?:余额|日期).*?[）)]", ""), 1, 160)
    return got.select("block_id", refs.alias("references"), title.alias("title"), F.array_join(F.transform("x", lambda i: i["v"]), " ").alias("words"))


def continuation_pairs(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """document_id, previous_id, current_id with evidence and score of each page's last table and the next page's first one."""
    tables = blocks.where((F.col("block_type") == "table") & ~F.coalesce(F.col("skip_chunk"), F.lit(False)))
    spot = Window.partitionBy("document_id", "page_no").orderBy("position", "block_id")
    back = Window.partitionBy("document_id", "page_no").orderBy(F.desc("position"), F.desc("block_id"))
    ranked = tables.withColumn("first", F.row_number().over(spot)).withColumn("last", F.row_number().over(back)).select("document_id", "page_no", "block_id", "bbox", "content", "first", "last")
    sizes = pages.select("document_id", "page_no", F.coalesce(F.nullif("height", F.lit(0.0)), F.lit(1000.0)).alias("height"))
    who = table_identities(blocks, pages)
    side = ranked.join(sizes, ["document_id", "page_no"], "left").join(who, "block_id", "left").withColumn("height", F.coalesce("height", F.lit(1000.0)))
    a = side.where("last = 1").select("document_id", "page_no", *[F.col(c).alias(f"p_{c}") for c in ("block_id", "bbox", "content", "height", "references", "title")])
    b = side.where("first = 1").select("document_id", (F.col("page_no") - 1).alias("page_no"), *[F.col(c).alias(f"c_{c}") for c in ("block_id", "bbox", "content", "height", "references", "title", "words")])
    pair = a.join(b, ["document_id", "page_no"])
    none = F.array().cast("array<string>")
    pr, cr = F.coalesce("p_references", none), F.coalesce("c_references", none)
    pt, ct = F.coalesce("p_title", F.lit("")), F.coalesce("c_title", F.lit(""))
    pair = pair.withColumn("title_similarity", F.when((F.length(pt) > 0) & (F.length(ct) > 0), similarity(pt, ct)))
    explicit = F.concat_ws(" ", F.coalesce("c_words", F.lit("")), F.substring("c_content", 1, 300)).rlike("(?i)续表|continued")
    distinct_ref = (F.size(pr) > 0) & (F.size(cr) > 0) & ~F.arrays_overlap(pr, cr)
    pair = pair.withColumn("explicit", explicit).withColumn("distinct_reference", distinct_ref).withColumn("distinct_title", F.coalesce(F.col("title_similarity") < 0.72, F.lit(False)))
    edge = (F.coalesce(F.col("p_bbox.y1") / F.col("p_height"), F.lit(0.0)) >= 0.80) & (F.coalesce(F.col("c_bbox.y0") / F.col("c_height"), F.lit(1.0)) <= 0.25)
    same = ((F.size(pr) > 0) & (F.array_sort(pr) == F.array_sort(cr))) | F.coalesce(F.col("title_similarity") >= 0.90, F.lit(False))
    independent = ((F.size(cr) > 0) | (F.length(ct) > 0)) & ~F.col("explicit")
    pair = pair.withColumn("hard_negative", F.col("distinct_reference") | F.col("distinct_title")).withColumn("edge_continuity", edge)
    pair = pair.withColumn("auto_eligible", F.col("edge_continuity") & ~F.col("hard_negative") & (F.col("explicit") | same | ~independent))
    ph, ch = header_text("p_content"), header_text("c_content")
    pair = pair.withColumn("lexical", similarity(ph, ch)).withColumn("pc", column_count("p_content")).withColumn("cc", column_count("c_content"))
    position = F.when(F.col("p_bbox").isNull() | F.col("c_bbox").isNull(), 0.0).when(F.col("p_bbox.y0") > F.col("c_bbox.y0"), 1.0).otherwise(0.5)
    columns = F.when((F.col("pc") > 0) & (F.col("pc") == F.col("cc")), 1.0).otherwise(0.0)
    keyword = F.when(F.col("c_content").rlike("(?i)续表|continued"), 1.0).otherwise(0.0)
    pair = pair.withColumn("score", F.round(0.2 * position + 0.25 * columns + 0.45 * F.col("lexical") + 0.1 * keyword, 4))  # without header vectors the lexical similarity stands for both
    decision = F.when(F.col("auto_eligible") & (F.col("score") >= DEFAULT.continuation_auto), "merge").when(F.col("edge_continuity") & ~F.col("hard_negative") & (F.col("score") >= DEFAULT.continuation_ask), "ask").otherwise("apart")
    return pair.select("document_id", F.col("page_no").alias("previous_page"), F.col("p_block_id").alias("previous_id"), F.col("c_block_id").alias("current_id"), "title_similarity", "explicit", "distinct_reference", "distinct_title", "edge_continuity", "hard_negative", "auto_eligible", "score", decision.alias("decision"))


def merged_tables(blocks: DataFrame, pairs: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """root_id, document_id, n_parts, source_pages, merged_html, child_ids of the chains of tables that continue.

    A pair links where it merges by itself or where ``answers`` (previous_id, current_id, same) says so. Chains are islands over the
    pages of a document: a run of pages each linked with the next."""
    links = pairs.where("decision = 'merge'").select("document_id", "previous_page", "previous_id", "current_id")
    if answers is not None:
        asked = pairs.where("decision = 'ask'").join(answers.where("same"), ["previous_id", "current_id"], "left_semi")
        links = links.unionByName(asked.select("document_id", "previous_page", "previous_id", "current_id"))
    # a chain goes on only through the same table: the current of one link is the previous of the next
    w = Window.partitionBy("document_id").orderBy("previous_page")
    start = (F.lag("current_id").over(w) != F.col("previous_id")) | F.lag("current_id").over(w).isNull()
    chained = links.withColumn("chain", F.sum(start.cast("int")).over(w))
    ends = chained.select("document_id", "chain", F.explode(F.array(F.struct(F.col("previous_page").alias("page"), F.col("previous_id").alias("id")), F.struct((F.col("previous_page") + 1).alias("page"), F.col("current_id").alias("id")))).alias("e")).select("document_id", "chain", "e.page", F.col("e.id").alias("block_id")).distinct()
    parts = ends.join(blocks.select("block_id", "content"), "block_id")
    whole = parts.groupBy("document_id", "chain").agg(F.array_sort(F.collect_list(F.struct("page", "block_id", "content"))).alias("p"))  # the parts of one table

    def merge(chains: pd.Series) -> pd.Series:
        out = []
        for chain in chains:
            try:
                out.append(H.merge([(p["content"], p["page"]) for p in chain]))
            except H.TableError:
                out.append(None)
        return pd.Series(out, dtype=object)

    joined = F.pandas_udf(merge, "string")
    return whole.select(F.element_at("p", 1)["block_id"].alias("root_id"), "document_id", F.size("p").cast("long").alias("n_parts"), F.array_join(F.transform("p", lambda x: x["page"].cast("string")), ",").alias("source_pages"), joined("p").alias("merged_html"), F.transform(F.slice("p", 2, F.size("p")), lambda x: x["block_id"]).alias("child_ids"))


def with_merged_tables(blocks: DataFrame, pages: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """blocks (of laid_out) in which the first table of each chain has the whole table (resolved_content, repaired, TAB-003, all source pages), and the others are left out of chunks.

    First readings stay as they are; what a chain's table cannot be parsed from stays apart."""
    merged = cut_lineage(merged_tables(blocks, continuation_pairs(blocks, pages), answers).where("merged_html is not null"))  # few
    roots = merged.select(F.col("root_id").alias("block_id"), F.col("merged_html").alias("_whole"), F.transform(F.split("source_pages", ","), lambda x: x.cast("int")).alias("_pages"))
    children = merged.select(F.explode("child_ids").alias("block_id"), F.lit(True).alias("_child"))
    out = blocks.join(roots, "block_id", "left").join(children, "block_id", "left")
    root = F.col("_whole").isNotNull()
    for name, value in (("resolved_content", F.col("_whole")), ("content", F.col("_whole")), ("status", F.lit("repaired")), ("source_pages", F.col("_pages")), ("issue_flags", F.array_union(F.coalesce("issue_flags", F.array().cast("array<string>")), F.array(F.lit("TAB-003"))))):
        out = out.withColumn(name, F.when(root, value).otherwise(F.col(name)))
    return out.withColumn("skip_chunk", F.coalesce("_child", F.lit(False)) | F.coalesce("skip_chunk", F.lit(False))).drop("_whole", "_pages", "_child")


def unsafe_merges(merges: DataFrame, pairs: DataFrame) -> DataFrame:
    """root_id, child_id, page_no, revert: merges to undo, all children of a root of which any child is a hard negative.

    merges: root_id, child_id, page_no."""
    judged = merges.join(pairs.select(F.col("current_id").alias("child_id"), "hard_negative").dropDuplicates(["child_id"]), "child_id", "left")
    bad = judged.groupBy("root_id").agg(F.max(F.coalesce("hard_negative", F.lit(False))).alias("revert"))
    return judged.drop("hard_negative").join(bad, "root_id")


def row_groups(records: DataFrame, key: str, group: int = DEFAULT.table_row_group, size: int = DEFAULT.text_size) -> DataFrame:
    """key, group_no, first_row, last_row, n_rows: greedy runs of body rows of at most ``group`` rows and ``size`` characters."""
    lines = records.select(key, "row_index", F.length(record_text(F.col("headers"), F.col("row"), F.col("source_page"))).alias("n"))
    whole = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("row_index", "n"))).alias("rows"))  # the rows of one table
    start = F.struct(F.array().cast("array<struct<f:int,l:int,k:int>>").alias("done"), F.lit(-1).alias("f"), F.lit(-1).alias("l"), F.lit(0).alias("k"), F.lit(0).alias("n"))

    def step(a, x):
        full = (a["k"] > 0) & ((a["k"] >= group) | (a["n"] + 1 + x["n"] > size))
        return F.struct(
            F.when(full, F.concat(a["done"], F.array(F.struct(a["f"].alias("f"), a["l"].alias("l"), a["k"].alias("k"))))).otherwise(a["done"]).alias("done"),
            F.when(full | (a["k"] == 0), x["row_index"]).otherwise(a["f"]).alias("f"), x["row_index"].alias("l"), F.when(full, 1).otherwise(a["k"] + 1).alias("k"),
            F.when(full | (a["k"] == 0), x["n"]).otherwise(a["n"] + 1 + x["n"]).alias("n"),
        )

    end = lambda a: F.concat(a["done"], F.array(F.struct(a["f"].alias("f"), a["l"].alias("l"), a["k"].alias("k"))))
    groups = whole.select(key, F.posexplode(F.aggregate("rows", start, step, end)).alias("group_no", "g"))
    return groups.select(key, "group_no", F.col("g.f").alias("first_row"), F.col("g.l").alias("last_row"), F.col("g.k").alias("n_rows"))


def merged_tiles(tiles: DataFrame, header_rows: int | None = None) -> DataFrame:
    """block_id, readable, merged_html of tile readings (block_id, tile_no, readable, html): readable only if every tile is."""
    whole = tiles.groupBy("block_id").agg(F.every("readable").alias("readable"), F.array_sort(F.collect_list(F.struct("tile_no", "html"))).alias("t"))  # the tiles of one picture

    def merge(rows: pd.Series) -> pd.Series:
        out = []
        for row in rows:
            try:
                out.append(H.merge_tiles([t["html"] or "" for t in row], header_rows))
            except H.TableError:
                out.append(None)
        return pd.Series(out, dtype=object)

    return whole.select("block_id", "readable", F.when(F.col("readable"), F.pandas_udf(merge, "string")("t")).alias("merged_html"))
