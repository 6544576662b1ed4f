"""Problem 5: lines repeated across the pages of one document.

Distributed PrefixSpan over the sequences of line identifiers: one sequence per (document, page), one identifier per line that is
equal after lower-casing, deleting white space and masking digits. Level 1 counts the distinct pages of each line with map-side
combining; level n+1 extends the frequent prefixes of level n by frequent lines that follow on the same page. A line is deleted
where it is part of any frequent sequence. Each part of a frequent sequence is frequent by itself, so the lines to delete are
known after level 1 already, and deeper levels only tell which of them occur together.

Null or empty texts have no lines; a null document_id or page_no supports nothing. Rows delivered twice count once, because support
counts distinct pages and the results are distinct. No group is gathered: a document with a third of all rows is spread over its
lines and, in joins, over salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

SALTS = 16
# White space as Python's str.isspace() knows it, for Java's and RE2's syntax.
SPACE_JAVA = r"[\s\p{Z}\x0B\x1C-\x1F\x85]+"
SPACE_RE2 = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]+"


def line_key(line: Column) -> Column:
    """The form in which two lines are compared."""
    return F.regexp_replace(F.regexp_replace(F.lower(line), SPACE_JAVA, ""), r"\p{Nd}+", "#")


def lines_of(blocks: DataFrame) -> DataFrame:
    """block_id, doc, page_no, line_no from 1, item (64-bit identifier of the line) of every line that isn't empty."""
    rows = blocks.where("raw_content is not null and document_id is not null and page_no is not null")
    rows = rows.select("block_id", F.xxhash64("document_id").alias("doc"), "page_no", F.posexplode(F.split("raw_content", "\n", -1)).alias("at", "line"))
    rows = rows.withColumn("key", line_key(F.col("line"))).where("key <> ''")
    return rows.select("block_id", "doc", "page_no", (F.col("at") + 1).cast("int").alias("line_no"), F.xxhash64("key").alias("item"))


def frequent_lines(blocks: DataFrame, min_pages: int = 3, min_share: float = 0.25) -> DataFrame:
    """Level 1: doc, item, support (distinct pages), needed (pages that make a sequence of this document frequent)."""
    lines = lines_of(blocks)
    support = lines.groupBy("doc", "item").agg(F.count_distinct("page_no").alias("support")).where(F.col("support") >= min_pages)
    pages = blocks.where("document_id is not null and page_no is not null").groupBy(F.xxhash64("document_id").alias("doc")).agg(F.count_distinct("page_no").alias("pages"))
    pages = pages.select("doc", F.greatest(F.lit(min_pages), F.ceil(F.col("pages") * min_share - 1e-9)).cast("long").alias("needed"))
    return support.join(pages, "doc").where("support >= needed")


def occurrences(blocks: DataFrame, frequent: DataFrame) -> DataFrame:
    """The lines of lines_of whose item is frequent in its document. The frequent lines, few for each document, are copied to each salt."""
    salted = frequent.select("doc", "item", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    lines = lines_of(blocks).withColumn("salt", F.pmod(F.xxhash64("block_id"), F.lit(SALTS)).cast("int"))
    return lines.join(salted, ["doc", "item", "salt"]).drop("salt")


def repeated_lines(blocks: DataFrame, min_pages: int = 3, min_share: float = 0.25) -> DataFrame:
    """Distinct (block_id, line_no) of every line that stands in a frequent sequence of its document."""
    return occurrences(blocks, frequent_lines(blocks, min_pages, min_share)).select("block_id", "line_no").distinct()


def frequent_sequences(blocks: DataFrame, min_pages: int = 3, min_share: float = 0.25, max_length: int | None = None) -> DataFrame:
    """doc, items (array of identifiers in page order), support of all frequent sequences, or those of up to max_length lines.

    Levels follow until one is empty, at most as many as a page has frequent lines; n of them on the same pages make 2^n - 1 sequences. Gaps between the lines are allowed. The order on a page is that of reading_order, block and line."""
    frequent = cut_lineage(frequent_lines(blocks, min_pages, min_share))
    order = blocks.groupBy("block_id").agg(F.min("reading_order").alias("reading_order"))
    placed = occurrences(blocks, frequent).distinct().join(order, "block_id")
    placed = placed.select("doc", "page_no", "item", F.struct(F.coalesce("reading_order", F.lit(-1)).alias("r"), "block_id", "line_no").alias("at"))
    placed = cut_lineage(placed)
    needed = frequent.select("doc", "needed").distinct()
    level = frequent.select("doc", F.array("item").alias("items"), "support")
    # the projected database of a prefix: the first place on each page after which it can go on
    projected = placed.groupBy("doc", "page_no", F.array("item").alias("items")).agg(F.min("at").alias("end"))
    found, length = level, 1
    while max_length is None or length < max_length:
        longer = projected.join(placed, ["doc", "page_no"]).where("at > end")
        longer = cut_lineage(longer.groupBy("doc", "page_no", F.concat("items", F.array("item")).alias("items")).agg(F.min("at").alias("end")))
        level = cut_lineage(longer.groupBy("doc", "items").agg(F.count("*").alias("support")).join(needed, "doc").where("support >= needed").drop("needed"))
        if level.isEmpty():
            break
        projected = longer.join(level.select("doc", "items"), ["doc", "items"], "left_semi").select("doc", "page_no", "items", "end")
        found, length = found.unionByName(level), length + 1
    return found


def without_repeated_lines(blocks: DataFrame, min_pages: int = 3, min_share: float = 0.25) -> DataFrame:
    """block_id, clean_content (raw_content without its repeated lines; null stays null), n_removed; one row per block_id."""
    gone = repeated_lines(blocks, min_pages, min_share).groupBy("block_id").agg(F.collect_set("line_no").alias("gone"))  # at most a block's own lines
    once = blocks.select("block_id", "raw_content").dropDuplicates(["block_id"])
    kept = F.filter(F.split("raw_content", "\n", -1), lambda _, i: ~F.array_contains("gone", i + 1))
    both = once.join(gone, "block_id", "left")
    return both.select(
        "block_id",
        F.when(F.col("gone").isNull(), F.col("raw_content")).otherwise(F.array_join(kept, "\n")).alias("clean_content"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def sql_repeated_lines() -> str:
    """The same lines for DuckDB."""
    key = f"regexp_replace(regexp_replace(lower(line), '{SPACE_RE2}', '', 'g'), '\\p{{Nd}}+', '#', 'g')"
    return f"""
with pages as (select document_id, count(distinct page_no) as pages from blocks group by document_id),
parts as (select distinct block_id, document_id, page_no, raw_content from blocks where raw_content is not null),
split as (select block_id, document_id, page_no, string_split(raw_content, chr(10)) as ls from parts),
lines as (select block_id, document_id, page_no, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as line_no from split),
keyed as (select block_id, document_id, page_no, line_no, {key} as k from lines),
support as (select document_id, k, count(distinct page_no) as support from keyed where k <> '' group by document_id, k)
select distinct keyed.block_id, cast(keyed.line_no as integer) as line_no
from keyed join support using (document_id, k) join pages using (document_id)
where support >= 3 and support >= 0.25 * pages"""


def sql_clean_text() -> str:
    """without_repeated_lines for DuckDB."""
    return f"""with gone as ({sql_repeated_lines()}), once as (select distinct on (block_id) block_id, raw_content, string_split(raw_content, chr(10)) as ls from blocks order by block_id),
lines as (select block_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as line_no from once where raw_content is not null),
kept as (select l.block_id, count(g.line_no) as n, string_agg(l.line, chr(10) order by l.line_no) filter (g.line_no is null) as text from lines l left join gone g on g.block_id = l.block_id and g.line_no = l.line_no group by l.block_id)
select o.block_id, case when coalesce(n, 0) = 0 then raw_content else coalesce(text, '') end as clean_content, cast(coalesce(n, 0) as bigint) as n_removed from once o left join kept k using (block_id)"""
