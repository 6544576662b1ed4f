"""Audits of chunks and profiles of tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.options import DEFAULT
from foliant.sources.tables import delivered_once

BAD_SECTION = r"^(?:单位|币种)[：:]|^(?:续)?(?:附表|表|图)\s*\d+|^续表$"


def stored_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks as stored, each chunk_id once, with role and sources from their JSON metadata."""
    names = ["chunk_id", "document_id", "page_start", "page_end", "block_type", "parent_id", "section_path", "display_text", "embedding_text", "asset_id", "metadata_json", "embedding_state"]
    chunks = delivered_once(chunks, "chunk_id").select(*names)
    role = F.get_json_object("metadata_json", "$.chunk_role")
    ids = F.from_json(F.get_json_object("metadata_json", "$.source_block_ids"), "array<string>")
    return chunks.withColumn("chunk_role", role).withColumn("source_block_ids", ids)


def floor_percentile(values: str, share: float) -> Column:
    """The element at int((n - 1) * share) of the sorted values, from counts per value: see length_profile."""
    return F.min(F.when(F.col("upto") > F.floor((F.col("total") - 1) * share), F.col(values)))


def length_profile(rows: DataFrame, group: str, length: Column) -> DataFrame:
    """group, n, least, median (truncated), p95 (floor index), most. Works on counts per distinct length, so no group is gathered."""
    counts = rows.select(F.col(group), length.cast("long").alias("len")).where("len is not null").groupBy(group, "len").agg(F.count("*").alias("c"))
    w = Window.partitionBy(group)
    counts = counts.withColumn("upto", F.sum("c").over(w.orderBy("len"))).withColumn("total", F.sum("c").over(w))
    low = F.min(F.when(F.col("upto") > F.floor((F.col("total") - 1) / 2), F.col("len")))
    high = F.min(F.when(F.col("upto") > F.floor(F.col("total") / 2), F.col("len")))
    return counts.groupBy(group).agg(F.max("total").alias("n"), F.min("len").alias("least"), F.floor((low + high) / 2).cast("long").alias("median"), floor_percentile("len", 0.95).alias("p95"), F.max("len").alias("most"))


def exact_duplicates(chunks: DataFrame) -> DataFrame:
    """text_hash, n_chunks, first_id of texts that several chunks show, white space apart."""
    flat = T.collapse(F.col("display_text"))
    return chunks.withColumn("flat", flat).where(F.length("flat") > 0).groupBy(F.sha2("flat", 256).alias("text_hash")).agg(F.count("*").alias("n_chunks"), F.min("chunk_id").alias("first_id")).where("n_chunks > 1")


REGRESSION_ROWS = 4096  # rows of a document that a task puts in order at once, about


def order_regressions(chunks: DataFrame, order: str = "chunk_id") -> DataFrame:
    """document_id, n_start, n_end: how often the first or last page decreases along a document in the order of a hashed id.

    A document is cut into ranges of its ids by their leading digits, as many as its rows ask for; each range is put in order by itself,
    and the last row of a range meets the first of the next in a window over one row a range. Null pages make no decrease."""
    size = chunks.groupBy("document_id").agg(F.count("*").alias("_rows"))
    digits = F.least(F.lit(8), F.ceil(F.log(F.greatest(F.lit(1.0), F.col("_rows") / REGRESSION_ROWS)) / math.log(16.0)).cast("int"))
    rows = chunks.select("document_id", order, "page_start", "page_end").join(size.select("document_id", digits.alias("_digits")), "document_id")
    rows = rows.withColumn("_range", F.substring(F.col(order), F.lit(1), F.col("_digits")))
    inner = Window.partitionBy("document_id", "_range").orderBy(order)
    here = F.struct("page_start", "page_end")
    rows = rows.withColumn("_ahead", F.lag(here).over(inner))
    fell = lambda c: (F.col(f"_ahead.{c}") > F.col(c)).cast("int")
    by = rows.groupBy("document_id", "_range").agg(F.count_if(fell("page_start") == 1).alias("s"), F.count_if(fell("page_end") == 1).alias("e"), F.min_by(here, order).alias("first"), F.max_by(here, order).alias("last"))
    before = F.lag("last").over(Window.partitionBy("document_id").orderBy("_range"))
    by = by.withColumn("before", before)
    step = lambda c: F.coalesce((F.col(f"before.{c}") > F.col(f"first.{c}")).cast("long"), F.lit(0))
    return by.groupBy("document_id").agg(F.sum(F.col("s") + step("page_start")).alias("n_start"), F.sum(F.col("e") + step("page_end")).alias("n_end"))


def chunk_audit(chunks: DataFrame, target: int = DEFAULT.text_size) -> DataFrame:
    """check, severity, n of every check with a finding, and the score as check 'score': max(0, 100 - 20 * failures - min(20, warnings)).

    chunks: chunk_id, chunk_role, display_text, embedding_text, section_path, source_block_ids."""
    text = F.coalesce("display_text", F.lit(""))
    section = F.exists(F.split(F.coalesce("section_path", F.lit("")), " / "), lambda s: s.rlike(BAD_SECTION))
    one = chunks.agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct("chunk_id")).alias("duplicate_chunk_id"), F.count_if(T.blank(F.col("display_text"))).alias("empty_chunk_text"),
        F.count_if(F.coalesce(F.size("source_block_ids"), F.lit(0)) < 1).alias("missing_source_blocks"), F.count_if(section).alias("bad_section_path"), F.count_if((F.length(text) <= 240) & F.coalesce(T.failure_placeholder(text), F.lit(False))).alias("model_failure_placeholder"),
        F.count_if((F.col("chunk_role") == "text_segment") & (F.length(text) > target)).alias("text_chunk_over_target"), F.count_if((F.col("chunk_role") == "text_segment") & (F.length(text) < 20)).alias("short_text_chunk"),
        F.count_if(F.length(F.coalesce("embedding_text", F.lit(""))) > max(1600, 2 * target)).alias("long_chunk"),
    )
    repeated = exact_duplicates(chunks).agg(F.count("*").alias("exact_duplicate_text"))
    one = one.crossJoin(repeated).withColumn("empty_chunk_set", (F.col("n") == 0).cast("long"))  # one row each
    hard = ["empty_chunk_set", "duplicate_chunk_id", "empty_chunk_text", "missing_source_blocks", "exact_duplicate_text", "bad_section_path", "model_failure_placeholder", "text_chunk_over_target"]
    soft = ["short_text_chunk", "long_chunk"]
    failures = sum((F.col(c) > 0).cast("long") for c in hard)
    warnings = sum((F.col(c) > 0).cast("long") for c in soft)
    score = F.greatest(F.lit(0), 100 - 20 * failures - F.least(F.lit(20), warnings))
    rows = [F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), F.col(c).cast("long").alias("n")) for s, cs in (("failure", hard), ("warning", soft)) for c in cs]
    rows.append(F.struct(F.lit("score").alias("check"), F.lit("score").alias("severity"), score.cast("long").alias("n")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("n > 0 or severity = 'score'")


def export_summary(chunks: DataFrame) -> DataFrame:
    """dimension, value, n: chunks by role, modality and state in one pass (grouping sets)."""
    role, kind, state = F.col("chunk_role"), F.col("block_type"), F.col("embedding_state")
    dimension = F.when(F.grouping("chunk_role") == 0, "role").when(F.grouping("block_type") == 0, "modality").otherwise("state")
    out = chunks.groupingSets([[role], [kind], [state]], role, kind, state).agg(dimension.alias("dimension"), F.count("*").alias("n"))
    return out.select("dimension", F.coalesce("chunk_role", "block_type", "embedding_state", F.lit("unknown")).alias("value"), "n")


def export_validation(chunks: DataFrame) -> DataFrame:
    """One row of checks that an export must pass."""
    return chunks.agg(
        (F.count("*") == F.count_distinct("chunk_id")).alias("chunk_ids_unique"), F.every(~T.blank(F.col("display_text")) & ~T.blank(F.col("embedding_text"))).alias("all_chunks_nonempty"),
        F.every(F.coalesce(F.size("source_block_ids"), F.lit(0)) > 0).alias("all_chunks_have_source_blocks"),
    )


def work_units(pages: DataFrame, size: int = DEFAULT.page_work_unit) -> DataFrame:
    """document_id, unit_no, first_page, last_page, n_pages: runs of ``size`` pages."""
    return pages.groupBy("document_id", F.floor((F.col("page_no") - 1) / size).alias("unit_no")).agg(F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), F.count_distinct("page_no").alias("n_pages"))


def structure_summary(blocks: DataFrame, sections: DataFrame, context: DataFrame, carried: DataFrame) -> DataFrame:
    """document_id, n_pages, n_headings, n_table_context, n_carried."""
    marks = blocks.select("document_id", "page_no", "block_id").join(sections.where("is_heading").select("block_id", F.lit(1).alias("h")), "block_id", "left")
    marks = marks.join(context.select(F.col("context_id").alias("block_id"), F.lit(1).alias("t")), "block_id", "left").join(carried.select("block_id", F.lit(1).alias("d")), "block_id", "left")
    return marks.groupBy("document_id").agg(F.count_distinct("page_no").alias("n_pages"), F.count("h").alias("n_headings"), F.count("t").alias("n_table_context"), F.count("d").alias("n_carried"))
