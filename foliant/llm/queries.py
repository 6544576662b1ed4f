"""The queries of problems 1 to 10 and, where SQL can tell the same, their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import leakage, markup, near_duplicates, packing, repeated_lines, residue, scan_noise, splitting, truncation, visual_form
from foliant.session import checkpoint_dir
from foliant.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# 5: lines repeated within a document


def _lined_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "blocks", "block_id", "document_id", "page_no", "reading_order", "raw_content")


@_query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.repeated_lines(_lined_blocks(spark, folder))


@_query
def p5_clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(_lined_blocks(spark, folder))


@_query
def p5_sequences(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_lines.frequent_sequences(_lined_blocks(spark, folder))
    return found.select("doc", F.array_join(F.transform("items", lambda x: x.cast("string")), " ").alias("items"), F.size("items").cast("long").alias("n_lines"), "support")


SQL["p5_found"] = repeated_lines.sql_repeated_lines()


# 6: visually identical text


@_query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    fields = ("raw_content", "resolved_content")
    return visual_form.values_with_odd_characters(table(spark, folder, "blocks", "block_id", *fields), "block_id", fields)


@_query
def p6_canonical_text(spark: SparkSession, folder: str) -> DataFrame:
    blocks = table(spark, folder, "blocks", "block_id", "raw_content", "resolved_content")
    return visual_form.canonical_texts(blocks, ("block_id",), ("raw_content", "resolved_content")).dropDuplicates(["block_id"])


@_query
def p6_equal_looking(spark: SparkSession, folder: str) -> DataFrame:
    return visual_form.equal_looking_groups(table(spark, folder, "blocks", "block_id", "raw_content"), "block_id", "raw_content")


# 7: oversized items


@_query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.oversized(table(spark, folder, "blocks", "block_id", "resolved_content"), "block_id", "resolved_content")


@_query
def p7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_items(table(spark, folder, "blocks", "block_id", "resolved_content"), "block_id", "resolved_content")


@_query
def p7_file_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus written as text files to the shared folder, and these cut by byte ranges: file_no, piece_no, start_char, end_char."""
    path = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    table(spark, folder, "documents", "doc_id", "text").where("text is not null").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id", "text").select("text").write.text(path)
    pieces = splitting.split_files(spark, [f"{path}/part-*"])
    return pieces.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file_no"), "piece_no", "start_char", "end_char")


SQL["p7_found"] = "select distinct block_id from blocks where length(resolved_content) > 1200"


# 10: template residue


@_query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue_documents(table(spark, folder, "documents", "doc_id", "source", "text"))


@_query
def p10_messages(spark: SparkSession, folder: str) -> DataFrame:
    return residue.message_groups(table(spark, folder, "documents", "doc_id", "source", "text"))


@_query
def p10_clean_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return residue.clean_corpus(table(spark, folder, "documents", "doc_id", "source", "lang", "text"))


SQL["p10_found"] = residue.sql_residue_documents()
SQL["p10_messages"] = residue.sql_message_groups()
SQL["p10_clean_corpus"] = f"select doc_id, source, lang, text from documents where doc_id not in ({residue.sql_residue_documents()})"


# 3: markup residue


def _marked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, folder, "blocks", "block_id", "source", "raw_content"), table(spark, folder, "vlm_results", "result_id", "task", "html", "latex")


@_query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.values_with_markup(*_marked(spark, folder))


@_query
def p3_clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return markup.extracted(*_marked(spark, folder)).dropDuplicates(["record_kind", "record_id", "field_name"])


@_query
def p3_host_paths(spark: SparkSession, folder: str) -> DataFrame:
    return markup.host_paths(markup.values(*_marked(spark, folder)))


# 2: near-duplicate records


def _near_texts(spark: SparkSession, folder: str) -> DataFrame:
    blocks = table(spark, folder, "blocks", "block_id", "block_type", "resolved_content")
    chunks = table(spark, folder, "chunks", "chunk_id", "block_type", "display_text")
    return near_duplicates.records(blocks, "block", "block_id", "resolved_content").unionByName(near_duplicates.records(chunks, "chunk", "chunk_id", "display_text"))


@_query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.similar_pairs(_near_texts(spark, folder))


@_query
def p2_groups(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.groups(_near_texts(spark, folder))


# 9: evaluation texts in the corpus


@_query
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked(spark, table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "questions"))


@_query
def p9_matches(spark: SparkSession, folder: str) -> DataFrame:
    found = leakage.passage_matches(spark, table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "questions"))
    return found.where(F.col("share") >= leakage.SHARE)


# 1: noise of scanned pages


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "blocks", "block_id", "block_type", "raw_content", "resolved_content")


@_query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return scan_noise.damaged_blocks(_scanned(spark, folder)).select("block_id").distinct()


@_query
def p1_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return scan_noise.damaged_blocks(_scanned(spark, folder))


@_query
def p1_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return scan_noise.repaired_blocks(_scanned(spark, folder))


# 4: text cut off by field limits


def _cuttable(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "blocks", "block_id", "document_id", "page_no", "reading_order", "block_type", "source", "raw_content", "resolved_content")


@_query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.cut_values(_cuttable(spark, folder)).select("block_id", "field_name").distinct()


@_query
def p4_source_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.source_rates(_cuttable(spark, folder))


@_query
def p4_hidden_limits(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.hidden_limits(_cuttable(spark, folder))


# 8: containers of fixed capacity


@_query
def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents", "doc_id", "text"))


@_query
def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(p8_containers(spark, folder))


SQL["p2_found"] = near_duplicates.sql_similar_pairs()
SQL["p6_found"] = visual_form.sql_odd_characters(("raw_content", "resolved_content"))
SQL["p5_clean_text"] = repeated_lines.sql_clean_text()
