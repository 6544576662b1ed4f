"""Jobs from the command line: python -m foliant.cli JOB --help."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from foliant import schemas
from foliant.functions import text as T
from foliant.operators import chunks, evaluation, layout, quality, retrieval, tables
from foliant.options import Options
from foliant.session import cut_lineage
from foliant.sinks import stores
from foliant.sources import parser_items


def _session() -> SparkSession:
    return SparkSession.builder.appName("foliant").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def init(spark: SparkSession, a) -> int:
    """Empty tables for those that are missing."""
    for name, ddl in schemas.TABLES.items():
        if not stores.there(spark, f"{a.tables}/{name}.parquet"):
            spark.createDataFrame([], ddl).write.parquet(f"{a.tables}/{name}.parquet")
    return 0


def doctor(spark: SparkSession, a) -> int:
    """Which tables are missing, or lack columns."""
    bad = 0
    for name, ddl in schemas.TABLES.items():
        try:
            have = set(spark.read.parquet(f"{a.tables}/{name}.parquet").columns)
        except Exception as e:  # noqa: BLE001
            print(f"{name}: unreadable ({type(e).__name__})")
            bad += 1
            continue
        lack = [f.name for f in spark.createDataFrame([], ddl).schema if f.name not in have]
        print(f"{name}: " + ("ok" if not lack else f"lacks {', '.join(lack)}"))
        bad += bool(lack)
    return 1 if bad else 0


def ingest(spark: SparkSession, a) -> int:
    """Parser files to blocks and pages, furniture marked and blocks gated, into the stores."""
    items = parser_items.read_items(spark, a.items)
    raw = parser_items.blocks_of_items(items, F.coalesce(F.nullif(F.regexp_extract("path", a.document_pattern, 1), F.lit("")), F.sha2("path", 256)))
    pages = cut_lineage(parser_items.pages_of_blocks(raw).withColumn("rotation", F.lit(0)))
    blank = {n: F.lit(None).cast(t) for n, t in (("resolved_content", "string"), ("asset_id", "string"), ("section_path", "array<string>"), ("issue_flags", "array<string>"), ("column_index", "int"), ("chunk_eligible", "boolean"), ("source_pages", "array<int>"))}
    rows = raw.withColumns(blank | {"resolved_content": F.col("raw_content"), "source": F.lit("primary"), "status": F.lit("accepted"), "skip_chunk": F.lit(False)})
    blocks = cut_lineage(layout.laid_out(rows))
    kinds = layout.templates(blocks, pages)
    marked = blocks.join(kinds, "block_id", "left").withColumn("skip_chunk", F.col("template_kind").isNotNull())
    marked = marked.withColumn("block_type", F.when(F.col("template_kind") == "page_number", "page_number").when(F.col("template_kind") == "repeated_header", "header").when(F.col("template_kind") == "repeated_footer", "footer").otherwise(F.col("block_type")))
    gates = quality.gated_blocks(marked)
    done = marked.drop("issue_flags", "template_kind", "content", "position").join(gates.select("block_id", F.col("flags").alias("issue_flags"), "decision"), "block_id")
    done = done.withColumn("status", F.when(F.col("decision") == "unreadable", "unreadable").when(F.col("decision") == "second_reading", "review").otherwise("accepted")).drop("decision")
    stores.replace_documents(spark, f"{a.tables}/blocks.parquet", done)
    stores.replace_documents(spark, f"{a.tables}/page_layout.parquet", pages)
    stores.write_manifest(spark, f"{a.tables}/manifest", {"job": "ingest", "items": a.items})
    return 0


def _blocks(spark: SparkSession, a):
    return layout.laid_out(spark.read.parquet(f"{a.tables}/blocks.parquet")), spark.read.parquet(f"{a.tables}/page_layout.parquet")


def rechunk(spark: SparkSession, a) -> int:
    """Reading order, tables that go on over pages, sections and chunks anew from the stored blocks."""
    options = Options(text_size=a.size, text_overlap=a.overlap, table_row_group=a.row_group)
    blocks, pages = _blocks(spark, a)
    context = cut_lineage(layout.table_context(blocks, pages))
    order = layout.reading_order(blocks, pages, context).select("block_id", F.col("place").cast("int").alias("reading_order"), F.col("column_index").cast("int"))
    blocks = blocks.drop("reading_order", "column_index", "position").join(order, "block_id", "left").withColumn("position", F.coalesce("reading_order", F.lit(1 << 20)))
    blocks = tables.with_merged_tables(cut_lineage(blocks), pages)  # from the first readings each time, so that an unsafe merge never stays
    carried = layout.carried_over(blocks, pages).select("block_id", F.lit(True).alias("again"))
    blocks = cut_lineage(blocks.join(carried, "block_id", "left").withColumn("skip_chunk", F.coalesce("skip_chunk", F.lit(False)) | F.col("again").isNotNull()).drop("again"))
    paths = layout.section_paths(blocks, context).select("block_id", F.when(F.length("section_path") > 0, F.split("section_path", " / ")).alias("section_path"))
    blocks = blocks.drop("section_path").join(paths, "block_id", "left")
    made = chunks.link_chunks(cut_lineage(chunks.build_chunks(blocks, context, layout.visual_captions(blocks, pages), options)))
    made = made.withColumn("embedding_state", F.lit("pending"))
    stores.replace_documents(spark, a.out, made)
    stores.write_manifest(spark, f"{a.out.rstrip('/')}_manifest", {"job": "rechunk", "size": a.size, "overlap": a.overlap, "row_group": a.row_group})
    return 0


def _audit(spark: SparkSession, path: str) -> int:
    checks = evaluation.chunk_audit(spark.read.parquet(path)).orderBy("severity", "check").collect()  # a row a check
    for c in checks:
        print(f"{c.severity:8} {c.check:28} {c.n}")
    return 2 if any(c.severity == "failure" for c in checks) else 0


def audit_chunks(spark: SparkSession, a) -> int:
    """The chunk audit; exit code 2 where it fails."""
    return _audit(spark, a.chunks)


def index_chunks(spark: SparkSession, a) -> int:
    """Chunks that pass the audit, with their vectors, to the vector store; then they are marked embedded."""
    failed = _audit(spark, a.chunks)
    if failed:
        return failed
    rows = spark.read.parquet(a.chunks).drop("bucket")
    vectors = spark.read.parquet(a.vectors)
    stores.vector_rows(rows, vectors).write.mode("overwrite").partitionBy("dim").parquet(a.out)
    stores.replace_documents(spark, a.chunks, cut_lineage(stores.marked_embedded(rows, vectors)))
    return 0


def _found(spark: SparkSession, a, asked, limit: int):
    """The hybrid results for asked (query_id, query) over stored chunks: with the vectors of --vectors and --query-vectors, or hashed terms where none are given."""
    corpus = spark.read.parquet(a.chunks)
    if bool(a.vectors) != bool(a.query_vectors):
        raise SystemExit("--vectors and --query-vectors go together")
    if a.vectors:
        vectors = spark.read.parquet(a.vectors).select("chunk_id", F.col("dense_vector").alias("vector"))
        own = spark.read.parquet(a.query_vectors).select("query_id", "vector")
    else:
        vectors, own = retrieval.hashed_vectors(corpus, "chunk_id", "display_text"), retrieval.hashed_vectors(asked, "query_id", "query")
    relevance = spark.read.parquet(a.relevance) if a.relevance else None
    return retrieval.hybrid_search(spark, asked.join(own, "query_id", "left"), corpus, vectors, limit, relevance, a.document or None, a.type or None)


def eval_retrieval(spark: SparkSession, a) -> int:
    """Metrics of the hybrid search for the questions; written to --out where that is given."""
    questions = spark.read.parquet(f"{a.tables}/questions.parquet")
    found = _found(spark, a, questions.select(F.col("id").alias("query_id"), F.col("question").alias("query")), 10)
    results = found.select(F.col("query_id").alias("id"), "rank", "text", "page_start", "page_end")
    metrics = cut_lineage(retrieval.prefix_metrics(questions, results))
    if a.out:
        metrics.write.mode("overwrite").parquet(a.out)
    retrieval.metric_groups(metrics).orderBy("grouped_by", "value", "k").show(200, False)
    return 0


def query(spark: SparkSession, a) -> int:
    """The best chunks for one question."""
    found = _found(spark, a, spark.createDataFrame([("q", a.text)], "query_id string, query string"), a.limit)
    found.orderBy("rank").select("rank", F.round("final_score", 4).alias("score"), F.array_join("sources", "+").alias("sources"), "document_id", "page_start", T.collapse(F.substring("text", 1, 120)).alias("text")).show(a.limit, False)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="foliant")
    jobs = p.add_subparsers(dest="job", required=True)

    def job(f, **options):
        j = jobs.add_parser(f.__name__.replace("_", "-"), help=f.__doc__)
        for name, default in options.items():
            j.add_argument(f"--{name.replace('_', '-')}", required=default is None, default=default, type=int if isinstance(default, int) else str)
        j.set_defaults(run=f)

    job(init, tables=None)
    job(doctor, tables=None)
    job(ingest, items=None, tables=None, document_pattern=r"([0-9a-f]{64})")
    job(rechunk, tables=None, out=None, size=1200, overlap=120, row_group=6)
    job(audit_chunks, chunks=None)
    job(index_chunks, chunks=None, vectors=None, out=None)
    search = {"vectors": "", "query_vectors": "", "relevance": "", "document": "", "type": ""}
    job(eval_retrieval, tables=None, chunks=None, out="", **search)
    job(query, chunks=None, text=None, limit=8, **search)
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(_session(), a)


if __name__ == "__main__":
    sys.exit(main())
