"""Writing results: replacing documents, marking, events, vectors and exports.

A store is a folder of Parquet partitioned by a hash bucket of document_id, so that replacing documents rewrites their buckets only. A
run's manifest is written last: readers that follow the manifest see whole runs."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.session import cut_lineage

BUCKETS = 64  # of a new store; a store keeps the number it was made with
# Caps of the vector store's string columns, in code points.
CAPS = {"section_path": 2048, "text": 65535, "bbox_json": 65535, "asset_id": 128}


def replaced(stored: DataFrame, fresh: DataFrame, key: str = "document_id", keys: DataFrame | None = None) -> DataFrame:
    """The rows of stored without the documents that fresh has (or that ``keys`` names, also those that have no rows any more), and the rows of fresh."""
    gone = (fresh if keys is None else keys).select(key).distinct()
    return stored.join(gone, key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def bucket(buckets: int, key: str = "document_id"):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _data_files(spark: SparkSession, path: str):
    """What a store's folder holds besides its own notes."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    for status in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p):
        if not status.getPath().getName().startswith(("_", ".")):
            yield status


def store_buckets(spark: SparkSession, path: str) -> int | None:
    """How many buckets the store at path was made with; None where there is no store."""
    if not there(spark, f"{path}/_store"):
        return None
    return json.loads(spark.read.text(f"{path}/_store").first().value)["buckets"]


def replace_documents(spark: SparkSession, path: str, fresh: DataFrame, buckets: int = BUCKETS) -> None:
    """Write fresh to the store at path; its documents' earlier rows go, other buckets aren't touched.

    ``buckets`` counts for a new store only: for one of many terabytes take thousands, so that a few documents rewrite little. Rows that
    cannot be put together with the stored ones raise an error before anything is written."""
    known = store_buckets(spark, path)
    if known is None:
        if there(spark, path):
            raise ValueError(f"{path} holds something, but no store")
        spark.createDataFrame([(json.dumps({"buckets": buckets}),)], "value string").coalesce(1).write.text(f"{path}/_store")
    buckets = known or buckets
    fresh = fresh.withColumn("bucket", bucket(buckets))
    rows = fresh
    if known is not None and any(True for _ in _data_files(spark, path)):
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
        stored = spark.read.parquet(path)
        for f in stored.schema:
            if f.name in fresh.columns and f.name != "bucket" and fresh.schema[f.name].dataType != f.dataType:
                raise TypeError(f"{f.name} is {f.dataType.simpleString()} in the store, {fresh.schema[f.name].dataType.simpleString()} in the new rows")
        rows = replaced(stored.where(F.col("bucket").isin(touched)), fresh)
    cut_lineage(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def checked_chunks(chunks: DataFrame, document_id: str, documents: DataFrame | None = None) -> DataFrame:
    """chunks, or an error where one belongs to another document, repeats an id, or the document is not in ``documents``."""
    ok = chunks.agg(F.count_if(F.col("document_id") != document_id).alias("foreign"), (F.count("*") - F.count_distinct("chunk_id")).alias("twice")).first()
    if ok.foreign or ok.twice:
        raise ValueError(f"{ok.foreign} chunks of other documents, {ok.twice} repeated chunk ids")
    if documents is not None and documents.where(F.col("document_id") == document_id).isEmpty():
        raise ValueError(f"unknown document {document_id}")
    return chunks


def with_status(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """documents with the status that changes (document_id, status, updated_at) give last; of equal times the greatest status."""
    last = changes.groupBy("document_id").agg(F.max(F.struct("updated_at", "status")).alias("c"))
    out = documents.join(last, "document_id", "left")
    return out.withColumn("status", F.coalesce("c.status", "status")).withColumn("updated_at", F.coalesce("c.updated_at", "updated_at")).drop("c")


def append_events(events: DataFrame, path: str, run_id: str) -> None:
    """Append a run's events as JSON lines; each carries the run's id."""
    events.withColumn("run_id", F.lit(run_id)).write.mode("append").json(path)


def write_chunk_export(chunks: DataFrame, path: str) -> None:
    """The chunks as JSON lines, a folder for each document. Spark renames a finished job's files into place, so that readers never see half an export."""
    chunks.write.mode("overwrite").partitionBy("document_id").json(path)


def marked_embedded(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """chunks with embedding_state 'embedded' where ids has their chunk_id."""
    done = ids.select("chunk_id", F.lit("embedded").alias("_s")).distinct()
    return chunks.join(done, "chunk_id", "left").withColumn("embedding_state", F.coalesce("_s", "embedding_state")).drop("_s")


def upserted(stored: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """One row per key: the fresh one where there is one, of several the last by written_at."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (key, "_new")]
    return both.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct("_new", "written_at")).alias("r")).select(key, "r.*")


def vector_rows(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows of the vector store: chunks joined with their vectors (chunk_id, dense_vector), long strings capped, dim as partition. A chunk without vector, or vectors of several lengths, end the job."""
    dims = vectors.select(F.size("dense_vector").alias("d")).distinct().limit(2).count()
    if dims > 1:
        raise ValueError("vectors of different length")
    rows = chunks.join(vectors, "chunk_id", "left")
    rows = rows.withColumn("dense_vector", F.when(F.assert_true(F.col("dense_vector").isNotNull(), F.lit("a chunk has no vector")).isNull(), F.col("dense_vector")))
    for name, cap in CAPS.items():
        if name in rows.columns:
            rows = rows.withColumn(name, F.substring(name, 1, cap))
    return rows.withColumn("dim", F.size("dense_vector"))


def without_query(url):
    """A URL without query and fragment."""
    return F.regexp_replace(url, r"[?#].*$", "")


def redacted(json_text):
    """JSON text in which every string under a key with 'url' in its name, at any depth, lost its query and fragment."""
    return F.regexp_replace(json_text, r'(?i)("[^"]*url[^"]*"\s*:\s*"[^"?#]*)[?#](?:[^"\\]|\\.)*"', '$1"')


def audit_markdown(audit: DataFrame) -> str:
    """The findings of a chunk audit (check, severity, n) as a Markdown table; there are few checks."""
    rows = audit.orderBy("severity", "check").toLocalIterator()
    return "\n".join(["| check | severity | count |", "| --- | --- | --- |", *(f"| {r.check} | {r.severity} | {r.n} |" for r in rows)])


def run_metadata(sources: DataFrame) -> DataFrame:
    """path, sha256, length of a run's input files: what its manifest keeps of its provenance."""
    return sources.select("path", F.sha2("content", 256).alias("sha256"), "length")


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a run; {} where there is none or it is no JSON."""
    if not there(spark, path):
        return {}
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    except ValueError:
        return {}


def events_markdown(events: DataFrame) -> str:
    """A run's events (event_id, stage, status, message) as a Markdown table; a run has few."""
    rows = events.orderBy("event_id").select("stage", "status", "message").toLocalIterator()
    escape = lambda v: str(v if v is not None else "").replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| stage | status | message |", "| --- | --- | --- |", *(f"| {escape(r.stage)} | {escape(r.status)} | {escape(r.message)} |" for r in rows)])


def write_manifest(spark: SparkSession, path: str, run: dict) -> None:
    """The last file of a run."""
    spark.createDataFrame([(json.dumps(run | {"written_at": time.time()}, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
