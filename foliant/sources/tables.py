"""Reading the project's Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.session import cut_lineage


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One table of a folder, with only the named columns when any are named."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


BROADCAST_ROWS = 100_000  # of two numbers each


def delivered_once(df: DataFrame, key: str) -> DataFrame:
    """One row per key (rows without key are dropped); of several copies the first by file and place.

    Of a file scan only keys and places are shuffled, to find the few copies to leave out; the rows themselves stay where they are. What
    is no file scan is deduplicated by the key."""
    df = df.where(F.col(key).isNotNull())
    try:
        placed = df.select(key, F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return df.dropDuplicates([key])
    first = placed.groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct("_file", "_row")).alias("first")).where("n > 1")
    again = cut_lineage(placed.join(first, key).where("_file <> first._file or _row <> first._row").select("_file", "_row"))
    n = again.count()
    if not n:
        return df
    rows = df.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return rows.join(F.broadcast(again) if n <= BROADCAST_ROWS else again, ["_file", "_row"], "left_anti").drop("_file", "_row")
