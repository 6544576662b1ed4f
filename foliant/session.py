"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FOLIANT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``. Where that is unset, a local session gets a folder of its own; on a cluster it is an error, because executors share no local folder."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own
    made = spark.sparkContext.getCheckpointDir()
    if made is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        made = tempfile.mkdtemp(prefix="foliant-checkpoint-")
        spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it from there, so that it is neither recomputed nor lost with an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A written df of few columns, marked for broadcast where it is counted to have at most ``most`` rows; larger ones are left to Spark's own choice."""
    return F.broadcast(df) if df.count() <= most else df


def written_table(df: DataFrame) -> DataFrame:
    """Like cut_lineage, as a compressed table in the shared folder: for rows with texts that several branches read, each of them only its columns."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that their Python workers can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="foliant-ship-")) / "foliant_package.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))  # the driver serves it; executors keep no reference to this folder
