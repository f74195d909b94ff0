"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: str | int = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own. Pass ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallybook")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SCRATCH = "spark.tallybook.scratch"
"""Names the scratch folder where ``spark.checkpoint.dir`` is unset; every executor must see it."""


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can see, as named by ``spark.checkpoint.dir`` or else ``SCRATCH``.

    The library has no folder of its own to fall back on: a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def _scratch_of(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tallybook/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in this application's part of the scratch folder."""
    return f"{_scratch_of(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has put in the scratch folder.

    For the end of a run: DataFrames that the library returned may read from there until then.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_of(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to the shared scratch folder; return it read back, and its row count.

    Cuts the lineage, survives the loss of executors, and gives the reader real sizes to
    plan joins with. The write counts the rows itself.
    """
    path = scratch_path(df.sparkSession, label)
    written = Observation(label)
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), written.get["rows"]


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    own = f"/tallybook/{spark.sparkContext.applicationId}/"
    paths = {file.rsplit("/", 1)[0] for file in df.inputFiles() if own in file}
    for path in (spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
