"""Session builder and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "placerank", driver_memory: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for.

    The master and the shuffle partition count stay with spark-submit; adaptive execution
    sizes the shuffles, splits skewed join partitions and picks broadcast joins by measured size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # sketches per group stay in the hash map up to this many groups in a task, instead of sorting all rows
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1024")
        # no Python call sites in error messages: building a query takes a third less time
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # '01' must stay the string '01' when a partitioned table is read back
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="placerank-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/placerank/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back; the result survives the loss of executors.

    A Parquet table rather than checkpoint(): later passes read only the columns they need, and its
    measured size lets Spark broadcast it where it is small.
    """
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
