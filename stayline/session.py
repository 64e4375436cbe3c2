"""Session helpers: where lineage is cut and how a local test session looks."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "stayline", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> None:
    """Runtime re-planning, also for a skewed join whose partitioning a later
    aggregate could have reused: splitting the hot key is worth the extra shuffle."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only on a single machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="stayline-")


def freeze(df: DataFrame) -> DataFrame:
    """Compute df once into the shared folder, so that later uses see the same rows
    even when executors are lost."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
