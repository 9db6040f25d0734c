"""Session helpers: table access and durable lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: Session settings used by tests and by the bench; a cluster brings its own.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lectern")
    conf = DEFAULT_CONF | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory}
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names, or a temporary one on a local master.

    On a cluster without the setting this raises: executors could not share a machine's own folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lectern-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of df by writing it to the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cached(df: DataFrame) -> DataFrame:
    """Keep df for reuse; lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
