"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Bytes of a file split in a local session, so that small inputs use all cores. Clusters keep their own setting.
LOCAL_SPLIT_BYTES = 4 << 20


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("linkmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(LOCAL_SPLIT_BYTES))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session in one process (``local`` or ``local[...]``) without that setting gets a temporary folder; on a
    cluster, a local one too, a machine-local folder is not seen by the others, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="linkmill-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage durably (a lost executor re-reads the table) and gives the optimizer true sizes, so a
    later join is broadcast only if the table really is small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_with(df: DataFrame, path: str, measure: Column) -> tuple[DataFrame, int]:
    """The same for a given path, with an aggregate of the rows taken while they are written."""
    seen = Observation()
    df.observe(seen, measure.alias("measure")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["measure"] or 0
