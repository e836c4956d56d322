"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables bucketed by a key join on that key and others without an exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


# Folders of intermediates that this process made below the shared folder.
_SCRATCH: list[str] = []


def merged_settings(overrides: dict[str, str] | None = None) -> dict[str, str]:
    """The defaults with the overrides over them."""
    return {**SESSION_DEFAULTS, **(overrides or {})}


def create_session(
    name: str = "wicketworks",
    overrides: dict[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Named session; overrides are merged over the defaults, never replacing them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in merged_settings(overrides).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="wicketworks-")
    context.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the intermediates written so far and return their number; frames made from them are then void.

    Nothing but folders that ``scratch_path`` named in this process is touched.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a written table, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    return written


def discard(*written: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote and that nothing reads any more."""
    for df in written:
        spark, path = df.sparkSession, df._scratch_path
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        if path in _SCRATCH:
            _SCRATCH.remove(path)
