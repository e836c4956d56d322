"""Incremental landing with a file stream: each run picks up only files not seen before."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wicketworks import schemas
from wicketworks.session import shared_dir
from wicketworks.sources.tables import only_files


def land_new_deliveries(spark: SparkSession, incoming: str, landed: str, name: str) -> StreamingQuery:
    """Append delivery files that appeared since the last run to the landed table, then stop.

    The stream's own log, kept in the shared folder under ``name``, remembers what has landed,
    so a run that is interrupted and repeated lands every file exactly once.
    """
    rows = spark.readStream.option("header", True).schema(schemas.DELIVERIES).csv(incoming)
    tagged = only_files(rows.withColumn("file_name", F.col("_metadata.file_name")), info=False)
    return (
        tagged.writeStream.format("parquet")
        .option("path", landed)
        .option("checkpointLocation", f"{shared_dir(spark).rstrip('/')}/landing-{name}")
        .trigger(availableNow=True)
        .start()
    )
