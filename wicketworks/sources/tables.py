"""CSV and Parquet tables, the layer layout, and incremental landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketworks import schemas

# Directory of each layer.
LAYERS = {
    "raw": "1_rawData",
    "processed": "2_processedData",
    "merged": "3_mergedData",
    "filtered": "4_filteredData",
}
INFO_SUFFIX = "_info.csv"


def layer_path(base: str, layer: str, table: str) -> str:
    """Path of a table inside a layer."""
    return f"{base.rstrip('/')}/{LAYERS[layer]}/{table}"


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which costs an extra pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and every column as text: no inference, sentinels intact."""
    return spark.read.option("header", True).csv(path)


def is_info_file(name: Column, loose: bool = False) -> Column:
    """True for match info files; ``loose`` looks for 'info' anywhere in the name."""
    return name.contains("info") if loose else name.endswith(INFO_SUFFIX)


def only_files(df: DataFrame, info: bool, loose: bool = False) -> DataFrame:
    """Keep rows that were read from info files, or those read from the other files."""
    wanted = is_info_file(F.col("_metadata.file_name"), loose)
    return df.where(wanted if info else ~wanted)


def file_key(file_name: str = "file_name") -> Column:
    """Numeric key before the first underscore of a file name."""
    return F.regexp_extract(F.col(file_name), r"^([^_]+)_", 1).try_cast("bigint")


def read_deliveries(spark: SparkSession, directory: str) -> DataFrame:
    """All delivery files of a directory, with the fixed schema."""
    rows = spark.read.option("header", True).schema(schemas.DELIVERIES).csv(directory)
    return only_files(rows, info=False)


def write_csv(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Overwrite a CSV directory. Every part file carries the header and is written in parallel."""
    writer = df.write.mode("overwrite").option("header", True)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet table of a layer and return it as a scan."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def not_landed(incoming: DataFrame, landed: DataFrame, key: str = "file_name") -> DataFrame:
    """Incoming rows whose key has not been landed before."""
    return incoming.join(landed.select(key), key, "left_anti")


def write_samples(samples: DataFrame, path: str) -> None:
    """Sample set, one directory per split."""
    samples.write.mode("overwrite").partitionBy("split").parquet(path)


def read_samples(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Sample set; a split reads only its own directory."""
    samples = spark.read.parquet(path)
    return samples.where(F.col("split") == split) if split else samples
