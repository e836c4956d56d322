"""Stored layers: written once, checked in the pass that writes them, bucketed by key where later steps join on it.

A bucketed layer lies divided and sorted by its keys, so joins, semi-joins, groupings and windows on the keys read it
without an exchange. What its table is like stands in a small file beside the data: any later session can open it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from hashlib import md5
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wicketworks.operators.skew import BOUNDED, group_limit
from wicketworks.session import scratch_path

SPEC = "_layer.json"


class Watch:
    """Counts rows, and the nulls of some columns, of a table while a later write reads it: no job of its own."""

    def __init__(self, what: str, nulls: Sequence[str] = ()) -> None:
        self.what, self.nulls = what, list(nulls)

    def over(self, df: DataFrame) -> DataFrame:
        """``df``, counted. It must be read once, by the write that this watch is given to."""
        missing = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(self.nulls)]
        self._counts, self._seen, self._df = [F.count(F.lit(1)).alias("rows"), *missing], Observation(), df
        self._counted: dict[str, int] | None = None
        return df.observe(self._seen, *self._counts)

    def _values(self) -> dict[str, int]:
        if self._counted is None:
            self._counted = dict(self._seen._jo.getAsJava())
        if not self._counted:  # the write left the table out, as a join with an empty one does
            self._counted = self._df.agg(*self._counts).first().asDict()
        return self._counted

    @property
    def rows(self) -> int:
        return self._values()["rows"]

    def null_counts(self) -> dict[str, int]:
        return {c: self._values()[f"_{i}"] for i, c in enumerate(self.nulls)}

    def require_rows(self) -> None:
        """Refuse an empty table."""
        if self.rows == 0:
            raise ValueError(f"{self.what}: no rows")


class Layer(NamedTuple):
    """A stored table, its number of rows, and what operators on its keys take as ``group_rows``."""

    frame: DataFrame
    rows: int
    group_rows: int


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put the staged table in the place of ``path``."""
    source, files = _file_system(spark, staged)
    target, _ = _file_system(spark, path)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{staged} could not be moved to {path}")


def _checked(spark: SparkSession, staged: str, guards: Sequence[Watch]) -> None:
    """Refuse what the guards refuse; a table that was there before stays."""
    try:
        for guard in guards:
            guard.require_rows()
    except ValueError:
        at, files = _file_system(spark, staged)
        files.delete(at, True)
        raise


def write_layer(df: DataFrame, path: str, guards: Sequence[Watch] = (), keys: Sequence[str] = ()) -> Layer:
    """Write a table in one pass and take its place; ``guards`` watch tables that the write reads and refuse empty ones.

    With ``keys`` the layer tells whether any group of them is too large for a task: that takes a job
    only if the table has more rows than a task may hold.
    """
    spark, staged = df.sparkSession, f"{path}-staged-{uuid.uuid4().hex}"
    all_rows = Watch(path)
    all_rows.over(df).write.parquet(staged)
    _checked(spark, staged, guards)
    _replace(spark, staged, path)
    frame = spark.read.schema(df.schema).parquet(path)
    return Layer(frame, all_rows.rows, group_limit(frame, keys, all_rows.rows))


def store(df: DataFrame, name: str, guards: Sequence[Watch] = (), keys: Sequence[str] = ()) -> Layer:
    """``write_layer`` to an intermediate table in the shared folder."""
    return write_layer(df, scratch_path(df.sparkSession, name), guards, keys)


def _table_name(path: str) -> str:
    return "layer_" + md5(path.encode()).hexdigest()


def write_bucketed(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    buckets: int | None = None,
    spread: int = 1,
    guards: Sequence[Watch] = (),
    in_place: bool = False,
) -> Layer:
    """Write a table bucketed by ``keys`` and sorted by them and ``order``; tables that are to meet need equal ``buckets``.

    One exchange deals the rows to their buckets; none with ``in_place``, for rows that lie by the keys already, as those of a
    bucketed layer do through windows, groupings and joins on the keys.

    Each bucket is one file, or up to ``spread`` files, between which the rows of a key are dealt: give it where a key may
    hold very many rows, so that no task writes them all. If the layer has such a key, ``frame`` is its plain scan,
    which is read in splits, and operators divide the key as they do in any table.
    """
    spark, staged = df.sparkSession, f"{path}-staged-{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    all_rows, table = Watch(path), _table_name(staged)
    dealt = [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(spread))] if spread > 1 else []
    placed = all_rows.over(df)
    if not in_place:
        placed = placed.repartition(n * spread, *[F.col(f"`{k}`") for k in keys], *dealt)
    placed.write.option("path", staged).bucketBy(n, *keys).sortBy(*keys, *order).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")
    _checked(spark, staged, guards)
    spec = {"keys": list(keys), "order": list(order), "buckets": n, "rows": all_rows.rows, "columns": df._jdf.schema().toDDL()}
    at, files = _file_system(spark, f"{staged}/{SPEC}")
    out = files.create(at, True)
    out.write(bytearray(json.dumps(spec), "utf-8"))
    out.close()
    _replace(spark, staged, path)
    return open_bucketed(spark, path)


def open_bucketed(spark: SparkSession, path: str) -> Layer:
    """A bucketed layer, as this or an earlier session wrote it."""
    at, files = _file_system(spark, f"{path}/{SPEC}")
    stream = files.open(at)
    spec = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    table = _table_name(path)

    def quoted(names: Sequence[str]) -> str:
        return ", ".join(f"`{c}`" for c in names)

    spark.sql(f"DROP TABLE IF EXISTS {table}")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({spec['columns']}) USING parquet CLUSTERED BY ({quoted(spec['keys'])}) "
        f"SORTED BY ({quoted(spec['keys'] + spec['order'])}) INTO {spec['buckets']} BUCKETS LOCATION '{location}'"
    )
    frame = spark.table(table)
    limit = group_limit(frame, spec["keys"], spec["rows"])
    if limit < BOUNDED:  # a group is too large for a task: its bucket must be read in splits
        frame = spark.read.schema(frame.schema).parquet(path)
    return Layer(frame, spec["rows"], limit)
