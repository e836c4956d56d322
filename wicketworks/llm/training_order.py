"""Fixed-stride shards of token ids in a keyed random order."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import chain
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import releasing
from wicketworks.llm.permute import permuted
from wicketworks.llm.pieces import batches_by_bytes, encoder
from wicketworks.session import materialize, scratch_path

SEQUENCE_TOKENS = 512
SHARD_RECORDS = 16_384
END_ID = 50_256
BATCH_CHARS = 4 << 20
# Rows whose texts are turned into strings together.
ROWS = 1_000
_LOCAL = (1 << 33) - 1
# Shards are written in so many rounds, so that the exchange never holds more than one round's part of the sequences.
ROUNDS = 3
# Tasks of a round at most; a task streams out one shard after the other.
WRITERS = 4_096
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Layout(NamedTuple):
    """What a reader must know: record ``slot`` lies in shard slot // shard_records at (slot % shard_records) * stride."""

    records: int
    sequence_tokens: int
    shard_records: int
    seed: int
    pad_id: int

    @property
    def stride(self) -> int:
        """Bytes of a record: its number of tokens (unsigned 32 bits), then unsigned 16-bit ids, little-endian."""
        return 4 + 2 * self.sequence_tokens


def _sequences(text: Column, tokenizer_path: str, tokens: int, end_id: int) -> Column:
    """The text's ids and an end id, cut after every ``tokens`` ids."""

    @F.arrow_udf("array<struct<piece:int,ids:binary>>")
    @releasing
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = encoder(tokenizer_path, "short")
        end = end_id.to_bytes(2, "little")
        for part in parts:
            ids: list[bytes] = []
            numbers: list[int] = []
            offsets = [0]
            texts = chain.from_iterable(part.slice(at, ROWS).to_pylist() for at in range(0, len(part), ROWS))
            for batch in batches_by_bytes(texts, BATCH_CHARS):
                for values in library.encode(batch):
                    whole = b"".join((*values, end))
                    pieces = [whole[at : at + 2 * tokens] for at in range(0, len(whole), 2 * tokens)]
                    ids += pieces
                    numbers += range(len(pieces))
                    offsets.append(len(ids))
            rows = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(ids, pa.binary())], ["piece", "ids"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return cut(text)


def _slot(index: Column, records: int, seed: int) -> Column:
    @F.arrow_udf("long")
    def placed(numbers: pa.Array) -> pa.Array:
        return pa.array(permuted(np.asarray(numbers, np.int64), max(records, 1), seed))

    return placed(index)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write_shards(rows: DataFrame, path: str, layout: Layout) -> DataFrame:
    """Write each shard where its rows are, in slot order, and hand on what each record holds.

    A shard is written under a name of its attempt and moved into place when complete, so a task that is lost or
    runs twice leaves the same file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(path)
        attempt = TaskContext.get().taskAttemptId()
        at, out, part, expected = -1, None, "", 0

        def close() -> None:
            if out is not None:
                out.close()
                system.move(part, f"{folder}/shard-{at:06d}.bin")

        for batch in batches:
            sums = []
            for shard, slot, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "slot", "ids"))):
                if shard != at:
                    close()
                    at, expected = shard, shard * layout.shard_records
                    part = f"{folder}/.shard-{shard:06d}-{attempt}"
                    out = system.open_output_stream(part)
                if slot != expected:
                    raise ValueError(f"slot {slot} follows {expected - 1}")
                expected += 1
                n = len(ids) // 2
                out.write(n.to_bytes(4, "little") + ids + layout.pad_id.to_bytes(2, "little") * (layout.sequence_tokens - n))
                sums.append(crc32(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("piece"), batch.column("n_tokens"), batch.column("slot"), batch.column("shard"), pa.array(sums, pa.int64())],
                ["_key", "piece", "n_tokens", "slot", "shard", "ids_crc32"],
            )
        close()

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(write, f"_key {kind}, piece int, n_tokens bigint, slot bigint, shard bigint, ids_crc32 bigint")


@contextmanager
def _exchanges_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the files of an exchange go when the query that needed them has ended, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def write_training_order(
    docs: DataFrame,
    tokenizer_path: str,
    path: str | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_records: int = SHARD_RECORDS,
    seed: int = 0,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, str]:
    """Write all documents as token sequences in a random order; returns what was written where, and the folder.

    A document is its ids and an end id (below 65,536), cut into sequences of ``sequence_tokens``; the last is padded with the
    end id. Sequences are numbered as they are written to a table, the number is permuted by ``seed`` over the exact
    number of sequences, and the result is the sequence's slot. Shards hold ``shard_records`` slots each.

    One row per sequence: id, ``piece``, ``n_tokens``, ``slot``, ``shard``, ``ids_crc32`` (of the unpadded ids, unsigned 16 bits).
    Null and empty texts are the end id alone, repeated rows are written each, an empty table writes no shard.
    Encoded sequences are stored once, so numbers and order stay fixed whatever is lost later; then, in up to ``ROUNDS``
    rounds over ranges of shards, one exchange brings every shard of the round to one task, which streams it out.
    """
    spark = docs.sparkSession
    made = _sequences(F.col(f"`{text}`"), tokenizer_path, sequence_tokens, end_id)
    cut = docs.select(F.col(f"`{doc_id}`").alias("_key"), made.alias("_s")).select("_key", F.inline_outer("_s"))
    numbered = cut.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)))
    table = scratch_path(spark, "sequences")
    numbered.write.option("compression", "zstd").parquet(table)
    stored = spark.read.schema(numbered.schema).parquet(table)
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # one row per task that wrote
    counts = materialize(stored.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")), "sequence-counts")
    records = counts.agg(F.sum("_n")).first()[0] or 0
    bases = counts.select(F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    layout = Layout(records, sequence_tokens, shard_records, seed, end_id)
    folder = path or scratch_path(spark, "training-order")
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/layout.json") as out:
        out.write(json.dumps(layout._asdict()).encode())
    # Behind explode the filter of a round takes the slot as it is; else it would be computed once more for the rows that stay.
    slot = F.explode(F.array(_slot(F.col("_base") + F.col("_i"), records, seed)))
    placed = stored.join(bases, F.col("_p") == F.col("_q")).withColumn("slot", slot)
    placed = placed.withColumn("shard", F.floor(F.col("slot") / shard_records)).withColumn("n_tokens", (F.octet_length("ids") / 2).cast("long"))
    placed = placed.select("_key", "piece", "n_tokens", "slot", "shard", "ids")
    shards = -(-records // shard_records)
    rounds = min(ROUNDS, max(shards, 1))
    written = []
    for first, end in ((shards * r // rounds, shards * (r + 1) // rounds) for r in range(rounds)):
        tasks = max(1, min(end - first, WRITERS))
        task = F.floor((F.col("shard") - first) * tasks / (end - first)).cast("int") if end > first else F.lit(0)
        dealt = placed.where(F.col("shard").between(first, end - 1)).repartitionById(tasks, task).sortWithinPartitions("slot")
        with _exchanges_removed(spark):
            written.append(materialize(_write_shards(dealt, folder, layout), "written"))
    written = reduce(DataFrame.union, written)
    return written.withColumnRenamed("_key", doc_id), folder


def read_layout(path: str) -> Layout:
    system, root = _open(path)
    with system.open_input_stream(f"{root}/layout.json") as source:
        return Layout(**json.loads(source.read()))


def read_records(path: str, start: int = 0, count: int | None = None) -> Iterator[np.ndarray]:
    """Ids of the sequences from slot ``start`` on, in order: a reader resumes at any slot by one seek."""
    system, root = _open(path)
    layout = read_layout(path)
    stop = layout.records if count is None else min(layout.records, start + count)
    slot = start
    while slot < stop:
        shard, inside = divmod(slot, layout.shard_records)
        many = min(stop - slot, layout.shard_records - inside)
        with system.open_input_file(f"{root}/shard-{shard:06d}.bin") as source:
            source.seek(inside * layout.stride)
            for _ in range(many):
                record = source.read(layout.stride)
                n = int.from_bytes(record[:4], "little")
                yield np.frombuffer(record, "<u2", n, 4)
        slot += many
