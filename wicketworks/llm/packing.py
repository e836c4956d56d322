"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import keyed_hash, salted_buckets
from wicketworks.llm.pieces import batches_by_bytes, encoder
from wicketworks.session import materialize

CAPACITY = 2048
BATCH_CHARS = 4 << 20


class Step(NamedTuple):
    """Pieces of one length, from rank ``rank`` on, go ``each`` to a sequence, behind ``used`` tokens."""

    length: int
    rank: int
    each: int
    sequence: int
    used: int


def plan_best_fit(counts: dict[int, int], capacity: int) -> tuple[list[Step], int]:
    """Best-fit decreasing over counts of lengths: the steps and the number of sequences.

    A run of sequences with the same room is one entry, so time and memory depend on the number of
    different lengths, never on the number of pieces.
    """
    steps: list[Step] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, how many)
    rooms: list[int] = []  # rooms that have runs, ascending
    sequences = 0

    def leave(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    rooms.pop(at)
            else:
                room, first, many = capacity, sequences, -(-left // (capacity // length))
                sequences += many
            each = room // length
            full, rest = min(many, left // each), 0
            if full < many and left > full * each:
                rest = left - full * each
            steps.append(Step(length, rank, each, first, capacity - room))
            leave(room - each * length, first, full)
            if rest:
                leave(room - rest * length, first + full, 1)
            leave(room, first + full + bool(rest), many - full - bool(rest))
            rank += full * each + rest
            left -= full * each + rest
    return steps, sequences


def pieces_of(text: Column, tokenizer_path: str, capacity: int, end_id: int = 0, keep_ids: bool = False) -> Column:
    """Array of a text's pieces: piece, start, length, CRC-32 of the ids (little-endian unsigned 32 bits), ids if asked for."""
    sql = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint" + (",ids:binary>>" if keep_ids else ">>")
    end = end_id.to_bytes(4, "little")

    @F.arrow_udf(sql)
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = encoder(tokenizer_path, "words")
        for part in parts:
            numbers: list[int] = []
            starts: list[int] = []
            lengths: list[int] = []
            sums: list[int] = []
            kept: list[bytes] = []
            offsets = [0]
            for batch in batches_by_bytes(part.to_pylist(), BATCH_CHARS):
                for values in library.encode(batch):
                    ids = b"".join((*values, end))
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        numbers.append(i)
                        starts.append(at // 4)
                        lengths.append(len(piece) // 4)
                        sums.append(crc32(piece))
                        if keep_ids:
                            kept.append(piece)
                    offsets.append(len(numbers))
            columns = [pa.array(numbers, pa.int32()), *(pa.array(c, pa.int64()) for c in (starts, lengths, sums))]
            names = ["piece", "start", "length", "ids_crc32"]
            rows = pa.StructArray.from_arrays([*columns, pa.array(kept, pa.binary())] if keep_ids else columns, [*names, "ids"] if keep_ids else names)
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return cut(text)


def ranked_by_length(pieces: DataFrame, buckets: int) -> DataFrame:
    """``pieces`` with ``rank``, from 0 within each length, no task ever holding all of one length.

    Rows of a length are divided over ``buckets``; a bucket's rows are numbered from the total of
    the buckets before it.
    """
    salted = pieces.withColumn("_bucket", F.pmod(keyed_hash(0, F.col("_key"), F.col("piece")), F.lit(buckets)).cast("int"))
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        F.col("length").alias("_length"), F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    inside = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("_key", "piece", "ids_crc32"))
    numbered = salted.withColumn("_inside", inside)
    joined = numbered.join(offsets, (F.col("length") == F.col("_length")) & (F.col("_bucket") == F.col("_of")))
    return joined.withColumn("rank", F.col("_base") + F.col("_inside") - 1).drop("_length", "_of", "_base", "_inside", "_bucket")


def slot_of(length: Column, rank: Column, steps: list[Step]) -> Column:
    """Planned place (sequence_id, offset) of the ``rank``-th piece of a length."""

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def placed(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        import numpy as np

        plan = np.array(steps, np.int64).reshape(-1, 5)
        plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
        # Order by length, then rank, in one number; ranks stay below 2**50.
        starts = (plan[:, 0] << 50) | plan[:, 1]
        size, nth = np.asarray(lengths, np.int64), np.asarray(ranks, np.int64)
        step = plan[np.searchsorted(starts, (size << 50) | nth, "right") - 1]
        ahead = nth - step[:, 1]
        sequence = step[:, 3] + ahead // step[:, 2]
        offset = step[:, 4] + ahead % step[:, 2] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    return placed(length, rank)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` tokens as best fit finds.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``,
    little-endian unsigned 32 bits). A document is its ids and an end id; only documents above the
    capacity are cut. Null and empty texts are the end id alone; repeated rows are packed each;
    other columns are not carried; an empty table gives an empty table.

    Tokens are made once and written as a narrow table. The driver sees one count for each of at
    most ``capacity`` lengths and plans on those; the plan's size is bounded by the capacity and travels
    with the function that looks places up.
    """
    made = pieces_of(F.col(f"`{text}`"), tokenizer_path, capacity, keep_ids=keep_ids)
    # Every document has a piece. The outer form says so; the plain one would evaluate the pieces once more to filter.
    cut = docs.select(F.col(f"`{doc_id}`").alias("_key"), made.alias("_pieces")).select("_key", F.inline_outer("_pieces"))
    pieces = materialize(cut, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    steps, _ = plan_best_fit(counts, capacity)
    ranked = ranked_by_length(pieces, buckets or salted_buckets(sum(counts.values())))
    placed = ranked.withColumn("_slot", slot_of(F.col("length"), F.col("rank"), steps))
    return placed.select(
        F.col("_key").alias(doc_id), "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), "_slot.sequence_id", "_slot.offset"
    )
