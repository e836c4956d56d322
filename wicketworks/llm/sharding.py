"""Shards of near equal bytes by histogram sort."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import salted_buckets
from wicketworks.session import materialize

LEAST, MOST = -(1 << 63), (1 << 63) - 1
PROBES = 32
TOLERANCE = 0.001


class Between(NamedTuple):
    """What lies between two neighbouring probes: its bytes, those below it, its least and greatest key."""

    below: int
    size: int
    least: int
    greatest: int


def _between(rows: DataFrame, key: str, probes: list[int]) -> list[Between]:
    """Exact bytes between candidate boundaries: one pass, summed in every partition before the exchange."""

    @F.arrow_udf("int")
    def interval(keys: pa.Array) -> pa.Array:
        import numpy as np

        return pa.array(np.searchsorted(np.array(probes, np.int64), np.asarray(keys, np.int64), "right").astype(np.int32))

    sums = rows.groupBy(interval(F.col(key)).alias("_i")).agg(F.sum("size").alias("s"), F.min(key).alias("a"), F.max(key).alias("b"))
    out, below = [], 0
    for r in sorted(sums.collect(), key=lambda r: r["_i"]):  # at most one row per probe
        out.append(Between(below, r["s"], r["a"], r["b"]))
        below += r["s"]
    return out


def _spread(least: int, greatest: int) -> list[int]:
    """Probes inside the interval, and those that part it from what lies outside."""
    return [least, *(least + (greatest - least) * (i + 1) // PROBES for i in range(PROBES)), min(greatest + 1, MOST)]


def find_boundaries(rows: DataFrame, key: str, targets: list[float], tolerance: float) -> list[tuple[int, Between | None]]:
    """For each target number of bytes, the key below which about that many lie.

    Each round counts exact bytes below all candidate keys of all open targets at once and goes on within
    the interval that a target falls into, until a candidate is within ``tolerance`` bytes or the interval
    is a single key, which is then returned too. Beyond the largest key the boundary is one more.
    """
    found: dict[int, tuple[int, Between | None]] = {}
    probes = _spread(LEAST, MOST)
    while len(found) < len(targets):
        parts = _between(rows, key, probes)
        probes = []
        for i, target in enumerate(targets):
            if i in found:
                continue
            part = next((p for p in parts if p.below + p.size > target), None)
            if part is None:
                found[i] = (parts[-1].greatest + 1 if parts else MOST, None)
            elif target - part.below <= tolerance:
                found[i] = (part.least, None)
            elif part.below + part.size - target <= tolerance:
                found[i] = (part.greatest + 1, None)
            elif part.least == part.greatest:
                found[i] = (part.least, part)
            else:
                probes += _spread(part.least, part.greatest)
        probes = sorted(set(probes))
    return [found[i] for i in range(len(targets))]


def find_splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Splitters (key, tie) between shards of near equal bytes.

    A group of equal keys stays whole, with the boundary at its nearer end, unless it alone is larger than a
    shard's share: only then it is divided, by the tie.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = total / shards
    targets = [share * i for i in range(1, shards)]
    splitters: list[tuple[int, int] | None] = []
    inside: dict[int, list[tuple[int, float]]] = {}
    for i, (key, group) in enumerate(find_boundaries(rows, "key", targets, tolerance * share)):
        if group is not None and group.size > share:
            inside.setdefault(key, []).append((i, targets[i] - group.below))
            splitters.append(None)
        elif group is not None and targets[i] - group.below > group.below + group.size - targets[i]:
            splitters.append((key + 1, LEAST))
        else:
            splitters.append((key, LEAST))
    for key, cuts in inside.items():  # fewer than there are shards
        group = rows.where(F.col("key") == key)
        for (i, _), (tie, _) in zip(cuts, find_boundaries(group, "tie", [t for _, t in cuts], tolerance * share)):
            splitters[i] = (key, tie)
    return sorted(splitters)


def shard_number(key: Column, tie: Column, splitters: list[tuple[int, int]]) -> Column:
    """How many splitters are not above (key, tie)."""

    @F.arrow_udf("int")
    def numbered(keys: pa.Array, ties: pa.Array) -> pa.Array:
        import numpy as np

        keys, ties = np.asarray(keys, np.int64), np.asarray(ties, np.int64)
        at = np.array([k for k, _ in splitters], np.int64)
        cut = np.array([t for _, t in splitters], np.int64)
        low, high = np.searchsorted(at, keys, "left"), np.searchsorted(at, keys, "right")
        number = low.copy()
        for j in range(int((high - low).max(initial=0))):
            equal = low + j < high
            number += equal & (ties >= cut[np.minimum(low + j, len(cut) - 1)])
        return pa.array(number.astype(np.int32))

    return numbered(key, tie) if splitters else F.lit(0)


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0, gapless in its shard).

    Sizes are UTF-8 bytes plus 1 (1 for a null text, whose CRC is null). Documents are ordered by the hash of
    their text, so equal texts, null ones included, share a shard; ties are broken by the hash of the
    id where one text alone exceeds a shard. Bytes of shards differ by ``tolerance`` of a share as far
    as groups allow it. Repeated rows are placed each; an empty table gives an empty table.

    Rounds of counting run over a narrow table of keys and sizes; the driver sees at most 32 sums for each open
    boundary. Rows are exchanged once, by shard and a bucket inside it.
    """
    source = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("_id"),
        (F.coalesce(F.octet_length(source), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(source).alias("text_crc32"),
        F.xxhash64(source).alias("key"),
        F.xxhash64(F.col(f"`{doc_id}`")).alias("tie"),
    )
    rows = materialize(rows, "shard-keys")
    splitters = find_splitters(rows, shards, tolerance)
    many = buckets or salted_buckets(rows.count(), least=64)
    placed = rows.withColumn("shard", shard_number(F.col("key"), F.col("tie"), splitters))
    placed = placed.withColumn("_bucket", F.pmod(F.xxhash64("tie"), F.lit(many)).cast("int"))
    sizes = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select(F.col("shard").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(W.partitionBy("shard", "_bucket").orderBy("key", "tie"))
    numbered = placed.withColumn("_in", inside)
    joined = numbered.join(bases, (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    slot = (F.col("_base") + F.col("_in") - 1).cast("long")
    return joined.select(F.col("_id").alias(doc_id), "size", "text_crc32", "shard", slot.alias("slot"))
