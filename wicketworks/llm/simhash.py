"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import components, releasing
from wicketworks.session import materialize

BITS = 64
SEED = 42


def _fingerprint(text: str | None, words: int) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    if not text:
        return 0
    # bytes.lower and bytes.split know ASCII only: A-Z, and white space U+0020 and U+0009 to U+000D.
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    stops = (ends[min(words, len(tokens)) - 1 :] - 1).tolist()
    starts = [0, *ends[: n - 1].tolist()]
    total = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = [xxh64_intdigest(joined[i:j], SEED) for i, j in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """64-bit SimHash (as a signed long) of the word shingles, repeats included.

    A-Z are lower-cased; words are runs without U+0020 and U+0009 to U+000D; a text of fewer
    words is one shingle. A bit is set if it is set in over half of the shingles' XXH64.
    Null and empty texts and texts of white space have fingerprint 0.
    """

    @F.arrow_udf("long")
    @releasing
    def hashed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        for part in parts:
            prints = np.fromiter((_fingerprint(t.as_py(), words) for t in part), np.uint64, len(part))
            yield pa.array(prints.view(np.int64))

    return hashed(text)


def ball_variants(value: Column, half: int) -> Column:
    """All values within ``half`` flipped bits, the value itself first."""
    masks = [sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(BITS), k)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: value.bitwiseXOR(m))


def linked_fingerprints(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) joining all fingerprints that are within ``radius`` differing bits of one another.

    ``prints`` holds distinct values in ``fingerprint``. Two values within an even radius have a
    common variant within half of it, and all values at one variant lie within the radius of each
    other, at most 65 of them for radius 2: neighbours in the order of a variant's values are
    linked, which joins the same values as all pairs would. Odd radii are refused.
    """
    if radius % 2:
        raise ValueError("the radius must be even: both halves of the way are emitted in full")
    variants = prints.select("fingerprint", F.explode(ball_variants(F.col("fingerprint"), radius // 2)).alias("variant"))
    earlier = F.lag("fingerprint").over(W.partitionBy("variant").orderBy("fingerprint"))
    pairs = variants.select(earlier.alias("a"), F.col("fingerprint").alias("b")).where("a IS NOT NULL").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (long) and ``component_id``.

    Fingerprints link within ``radius`` bits; ``component_id`` is the smallest id reachable.
    Documents without words share fingerprint 0 and are linked like any other. Copies meet in
    the aggregation by fingerprint, so a large group of copies is one value in all that
    follows. Repeated ids give one row per input row; null ids never become a component's id unless
    the component has no other; an empty table gives an empty table.
    """
    key = F.col(f"`{doc_id}`")
    rows = materialize(docs.select(key.alias("_id"), fingerprint(F.col(f"`{text}`"), words).alias("fingerprint")), "simhash")
    prints = materialize(rows.groupBy("fingerprint").agg(F.min("_id").alias("_least")), "simhash-distinct")
    roots = components(linked_fingerprints(prints, radius), "simhash")
    # A value without links is its own root, and so needs no row of the component table.
    placed = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    groups = placed.join(least, "root").select(F.col("fingerprint").alias("_value"), "component_id")
    joined = rows.join(groups, F.col("fingerprint") == F.col("_value"))
    return joined.select(F.col("_id").alias(doc_id), "fingerprint", "component_id")


def hex_fingerprint(value: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")
