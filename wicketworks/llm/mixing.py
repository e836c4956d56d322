"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import free_name, keyed_hash, whole_row
from wicketworks.session import materialize

WEIGHTS = (5, 2, 1)
WORDS = r"[^\x20\x09-\x0D]+"
BLOCK_DOCS = 64
MOST_BLOCKS = 1 << 16
# Quotas travel to the executors: at most 32 MB. One row per source is also what a window without a key ranks.
MOST_CELLS = 4_000_000


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size, n_docs): adds ``weight`` and ``target``.

    Sources by code point, null last, get the weights in turn. Targets are proportional to the
    weights and sum to ``share`` of all sizes, but none is above ``most`` times its source's size: with
    sources in the order in which they reach that bound, the level of the first source that does not
    reach it is the largest of all levels.
    """
    in_turn = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(in_turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighted = sizes.withColumn("weight", weight)
    reached = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("source_size").over(reached.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(reached.rowsBetween(W.currentRow, W.unboundedFollowing))
    everything = W.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.lit(most) * before) / behind
    target = F.least(F.lit(most) * F.col("source_size"), F.col("weight") * F.max("_level").over(everything))
    return weighted.withColumn("_level", level).withColumn("target", target).drop("_level")


def split_quotas(quotas: Sequence[int], shards: int, seed: int):
    """Blocks of each source for each shard: exact, and as many in all for every shard (or one more).

    A node of the tree divides its sources' blocks between its shards' halves by one multivariate
    hypergeometric draw, as if the blocks had been shuffled and cut.
    """
    import numpy as np

    cells = np.zeros((len(quotas), shards), np.int64)

    def divide(have, first: int, last: int) -> None:
        if last - first == 1:
            cells[:, first] = have
            return
        middle = (first + last) // 2
        total = int(have.sum())
        part = total * (middle - first) // (last - first)
        draw = np.random.Generator(np.random.PCG64([seed, first, last])).multivariate_hypergeometric(have, part, method="marginals")
        divide(draw, first, middle)
        divide(have - draw, middle, last)

    if len(quotas):
        divide(np.asarray(quotas, np.int64), 0, shards)
    return cells


def _shards_of(cells, quotas, seed: int):
    """Function of (source number, block, blocks of the source, copies): the shard of each copy."""

    @F.arrow_udf("array<int>")
    def placed(number: pa.Array, block: pa.Array, blocks: pa.Array, last: pa.Array, copies: pa.Array) -> pa.Array:
        import numpy as np

        from wicketworks.llm.permute import permuted

        number, block, blocks, last, copies = (np.asarray(x, np.int64) for x in (number, block, blocks, last, copies))
        row = np.repeat(np.arange(len(copies)), copies)
        starts = np.cumsum(copies) - copies
        copy = np.arange(len(row)) - starts[row]
        of = number[row]
        # Only the last pass ends early; its closing document counts to the last block drawn.
        draw = copy * blocks[row] + np.where(copy == quotas[of] // blocks[row], np.minimum(block[row], last[row]), block[row])
        draw = np.minimum(draw, quotas[of] - 1)
        turn = permuted(draw, quotas[of], of * 1_000_003 + seed)
        upto = np.cumsum(cells, axis=1)
        shard = (upto[of] <= turn[:, None]).sum(1)
        offsets = np.concatenate([[0], np.cumsum(copies)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(shard, pa.int32()))

    return placed


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    shards: int = 16,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document with what the mix takes of it.

    Columns: the id, ``size`` (words), ``source_size``, ``target`` (of its source), ``copies``, ``shards``
    (the output shard of each copy) and the columns in ``keep``. A document's size is its number of
    words, 0 for a null text. Documents of a source are ordered by a keyed hash; the mix takes
    as many whole passes as the target holds, then documents from the start while they fit, then the
    one document that brings the source nearest to its target. Reruns on any cluster agree.

    A source is divided into blocks of about 64 documents (larger ones beyond 65,536 blocks), so a hot
    source is spread over many tasks and its running total is carried from block to block. Block
    quotas are split among the shards by the tree; a block's turn within its source is permuted, and
    turns are dealt to shards in runs, so each shard draws blocks of its own.

    Null sources are one source, repeated rows count each, an empty table gives an empty table. With more
    than 4,000,000 cells of sources and shards the call is refused, as quotas are kept on the driver.
    """
    import numpy as np

    spark = docs.sparkSession
    carried = {f"_keep{i}": c for i, c in enumerate(keep)}
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORDS)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("_id"),
        F.col(f"`{source}`").alias("source"),
        size.alias("size"),
        keyed_hash(seed, F.col(f"`{doc_id}`")).alias("_h"),
        *[F.col(f"`{c}`").alias(k) for k, c in carried.items()],
    )
    rows = materialize(rows, "mix-rows")
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "mix-sizes")
    n_sources = sizes.count()
    if n_sources * shards > MOST_CELLS:
        raise ValueError(f"{n_sources} sources and {shards} shards are more than {MOST_CELLS} quotas")
    blocks = F.least(F.greatest(F.ceil(F.col("n_docs") / BLOCK_DOCS), F.lit(1)), F.lit(MOST_BLOCKS))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    number = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    plan = source_targets(sizes, weights, share, most).select(
        F.col("source").alias("_source"), "source_size", "target", number.alias("_number"), blocks.cast("long").alias("_blocks"), passes.cast("long").alias("_passes")
    )
    plan = materialize(plan.withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size")), "mix-sources")

    # At most MOST_CELLS rows: small enough to send to every task.
    known = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_source")))
    block = F.shiftright(F.shiftright("_h", 30) * F.col("_blocks"), 30)
    blocked = known.withColumn("_block", block)
    before = W.partitionBy("_number").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = blocked.groupBy("_number", "_block").agg(F.sum("size").alias("_sum"))
    bases = sums.select(F.col("_number").alias("_n"), F.col("_block").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("_number", "_block").orderBy("_h", "_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = blocked.withColumn("_in", F.sum("size").over(inside))
    summed = summed.join(bases, (F.col("_number") == F.col("_n")) & (F.col("_block") == F.col("_b")))
    summed = materialize(summed.withColumn("_upto", F.col("_base") + F.col("_in")).drop("_in", "_base", "_n", "_b", "_source"), "mix-running")

    fits = F.col("_upto") <= F.col("_rest")
    ends = summed.groupBy("_number").agg(
        F.first("_rest").alias("_r"),
        F.coalesce(F.max(F.when(fits, F.col("_upto"))), F.lit(0)).alias("_taken"),
        F.max(F.when(fits & (F.col("size") > 0), F.col("_block"))).alias("_last"),
        F.first("_blocks").alias("_bl"),
        F.first("_passes").alias("_p"),
    )
    gap = F.col("_r") - F.col("_taken")
    candidates = summed.where(~fits & (F.col("size") > 0)).join(F.broadcast(ends.select(F.col("_number").alias("_n"), gap.alias("_gap"))), F.col("_number") == F.col("_n"))
    nearer = candidates.where(F.abs(F.col("size") - F.col("_gap")) < F.col("_gap"))
    closing = nearer.groupBy("_number").agg(F.min(F.struct(F.abs(F.col("size") - F.col("_gap")), F.col("_upto"))).alias("_c"))
    closing = closing.select(F.col("_number").alias("_cn"), F.col("_c._upto").alias("_closing"))
    ends = materialize(ends.join(closing, F.col("_number") == F.col("_cn"), "left"), "mix-ends")

    last = F.coalesce("_last", F.when(F.col("_closing").isNotNull(), F.lit(0)), F.lit(-1))
    per_source = ends.select("_number", (F.col("_p") * F.col("_bl") + last + 1).alias("_q")).orderBy("_number").collect()
    quotas = np.zeros(n_sources, np.int64)
    for r in per_source:
        quotas[r["_number"]] = r["_q"]
    cells = split_quotas(quotas, shards, seed)

    joined = summed.join(F.broadcast(ends.select(F.col("_number").alias("_n"), last.cast("long").alias("_last"), "_closing")), F.col("_number") == F.col("_n"))
    once_more = (fits & (F.col("_rest") > 0)) | ((F.col("size") > 0) & F.col("_upto").eqNullSafe(F.col("_closing")))
    # A document without words is taken by whole passes only.
    copies = (F.col("_passes") + F.when(once_more & (F.col("size") > 0), 1).otherwise(0)).cast("long")
    with_copies = joined.withColumn("copies", copies)
    shard = _shards_of(cells, quotas, seed)("_number", "_block", "_blocks", "_last", "copies")
    out = with_copies.withColumn("shards", shard)
    return out.select(
        F.col("_id").alias(doc_id), "size", "source_size", "target", "copies", "shards", *[F.col(k).alias(c) for k, c in carried.items()]
    )


def mixture(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mix itself: the columns of ``docs`` once for every copy, with ``_shard`` and ``_order`` in front.

    Each shard is shuffled locally: its rows are dealt over tasks and sorted by a keyed hash of row and copy.
    Null and empty texts have no words and come with whole passes only; null sources are one source; repeated rows
    count each. Extra columns may have any name; the two new ones get underscores behind theirs where ``docs`` has it.
    """
    inner = {"doc_id": "_id", "source": "_source", "text": "_text"}
    given = {inner[name]: F.col(f"`{options.pop(name, name)}`") for name in inner}
    shard, order = free_name(docs, "_shard"), free_name(docs, "_order")
    # The plan is made on narrow rows; rows alike in every column are told apart by a number.
    alike = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    narrow = docs.select(alike.alias("_alike"), *[c.alias(name) for name, c in given.items()])
    nth = F.row_number().over(W.partitionBy("_alike", "_id").orderBy("_id"))
    plan = mix(narrow, seed=seed, keep=["_alike"], **inner, **options).where("copies > 0")
    plan = plan.select(F.col("_alike").alias("_a"), F.col("_id").alias("_i"), "shards", F.row_number().over(W.partitionBy("_alike", "_id").orderBy(F.desc("copies"))).alias("_n"))
    rows = docs.select(alike.alias("_alike"), given["_id"].alias("_id"), whole_row(docs).alias("_doc")).withColumn("_nth", nth)
    matched = (F.col("_alike") == F.col("_a")) & F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_nth") == F.col("_n"))
    each = rows.join(plan, matched).select("_doc", "_id", F.posexplode("shards").alias("_copy", "_shard"))
    ordered = each.withColumn("_order", keyed_hash(seed + 1, F.col("_id"), F.col("_copy")))
    dealt = ordered.repartition("_shard", F.pmod("_order", F.lit(64))).sortWithinPartitions("_shard", "_order")
    return dealt.select(F.col("_shard").alias(shard), F.col("_order").alias(order), "_doc.*")
