"""Exact top-k search by block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.session import materialize

SCALE = 64
BLOCK_ROWS = 2048
QUERY_ROWS = 512
SUMMARY_BLOCKS = 1024
FIRST_BLOCKS = 2
PARTS = 8


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Not null, and all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of 64-bit integers; shorter vectors are filled up with 0."""
    offsets = np.asarray(lists.offsets)
    lengths = np.diff(offsets)
    values = np.asarray(lists.values)[offsets[0] : offsets[-1]].astype(np.int64)
    out = np.zeros((len(lists), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] == width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _product(queries: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where every partial sum is exact, else in integers."""
    width = max(queries.shape[1], docs.shape[1])
    queries, docs = _widened(queries, width), _widened(docs, width)
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(docs).max(initial=0)) * width
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return (queries.astype(kind) @ docs.astype(kind).T).astype(np.int64)


def _packed(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Consecutive rows (vec_id, v) of each partition as blocks of at most ``size`` rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.slice(at, size)
                matrix = _matrix(part.column("v"))
                first = part.column("vec_id")[0].as_py()
                name = f"{prefix}{first}-{len(part)}-{part.column('nth')[0].as_py()}"
                ids = np.asarray(part.column("vec_id"), np.int64).tobytes()
                top, low = (f(matrix, axis=0) for f in (np.max, np.min))
                yield pa.RecordBatch.from_pylist(
                    [{"block": name, "n": len(part), "ids": ids, "data": matrix.tobytes(), "top": top.tolist(), "low": low.tolist()}], schema=_BLOCK
                )

    return rows.mapInArrow(pack, "block string, n int, ids binary, data binary, top array<bigint>, low array<bigint>")


_BLOCK = pa.schema([("block", pa.string()), ("n", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("top", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])


def _of(row_ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row_ids, np.int64)
    return ids, np.frombuffer(data, np.int64).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, highest first, ties to the smaller id."""
    if scores.shape[1] > 4 * k:
        # Everything at least as good as the k-th, ties at the edge included, then ordered exactly.
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        widest = int((scores >= edge[:, None]).sum(1).max())
        if widest < scores.shape[1]:
            kept = np.argsort(-(scores >= edge[:, None]).astype(np.int8), axis=1, kind="stable")[:, :widest]
            scores, ids = np.take_along_axis(scores, kept, 1), np.take_along_axis(ids, kept, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


_MISSING = -(2**63 - 1)  # its negative exists


class _Best:
    """Running best k of one block of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.scores = np.full((len(ids), k), _MISSING)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(ids), _MISSING) if floor is None else floor

    def limit(self) -> np.ndarray:
        """Score of the k-th so far, or a known lower bound of it."""
        return np.maximum(self.scores[:, -1], self.floor)

    def score(self, rows: np.ndarray, doc_ids: np.ndarray, docs: np.ndarray) -> None:
        if not len(rows) or not len(doc_ids):
            return
        scores = _product(self.vectors[rows], docs)
        scores[self.ids[rows][:, None] == doc_ids[None, :]] = _MISSING
        if scores.shape[1] > 4 * self.k:
            better = scores >= np.maximum(self.limit()[rows], _MISSING + 1)[:, None]
            some = np.flatnonzero(better.any(0))
            scores, doc_ids = scores[:, some], doc_ids[some]
        ids = np.broadcast_to(doc_ids, scores.shape)
        best = _best(np.hstack([self.scores[rows], scores]), np.hstack([self.found[rows], ids]), self.k)
        self.scores[rows], self.found[rows] = best

    def rows(self) -> pa.RecordBatch:
        there = self.scores > _MISSING
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, there.sum(1))), pa.array(self.found[there]), pa.array(self.scores[there])], ["query_id", "vec_id", "score"]
        )


def _bounds(vectors: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Largest score that each query could have in each block: summed maxima of its terms."""
    return _product(np.maximum(vectors, 0), top) + _product(np.minimum(vectors, 0), low)


def _padded(lists: list[list[int]]) -> np.ndarray:
    width = max(map(len, lists), default=0)
    return np.array([[*x, *[0] * (width - len(x))] for x in lists], np.int64).reshape(len(lists), width)


def _scored(queries: DataFrame, blocks: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Best k of every query within the wanted (query block, block) pairs, per part of the blocks.

    Blocks reach a query block in falling order of their bounds; a query skips a block, and a block all
    whose bounds are below is skipped whole, once the bound is below its k-th score.
    """
    shipped = wanted.join(blocks.select(F.col("block").alias("b"), "n", "ids", "data", "top", "low"), F.col("block") == F.col("b"))
    shipped = shipped.join(queries.select(F.col("block").alias("q"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), F.col("q_block") == F.col("q"))
    dealt = shipped.repartition("q_block", "part").sortWithinPartitions("q_block", "part", F.desc("bound"))
    dealt = dealt.select("q_block", "part", "q_ids", "q_data", "floors", "ids", "data", "top", "low")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best = None, None
        for batch in batches:
            for r in range(len(batch)):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                if (row["q_block"], row["part"]) != at:
                    if best is not None:
                        yield best.rows()
                    at = (row["q_block"], row["part"])
                    best = _Best(*_of(row["q_ids"], row["q_data"]), k, np.frombuffer(row["floors"], np.int64))
                bound = _bounds(best.vectors, _padded([row["top"]]), _padded([row["low"]]))[:, 0]
                # A bound equal to the k-th score may hide a tie with a smaller id.
                best.score(np.flatnonzero(bound >= best.limit()), *_of(row["ids"], row["data"]))
        if best is not None:
            yield best.rows()

    return dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """Exact ``k`` best rows for every row whose id is divisible by ``every``: ``query_id, rank, vec_id, score``.

    Components become floor(scale * x); the score is the inner product, ties go to the smaller
    id, a query's own id is no candidate. Vectors that are null or hold null or non-finite components
    and rows with a null id take no part; vectors of unequal lengths are filled up with 0; repeated ids
    are repeated queries and candidates; an empty table gives an empty table.

    Documents are ordered by their strongest term and cut into blocks of at most 2,048 with their maxima and minima per term.
    First every query scores the two blocks with its highest bounds, which gives a floor under its
    k-th score; then only pairs of query blocks and blocks with a bound that reaches a floor are shipped.
    """
    key = F.col(f"`{vec_id}`")
    clean = vectors.where(key.isNotNull() & usable(F.col(f"`{vector}`")))
    rows = clean.select(key.cast("long").alias("vec_id"), quantised(F.col(f"`{vector}`"), scale).alias("v"))
    strength = F.transform("v", lambda x: F.abs(x))
    strongest = F.array_position(strength, F.array_max(strength))
    signed = F.coalesce(strongest * F.signum(F.element_at("v", F.greatest(strongest.cast("int"), F.lit(1)))), F.lit(0))
    cell = F.when(F.size("v") > 0, signed).otherwise(F.lit(0)).cast("int")
    ordered = rows.withColumn("_cell", cell).repartitionByRange("_cell", "vec_id").sortWithinPartitions("_cell", "vec_id")
    numbered = ordered.withColumn("nth", F.monotonically_increasing_id()).select("vec_id", "nth", "v")
    blocks = materialize(_packed(numbered, BLOCK_ROWS, "d"), "blocks")
    chosen = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    dealt = chosen.repartitionByRange("vec_id").sortWithinPartitions("vec_id").withColumn("nth", F.monotonically_increasing_id())
    queries = materialize(_packed(dealt.select("vec_id", "nth", "v"), QUERY_ROWS, "q"), "queries")

    # Summaries of 1,024 blocks travel together, so bounds of all blocks never have to fit in one place.
    groups = -(-blocks.count() // SUMMARY_BLOCKS) or 1
    summaries = blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"), F.struct("block", "top", "low").alias("s"))
    summaries = summaries.groupBy("g").agg(F.collect_list("s").alias("s"))
    facing = queries.select(F.col("block").alias("q_block"), "ids", "data", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("gq"))
    facing = facing.join(summaries, F.col("gq") == F.col("g"))

    def bounded(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                ids, data = _of(row["ids"], row["data"])
                names = [s["block"] for s in row["s"]]
                bound = _bounds(data, _padded([s["top"] for s in row["s"]]), _padded([s["low"] for s in row["s"]]))
                if first:
                    wanted = np.unique(np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS])
                    floors = np.full(len(ids), _MISSING)
                else:
                    floors = np.frombuffer(row["floors"], np.int64)
                    wanted = np.flatnonzero((bound >= floors[:, None]).any(0))
                most = bound.max(0) if len(ids) else bound
                yield pa.RecordBatch.from_pylist(
                    [{"q_block": row["q_block"], "block": names[i], "bound": int(most[i]), "floors": floors.tobytes()} for i in wanted], schema=_PAIR
                )

    kind = "q_block string, block string, bound bigint, floors binary"
    columns = ["q_block", "ids", "data", "s"]
    first = facing.select(*columns).mapInArrow(lambda b: bounded(b, True), kind).withColumn("part", F.lit(0))
    found = materialize(_scored(queries, blocks, first, k), "first-found")
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floors = found.withColumn("r", nth).where(F.col("r") == k).select("query_id", F.col("score").alias("floor"))
    known = _floors(queries, floors)
    again = facing.join(known, F.col("q_block") == F.col("kq")).select(*columns, "floors")
    pairs = again.mapInArrow(lambda b: bounded(b, False), kind).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(PARTS)).cast("int"))
    results = _scored(queries, blocks, pairs, k)
    ranked = results.withColumn("rank", nth.cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floors(queries: DataFrame, floors: DataFrame) -> DataFrame:
    """For each query block its queries' floors, in order."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                ids = np.frombuffer(batch.column("ids")[r].as_py(), np.int64)
                name = batch.column("block")[r].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids), pa.string()), pa.array(ids), pa.array(np.arange(len(ids)))], ["kq", "id", "at"])

    each = queries.select("block", "ids").mapInArrow(unpack, "kq string, id bigint, at bigint")
    joined = each.join(floors.dropDuplicates(["query_id"]), F.col("id") == F.col("query_id"), "left")
    lists = joined.groupBy("kq").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("floor", F.lit(_MISSING)).alias("floor")))).alias("f"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array([x["floor"] for x in f], np.int64).tobytes() for f in batch.column("f").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("kq"), pa.array(values, pa.binary())], ["kq", "floors"])

    return lists.mapInArrow(packed, "kq string, floors binary")


_PAIR = pa.schema([("q_block", pa.string()), ("block", pa.string()), ("bound", pa.int64()), ("floors", pa.binary())])
