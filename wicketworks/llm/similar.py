"""Documents with a word-shingle Jaccard similarity of at least 0.8, by an exact prefix-filter join."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketworks.llm.common import components, releasing, whole_row
from wicketworks.session import discard, materialize

WORDS = 5
# A pair is similar if FIVE times its common shingles are at least FOUR times all its shingles.
FOUR, FIVE = 4, 5
SEED = 42
# Shingles that a sample of documents repeats come last in the order of shingles; which ones changes the work, not the result.
SAMPLE_DOCS = 16
SAMPLE_REPEATS = 4
MOST_COMMON = 200_000
SEEN_SETS = 200_000
MEMO_WORDS = 200_000
# Shingles of the sets that a task keeps while it verifies pairs.
RECENT_SHINGLES = 4_000_000


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        value = xxh64_intdigest(word, SEED)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


def shingle_set(text: str | None, words: int, memo: _Words):
    """The distinct 64-bit hashes of a text's shingles in ascending order.

    A-Z are lower-cased; words are runs without U+0020 and U+0009 to U+000D; a text of fewer words is one shingle,
    a text without words has none.
    """
    import numpy as np

    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(own))
    value = np.zeros(len(own) - size + 1, np.uint64)
    for i in range(size):
        value = (value ^ own[i : i + len(value)]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
    return np.unique(value)


class _Recent:
    """The shingle sets of the nodes met last: pairs come ordered by one side, and the other sides repeat."""

    def __init__(self, words: int) -> None:
        self.words, self.memo, self.size = words, _Words(), 0
        self.sets: OrderedDict[int, object] = OrderedDict()

    def of(self, node: int, text: pa.Scalar):
        if node in self.sets:
            self.sets.move_to_end(node)
            return self.sets[node]
        made = self.sets[node] = shingle_set(text.as_py(), self.words, self.memo)
        self.size += len(made)
        while self.size > RECENT_SHINGLES and len(self.sets) > 1:
            self.size -= len(self.sets.popitem(last=False)[1])
        return made


def _set_hash(shingles) -> int:
    from xxhash import xxh64_intdigest

    value = xxh64_intdigest(shingles.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def similar(a, b) -> bool:
    """Whether two ascending sets have at least four fifths of their union in common."""
    import numpy as np

    common = len(np.intersect1d(a, b, assume_unique=True))
    return FIVE * common >= FOUR * (len(a) + len(b) - common)


def sketch(shingles) -> bytes:
    """Parities of how many shingles share their low bits, in two to four bits a shingle.

    Two sets differ in at least as many shingles as their sketches differ in bits.
    """
    import numpy as np

    size = max(64, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & np.uint64(size - 1)).view(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def possible(n: int, m: int, a: bytes, b: bytes) -> bool:
    """False only if sets of ``n`` and ``m`` shingles with these sketches cannot be similar: they differ in too many shingles."""
    if FIVE * n < FOUR * m or FIVE * m < FOUR * n:
        return False
    if len(a) < len(b):
        a, b = b, a
    size, value = 8 * len(a), int.from_bytes(a, "little")
    while size > 8 * len(b):  # the upper half falls on the lower one
        size //= 2
        value = (value >> size) ^ (value & ((1 << size) - 1))
    return (FOUR + FIVE) * (value ^ int.from_bytes(b, "little")).bit_count() <= (FIVE - FOUR) * (n + m)


def _common(texts: DataFrame, words: int) -> tuple[list[int], list[int]]:
    """The most frequent shingles of a sample of the documents, and how often each is there."""

    @releasing
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), words, memo).view("i8"))], ["sig"])

    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_DOCS)) == 0).select("text").distinct()
    counts = sample.mapInArrow(made, "sig bigint").groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_REPEATS)
    found = sorted((r["sig"], r["n"]) for r in counts.orderBy(F.desc("n"), "sig").limit(MOST_COMMON).collect())
    return [s for s, _ in found], [n for _, n in found]


def described(texts: DataFrame, words: int) -> Column:
    """Struct of a text's ``node`` (64-bit hash of its shingle set; texts without words share one), ``n`` (shingles), ``sketch``, ``first``.

    ``first`` holds the first shingles of the set in one order of all shingles, rare ones first; it is empty where the task has
    met the set before. Similar sets of n and m shingles share at least four fifths of the larger number, so the first
    n // 5 + 1 of the one and m // 5 + 1 of the other have a shingle in common.
    """
    import numpy as np

    common, often = (np.array(x, np.int64) for x in _common(texts, words))

    @F.arrow_udf("struct<node:bigint,n:int,sketch:binary,first:array<bigint>>")
    @releasing
    def made(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo, seen = _Words(), set()
        for part in parts:
            nodes, sizes, sketches, firsts = [], [], [], []
            for text in part:
                own = shingle_set(text.as_py(), words, memo)
                node, n, signed = _set_hash(own), len(own), own.view("i8")
                nodes.append(node)
                sizes.append(n)
                sketches.append(sketch(own))
                if not n or node in seen:
                    firsts.append(signed[:0])
                    continue
                if len(seen) > SEEN_SETS:
                    seen.clear()
                seen.add(node)
                rank = np.zeros(n, np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, signed), len(common) - 1)
                    rank = np.where(common[at] == signed, often[at], 0)
                firsts.append(signed[np.lexsort((own, rank))[: n // FIVE + 1]])
            offsets = np.cumsum([0, *map(len, firsts)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *firsts])))
            yield pa.StructArray.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), lists], ["node", "n", "sketch", "first"])

    return made(F.col("text"))


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar: sketches rule out most others, texts decide."""
    few = nodes.select("node", "n", "sketch")
    left = few.select(F.col("node").alias("_a"), F.col("n").alias("n"), F.col("sketch").alias("left"))
    right = few.select(F.col("node").alias("_b"), F.col("n").alias("m"), F.col("sketch").alias("right"))
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).select("a", "b", "n", "m", "left", "right")

    @releasing
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(map(possible, *(batch.column(c).to_pylist() for c in ("n", "m", "left", "right"))))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    pairs = materialize(both.mapInArrow(sketched, "a bigint, b bigint"), "similar-pairs")
    wanted = pairs.select(F.col("a").alias("of")).union(pairs.select(F.col("b").alias("of"))).distinct()
    wanted = nodes.join(wanted, F.col("node") == F.col("of"), "left_semi").select("node", F.col("th").alias("_th"))
    wanted = materialize(wanted, "similar-wanted")
    hashed = texts.withColumn("th", F.xxhash64("text"))
    shown = hashed.join(wanted, F.col("th") == F.col("_th")).groupBy("node").agg(F.min("text").alias("text"))
    shown = materialize(shown, "similar-texts")
    left = shown.select(F.col("node").alias("_a"), F.col("text").alias("left"))
    right = shown.select(F.col("node").alias("_b"), F.col("text").alias("right"))
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).select("a", "b", "left", "right")

    @releasing
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = _Recent(words)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [similar(recent.of(i, x), recent.of(j, y)) for i, j, x, y in zip(a, b, batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(found, pa.bool_()))

    links = materialize(both.mapInArrow(checked, "a bigint, b bigint"), "similar-links")
    discard(pairs, wanted, shown)
    return links


def linked_sets(texts: DataFrame, nodes: DataFrame, rows: DataFrame, words: int = WORDS) -> DataFrame:
    """Edges (a, b) that join the nodes of all similar sets of ``texts`` (text), directly or by others.

    ``nodes`` has ``n``, ``sketch`` and the hash ``th`` of one text of each ``node``; all texts of a node have one set.
    ``rows`` has the first shingles of each set (sig, node, n, place).

    First each set is verified against one set of each of its groups of a common shingle, so a large group of near
    copies is joined by as many pairs as it has sets. Then all other pairs of a group are verified, unless they
    are joined already, their sizes are too far apart, or too few shingles lie behind the common one.
    """
    groups = rows.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    shared = rows.join(groups.withColumnRenamed("sig", "_sig"), F.col("sig") == F.col("_sig")).drop("_sig", "high").distinct()
    shared = materialize(shared, "similar-groups")
    first = _verified(shared.where("low < node").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), texts, nodes, words)
    roots = components(first, "similar").withColumnRenamed("node", "_node")
    known = shared.join(roots, F.col("node") == F.col("_node"), "left").select("sig", "node", "n", "place", F.coalesce("root", "node").alias("root"))
    apart = known.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    known = materialize(known.join(apart.select(F.col("sig").alias("_sig")), F.col("sig") == F.col("_sig"), "left_semi"), "similar-apart")
    discard(shared)
    x, y = known.alias("x"), known.alias("y")
    size = (FIVE * F.col("x.n") >= FOUR * F.col("y.n")) & (FIVE * F.col("y.n") >= FOUR * F.col("x.n"))
    behind = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    enough = (FOUR + FIVE) * behind >= FOUR * (F.col("x.n") + F.col("y.n"))
    other = (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    pairs = x.join(y, (F.col("x.sig") == F.col("y.sig")) & other & size & enough)
    rest = _verified(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), texts, nodes, words)
    return first.union(rest)


def drop_similar(
    docs: DataFrame, words: int = WORDS, doc_id: str = "doc_id", text: str = "text", links: DataFrame | None = None
) -> DataFrame:
    """One row of each group of documents that similarity joins, directly or by others between.

    It is the row of the smallest id, null last, then the smallest hash of the text and of the whole row. Texts without words are
    one group; rows alike in every column are one. Extra columns may have any name and are kept as they are.
    ``links`` (a, b) joins the texts of these ``xxhash64`` as well, whatever their similarity.
    """
    key = F.col(f"`{doc_id}`")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    kept = docs.select(key.alias("_id"), whole.alias("_row"), F.col(f"`{text}`").alias("text"))
    described_rows = kept.select("_id", F.xxhash64("text").alias("_th"), "_row", described(texts, words).alias("_s"))
    stored = materialize(described_rows, "similar-rows")
    rows = stored.select("_id", "_th", "_row", F.col("_s.node").alias("_set"))
    firsts = stored.select(F.col("_s.node").alias("node"), F.col("_s.n").alias("n"), F.posexplode("_s.first").alias("place", "sig"))
    one = stored.groupBy(F.col("_s.node").alias("node")).agg(F.min("_th").alias("th"), F.first("_s.n").alias("n"), F.first("_s.sketch").alias("sketch"))
    nodes = materialize(one, "similar-nodes")
    edges = linked_sets(texts, nodes.where("n > 0"), firsts.select("sig", "node", "n", "place"), words)
    if links is not None:
        of = rows.select("_th", "_set").distinct()
        ends = links.join(of.toDF("_x", "_a"), F.col("a") == F.col("_x")).join(of.toDF("_y", "_b"), F.col("b") == F.col("_y"))
        edges = edges.union(ends.select("_a", "_b").distinct())
    roots = components(edges, "similar-all")
    place = F.struct(F.col("_id").isNull().alias("u"), "_id", "_th", "_row", "_n")
    least = rows.groupBy("_set", "_id", "_th", "_row").agg(F.count(F.lit(1)).alias("_n")).groupBy("_set").agg(F.min(place).alias("least"))
    placed = least.join(roots, F.col("_set") == F.col("node"), "left").withColumn("root", F.coalesce("root", "_set"))
    chosen = placed.groupBy("root").agg(F.min("least").alias("least")).select("least._id", "least._row", "least._n")
    # Few rows are there more than once as a whole; only they need to meet, all others stay where they are.
    chosen = materialize(chosen, "similar-chosen")
    once, more = (materialize(chosen.where(x).select("_id", "_row"), "similar-kept") for x in ("_n = 1", "_n > 1"))
    discard(stored, nodes, chosen)
    own = docs.select(key.alias("_key"), whole.alias("_own"), whole_row(docs).alias("_doc"))
    wanted = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_row"))
    repeated = own.join(more, wanted, "left_semi").dropDuplicates(["_own", "_key"])
    return own.join(once, wanted, "left_semi").union(repeated).select("_doc.*")
