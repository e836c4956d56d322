"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import sqrt
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import components
from wicketworks.llm.topk import usable
from wicketworks.session import materialize, scratch_path

LEADING = 8
BLOCK_ROWS = 4096
# Intervals that a task compares with one that it holds, and the most tasks that pairs are dealt over.
RUN = 4
TASKS = 4096
STRIP_ROWS = 512
FAN_OUT = 8
_LOCAL = (1 << 33) - 1


def _units(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of length 1; shorter vectors are filled up with 0."""
    offsets = np.asarray(lists.offsets)
    lengths = np.diff(offsets)
    out = np.zeros((len(lists), width))
    out[np.arange(width) < lengths[:, None]] = np.asarray(lists.values)[offsets[0] : offsets[-1]]
    if len(out):
        out /= np.abs(out).max(1, keepdims=True)
        out /= np.linalg.norm(out, axis=1, keepdims=True)
    return out


def principal_axes(vectors: DataFrame, width: int, leading: int = LEADING) -> np.ndarray:
    """The ``leading`` orthonormal directions of greatest variance of the unit vectors in column ``v``.

    Every task adds up its products and hands on one row per cell of the matrix; the driver sees width x width sums.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            unit = np.pad(_units(batch.column("v"), width), ((0, 0), (0, 1)), constant_values=1)
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "value"])

    sums = vectors.select("v").mapInArrow(products, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    table = np.zeros((width + 1) ** 2)
    for r in sums.collect():
        table[r["cell"]] = r["value"]
    table = table.reshape(width + 1, width + 1)
    n = max(table[-1, -1], 1)
    mean = table[-1, :-1] / n
    _, axes = np.linalg.eigh(table[:-1, :-1] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1][:, :leading])


def _cell_order(vector: Column, axes: np.ndarray, epsilon: float) -> Column:
    """Grid cells of side ``epsilon`` on the leading axes, first axis first, as one number."""

    @F.arrow_udf("long")
    def cells(lists: pa.Array) -> pa.Array:
        spots = np.floor(_units(lists, axes.shape[0]) @ axes / epsilon).astype(np.int64)
        side = int(np.ceil(1 / epsilon)) + 1
        number = np.zeros(len(spots), np.int64)
        for d in range(spots.shape[1]):
            number = number * (2 * side) + spots[:, d] + side
        return pa.array(number)

    return cells(vector)


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write_interval(folder: str, node: int, classes: np.ndarray, sizes: np.ndarray, unit: np.ndarray) -> str:
    """A file of the shared folder with an interval; its name is new, so an attempt that is repeated disturbs no other."""
    system, root = _file_system(folder)
    name = f"{node}-{uuid4().hex}"
    with system.open_output_stream(f"{root}/{name}") as out:
        for part in (classes, sizes, unit):
            out.write(part.tobytes())
    return name


def _read_interval(folder: str, name: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes, their sizes and unit vectors."""
    system, root = _file_system(folder)
    with system.open_input_file(f"{root}/{name}") as source:
        data = source.read_buffer(source.size())
    n = len(data) // (16 + 8 * width)
    classes, sizes = np.frombuffer(data, np.int64, 2 * n).reshape(2, n)
    return classes, sizes, np.frombuffer(data, np.float64, n * width, 16 * n).reshape(n, width)


def _intervals(ordered: DataFrame, axes: np.ndarray, rows: int, folder: str) -> DataFrame:
    """Consecutive vectors as one row per interval: its box on the axes, and its file below ``folder``."""
    placed = ordered.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)))
    placed = materialize(placed, "grid-order")
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # one row per task that wrote
    bases = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select(F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = placed.join(bases, F.col("_p") == F.col("_q")).withColumn("node", F.floor((F.col("_base") + F.col("_i")) / rows))
    leading = axes.shape[1]
    schema = pa.schema(
        [("node", pa.int64()), *[(f"{s}{d}", pa.float64()) for d in range(leading) for s in ("lo", "hi")], ("file", pa.string())]
    )

    def gathered(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_p", "ascending"), ("_i", "ascending")]).combine_chunks()
        unit = _units(group.column("v").combine_chunks() if group.column("v").num_chunks != 1 else group.column("v").chunk(0), axes.shape[0])
        spots = unit @ axes
        classes, sizes = (np.asarray(group.column(c), np.int64) for c in ("class", "n"))
        node = group.column("node")[0].as_py()
        row = {"node": node, "file": _write_interval(folder, node, classes, sizes, unit)}
        row |= {f"{s}{d}": float(f(spots[:, d])) for d in range(leading) for s, f in (("lo", np.min), ("hi", np.max))}
        return pa.Table.from_pylist([row], schema=schema)

    kinds = "node bigint, " + ", ".join(f"{s}{d} double" for d in range(leading) for s in ("lo", "hi")) + ", file string"
    return numbered.select("node", "_p", "_i", "class", "n", "v").groupBy("node").applyInArrow(gathered, kinds)


def _near_boxes(leading: int, epsilon: float) -> Column:
    gaps = [F.greatest(F.lit(0.0), F.col(f"b_lo{d}") - F.col(f"a_hi{d}"), F.col(f"a_lo{d}") - F.col(f"b_hi{d}")) for d in range(leading)]
    return reduce(lambda x, y: x + y, [g * g for g in gaps]) <= epsilon * epsilon * (1 + 1e-9)


def near_intervals(blocks: DataFrame, leading: int, epsilon: float) -> DataFrame:
    """Pairs (a, b), a <= b, of intervals whose boxes are within ``epsilon``.

    The sequence is joined with itself from the top: a pair of long intervals is replaced by the pairs of their
    eighths, unless their boxes are provably apart.
    """
    sides = [(f"{s}{d}", f) for d in range(leading) for s, f in (("lo", F.min), ("hi", F.max))]
    top = blocks.agg(F.max("node")).first()[0] or 0
    depth = 0
    while top >> (3 * depth):
        depth += 1
    pairs = blocks.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in range(depth - 1, -1, -1):
        node = F.floor(F.col("node") / (FAN_OUT**level))
        boxes = blocks.groupBy(node.alias("node")).agg(*[f(c).alias(c) for c, f in sides])
        of = [boxes.select(F.floor(F.col("node") / FAN_OUT).alias(f"{x}_up"), F.col("node").alias(f"{x}_node"), *[F.col(c).alias(f"{x}_{c}") for c, _ in sides]) for x in "ab"]
        joined = pairs.join(of[0], F.col("a") == F.col("a_up")).join(of[1], F.col("b") == F.col("b_up"))
        near = joined.where((F.col("a_node") <= F.col("b_node")) & _near_boxes(leading, epsilon))
        pairs = materialize(near.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "grid-pairs")
    return pairs


def _strips(spots: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    return [(i, min(i + STRIP_ROWS, len(spots)), spots[i : i + STRIP_ROWS].min(0), spots[i : i + STRIP_ROWS].max(0)) for i in range(0, len(spots), STRIP_ROWS)]


def _joined_blocks(left, right, same: bool, axes: np.ndarray, epsilon: float, threshold: float):
    """Links of two intervals: for each class how many vectors it links with, and edges that join what is linked."""
    (ids_a, n_a, unit_a), (ids_b, n_b, unit_b) = left, right
    links_a, links_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    edges = []
    strips_b = _strips(unit_b @ axes)
    for i0, i1, lo_a, hi_a in _strips(unit_a @ axes):
        for j0, j1, lo_b, hi_b in strips_b:
            if same and j1 <= i0:
                continue
            gap = np.maximum(0, np.maximum(lo_b - hi_a, lo_a - hi_b))
            if gap @ gap > epsilon * epsilon * (1 + 1e-9):
                continue
            linked = unit_a[i0:i1] @ unit_b[j0:j1].T >= threshold
            if same and i0 == j0:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            links_a[i0:i1] += linked @ n_b[j0:j1]
            if not (same and i0 == j0):
                links_b[j0:j1] += n_a[i0:i1] @ linked
            rows, cols = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
            part = linked[np.ix_(rows, cols)]
            least_a, least_b = ids_a[i0:i1][rows], ids_b[j0:j1][cols]
            high = np.iinfo(np.int64).max
            while True:  # the smallest class spreads over each component of this rectangle
                new_b = np.minimum(least_b, np.where(part, least_a[:, None], high).min(0))
                new_a = np.minimum(least_a, np.where(part, new_b[None, :], high).min(1))
                if (new_a == least_a).all() and (new_b == least_b).all():
                    break
                least_a, least_b = new_a, new_b
            edges += [np.stack([ids_a[i0:i1][rows], least_a]), np.stack([ids_b[j0:j1][cols], least_b])]
    if same:
        links_a, links_b = links_a + links_b, np.zeros_like(links_b)
    found = np.unique(np.hstack(edges), axis=1) if edges else np.zeros((2, 0), np.int64)
    return links_a, links_b, found[:, found[0] != found[1]]


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    leading: int = LEADING,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (smallest id reachable) and ``kept`` (its own id).

    Vectors link if their cosine, in double precision, is at least ``threshold``: a distance of at most sqrt(2 - 2
    threshold) between unit vectors. Null and zero vectors and those with null or non-finite components link
    with nothing. Shorter vectors are filled up with 0. Rows with a null id link but lend their
    component no id; repeated rows link with each other; an empty table gives an empty table.

    Equal vectors are one class with a size, so copies meet only in an aggregation. Classes are ordered by
    grid cells on the leading principal axes and cut into intervals; intervals are joined recursively, boxes that
    are provably apart are skipped, and each remaining pair of intervals is one product of matrices. Intervals lie
    in files of the shared folder, written once; a pair crosses an exchange as two numbers and two names, and
    its task reads the files, two at a time. A pair hands on counts per class and the edges of a forest, never all its links.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    epsilon = sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    leads = F.col(f"`{vector}`")
    valid = usable(leads) & F.exists(leads, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{vec_id}`").alias("_id"), F.when(valid, leads).alias("v"))
    grouped = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = materialize(grouped.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    axes = principal_axes(classes, width, leading)
    leading = axes.shape[1]
    ordered = classes.withColumn("_cell", _cell_order(F.col("v"), axes, epsilon)).repartitionByRange("_cell", "class").sortWithinPartitions("_cell", "class")
    folder = scratch_path(vectors.sparkSession, "grid-intervals")
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    blocks = materialize(_intervals(ordered, axes, block_rows, folder), "grid-blocks")
    pairs = near_intervals(blocks.drop("file"), leading, epsilon)
    sides = [blocks.select(F.col("node").alias(f"{x}_node"), F.col("file").alias(x)) for x in ("left", "right")]
    named = pairs.join(sides[0], F.col("a") == F.col("left_node")).join(sides[1], F.col("b") == F.col("right_node"))
    # As many tasks as there are runs: rows as small as these would else be gathered into a few tasks.
    tasks = max(1, min(TASKS, -(-pairs.count() // RUN)))
    dealt = named.repartition(tasks, "a", F.floor(F.col("b") / RUN)).sortWithinPartitions("a", "b").select("a", "b", "left", "right")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = None, None
        for batch in batches:
            for a, b, file_a, file_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "left", "right"))):
                if a != held:
                    held, left = a, _read_interval(folder, file_a, width)
                right = left if a == b else _read_interval(folder, file_b, width)
                links_a, links_b, edges = _joined_blocks(left, right, a == b, axes, epsilon, threshold)
                some_a, some_b = links_a > 0, links_b > 0
                ids = np.concatenate([left[0][some_a], right[0][some_b], edges[0]])
                links = np.concatenate([links_a[some_a], links_b[some_b], np.zeros(edges.shape[1], np.int64)])
                others = np.concatenate([np.full(int(some_a.sum() + some_b.sum()), -1), edges[1]])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(others)], ["class", "links", "other"])

    found = materialize(dealt.mapInArrow(joined, "class bigint, links bigint, other bigint"), "grid-links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.where("other >= 0").select(F.col("class").alias("a"), F.col("other").alias("b")), "grid")
    known = classes.join(links.withColumnRenamed("class", "lc"), F.col("class") == F.col("lc"), "left").join(roots, F.col("class") == F.col("node"), "left")
    known = known.select("v", "least", F.coalesce("root", "class").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    done = known.join(least, F.col("root") == F.col("_root")).select(F.col("v").alias("_v"), "n_links", "component_id")
    out = rows.join(done, F.col("v") == F.col("_v"), "left")
    # A vector that links with nothing is its own component; so is a class without any id.
    component = F.when(F.col("_v").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("_id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
