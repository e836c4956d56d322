"""Near-duplicate lines by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import components, free_name, releasing, whole_row
from wicketworks.session import materialize

MAX_EDITS = 2
LEAST_CHARS = 20
# Rows of a group with one segment that a task compares at once; larger groups are compared in parts.
GROUP_LINES = 256
SEEN_LINES = 200_000
BLANKS = " \t\r\f\v"
SEED = 42


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of ``parts`` segments of nearly equal size, the longer ones last."""
    out, start = [], 0
    for left in range(parts, 0, -1):
        size = (length - start) // left
        out.append((start, size))
        start += size
    return out


def signatures(text: str, edits: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """(segment number, length of the other text, start, size, own) of all substrings to look up.

    A text is found under its own segments. Any text within ``edits`` that is at most as long keeps one
    segment unchanged, shifted by no more than the edits on either side of it allow; only those
    substrings are probed.
    """
    n = len(text)
    for shorter in range(edits + 1):
        length = n - shorter
        if length < edits + 1:
            return
        for i, (start, size) in enumerate(segments(length, edits + 1)):
            low = max(-i, shorter - (edits - i), -start)
            high = min(i, shorter + (edits - i), n - size - start)
            for shift in range(low, high + 1):
                yield i, length, start + shift, size, shorter == 0 and shift == 0


def _alike(equal, most: int) -> int:
    """Largest n up to ``most`` for which ``equal`` holds, by halving."""
    low = 0
    while low < most:
        middle = (low + most + 1) // 2
        low, most = (middle, most) if equal(middle) else (low, middle - 1)
    return low


def within_edits(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: bit-parallel over a diagonal band.

    Bit j of the vectors stands for the j-th row of the band, which moves down one row with every
    character; all cells of a column are computed at once with carries of one addition.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    most = min(len(a), len(b))
    at = _alike(lambda n: a[:n] == b[:n], most)
    end = _alike(lambda n: a[len(a) - n :] == b[len(b) - n :], most - at)
    a, b = a[at : len(a) - end], b[at : len(b) - end]
    if not a or not b:
        return max(len(a), len(b)) <= edits
    if len(a) < len(b):
        a, b = b, a
    if len(a) <= edits:
        return True
    # Bit r of the band at column j is row j - edits + r of the matrix; the band moves down with each column.
    width = 2 * edits + 1
    mask, lowest = (1 << width) - 1, 1 << (width - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + edits)
    rising, falling = mask ^ ((1 << edits) - 1), 0
    distance, last_row = edits, lowest >> 1
    for j, c in enumerate(b):
        same = places.get(c, 0) >> j & mask
        diagonal = ((((same & rising) + rising) ^ rising) | same | falling) & mask
        right = (falling | ~(diagonal | rising)) & mask
        left = diagonal & rising
        if j < len(a) - edits:  # down the band's lowest diagonal until it meets the last row
            distance += not diagonal & lowest
            if distance > 3 * edits:  # the last row gives back at most twice the edits
                return False
        else:  # then along the last row
            distance += bool(right & last_row) - bool(left & last_row)
            last_row >>= 1
        rising = (left | ~((diagonal >> 1) | right)) & mask
        falling = (diagonal >> 1) & right
    return distance <= edits


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)))


def _signature_rows(keys: list[int], texts: list[str], edits: int, out: tuple[list, list, list]) -> None:
    """Append (signature, line, own) of the texts; equal signatures are equal segments at like places."""
    from xxhash import xxh64_intdigest

    for key, text in zip(keys, texts):
        for i, length, start, size, own in signatures(text, edits):
            value = xxh64_intdigest(text[start : start + size].encode(), length * (edits + 1) + i)
            out[0].append(value - (1 << 64) if value >> 63 else value)
            out[1].append(key)
            out[2].append(own)


_ROWS = pa.schema([("sig", pa.int64()), ("line", pa.int64()), ("own", pa.bool_())])


def line_signatures(docs: DataFrame, text: str, edits: int, least_chars: int) -> DataFrame:
    """(sig, line, own) of every distinct line; a task drops lines that it has seen, so a hot line has few rows."""

    @releasing
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        seen: set[int] = set()
        for batch in batches:
            for at in range(0, len(batch), 256):
                keys, lines = [], []
                for whole in batch.column(0).slice(at, 256).to_pylist():
                    for line in (whole or "").split("\n"):
                        line = line.strip(BLANKS)
                        if len(line) < least_chars:
                            continue
                        key = xxh64_intdigest(line.encode(), SEED)
                        if key in seen:
                            continue
                        if len(seen) > SEEN_LINES:
                            seen.clear()
                        seen.add(key)
                        keys.append(key - (1 << 64) if key >> 63 else key)
                        lines.append(line)
                out: tuple[list, list, list] = ([], [], [])
                _signature_rows(keys, lines, edits, out)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.bool_())], schema=_ROWS)

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(made, "sig bigint, line bigint, own boolean")


def _contested(rows: DataFrame) -> DataFrame:
    """Rows whose signature two different lines share, at least one of them as a segment of its own."""
    same = W.partitionBy("sig")
    marked = rows.select("*", F.min("line").over(same).alias("_a"), F.max("line").over(same).alias("_b"), F.max("own").over(same).alias("_o"))
    return marked.where("_a <> _b AND _o").drop("_a", "_b", "_o").dropDuplicates(["sig", "line", "own"])


def _rectangles(rows: DataFrame, group_lines: int) -> DataFrame:
    """Rows with ``left`` and ``right``: the part of their group that a task compares.

    A group of up to ``group_lines`` rows is one part; a larger one is cut into chunks by the hash of the line, and a task
    gets the rows of two chunks. Every two rows of a group meet in exactly one part.
    """
    sizes = rows.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / group_lines).alias("chunks")).withColumnRenamed("sig", "_sig")
    cut = rows.join(sizes, F.col("sig") == F.col("_sig")).withColumn("own_chunk", F.pmod(F.xxhash64("line"), F.col("chunks")))
    each = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return each.select("*", F.least("own_chunk", "other").alias("left"), F.greatest("own_chunk", "other").alias("right")).drop("_sig", "chunks", "other")


def _compared(rows: DataFrame, edits: int) -> DataFrame:
    """Links of the parts. A part hands on a forest: two lines that are already joined need not be compared."""

    @releasing
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        texts: dict[int, tuple[str, int]] = {}
        own: set[int] = set()

        def joined(cross: bool) -> tuple[list[int], list[int]]:
            root = {k: k for k in texts}

            def find(k: int) -> int:
                while root[k] != k:
                    root[k] = k = root[root[k]]
                return k

            found: tuple[list[int], list[int]] = ([], [])
            by_length = sorted(texts, key=lambda k: (len(texts[k][0]), k))
            for i, a in enumerate(by_length):
                text, chunk = texts[a]
                for j in range(i + 1, len(by_length)):
                    b = by_length[j]
                    other, beside = texts[b]
                    if len(other) - len(text) > edits:
                        break
                    if (a in own or b in own) and (chunk != beside or not cross) and find(a) != find(b) and within_edits(text, other, edits):
                        root[find(b)] = find(a)
                        found[0].append(a), found[1].append(b)
            return found

        def batch_of(found: tuple[list[int], list[int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sig", "left", "right", "line", "own", "own_chunk", "text")]
            for sig, left, right, line, is_own, chunk, text in zip(*columns):
                if (sig, left, right) != group:
                    if group is not None:
                        yield batch_of(joined(group[1] != group[2]))
                    group, texts, own = (sig, left, right), {}, set()
                texts[line] = (text, chunk)
                if is_own:
                    own.add(line)
        if group is not None:
            yield batch_of(joined(group[1] != group[2]))

    dealt = rows.repartition("sig", "left", "right").sortWithinPartitions("sig", "left", "right")
    return dealt.select("sig", "left", "right", "line", "own", "own_chunk", "text").mapInArrow(links, "a bigint, b bigint")


def linked_lines(docs: DataFrame, text: str = "text", edits: int = MAX_EDITS, least_chars: int = LEAST_CHARS, group_lines: int = GROUP_LINES) -> DataFrame:
    """Edges (a, b) that join the 64-bit hashes of all lines within ``edits`` of each other.

    A pair within ``edits`` shares at least one of ``edits`` + 1 segments, so lines meet by the hash of a segment and are
    then verified where they meet; only verified links leave the task. A group with a very common segment is
    compared in parts of bounded size by many tasks.
    """
    contested = materialize(_contested(line_signatures(docs, text, edits, least_chars)), "line-meetings")
    wanted = contested.select(F.col("line").alias("of")).distinct()
    each = docs.select(F.explode(_lines(F.col(f"`{text}`"))).alias("text")).withColumn("line", F.xxhash64("text"))
    # Copies are combined before the exchange, so a very common line is one row of each task.
    distinct = each.groupBy("line").agg(F.min("text").alias("text"))
    texts = distinct.join(wanted, F.col("line") == F.col("of"), "left_semi").select(F.col("line").alias("of"), "text")
    shown = _rectangles(contested, group_lines).join(texts, F.col("line") == F.col("of")).drop("of")
    return _compared(shown, edits)


def repeated_lines(docs: DataFrame, edits: int = MAX_EDITS, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id", text: str = "text", group_lines: int = GROUP_LINES) -> DataFrame:
    """(id, hash of the text, array of line numbers) of the lines that repeat an earlier one, for documents that have any."""
    lines = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.posexplode(_lines(F.col(f"`{text}`"))).alias("no", "_t"))
    longer = lines.where(F.length("_t") >= least_chars)
    # Exact copies are told by 128 bits.
    seen = materialize(longer.select("id", "th", "no", F.xxhash64("_t").alias("line"), F.xxhash64("_t", F.lit("again")).alias("check")), "lines")
    # Documents without an id come last.
    place = F.struct(F.col("id").isNull().alias("u"), "id", "th", "no")
    firsts = seen.groupBy("line", "check").agg(F.min(place).alias("first"))
    roots = components(linked_lines(docs, text, edits, least_chars, group_lines), "lines")
    placed = firsts.join(roots, F.col("line") == F.col("node"), "left").withColumn("kind", F.coalesce("root", "line")).withColumn("kind2", F.when(F.col("root").isNull(), F.col("check")))
    placed = materialize(placed.select("line", "check", "first", "kind", "kind2", F.col("root").isNotNull().alias("linked")), "line-firsts")
    least = placed.where("linked").groupBy("kind").agg(F.min("first").alias("least")).withColumnRenamed("kind", "_kind")
    known = placed.join(least, F.col("linked") & (F.col("kind") == F.col("_kind")), "left")
    known = known.select(F.col("line").alias("_line"), F.col("check").alias("_check"), F.coalesce("least", "first").alias("stays"))
    judged = seen.join(known, (F.col("line") == F.col("_line")) & (F.col("check") == F.col("_check")))
    gone = judged.where(F.col("stays") != place)
    return gone.groupBy("id", "th").agg(F.collect_set("no").alias("gone"))


def dedup_lines(docs: DataFrame, edits: int = MAX_EDITS, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id", text: str = "text", group_lines: int = GROUP_LINES) -> DataFrame:
    """The documents with only the first of all lines within ``edits`` of each other, directly or by others between.

    Lines are parted by line feeds and compared without blanks at their ends; lines below ``least_chars``
    characters always stay. The first is that of the smallest document id (null last), then the earliest. Adds
    ``n_lines`` and ``n_removed`` behind the columns of ``docs``. Null texts stay null with 0 lines, an empty text is one
    line; rows alike in id and text are one document and keep the same lines; an empty table gives an empty table. Extra
    columns may have any name; the two new ones get underscores behind theirs where ``docs`` has it.
    """
    gone = repeated_lines(docs, edits, least_chars, doc_id, text, group_lines).select(F.col("id").alias("_gid"), F.col("th").alias("_gth"), F.col("gone").alias("_gone"))
    given = F.col(f"`{text}`")
    own = docs.select(F.col(f"`{doc_id}`").alias("_key"), given.alias("_text"), F.xxhash64(given).alias("_th"), whole_row(docs).alias("_doc"))
    joined = own.join(gone, F.col("_key").eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left")
    whole = F.split(F.col("_text"), "\n", -1)
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.filter(whole, lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    )
    columns = [kept.alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in docs.columns]
    return joined.select(
        *columns,
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(whole)).alias(free_name(docs, "n_lines")),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias(free_name(docs, "n_removed")),
    )
