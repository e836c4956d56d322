"""How far the word use of each source lies from the other sources of its language, by count-level bitmaps.

A term's probability in a group depends on nothing but its count there. So the terms of a group are kept as
one bitset per count, and the divergence of two groups is a sum over pairs of counts: the number of terms
with both counts, which AND and a bit count give, times a value made once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.session import materialize

SCALE = 1_000_000_000
# Terms of a bitset word.
WORD = 64
# Distinct terms, and characters of text, that a task counts before it hands its counts on.
COUNTED, COUNTED_CHARS = 200_000, 1 << 26
# Characters of a text that are split at a time.
SLICE_CHARS = 1 << 20

_TERMS = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+"


def _slices(text: str) -> Iterator[str]:
    """The text in parts of about ``SLICE_CHARS``, cut where no term is cut."""
    import re

    gap, at = re.compile("[\x00-\x40\x5b-\x60\x7b-\x7f]"), 0
    while len(text) - at > SLICE_CHARS:
        found = gap.search(text, at + SLICE_CHARS)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents of every term in every group.

    Every group of the table has a row with an empty term as well. Terms are maximal runs of ASCII letters and of characters
    beyond ASCII, with A-Z lower-cased; null text, lang and source are empty. Each task counts before the exchange, at most
    ``COUNTED`` distinct terms at a time, so a hot group or term costs the exchange no more than any other.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        terms, names = re.compile(_TERMS), ["lang", "source", "term", "n", "n_docs"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        seen = 0

        def flushed() -> pa.RecordBatch:
            rows: list[list] = [[] for _ in names]
            for (lang, source), (total, holding) in groups.items():
                here = ["", *total]
                for column, values in zip(rows, ([lang] * len(here), [source] * len(here), here, [0, *total.values()], [holding[t] for t in here])):
                    column.extend(values)
            groups.clear()
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3))):
                total, holding = groups.setdefault((lang.as_py() or "", source.as_py() or ""), (Counter(), Counter()))
                whole = text.as_py() or ""
                if len(whole) <= SLICE_CHARS:
                    # bytes.lower knows A-Z only.
                    found = terms.findall(whole.encode().lower().decode())
                    total.update(found)
                    holding.update(set(found))
                else:
                    once: set[str] = set()
                    for part in _slices(whole):
                        found = terms.findall(part.encode().lower().decode())
                        total.update(found)
                        once.update(found)
                    holding.update(once)
                seen += len(whole)
                if seen >= COUNTED_CHARS or len(total) >= COUNTED:
                    yield flushed()
                    seen = 0
        if groups:
            yield flushed()

    schema = "lang string, source string, term string, n long, n_docs long"
    found = docs.select("lang", "source", "text").mapInArrow(counted, schema)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)) as a long, exact for any counts; null without terms.

    In 64 bits where the product fits, else in decimals.
    """
    size = F.nullif(total + terms, F.lit(0).cast("long"))
    short = F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), size)
    wide = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), size.cast("decimal(20,0)"))
    return 1 + F.when(count < 2**63 // SCALE - 1, short).otherwise(wide)


def gain(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) as a long: at most 10^18, as probabilities are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def count_bitmaps(counts: DataFrame) -> DataFrame:
    """(lang, source, n, block, bits): bitsets of the terms (numbered from 0 in ``term_no``) with count ``n`` > 0.

    Only words with a bit are kept. Numbers run by falling count, so the many rare terms share blocks of few counts.
    """
    block = F.floor(F.col("term_no") / WORD)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("term_no") % WORD).cast("int"))
    return counts.where("n > 0").groupBy("lang", block.alias("block"), "source", "n").agg(F.bit_or(bit).alias("bits"))


def joint_cells(bitmaps: DataFrame) -> DataFrame:
    """(lang, source, other, n, m, terms): how many terms have count n > 0 in a source and m > 0 in another one after it."""
    other = bitmaps.select(
        "lang", "block", F.col("source").alias("other"), F.col("n").alias("m"), F.col("bits").alias("_bits")
    )
    both = bitmaps.join(other, ["lang", "block"]).where(F.col("source") < F.col("other"))
    common = both.withColumn("_common", F.col("bits").bitwiseAND(F.col("_bits"))).where(F.col("_common") != 0)
    return common.groupBy("lang", "source", "other", "n", "m").agg(F.sum(F.bit_count("_common").cast("long")).alias("terms"))


def source_divergence(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source of a language apart.

    Each language keeps the terms in at least ``least_docs`` of its documents. With p and q the smoothed probabilities of a term in two
    groups, f = floor((p - q)^2 / q). Part ``pair`` has f summed over the kept terms against each other source of the
    language; part ``term`` has the ``top`` terms of the source by f against the whole language, of those that it
    uses more. Ranks count from 1, by falling value, then by item.

    Null text, lang and source count as empty; groups without terms take part; repeated rows each count; an empty table
    has no rows; other columns, whatever their names, are not looked at. The result has a row for each pair of sources
    of a language, as it must; before that no step forms pairs of terms or documents.
    """
    counts = materialize(term_counts(docs), "term-counts")
    groups = counts.where("term = ''").select("lang", "source")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"))
    kept = kept.where(F.col("n_docs") >= least_docs).select("lang", "term", "lang_n")
    # Numbered in order of language and falling count, over as many tasks as there are; gaps between them do no harm.
    order = ["lang", F.col("lang_n").desc(), "term"]
    kept = materialize(kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("term_no", F.monotonically_increasing_id()), "terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    used = materialize(counts.join(kept, ["lang", "term"]), "used-terms")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), "lang_total"
    )
    sized = materialize(sized, "group-sizes")
    return _pairs(used, sized).unionByName(_terms(used, sized, top))


def _pairs(used: DataFrame, sized: DataFrame) -> DataFrame:
    """The sums over joint cells, and over the cells with a zero by what is left of each count and of all terms."""
    bitmaps = materialize(count_bitmaps(used), "bitmaps")
    cells = materialize(joint_cells(bitmaps), "cells")
    # Both directions of each pair of sources; n and total belong to the source, m and other_total to the other one.
    turned = cells.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("m").alias("n"), F.col("n").alias("m"), "terms")
    mine = sized.select("lang", "source", "total", "v")
    theirs = sized.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total"))
    pairs = mine.join(theirs, "lang").where(F.col("source") != F.col("other"))

    def p(count: str | Column) -> Column:
        return probability(F.lit(0).cast("long") if count is None else F.col(count), F.col("total"), F.col("v"))

    def q(count) -> Column:
        return probability(F.lit(0).cast("long") if count is None else F.col(count), F.col("other_total"), F.col("v"))

    def total(value: Column) -> Column:
        """Terms times value, summed exactly: in 64 bits for values that cannot exceed them over any terms, else in decimals."""
        small = F.abs(value) <= SCALE
        low = F.coalesce(F.sum(F.when(small, F.col("terms") * value)), F.lit(0)).cast("decimal(38,0)")
        high = F.sum(F.when(~small, F.col("terms").cast("decimal(19,0)") * value.cast("decimal(19,0)")))
        return low + F.coalesce(high, F.lit(0).cast("decimal(38,0)"))

    keys = ["lang", "source", "other"]
    # A joint cell takes its terms out of the cells (n, 0) and (0, m), which are filled below, and once too often out of (0, 0).
    joint = cells.unionByName(turned).join(pairs, keys).select(
        *keys, "terms", p("n").alias("p"), q("m").alias("q"), p(None).alias("p0"), q(None).alias("q0")
    )
    p1, q1, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    joint = joint.groupBy(*keys).agg(total(gain(p1, q1) - gain(p1, q0) - gain(p0, q1) + gain(p0, q0)).alias("value"))
    levels = bitmaps.groupBy("lang", "source", "n").agg(F.sum(F.bit_count("bits").cast("long")).alias("terms"))
    alone = levels.join(pairs, ["lang", "source"]).groupBy(*keys).agg(total(gain(p("n"), q(None)) - gain(p(None), q(None))).alias("value"))
    others = levels.toDF("lang", "other", "m", "terms").join(pairs, ["lang", "other"]).groupBy(*keys).agg(
        total(gain(p(None), q("m")) - gain(p(None), q(None))).alias("value")
    )
    empty = pairs.select(*keys, F.coalesce(F.col("v").cast("decimal(19,0)") * gain(p(None), q(None)).cast("decimal(19,0)"), F.lit(0)).alias("value"))
    parts = [x.select(*keys, F.col("value").cast("decimal(38,0)").alias("value")) for x in (joint, alone, others, empty)]
    summed = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).groupBy(*keys).agg(F.sum("value").cast("long").alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "other"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", rank.alias("rank"))


def _terms(used: DataFrame, sized: DataFrame, top: int) -> DataFrame:
    """The terms of each source that lie furthest above their language."""
    p = probability(F.col("n"), F.col("total"), F.col("v"))
    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    rows = used.where("n > 0").join(sized, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    valued = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gain(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return valued.withColumn("rank", rank).where(F.col("rank") <= top)
