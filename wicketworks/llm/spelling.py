"""Groups of spelling variants by an index of variable-length grams.

A gram is as short as it can be while it stays rare: a gram that more than a threshold of words hold is
extended by a letter. Of a word's grams an edit can touch only so many, so a near word must share one of
the rarest ones, and only the lists of those are merged and verified.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketworks.session import materialize

LEAST_GRAM, MOST_GRAM = 2, 6
# Gram length for words of which an edit can touch all variable grams; any word of twice this length keeps one.
SHORT_GRAM = 3
# Grams the dictionary may hold, whatever the number of words: it is broadcast.
MOST_FREQUENT = 50_000
# Words that a list may hold without being divided by a further letter.
LEAST_LIST = 100
# Letters from which on the engine's edit distance, which takes time with the square of the length, is not used.
LONG_WORD = 256
# Distinct words, and characters of text, that a task counts before it hands its counts on.
COUNTED, COUNTED_CHARS = 200_000, 1 << 26
# Characters of a text that are split at a time.
SLICE_CHARS = 1 << 20

_RUNS = "[a-zA-ZÀ-ÿ]+"


def _slices(text: str) -> Iterator[str]:
    """The text in parts of about ``SLICE_CHARS``, cut where no run of letters is cut."""
    import re

    gap, at = re.compile("[^a-zA-ZÀ-ÿ]"), 0
    while len(text) - at > SLICE_CHARS:
        found = gap.search(text, at + SLICE_CHARS)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _misspelt(run: str, prefix: int, every: int) -> str:
    """The run, or the run without one letter if ``every`` divides the crc32 of '<doc_id>:<run>'."""
    from zlib import crc32

    h = crc32(run.encode(), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(total: Counter, name: str) -> pa.RecordBatch:
    """The counts so far as a batch; the counter begins anew."""
    columns = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
    total.clear()
    return pa.RecordBatch.from_arrays(columns, [name, "n"])


def count_words(docs: DataFrame, least_letters: int = 6, least_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. In a document whose id
    (null: empty) and run have a crc32 that ``every`` divides, all occurrences of the run lose one letter.
    Texts are split a slice at a time, and a task counts at most ``COUNTED`` distinct words before it hands them on.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        from zlib import crc32

        runs, total, seen = re.compile(_RUNS), Counter(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc, whole = doc_id.as_py(), text.as_py()
                if not whole:
                    continue
                prefix = crc32(f"{'' if doc is None else doc}:".encode())
                for part in _slices(whole):
                    # bytes.lower knows A-Z only.
                    for run, n in Counter(runs.findall(part.encode().lower().decode())).items():
                        if len(run) >= least_letters:
                            word = _misspelt(run, prefix, every)
                            if len(word) >= least_letters:
                                total[word] += n
                    seen += len(part)
                    if len(total) >= COUNTED or seen >= COUNTED_CHARS:
                        yield _counts(total, "word")
                        seen = 0
        if total:
            yield _counts(total, "word")

    found = docs.select("doc_id", "text").mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def grams_of(word: str, frequent: Mapping[str, object] | frozenset[str], least: int = LEAST_GRAM, most: int = MOST_GRAM) -> list[tuple[int, str]]:
    """(position, gram) of a word: from each position the shortest gram that is not frequent, unless an earlier one covers it."""
    found, reach = [], 0
    for at in range(len(word) - least + 1):
        end = at + least
        while end - at < most and end < len(word) and word[at:end] in frequent:
            end += 1
        if end > reach:
            found.append((at, word[at:end]))
            reach = end
    return found


def affected(word: str, grams: list[tuple[int, str]], frequent, tails, most: int = MOST_GRAM) -> int:
    """The most grams of a word that one inserted, deleted or replaced letter can take away.

    Away go the grams that hold the place, and behind it those that a longer gram across the place may
    cover: it would have to begin with a frequent gram that ends in the letters from the place on, so
    these letters are in ``tails``, the proper endings of frequent grams. Grams before the place stay, but for
    the last one, if letters behind the word's end would extend it.
    """
    n = len(word)

    def reach(at: int) -> int:
        """The end of the longest tail that begins at ``at``."""
        end = at
        while end < n and word[at : end + 1] in tails:
            end += 1
        return end

    starts, worst = [p for p, _ in grams], 0
    for place in range(n + 1):
        # No gram further off holds the place or ends within a tail behind it.
        nearby = grams[bisect_left(starts, place - most) : bisect_right(starts, place + most)]
        spans = [(p, p + len(g)) for p, g in nearby]
        far = reach(place)
        # A letter inserted before ``place``.
        inserted = sum(p < place < e or (p >= place and e - 1 <= far and far > place) for p, e in spans)
        if place == n:
            inserted += sum(e == n and word[p:e] in frequent and e - p < most for p, e in spans)
        worst = max(worst, inserted)
        if place < n:  # the letter at ``place`` replaced or deleted
            far = reach(place + 1)
            worst = max(worst, sum(p <= place < e or (p > place and e - 1 <= far and far > place + 1) for p, e in spans))
    return worst


def gram_dictionary(words: DataFrame, most_frequent: int = MOST_FREQUENT, least_list: int = LEAST_LIST) -> frozenset[str]:
    """The grams, shorter than ``MOST_GRAM``, that stand in too many places to be a list of their own.

    The threshold is ``least_list`` places, or as many more as keep the dictionary within ``most_frequent`` grams:
    their lists add up to no more than all places of all words.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for size in range(LEAST_GRAM, MOST_GRAM):
                    total.update(word[at : at + size] for at in range(len(word) - size + 1))
                if len(total) >= COUNTED:
                    yield _counts(total, "gram")
        if total:
            yield _counts(total, "gram")

    sizes = words.select("word").mapInArrow(cut, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n_places"))
    total = words.agg(F.sum(F.length("word") * (MOST_GRAM - LEAST_GRAM))).first()[0] or 0
    threshold = max(least_list, -(-total // most_frequent))
    return frozenset(r.gram for r in sizes.where(F.col("n_places") > threshold).select("gram").collect())


def decomposed(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """(word_id, kind, at, gram, keep): the grams of every word, and how many of its rarest ones must be probed.

    ``keep`` is one more than an edit can take away. A word of which an edit may take all grams is decomposed
    a second time, into all grams of ``SHORT_GRAM`` letters (kind 1), of which an edit takes ``SHORT_GRAM`` at most.
    """
    known = words.sparkSession.sparkContext.broadcast(frequent)
    schema = "word_id long, kind int, at int, gram string, keep int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = known.value
        tails = frozenset(g[i:] for g in dictionary for i in range(1, len(g)))
        names, rows = ["word_id", "kind", "at", "gram", "keep"], []
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32()]
        for batch in batches:
            for word_id, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = grams_of(word, dictionary)
                lost = affected(word, grams, dictionary, tails)
                sets = [(0, lost + 1, grams)]
                if lost >= len(grams):
                    sets.append((1, SHORT_GRAM + 1, grams_of(word, frozenset(), SHORT_GRAM, SHORT_GRAM)))
                rows += [(word_id, kind, at, g, keep) for kind, keep, found in sets for at, g in found]
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return words.select("word_id", "word").mapInArrow(cut, schema)


def near_words(words: DataFrame, frequent: frozenset[str] | None = None) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of words, each once, that one inserted, deleted or replaced letter tells apart.

    ``words`` has distinct (word, n) of at least ``2 * SHORT_GRAM`` letters. Grams that an edit leaves stand at the same place in
    both words, or one further on in the longer one. So the lists are kept per gram, word length and place;
    a word is entered with its rarest grams, as many as an edit can take away and one more, and probes the lists of its own
    length and of one letter more. Whichever common gram is the rarest is among these in both words.
    Candidates are verified by their edit distance.
    """
    words = materialize(words.select(F.monotonically_increasing_id().alias("word_id"), "word", "n"), "words")
    frequent = gram_dictionary(words) if frequent is None else frequent
    grams = materialize(decomposed(words, frequent), "grams")
    sizes = grams.groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("n_places"))
    placed = F.array_sort(F.collect_list(F.struct("n_places", "gram", "at")))
    rarest = grams.join(sizes, ["kind", "gram"]).groupBy("word_id", "kind").agg(F.slice(placed, F.lit(1), F.max("keep")).alias("rarest"))
    entered = words.join(rarest, "word_id").select("word", "n", "kind", F.length("word").alias("size"), F.inline("rarest"))
    entered = materialize(entered.drop("n_places"), "lists")
    short, long = _met(entered, F.col("size") <= LONG_WORD), _met(entered, F.col("size") > LONG_WORD).distinct()
    return short.where(F.levenshtein("a", "b", 1) == 1).union(long.where(_one_edit("a", "b"))).distinct()


def _met(entered: DataFrame, chosen: Column) -> DataFrame:
    """(a, n_a, b, n_b) of words that meet in a list; ``chosen`` tells which words ``a`` probe the lists."""
    # Same length and place; or one letter longer, at the same place or one on.
    moves = F.array(*[F.struct(F.lit(s).alias("more"), F.lit(p).alias("on")) for s, p in ((0, 0), (1, 0), (1, 1))])
    probes = entered.where(chosen).select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), "kind", "gram", "size", "at", F.explode(moves).alias("m")
    )
    probes = probes.select(
        "a", "n_a", "kind", "gram", (F.col("size") + F.col("m.more")).alias("size"), (F.col("at") + F.col("m.on")).alias("at")
    )
    key = ["kind", "gram", "size", "at"]
    lists = entered.select(F.col("word").alias("b"), F.col("n").alias("n_b"), *key)
    met = probes.join(lists, key).where((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
    return met.select("a", "n_a", "b", "n_b")


def _one_edit(shorter: Column, longer: Column) -> Column:
    """Whether one edit leads from each word to the other one, which is no shorter, in time linear in their length."""

    def near(x: str, y: str) -> bool:
        low, high = 0, len(x)
        while low < high:  # the length of the common beginning
            middle = (low + high + 1) // 2
            low, high = (middle, high) if x[low:middle] == y[low:middle] else (low, middle - 1)
        return x[low + (len(x) == len(y)) :] == y[low + 1 :]

    @F.arrow_udf("boolean")
    def checked(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([near(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    return checked(shorter, longer)


def spelling_variants(docs: DataFrame, factor: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of the texts with the word it is a variant of.

    Words are those of ``count_words``; words that one letter tells apart are near. The form of a word is its near word of
    largest n (ties: the smallest), if that is at least ``factor`` times its own n; the root is where forms lead in the end.
    Null and empty texts have no words, documents without id count under an empty one, repeated rows each count, and an empty
    table has no rows. Other columns, whatever their names, are not looked at.
    """
    words = materialize(count_words(docs), "word-counts")
    pairs = materialize(near_words(words), "near-words")
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a"))
    # The least (-n, word) is the near word of largest n, ties to the smallest word.
    nearest = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("top")
    )
    chosen = (-F.col("top.less")) >= F.col("n") * factor
    formed = words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("top.form")).alias("form"), F.when(chosen, -F.col("top.less")).alias("form_n"),
    )
    formed = materialize(formed, "forms")
    return formed.join(_roots(formed.where("form IS NOT NULL").select("word", "form"), factor), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame, factor: int) -> DataFrame:
    """(word, root): where the forms of each word lead in the end.

    Counts grow by ``factor`` with each step, so 64-bit counts allow fewer steps than the doublings reach.
    """
    steps = next(k for k in range(64) if factor**k >= 2**63)

    def doubled(paths: DataFrame, _: int) -> DataFrame:
        onward = paths.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = paths.join(onward, F.col("root") == F.col("_word"), "left")
        return materialize(moved.select("word", F.coalesce("_root", "root").alias("root")), "roots")

    return reduce(doubled, range(steps.bit_length()), forms.withColumnRenamed("form", "root"))
