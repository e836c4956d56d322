"""Divergence of sources against a plain reading of the definition."""

import re
from collections import Counter

from tests.llm.edge import SCHEMA, clashing, edge_documents
from wicketworks.llm import divergence
from wicketworks.llm.divergence import source_divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain_divergence(rows, top=200):
    docs = [(r.lang or "", r.source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or ""))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        holding = Counter(t for _, _, terms in here for t in set(terms))
        kept = sorted(t for t, n in holding.items() if n >= 3)
        counts = {s: Counter() for _, s, _ in here}
        for _, s, terms in here:
            counts[s].update(t for t in terms if holding[t] >= 3)
        whole = sum(counts.values(), Counter())

        def share(count, t):
            return 1 + 10**9 * (count[t] + 1) // (sum(count.values()) + len(kept))

        shares = {s: {t: share(c, t) for t in kept} for s, c in counts.items()}
        all_shares = {t: share(whole, t) for t in kept}
        for s in counts:
            pairs = [(o, sum((shares[s][t] - shares[o][t]) ** 2 // shares[o][t] for t in kept)) for o in counts if o != s]
            terms = [(t, (shares[s][t] - all_shares[t]) ** 2 // all_shares[t]) for t in kept if counts[s][t] > 0 and shares[s][t] > all_shares[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(source_divergence(docs)) == plain_divergence(docs.collect())


def test_edge_rows(spark, monkeypatch):
    docs = edge_documents(spark)
    more = [(i, t, lang, source, None) for i, (t, lang, source) in enumerate(
        [("Üben üben ÜBEN don't x1y", "de", "a"), ("üben x ý 語 語", "de", "b"), ("üben x", "de", None), (None, "de", "empty"), ("no kept terms", "xx", "a"), ("", "xx", "b"), (None, "xx", None)])]
    docs = docs.unionByName(spark.createDataFrame(more * 2, SCHEMA))
    want = plain_divergence(docs.collect())
    assert ("de", "empty", "pair") in {w[:3] for w in want}
    assert [w for w in want if w[0] == "xx" and w[2] == "pair" and w[4] != 0] == []
    assert found(source_divergence(docs)) == want
    named = clashing(docs).selectExpr("*", "1 AS term", "2 AS n", "3 AS n_docs", "'x' AS block", "4 AS bits", "5 AS other", "6 AS v", "7 AS total", "8 AS part")
    assert found(source_divergence(named)) == want
    monkeypatch.setattr(divergence, "SLICE_CHARS", 100)
    assert found(source_divergence(docs)) == want
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_of_many_levels_and_one_hot_source(spark):
    """Every count from 0 to 200 in each of three sources, joint in many ways."""
    rows = []
    for s, step in (("a", 1), ("b", 7), ("c", 50)):
        words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
        text = " ".join(w for i, w in enumerate(words) for _ in range(i * step % 201))
        rows += [(len(rows), text, "en", s, None)] * (6 if s == "a" else 1)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(source_divergence(docs)) == plain_divergence(docs.collect())


def test_probabilities_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, total, v = 10**13, 10**17 + 12345, 10**9
    row = spark.range(1).select(divergence.probability(F.lit(n), F.lit(total), F.lit(v))).first()
    assert row[0] == 1 + 10**9 * (n + 1) // (total + v)
