"""SimHash groups against a plain reading of the definition."""

import re

import xxhash

from tests.llm.edge import SCHEMA, clashing, edge_documents
from wicketworks.llm.common import components
from wicketworks.llm.simhash import near_duplicates

MASK = (1 << 64) - 1


def plain_fingerprint(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def plain_groups(rows):
    prints = {(r.doc_id, r.text): plain_fingerprint(r.text) for r in rows}
    roots = plain_roots(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, _), p in prints.items():
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    return sorted(((r.doc_id, prints[r.doc_id, r.text], least.get(roots[prints[r.doc_id, r.text]])) for r in rows), key=str)


def test_edge_rows(spark):
    docs = edge_documents(spark)
    for df in (docs, clashing(docs)):
        got = near_duplicates(df)
        assert got.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted(((r[0], r[1] & MASK, r[2]) for r in got.collect()), key=str) == plain_groups(docs.collect())
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = near_duplicates(docs).collect()
    assert sorted(((r[0], r[1] & MASK, r[2]) for r in got), key=str) == plain_groups(docs.collect())


def test_components_of_paths_stars_and_cliques(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 340)]
    pairs += [(a, b) for a in range(500, 508) for b in range(500, 508)] + [(9, 9), (339, 160)]
    nodes = sorted({n for p in pairs if p[0] != p[1] for n in p})
    edges = {frozenset(p) for p in pairs}
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == plain_roots(nodes, lambda a, b: frozenset((a, b)) in edges)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
