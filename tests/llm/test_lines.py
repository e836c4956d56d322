"""Line deduplication against all pairs with a plain edit distance."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edge import SCHEMA, clashing, edge_documents
from tests.llm.test_simhash import plain_roots
from wicketworks.llm.line_dedup import BLANKS, dedup_lines, signatures, within_edits


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=2000, deadline=None)
@given(st.text("ab", max_size=14), st.text("ab", max_size=14), st.integers(0, 4))
def test_banded_distance(a, b, edits):
    assert within_edits(a, b, edits) == (plain_distance(a, b) <= edits)


@settings(max_examples=1000, deadline=None)
@given(st.text("ab", min_size=5, max_size=12), st.lists(st.tuples(st.integers(0, 11), st.sampled_from(["a", "b", "", "ab"])), max_size=2))
def test_near_texts_share_a_signature(a, changes):
    b = a
    for at, new in changes:
        b = b[:at] + new + b[at + 1 :]
    if len(b) < 4 or plain_distance(a, b) > 2:
        return
    seen = [{(i, n, t[s : s + z]): o for i, n, s, z, o in sorted(signatures(t, 2), key=lambda x: x[4])} for t in (a, b)]
    assert any(k in seen[1] and (seen[0][k] or seen[1][k]) for k in seen[0])


def plain_dedup(rows, edits, least):
    places = {}
    for r in dict.fromkeys((r.doc_id, r.text) for r in rows):
        for no, line in enumerate((r[1] or "").split("\n")):
            if r[1] is not None and len(line.strip(BLANKS)) >= least:
                places.setdefault(line.strip(BLANKS), []).append((r[0] is None, r[0] or 0, r[1], no))
    roots = plain_roots(sorted(places), lambda a, b: abs(len(a) - len(b)) <= edits and plain_distance(a, b) <= edits)
    first = {}
    for line, found in places.items():
        first[roots[line]] = min([*found, *([first[roots[line]]] if roots[line] in first else [])])
    out = []
    for r in rows:
        if r.text is None:
            out.append((r.doc_id, None))
            continue
        kept = []
        for no, line in enumerate(r.text.split("\n")):
            own = line.strip(BLANKS)
            if len(own) < least or first[roots[own]] == (r.doc_id is None, r.doc_id or 0, r.text, no):
                kept.append(line)
        out.append((r.doc_id, "\n".join(kept)))
    return sorted(out, key=str)


def changed(line, rng):
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(line))
        line = line[:at] + rng.choice(["", "x", "yz", " "]) + line[at + rng.randrange(2) :]
    return line


@pytest.mark.parametrize("group_lines", [256, 3])
def test_lines_of_a_made_corpus(spark, group_lines):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(18, 60))) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [changed(rng.choice(base), rng) if rng.random() < 0.7 else f"line {rng.random()} of its own" for _ in range(4)]
        rows.append((i, "\n".join([*lines, "short", ""]), None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = dedup_lines(docs, group_lines=group_lines)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == plain_dedup(docs.collect(), 2, 20)


def test_edge_rows(spark):
    docs = edge_documents(spark)
    for df in (docs, clashing(docs)):
        got = dedup_lines(df)
        assert got.columns == [*df.columns, "n_lines", "n_removed"]
        rows = got.collect()
        assert len(rows) == docs.count()
        assert sorted(((r.doc_id, r.text) for r in rows), key=str) == plain_dedup(docs.collect(), 2, 20)
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
