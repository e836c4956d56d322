"""Spelling variants against a plain reading of the definition."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edge import SCHEMA, edge_documents
from wicketworks.llm import spelling
from wicketworks.llm.spelling import affected, grams_of, near_words, spelling_variants


def edits(word, letters):
    """(kind, place, result) of every single edit."""
    for i in range(len(word) + 1):
        for c in letters:
            yield "insert", i, word[:i] + c + word[i:]
        if i < len(word):
            yield "delete", i, word[:i] + word[i + 1 :]
            for c in letters:
                if c != word[i]:
                    yield "replace", i, word[:i] + c + word[i + 1 :]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=11), min_size=1, max_size=20), st.integers(1, 6), st.integers(0, 10**6))
def test_no_edit_takes_more_grams_than_the_bound(corpus, threshold, pick):
    n_words = Counter(g for w in corpus for g in {w[i : i + k] for k in range(2, 6) for i in range(len(w) - k + 1)})
    frequent = frozenset(g for g, n in n_words.items() if n > threshold)
    tails = frozenset(g[i:] for g in frequent for i in range(1, len(g)))
    word = corpus[pick % len(corpus)]
    grams = grams_of(word, frequent)
    assert all(word[p : p + len(g)] == g for p, g in grams) and grams[-1][0] + len(grams[-1][1]) == len(word)
    bound = affected(word, grams, frequent, tails)
    for kind, at, other in edits(word, "abc"):
        theirs, shift = set(grams_of(other, frequent)), {"insert": 1, "delete": -1, "replace": 0}[kind]
        stay = sum((p + len(g) <= at and (p, g) in theirs) or (p >= at + (kind != "insert") and (p + shift, g) in theirs) for p, g in grams)
        assert len(grams) - stay <= bound


def plain_words(rows):
    total = Counter()
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def plain_near(words):
    """All pairs at one edit, by the words that the removal of a letter leaves."""
    shapes = {}
    for w in words:
        for i in range(len(w)):
            shapes.setdefault(w[:i] + "*" + w[i + 1 :], set()).add(w)
            shapes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        shapes.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for group in shapes.values():
        for a in group:
            for b in group:
                if a != b and one_edit(a, b):
                    near[a].add(b)
    return near


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return (len(a) == len(b) and a[i + 1 :] == b[i + 1 :]) or (len(b) == len(a) + 1 and a[i:] == b[i + 1 :])


def plain_variants(rows):
    words = plain_words(rows)
    near = plain_near(words)
    form = {}
    for w in words:
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert found(spelling_variants(docs)) == want
    assert sum(w[1] is not None for w in want) > 10


def test_chains_of_forms_and_ties(spark):
    texts = {"abcdef": 3200, "abcdeg": 640, "abcdhg": 128, "abcihg": 25, "jbcihg": 5, "zzzzzz": 25, "zzzzzy": 25, "zzzzzéz": 5, "Àbcdef": 4}
    rows = [(None, " ".join([w] * n), None, None, None) for w, n in texts.items()]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = plain_variants([(None, r[1]) for r in rows])
    assert found(spelling_variants(docs)) == want
    roots = {w[0]: w[2] for w in want}
    assert roots["jbcihg"] == "abcdef" and roots["zzzzzz"] == "zzzzzz"


@pytest.mark.parametrize("least_list", [1, 5, 10**6])
def test_words_of_few_letters_in_any_dictionary(spark, least_list):
    """Every mix of variable and fixed grams finds every pair."""
    rnd = random.Random(least_list)
    words = {"".join(rnd.choice("ab" if rnd.random() < 0.7 else "abcé") for _ in range(rnd.randint(6, 10))) for _ in range(700)}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    frequent = spelling.gram_dictionary(df, least_list=least_list)
    assert bool(frequent) == (least_list < 100)
    got = {frozenset((r.a, r.b)) for r in near_words(df, frequent).collect()}
    assert got == {frozenset((a, b)) for a, bs in plain_near(words).items() for b in bs}


def test_edge_rows_and_slices(spark, monkeypatch):
    docs = edge_documents(spark)
    extra = spark.createDataFrame([(77, ("Straßen straßen ×÷aaaa " * 4000), None, None, None), (78, "z" * 3000 + " " + "z" * 3001, None, None, None)] * 5, SCHEMA)
    huge = spark.createDataFrame([(79, "y" * 3_000_000 + " yes", None, None, None)] * 4, SCHEMA)
    docs = docs.unionByName(extra).unionByName(huge)
    want = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert found(spelling_variants(docs)) == want
    named = docs.selectExpr("*", "1 AS word", "2 AS n", "'x' AS gram", "3 AS kind", "4 AS root", "5 AS form", "6 AS size", "7 AS at")
    assert found(spelling_variants(named)) == want
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_of_very_many_letters(spark):
    long = "".join(random.Random(9).choice("abcdé") for _ in range(20_000))
    words = [long, long[:10_000] + "x" + long[10_000:], long[:-1] + "z", long + "zz", "y" * 15_000, "y" * 15_001]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {frozenset((words.index(r.a), words.index(r.b))) for r in near_words(df).collect()}
    assert got == {frozenset(p) for p in ((0, 1), (0, 2), (4, 5))}


def test_slices_cut_no_word(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE_CHARS", 10)
    text = "abcdefghijklmnopq rst, uv " * 9
    parts = list(spelling._slices(text))
    assert "".join(parts) == text and len(parts) > 5
    assert [w for p in parts for w in re.findall("[a-z]+", p)] == re.findall("[a-z]+", text)


def test_the_dictionary_is_bounded(spark):
    df = spark.createDataFrame([(f"{a}{b}{c}word{c}{b}", 5) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"], "word string, n long")
    assert len(spelling.gram_dictionary(df, most_frequent=20, least_list=1)) <= 20
