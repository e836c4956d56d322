"""The near-duplicate stage against all pairs with an exact five-word similarity."""

import random
import re
import weakref
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.edge import SCHEMA, clashing, edge_documents
from tests.llm.test_simhash import plain_fingerprint, plain_roots
from wicketworks.llm import common, similar
from wicketworks.llm.similar import drop_similar


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4))) if tokens else frozenset()


def plain_survivors(rows):
    """The set of the texts of each group, and the smallest id there, null last."""
    sets = [plain_set(r.text) for r in rows]
    numbers = {s: i for i, s in reversed(list(enumerate(sets)))}
    by_number = {i: s for s, i in numbers.items()}
    holders = {}
    for i, s in by_number.items():
        for x in s:
            holders.setdefault(x, set()).add(i)

    def alike(a, b):
        a, b = by_number[a], by_number[b]
        return 5 * len(a & b) >= 4 * len(a | b)

    near = {i: {j for x in s for j in holders[x]} for i, s in by_number.items()}
    roots = plain_roots(sorted(by_number), lambda a, b: b in near[a] and alike(a, b))
    groups = {}
    for r, s in zip(rows, sets):
        groups.setdefault(roots[numbers[s]], []).append(r)
    return [(min((r.doc_id is None, r.doc_id or 0) for r in g), {r.text for r in g}) for g in groups.values()]


def check(docs, got):
    want = plain_survivors(docs)
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in got) == Counter(w[0] for w in want)
    for r in got:
        assert any(w[0] == (r.doc_id is None, r.doc_id or 0) and r.text in w[1] for w in want)
    return len(docs) - len(want)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("sample,repeats", [(16, 4), (1, 2)])
def test_made_near_copies(spark, monkeypatch, sample, repeats):
    """Near copies of few and many words, a large group of them, and a passage that all documents have."""
    monkeypatch.setattr(similar, "SAMPLE_DOCS", sample)
    monkeypatch.setattr(similar, "SAMPLE_REPEATS", repeats)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for size in (4, 5, 6, 20, 60, 150, 400):
        for _ in range(6):
            base = [f"v{rng.randrange(3000)}" for _ in range(size)] + (passage if size > 20 else [])
            texts += [edited(base, rng, n) for n in (0, 1, 1, 2, size // 40, size // 25)]
    hot = [f"h{i}" for i in range(90)]
    texts += [edited(hot, rng, rng.randrange(3)) for _ in range(80)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    assert check(docs.collect(), drop_similar(docs).collect()) > 150


def test_stage_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars < 6000")
    got = corpus_pipeline.near_duplicates(spark, docs, "/nowhere")
    assert got.columns == docs.columns
    assert check(docs.collect(), got.collect()) > 0


def test_edge_rows(spark):
    docs = edge_documents(spark)
    for df in (docs, clashing(docs)):
        got = drop_similar(df)
        assert got.columns == df.columns
        check(docs.collect(), got.collect())
    assert drop_similar(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_and_null_ids(spark):
    """A repeated id loses no text that is unlike the others; copies without ids go, and the choice is the same in any order of rows."""
    a, b, c = ("".join(f"{x}{i} " for i in range(30)) for x in "abc")
    rows = [(1, a, "en", None, None), (1, b, "en", None, None), (2, a, "de", None, None), (None, c, "x", None, None), (None, c + "one", "y", None, None)]
    rows += [(None, b, None, None, None), (1, b, "en", None, None), (1, b, "fr", None, None), (None, c, "x", None, None)]
    got = [sorted(map(tuple, drop_similar(spark.createDataFrame(r, SCHEMA).repartition(3)).collect()), key=str) for r in (rows, rows[::-1])]
    assert got[0] == got[1]
    assert [(r[0], r[1].split()[0]) for r in got[0]] in ([(1, "a0"), (1, "b0"), (None, "c0")],)


def test_stage_takes_both_steps(spark):
    """What fingerprints link goes though its words are unlike, what only similar words join goes too, and chains of both hold together."""
    spam = " ".join(["spam"] * 30)
    words = [f"w{i}" for i in range(120)]
    like = " ".join([*words[:60], "other", *words[61:]])
    texts = [f"{spam} a b", f"{spam} c d", " ".join(words), like, "quite another text of a few words", None, " \n"]
    prints = [plain_fingerprint(t) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= 2 < (prints[2] ^ prints[3]).bit_count()
    a, b = plain_set(texts[0]), plain_set(texts[1])
    assert 5 * len(a & b) < 4 * len(a | b)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "/nowhere").collect()) == [0, 2, 4, 5]
    assert sorted(r.doc_id for r in drop_similar(docs).collect()) == [0, 1, 2, 4, 5]
    # 2 ~ 3 by similarity, 3 ~ 4 by a given link: one group.
    chain = docs.where("doc_id in (3, 4)").selectExpr("min(xxhash64(text)) a", "max(xxhash64(text)) b")
    assert sorted(r.doc_id for r in drop_similar(docs, links=chain).collect()) == [0, 1, 2, 5]


def test_sketches_rule_out_no_similar_sets():
    rng = random.Random(5)
    ruled_out = 0
    for _ in range(3000):
        n = rng.choice((1, 2, 5, 9, 40, 63, 64, 65, 130, 500))
        own = {rng.getrandbits(64) for _ in range(n)}
        other = set(rng.sample(sorted(own), n - rng.randrange(n // rng.choice((2, 5, 9)) + 1)))
        other |= {rng.getrandbits(64) for _ in range(rng.randrange(n // rng.choice((2, 5, 9)) + 2))}
        if not other:
            continue
        a, b = (np.array(sorted(x), np.uint64) for x in (own, other))
        alike = similar.similar(a, b)
        told = similar.possible(len(a), len(b), similar.sketch(a), similar.sketch(b))
        assert told or not alike
        ruled_out += not told
    assert ruled_out > 500


def test_workers_give_memory_back_behind_the_last_batch(monkeypatch):
    """Only when all that a function remembered is gone."""
    freed, held = [], []

    class Memo(dict):
        pass

    @common.releasing
    def made(batches):
        memo = Memo()
        held.append(weakref.ref(memo))
        for batch in batches:
            yield memo.setdefault(batch, batch)

    monkeypatch.setattr(common, "release_memory", lambda: freed.append(held[0]() is None))
    assert list(made(iter([1, 2]))) == [1, 2] and freed == [True]
