"""The conditional random field against enumeration, and accuracy on held-out documents."""

from itertools import product
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.edge import SCHEMA, clashing, edge_documents
from wicketworks.llm import language
from wicketworks.llm.language import CrfModel, fit, forward_backward, held_out, identify_languages, keep_identified, label_documents, language_spans


def plain_posteriors(scores, first, transitions, start):
    out = np.zeros_like(scores)
    ends = [*np.flatnonzero(first), len(scores)]
    for i, j in zip(ends, ends[1:]):
        for path in product(range(scores.shape[1]), repeat=j - i):
            weight = start[path[0]] + sum(scores[i + t, k] for t, k in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
            out[range(i, j), path] += np.exp(weight)
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("chain", [2, 3, 64])
def test_forward_backward_sums_over_all_paths(monkeypatch, chain):
    monkeypatch.setattr(language, "CHAIN", chain)
    rng = np.random.default_rng(chain)
    scores, transitions, start = rng.normal(size=(13, 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.isin(np.arange(13), [0, 1, 6, 12])
    assert np.allclose(forward_backward(scores, first, transitions, start), plain_posteriors(scores, first, transitions, start))


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_code_switched_text_is_cut_at_the_switch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stretches = language.training_stretches(docs, "lang", F.col("doc_id"))
    model = fit(stretches)
    en, fr = (next(w for lang, w in reversed(stretches) if lang == x and len(w) == 32) for x in ("en", "fr"))
    text = " ".join([*en, "12", "--", *fr])
    spans = spark.createDataFrame([(text,)], "text string").select(language_spans(F.col("text"), model).alias("s")).first()["s"]
    assert [s["lang"] for s in spans] == ["en", "fr"]
    assert abs(spans[1]["first"] - 34) <= 2 and spans[1]["last"] == 65


def test_edge_rows(spark):
    docs = edge_documents(spark)
    for df in (docs, clashing(docs)):
        got = identify_languages(df).collect()
        assert len(got) == docs.count()
        unknown = [r.lang_pred for r in got if r.n_words == 0]
        assert set(unknown) == {"und"} and len(unknown) == 4
        kept = keep_identified(df)
        assert kept.columns == df.columns and kept.count() == len(got) - 4
    assert identify_languages(spark.createDataFrame([], SCHEMA)).count() == 0
    unlabelled = identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_labels_of_held_out_documents_are_never_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoilt = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert sorted(identify_languages(docs).collect()) == sorted(identify_languages(spoilt).collect())


def test_memo_changes_nothing(spark, monkeypatch):
    model = CrfModel(["a", "b"], {}, np.random.default_rng(0).normal(size=(language.BUCKETS, 2)), np.eye(2), np.zeros(2))
    tagger = language._Tagger(model)
    texts = ["one two three", "two 3 four " + "z" * 90, None, "one"] * 2
    want = tagger.posteriors(texts)[0]
    monkeypatch.setattr(language, "MEMO_WORDS", 1)
    assert np.allclose(np.vstack([tagger.posteriors([t])[0] for t in texts if t]), want)
    assert spark.createDataFrame([(t,) for t in texts], "text string").select(label_documents(F.col("text"), model)).count() == 8


def test_documents_stay_when_there_are_no_labels(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(["some words", "語", "12 34", "", None])], SCHEMA)
    assert sorted(r.doc_id for r in keep_identified(docs).collect()) == [0, 1]


def test_texts_in_all_languages_at_once_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IS NOT NULL")
    by_lang = {}
    for r in docs.where("n_chars > 300").orderBy("doc_id").collect():
        by_lang.setdefault(r.lang, r.text.split()[:40])
    assert len(by_lang) >= 3
    mixed = " ".join(w for words in by_lang.values() for w in words)
    both = docs.unionByName(spark.createDataFrame([(10**9, mixed, None, None, None)], docs.schema))
    label = {r.doc_id: r for r in identify_languages(both).collect()}[10**9]
    assert label.score < 0.34
    assert both.schema == docs.schema and 10**9 in {r.doc_id for r in keep_identified(both).collect()}


def test_features_are_hashes_of_their_names(monkeypatch):
    """The same buckets whether parts of words were met before or not, and when no more of them are kept; no name is hashed twice."""
    words = ["a", "ab", "abc", "abcd", "abcde", "straße", "слово", "語", "a" * 300, "𝔞𝔟𝔠"]

    def plain(word):
        names = [f"p{word[:n]}" for n in range(1, min(4, len(word)) + 1)] + [f"s{word[-n:]}" for n in range(1, min(4, len(word)) + 1)]
        names += [f"<{word}>"[i : i + n] for n in (2, 3) for i in range(len(word) + 3 - n)]
        return [crc32(x.encode()) % language.BUCKETS for x in names] + ([language.BUCKETS + 7] if word == "abc" else [])

    for _ in range(2):
        assert [language.word_features(w, {"abc": 7}) for w in words] == list(map(plain, words))
    hashed = []
    monkeypatch.setattr(language, "crc32", lambda x: hashed.append(x) or crc32(x))
    assert [language.word_features(w, {"abc": 7}) for w in words] == list(map(plain, words)) and not hashed
    monkeypatch.setattr(language, "MEMO_PARTS", 0)
    assert [language.word_features(w, {}) for w in ("neverseen", "neverseen")] == [plain("neverseen")] * 2


def test_words_are_scored_without_hashing_their_parts(monkeypatch):
    """Scores are the sums over ``word_features``; words of letters met before cost no hash at all."""
    words = ["a", "ab", "abc", "abcd", "abcde", "straße", "слово", "語", "語彙", "a" * 300, "𝔞𝔟𝔠𝔡𝔢", "i̇", "bade"] * 3
    rng = np.random.default_rng(1)
    model = CrfModel(["a", "b", "c"], {"abc": 1, "語": 0}, rng.normal(size=(language.BUCKETS + 2, 3)), np.eye(3), np.zeros(3))
    want = [sum(model.emission[i] for i in language.word_features(w, model.lexicon)) for w in words]
    monkeypatch.setattr(language, "WORDS_AT_ONCE", 5)
    characters = language._Characters()
    assert np.allclose(model.word_scores(words, characters), want)
    hashed = []
    monkeypatch.setattr(language, "crc32", lambda x: hashed.append(x) or crc32(x))
    assert model.word_scores(["eda", "teß", "волос", "彙語彙"], characters).shape == (4, 3) and not hashed


def test_blocks_change_no_posterior_of_long_chains(monkeypatch):
    rng = np.random.default_rng(7)
    scores, transitions, start = rng.normal(size=(5003, 3)) * 4, rng.normal(size=(3, 3)), rng.normal(size=3)
    first = rng.random(5003) < 0.002
    first[0] = True
    found = []
    for chain in (2, 64, 5003):
        monkeypatch.setattr(language, "CHAIN", chain)
        found.append(forward_backward(scores, first, transitions, start))
    assert np.allclose(found[0], found[2]) and np.allclose(found[1], found[2])


def test_workers_keep_nothing_of_words(spark):
    """After a task its worker holds no parts of words: nothing stays beside what later stages need."""
    model = CrfModel(["a", "b"], {}, np.random.default_rng(0).normal(size=(language.BUCKETS, 2)), np.eye(2), np.zeros(2))

    @F.arrow_udf("long")
    def held(text: pa.Array) -> pa.Array:
        from wicketworks.llm import language as own

        return pa.array([len(own._HEADS) + len(own._TAILS) + len(own._GRAMS)] * len(text), pa.int64())

    docs = spark.createDataFrame([(f"words{i} of some texts",) for i in range(64)], "text string").repartition(1)
    before = docs.select(held("text").alias("n")).agg(F.max("n")).first()[0]
    assert docs.select(label_documents(F.col("text"), model).alias("l")).where("l.n_words = 4").count() == 64
    assert docs.select(held("text").alias("n")).agg(F.max("n")).first()[0] == before == 0
