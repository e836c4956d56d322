"""The pipeline, stage by stage on each stage's own input, and its registration."""

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_lines import plain_dedup
from tests.llm.test_order import plain_targets, words
from tests.llm.test_simhash import plain_groups
from tests.llm.test_tokens import check_packing
from tests.llm.edge import edge_documents
from wicketworks.session import materialize


@pytest.fixture(scope="module", params=["given", "edge"])
def outputs(spark, request):
    """Input and output of each stage; the given documents are cut down to a fixture for the plain versions."""
    if request.param == "edge":
        docs = edge_documents(spark)
    else:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 1500")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, "/nowhere"), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def test_columns(outputs):
    for before, after in outputs[:-1]:
        assert after.columns == before.columns
    assert outputs[-1][1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_only_documents_without_letters_go(outputs):
    before, after = outputs[0]
    want = [r for r in before.collect() if any(c.isalpha() for c in r.text or "")]
    assert Counter(after.collect()) == Counter(want)


def test_lines(outputs):
    before, after = outputs[1]
    want = plain_dedup(before.collect(), 2, 20)
    lost = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    got = Counter((r.doc_id, r.text) for r in after.collect())
    assert got == Counter(x for x in want if x[1].strip() or x[0] not in lost)
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in after.collect() if r.text is not None)


def test_one_of_each_group(outputs):
    before, after = outputs[2]
    rows = before.collect()
    want = {g[2] for g in plain_groups([r for r in rows if r.doc_id is not None])}
    assert sorted(r.doc_id for r in after.collect() if r.doc_id is not None) == sorted(want)


def test_mix(outputs):
    before, after = outputs[3]
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r.source] += words(r.text)
    for r in after.collect():
        taken[r.source] += words(r.text)
    largest = max(words(r.text) for r in before.collect())
    assert all(abs(taken[s] - t) <= largest / 2 for s, t in plain_targets(sizes).items())
    assert set(after.collect()) <= set(before.collect())


def test_packing(outputs):
    before, after = outputs[4]
    check_packing(before.collect(), after.collect(), 2048)


def test_registered(spark):
    queries = __spark_entry__.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in queries) == 1
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
