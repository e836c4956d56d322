"""Extra columns named like those that the stages use inside come out with their own names and values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.edge import edge_documents

# Names taken from the code of the operators.
NAMES = [
    "_gid", "_gth", "_gone", "_th", "_key", "_text", "_doc", "_id", "_row", "_own", "_set", "_a", "_i", "_n", "_copy", "_shard",
    "_order", "shards", "_alike", "_nth", "_sure", "_source", "copies", "size", "target", "node", "root", "least", "id", "th", "gone",
    "n_lines", "n_removed", "piece", "length", "rank", "_number", "_block", "_h", "name.dotted",
]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_with_clashing_columns(spark, name, stage):
    plain = edge_documents(spark)
    docs = plain.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])
    got = stage(spark, docs, "/nowhere")
    want = stage(spark, plain, "/nowhere")
    if name == "packing":
        assert got.columns == want.columns
        assert got.count() == want.count()
        return
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(tuple(r)[len(plain.columns) :] == tuple(f"own {n}" for n in NAMES) for r in rows)
    # Of rows alike in id and text, the hash of the whole row decides which one stays.
    assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str((r.doc_id, r.text)) for r in want.collect())
