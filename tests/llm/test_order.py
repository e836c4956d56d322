"""Permutations, training-order shards, mixing and sharding."""

import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.edge import SCHEMA, clashing, edge_documents
from wicketworks.llm import training_order
from wicketworks.llm.mixing import mix, mixture, split_quotas
from wicketworks.llm.permute import permuted
from wicketworks.llm.sharding import shard_by_bytes
from wicketworks.llm.training_order import read_layout, read_records, write_training_order

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 1000, 4097])
def test_permutation_and_its_inverse(n):
    places = permuted(np.arange(n), n, 11)
    assert sorted(places) == list(range(n))
    assert (permuted(places, n, 11, inverse=True) == np.arange(n)).all()
    assert n < 17 or (places != permuted(np.arange(n), n, 12)).any()
    sizes = np.arange(1, n + 1)
    assert (permuted(np.zeros(n), sizes, 3) < sizes).all()


def test_permutation_refuses_what_lies_outside():
    with pytest.raises(ValueError):
        permuted([3], 3, 0)
    assert len(permuted([], 0, 0)) == 0


def test_round_trip_of_training_order(spark, tmp_path):
    docs = edge_documents(spark)
    for df, name in ((docs, "a"), (clashing(docs), "b")):
        path = f"file://{tmp_path}/{name}"
        written, folder = write_training_order(df, BYTES, path, sequence_tokens=16, shard_records=50, seed=3)
        rows = written.collect()
        records = [r.tolist() for r in read_records(folder)]
        assert sorted(r.slot for r in rows) == list(range(len(records))) == list(range(read_layout(folder).records))
        assert [r.tolist() for r in read_records(folder, 37, 61)] == records[37:98]
        library = Tokenizer.from_file(BYTES)
        want = Counter()
        for r in docs.collect():
            ids = [*library.encode(r.text or "").ids, 50256]
            want.update((str(r.doc_id), i, tuple(ids[at : at + 16])) for i, at in enumerate(range(0, len(ids), 16)))
        assert Counter((str(r.doc_id), r.piece, tuple(records[r.slot])) for r in rows) == want
        assert all(r.shard == r.slot // 50 and r.n_tokens == len(records[r.slot]) for r in rows)
        assert all(r.ids_crc32 == zlib.crc32(np.array(records[r.slot], "<u2").tobytes()) for r in rows)
    none, folder = write_training_order(spark.createDataFrame([], SCHEMA), BYTES, f"file://{tmp_path}/c")
    assert none.count() == 0 and list(read_records(folder)) == []


def exchanged_bytes(spark, most):
    """Bytes of exchanges that lie on disk, as soon as they are below ``most``, at the latest after 20 seconds."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    for _ in range(200):
        names = [f"{d}/{f}" for top in folders for d, _, files in os.walk(top) for f in files if f.startswith("shuffle_")]
        size = sum(os.path.getsize(f) for f in names if os.path.exists(f))
        if size < most:
            break
        time.sleep(0.1)
    return size


def test_training_order_exchanges_a_part_at_a_time(spark, monkeypatch):
    """Shards are written in rounds, and nothing of a round's exchange is left when the next begins."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    start, seen, ranges, write = exchanged_bytes(spark, 0), [], [], training_order._write_shards
    limit = start + 300_000

    def noted(rows, folder, layout):
        seen.append(exchanged_bytes(spark, limit))
        ranges.append(sorted(r.shard for r in rows.select("shard").distinct().collect()))
        return write(rows, folder, layout)

    monkeypatch.setattr(training_order, "_write_shards", noted)
    rows, folder = write_training_order(docs, BYTES, shard_records=50)
    kept = rows.collect()
    assert sum(2 * r.n_tokens for r in kept) > 1_500_000
    assert max(*seen, exchanged_bytes(spark, limit)) < limit
    assert len(ranges) == training_order.ROUNDS and [s for part in ranges for s in part] == list(range(-(-len(kept) // 50)))
    assert max(len(part) for part in ranges) - min(len(part) for part in ranges) <= 1
    assert sorted(r.slot for r in kept) == list(range(read_layout(folder).records))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_quotas_are_exact():
    quotas = [100, 1, 0, 37, 5]
    cells = split_quotas(quotas, 7, 2)
    assert cells.sum(1).tolist() == quotas
    assert cells.sum(0).max() - cells.sum(0).min() <= 1
    assert (cells == split_quotas(quotas, 7, 2)).all()


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Sharing by weight again and again until no target is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= fixed[s]


def test_mixing_on_edge_rows(spark):
    docs = edge_documents(spark)
    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
    targets = plain_targets(sizes)
    clash = docs.selectExpr("*", "1L AS length", "'y' AS size", "2 AS target", "3 AS _h", "4 AS source_size")
    for df in (docs, clash):
        got = mix(df).collect()
        assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), words(r.text)) for r in rows)
        assert all(r.copies == len(r.shards) <= 2 and all(0 <= s < 16 for s in r.shards) for r in got)
        assert sorted(got, key=str) == sorted(mix(df.repartition(5)).collect(), key=str)
        by_size = {sizes[s]: t for s, t in targets.items()}
        assert all(r.target == pytest.approx(by_size[r.source_size]) for r in got)
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixture(spark.createDataFrame([], SCHEMA)).count() == 0


def test_mixture_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mix(docs, shards=4).collect()
    rows = mixture(docs, shards=4).select("_shard", *docs.columns).collect()
    assert Counter(r.doc_id for r in rows) == Counter({r.doc_id: r.copies for r in plan if r.copies})
    assert {r.doc_id: r.text for r in rows}.items() <= {r.doc_id: r.text for r in docs.collect()}.items()
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target = Counter(), {}
    for r in plan:
        taken[source[r.doc_id]] += r.size * r.copies
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in target.items())
    shards = Counter(r._shard for r in rows)
    assert len(shards) == 4 and max(shards.values()) < 1.5 * min(shards.values())


@pytest.mark.parametrize("buckets", [None, 3])
def test_sharding_on_edge_rows(spark, buckets):
    docs = edge_documents(spark)
    rows = docs.collect()
    for df in (docs, clashing(docs)):
        got = shard_by_bytes(df, shards=4, buckets=buckets).collect()
        want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, None if r.text is None else zlib.crc32(r.text.encode())) for r in rows)
        assert sorted(((str(r.doc_id), r.size, r.text_crc32) for r in got), key=str) == sorted(want, key=str)
        for shard in {r.shard for r in got}:
            slots = sorted(r.slot for r in got if r.shard == shard)
            assert slots == list(range(len(slots)))
    assert shard_by_bytes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shards_are_near_equal_and_keep_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = shard_by_bytes(docs).collect()
    sizes, groups = Counter(), {}
    for r in got:
        sizes[r.shard] += r.size
        groups.setdefault(r.text_crc32, set()).add(r.shard)
    group_bytes = Counter()
    for r in got:
        group_bytes[r.text_crc32] += r.size
    share = sum(sizes.values()) / 16
    assert all(abs(sizes[s] - share) <= max(group_bytes.values()) + 0.002 * share for s in range(16))
    assert all(len(s) == 1 for s in groups.values())


def test_a_text_larger_than_a_shard_is_divided(spark):
    docs = spark.createDataFrame([(i, "same " * 20 if i % 3 else f"own {i}", None, None, None) for i in range(3000)], SCHEMA)
    got = shard_by_bytes(docs, shards=8).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    share = sum(sizes.values()) / 8
    assert all(abs(sizes[s] - share) <= 0.01 * share + 101 for s in range(8))
