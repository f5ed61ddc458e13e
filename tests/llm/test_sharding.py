import hashlib
import zlib

import numpy as np
import pytest

from storelens.llm import mixing, sharding
from storelens.llm.common import whole_text

from .conftest import clash


def shards_of(df, shards=40):
    return [tuple(r) for r in sharding.shard_documents(df, mixing.word_count(whole_text()), shards)
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()]


@pytest.mark.parametrize("table", ["edge", "documents", "empty"])
def test_every_document_has_a_place(request, table):
    df = request.getfixturevalue(table)
    got = shards_of(df)
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
            for r in df.select("doc_id", "text").collect()]
    order = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted([r[:3] for r in got], key=order) == sorted(want, key=order)
    slots = {}
    for r in got:
        assert r[3] == "bytes" and 0 <= r[4] < 40 and r[6] is None
        slots.setdefault(r[4], []).append(r[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_near_equal_with_a_large_group(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "copy of one text " * 20) for i in range(3000)]
    rows += [(3000 + i, "x" * int(rng.integers(1, 900)) + str(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = shards_of(df, 8)
    sums = [sum(r[1] for r in got if r[4] == s) for s in range(8)]
    assert max(sums) - min(sums) < 0.02 * max(sums)
    counts = [sum(1 for r in got if r[4] == s) for s in range(8)]
    assert max(counts) < 1.5 * min(counts)


def test_bytes_are_near_equal_with_a_repeated_row(spark):
    """One row 4,000 times, id and text alike."""
    rng = np.random.default_rng(2)
    rows = [(7, "the same row again " * 20)] * 4000
    rows += [(i, "y" * int(rng.integers(1, 900)) + str(i)) for i in range(4000)]
    got = shards_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8)
    sums = [sum(r[1] for r in got if r[4] == s) for s in range(8)]
    assert max(sums) - min(sums) < 0.02 * max(sums)
    for s in range(8):
        slots = sorted(r[5] for r in got if r[4] == s)
        assert slots == list(range(len(slots)))


def test_small_groups_stay_together(spark, documents):
    got = shards_of(documents.unionByName(documents.withColumn("doc_id", documents["doc_id"] + 10**6)), 4)
    text = {r["doc_id"]: hashlib.md5((r["text"] or "").encode()).hexdigest() for r in documents.collect()}
    places = {}
    for r in got:
        places.setdefault(text[r[0] % 10**6], set()).add(r[4])
    assert np.mean([len(p) == 1 for p in places.values()]) > 0.3


def test_packing_takes_the_highest_dot_product():
    parcels = np.array([[10, 1, 1], [9, 1, 1], [8, 1, 1], [7, 1, 1], [6, 1, 1], [5, 1, 1]])
    placed = sharding.pack(parcels, 3)
    sums = [parcels[placed == s][:, 0].sum() for s in range(3)]
    assert sums == [15, 15, 15]
    assert len(sharding.pack(np.zeros((0, 3), dtype=np.int64), 3)) == 0


def test_other_columns_may_clash(edge):
    assert sorted(map(str, shards_of(clash(edge)))) == sorted(map(str, shards_of(edge)))
