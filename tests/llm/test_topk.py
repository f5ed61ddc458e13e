import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storelens.llm import topk

COLUMNS = "vec_id long, embedding array<float>, label int"


def plain(rows, k=5, every=50):
    vectors = []
    for vec_id, vec, *_ in rows:
        if vec_id is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            vectors.append((vec_id, [math.floor(256 * float(x)) for x in vec]))
    out = []
    queries = {(i, tuple(v)) for i, v in vectors if i % every == 0}
    for query_id in sorted({i for i, _ in queries}):
        answers = []
        for _, query in sorted(q for q in queries if q[0] == query_id):
            found = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in vectors if i != query_id)
            answers += found[:k]
        out += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(sorted(answers), 1)]
    return out


def searched(df, k=5, every=50):
    found = topk.top_k(topk.quantized(df), F.col("vec_id") % every == 0, k)
    return sorted(tuple(r) for r in found.collect())


def test_agrees_with_brute_force_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert searched(df) == sorted(plain([(r["vec_id"], r["embedding"]) for r in df.collect()]))


@pytest.mark.parametrize("k", [1, 5, 40])
def test_edges(spark, monkeypatch, k):
    rng = random.Random(k)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)], 0) for i in range(120)]
    # Ties and one common vector, repeated rows and ids, nulls, odd numbers, other lengths.
    rows += [(200 + i, [0.5, 0.5, 0.5], 0) for i in range(60)] + [(200, [0.5, 0.5, 0.5], 0)] * 2
    rows += [(250, [1.0, 0.0, 0.0], 0), (250, [0.0, 1.0, 0.0], 0)]
    rows += [(None, [9.0, 9.0, 9.0], 0), (400, None, 0), (401, [float("nan"), 0.0, 0.0], 0),
             (402, [float("inf"), 0.0, 0.0], 0), (403, [None, 1.0, 1.0], 0), (404, [], 0), (405, [8.0], 0),
             (406, [-1e-9, 1.0, 2.0, 3.0], 0), (-50, [0.25, 0.25, 0.25], None)]
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(topk, "FIRST_VECTORS", 8)
    monkeypatch.setattr(topk, "_SENT_BYTES", 40)
    df = spark.createDataFrame(rows, COLUMNS).withColumn("packed", F.lit("x")).withColumn("cell", F.lit(None))
    assert searched(df, k, 10) == sorted(plain(rows, k, 10))


def test_a_block_may_come_in_several_batches(spark, monkeypatch):
    monkeypatch.setattr(topk, "PIVOTS", 2)
    rng = random.Random(3)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)], 0) for i in range(300)], COLUMNS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert searched(df) == sorted(plain([tuple(r) for r in df.collect()]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bounds_leave_out_annuli_but_no_answer():
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * (3.0 * np.eye(8)[rng.integers(0, 8, 1600)] + rng.normal(0, 0.02, (1600, 8))))
    index = topk.Index(vectors, float((vectors ** 2).sum(axis=1).max()), 24, 4)
    cell, distance = index.keys(vectors)
    frame = pd.DataFrame({"cell": cell, "d": distance}).groupby("cell")["d"].agg(n="count", near="min", far="max")
    cells = topk._Cells(index, frame.reset_index())
    queries = vectors[::50]
    least = cells.least(queries)
    assert cells.first(least).any(axis=1).all()
    scores = queries @ vectors.T
    fifth = -np.sort(-scores, axis=1)[:, 4]
    within = cells.within(queries, least, fifth)
    for q, v in zip(*np.nonzero(scores >= fifth[:, None])):
        assert within[q, list(cells.cell).index(cell[v])]
    assert within.mean() < 0.5


@pytest.mark.parametrize("rows", [[], [(50, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)]])
def test_nothing_to_find(spark, rows):
    assert searched(spark.createDataFrame(rows, COLUMNS)) == []


def test_large_components_stay_exact(spark):
    rows = [(i * 50, [1e6 + i, -1e6 + 3 * i, 12345.678 * i], 0) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert searched(df) == sorted(plain(rows))
