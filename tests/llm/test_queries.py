"""Registration, the SQL checks, and the pipeline against a plain version of its stages."""

import os
import sys
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle import compare, connect  # noqa: E402
from storelens.llm import decontamination, queries, tokenfiles, toxicity  # noqa: E402

from .test_mixing import plain_mix  # noqa: E402
from .test_overlap import expected  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, name):
    problem = compare(spark, connect(SMALL), name, SMALL)
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_row_is_returned(spark, name):
    table, key = {"op1": ("embeddings", None), "op6": ("pages", "page_id"), "op7": (None, None),
                  "op11": ("conversations", "conv_id"), "op12": (None, None)}.get(name.split("_")[0], ("documents", "doc_id"))
    rows = queries.QUERIES[name](spark, SMALL)
    if key:
        want = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key)
        want = want.distinct() if table == "conversations" else want
        assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in want.collect())
    assert rows.count() > 0


def plain_leaks(texts, items):
    """Whether each text holds an item: full edit distances, all items side by side."""
    patterns = [p for p in (decontamination.words_of(t) for _, t in items) if p]
    longest = max(map(len, patterns))
    words = np.array([p + [""] * (longest - len(p)) for p in patterns], dtype=object)
    ends, budgets = np.array([len(p) for p in patterns]), np.array([decontamination.error_budget(len(p)) for p in patterns])
    steps = np.arange(longest + 1)
    out = []
    for text in texts:
        column, found = np.broadcast_to(steps, (len(patterns), longest + 1)).copy(), False
        for word in decontamination.words_of(text):
            new = np.minimum(column + 1, np.concatenate(
                [np.zeros((len(patterns), 1), int), column[:, :-1] + (words != word)], axis=1))
            new[:, 0] = 0
            column = np.minimum.accumulate(new - steps, axis=1) + steps
            found |= bool((column[np.arange(len(patterns)), ends] <= budgets).any())
        out.append(found)
    return out


def test_pipeline_agrees_with_a_plain_version(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    lexicon = toxicity.learn(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    automaton = lexicon.automaton()
    a, b, c = lexicon.model
    rows = [tuple(r) for r in documents.collect()]
    rows = [r for r in rows if np.dot([a, b], toxicity.features(r[1], automaton)) + c < 0]
    named = {root for _, root in expected([r[:2] for r in rows])}
    rows = [r for r in rows if r[0] in named]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, leak in zip(rows, plain_leaks([r[1] for r in rows], items)) if not leak]
    size = {doc_id: size for doc_id, size, *_ in plain_mix(rows)}
    copies = {doc_id: taken // size for doc_id, size, _, _, taken in plain_mix(rows) if size}
    assert all(size.values())
    tokenizer, want, start = Tokenizer.from_file(queries.TOKENIZER), [], 0
    for doc_id, text, *_ in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokenfiles.END_ID]
        for repeat in range(copies[doc_id]):
            want.append((doc_id, repeat, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = corpus_pipeline.run(spark, SMALL).select("doc_id", "repeat", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == want


def test_stages_are_deleted_once_used(spark, monkeypatch):
    from storelens.session import work_dir

    folder = os.path.dirname(work_dir(spark, "stage")).removeprefix("file:")

    def stages():
        return {f for f in (os.listdir(folder) if os.path.isdir(folder) else []) if f.startswith("stage-")}

    first = stages()
    monkeypatch.setattr(corpus_pipeline, "STAGES", [
        (str(n), lambda spark, docs, sf_dir, n=n: docs.filter(docs["doc_id"] >= n)) for n in range(5)])
    found = corpus_pipeline.run(spark, SMALL)
    assert len(stages() - first) == 1
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found.count() == docs.filter(docs["doc_id"] >= 4).count() == docs.count() - 4


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash near-dedup", "benchmark decontamination", "mixing", "token files"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert 0 < out.count()
