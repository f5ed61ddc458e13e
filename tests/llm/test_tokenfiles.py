import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storelens.llm import queries, tokenfiles

from .conftest import clash


def plain(df):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    out, start = [], 0
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, tokenfiles.END_ID]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("table", ["edge", "documents", "empty"])
def test_agrees_with_plain_version(request, table):
    df = request.getfixturevalue(table)
    got = [tuple(r) for r in tokenfiles.token_digest(df, queries.TOKENIZER).orderBy("start")
           .select("doc_id", "n_tokens", "ids_crc32", "start", "repeat").collect()]
    order = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted([r[:3] for r in got], key=order) == sorted(plain(df), key=order)
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert [r[3] for r in got] == [sum(r[1] for r in got[:i]) for i in range(len(got))]
    assert len({(r[0], r[4]) for r in got}) == len(got)


def test_repeats_are_numbered_across_shards(spark):
    rows = [(d, f"text {i}") for i in range(300) for d in ([5] if i % 3 else [5, 6, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = tokenfiles.token_digest(clash(df), queries.TOKENIZER)
    for doc_id, count in ((5, 300), (6, 100), (None, 100)):
        repeats = [r["repeat"] for r in got.filter(F.col("doc_id").eqNullSafe(F.lit(doc_id))).orderBy("start").collect()]
        assert repeats == list(range(count))


def test_keys_of_others_are_not_found(spark, documents, tmp_path):
    folder = f"file://{tmp_path}"
    manifest = tokenfiles.write_files(documents, queries.TOKENIZER, folder)
    index = tokenfiles.write_index(manifest, folder, 3)
    asked = spark.createDataFrame([(1, 0), (2, 0), (1, 1), (10**9, 0), (None, 0)], "doc_id long, repeat long")
    found = tokenfiles.look_up(asked, index, 3).collect()
    assert sorted((r["doc_id"], r["repeat"]) for r in found) == [(1, 0), (2, 0)]
    files, root = pafs.FileSystem.from_uri(f"{folder}/ids")
    names = [f.path for f in files.get_file_info(pafs.FileSelector(root))]
    assert all(name.endswith(".bin") for name in names)
    assert sum(files.get_file_info(n).size for n in names) == 2 * manifest.agg(F.sum("n_tokens")).first()[0]


def test_displacements_are_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for count in (1, 2, 7, 100, 3000):
        deal, keys = rng.integers(0, 2**63, (2, count)).astype(np.uint64)
        slots = tokenfiles.slots_of(deal, keys, tokenfiles.displacements(deal, keys)) % np.uint64(count)
        assert sorted(slots.tolist()) == list(range(count))


def test_word_encoding_equals_whole_texts(documents, monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_PARTS", 20)
    texts = [r["text"] or "" for r in documents.limit(60).collect()]
    texts += ["a\x1cb \x1f c", "x\u0085y z　w", "e ́ é", "<|endoftext|>x <|startoftext|>", "ΣΣ İI",
              "it's IT'S Don't_a a_b x1 1x ½x ²", "ÀÉß!!! ß, œŒ x'll' 'd", "a" * 300, "´ ` é́"]
    encoder, plain_one = tokenfiles.WordEncoder(queries.TOKENIZER), Tokenizer.from_file(queries.TOKENIZER)
    for some in (texts[:30], texts[30:]):
        for text, data in zip(some, encoder.encode(some)):
            assert data.tolist() == plain_one.encode(text, add_special_tokens=False).ids


def test_addresses_of_stores_as_arrow_has_them():
    assert tokenfiles.arrow_address("s3a://bucket/folder/ids") == "s3://bucket/folder/ids"
    assert tokenfiles.arrow_address("abfs://c@account/x") == "abfss://c@account/x"
    for same in ("file:///tmp/x", "hdfs://host:1/x", "gs://b/x"):
        assert tokenfiles.arrow_address(same) == same
    tokenfiles.pafs.FileSystem.from_uri(tokenfiles.arrow_address("file:///tmp"))
