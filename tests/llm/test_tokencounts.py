"""Counts against the library, of whole texts and of every prefix."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from storelens.llm import tokencounts
from tests.llm.conftest import EDGE_ROWS, clash, rows_of

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
PARTS = ["a", "b", "th", "ing", "e", " ", " ", "  ", "▁", "\n", "\x00", "é", "日", "𝔸", "0", "'", "==", "<s>", "<0x0A>", " "]


def random_texts(count, longest):
    draw = random.Random(7)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def counter():
    return tokencounts.PrefixCounter(PATH)


def test_totals_agree_with_the_library(counter):
    texts = random_texts(3_000, 40) + ["", " ", " " * 50, "x" * 3_000, "ab" * 400 + " end"]
    texts += [" " * k + w for k in range(40) for w in ("", "a", "\n", "t")]
    got = counter.totals(pa.array(texts, pa.large_string()))
    assert list(got) == [len(ids) for ids in LIBRARY.encode(texts)]


def test_every_prefix_agrees_with_the_library(counter):
    for text in [*random_texts(300, 25), "a" * 300]:
        got = list(tokencounts._counts(counter.steps(text)))
        assert got == [len(LIBRARY.encode(text[:i])) for i in range(len(text) + 1)]


def test_words_are_forgotten_without_harm(counter, monkeypatch):
    monkeypatch.setattr(tokencounts, "KEPT_WORDS", 3)
    texts = random_texts(200, 20)
    for _ in range(2):
        assert list(counter.totals(pa.array(texts, pa.large_string()))) == [len(ids) for ids in LIBRARY.encode(texts)]


def test_edge_rows(edge):
    want = sorted(((r[0], len((r[1] or "").encode()), len(LIBRARY.encode(r[1] or ""))) for r in EDGE_ROWS),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    for table in (edge, clash(edge)):
        got = tokencounts.token_counts(table, PATH, limit=10)
        assert rows_of(got) == [(*r, r[2] > 10) for r in want]


def test_empty_table(empty):
    assert tokencounts.token_counts(empty, PATH).count() == 0
    assert tokencounts.prefix_table(empty, PATH).count() == 0


def test_given_documents(documents):
    got = tokencounts.token_counts(documents, PATH).select("doc_id", "n_tokens").collect()
    texts = {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(LIBRARY.encode(t)) for k, t in texts.items()}


def test_budget_questions_without_encoding(spark):
    texts = random_texts(60, 30)
    table = tokencounts.prefix_table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH)
    asked = table.select("doc_id", *[tokencounts.tokens_at(F.col("steps"), F.lit(n)).alias(f"t{n}") for n in (0, 5, 1000)],
                         *[tokencounts.chars_within(F.col("steps"), F.lit(n)).alias(f"c{n}") for n in (0, 4, 1000)])
    for row in asked.collect():
        text = texts[row.doc_id]
        counts = [len(LIBRARY.encode(text[:i])) for i in range(len(text) + 1)]
        assert [row.t0, row.t5, row.t1000] == [0, counts[min(5, len(text))], counts[-1]]
        assert [row.c0, row.c4, row.c1000] == [max(i for i, c in enumerate(counts) if c <= n) for n in (0, 4, 1000)]
