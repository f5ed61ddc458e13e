import math
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from storelens.llm import licenses

from .conftest import clash, rows_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(doc_id, text, templates=licenses.TEMPLATES, containment=0.8):
    text = folded(text)
    words = WORD.findall(text)
    starts, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        starts += at
        base |= {label} if at else set()
    labels, score = set(base), 1.0 if starts else 0.0
    lines = [WORD.findall(line) for line in text.split("\n")]
    paragraphs = [WORD.findall(paragraph) for paragraph in re.split("\n[ \t\r]*\n", text)]
    for template, label in templates.items():
        wanted, reach = set(template.split()), math.floor(len(template.split()) / containment + 1e-9)
        passages = [own[i:i + reach] for own in paragraphs for i in range(len(own))]
        for block in lines + passages:
            held = len(wanted & set(block))
            if held >= math.ceil(containment * len(wanted) - 1e-9):
                labels.add(label)
                score = max(score, held / len(wanted))
    return (doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def expected(df, **options):
    out = [plain(r["doc_id"], r["text"], **options) for r in df.select("doc_id", "text").collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r))


@pytest.mark.parametrize("table", ["edge", "documents", "empty"])
def test_agrees_with_plain_version(request, table):
    df = request.getfixturevalue(table)
    assert rows_of(licenses.scan_licenses(df), *COLUMNS) == expected(df)


def test_near_templates_and_word_borders(spark):
    texts = ["Released, under the MITK license", "released under the mit licence", "hall rights reserved",
             "all\nrights\nreserved x cc by cc by", "this work is licensed under gnu general public\nlicense version 3",
             "permission is hereby granted free of charge to person obtaining copy of this software",
             "released released released mit mit license", "cc", "by cc", "gnu general public license version 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(licenses.scan_licenses(df), *COLUMNS) == expected(df)


@pytest.mark.parametrize("width", [20, 60, 70, 80])
def test_wrapped_statements(spark, width):
    texts = [textwrap.fill(f"some words go before it. {template} and others come behind.", width, initial_indent="# ",
                           subsequent_indent="# ") for template in licenses.TEMPLATES]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(licenses.scan_licenses(df), *COLUMNS)
    assert got == expected(df)
    assert all(label in row[6].split(",") for row, label in zip(got, licenses.TEMPLATES.values()))


def test_passages_end_at_empty_lines_and_are_short(spark):
    half, rest = "redistribution and use in source and binary forms", "with or without modification are permitted"
    filler = " ".join(["word"] * 8)
    texts = [f"{half}\n{rest}", f"{half}\n \t\n{rest}", f"{half}\r\n{rest}", f"{half}\n{filler}\n{rest}",
             "\n".join(f"{half} {rest}".split()), f"\n{filler} ".join(f"{half} {rest}".split()),
             "released\nunder\nlicense" * 3, "released under\n" * 40 + "the mit license", "\n\n", "\n" + half + "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(licenses.scan_licenses(df), *COLUMNS)
    assert got == expected(df)
    assert ["bsd" in row[6] for row in got[:6]] == [True, False, True, False, True, False]


def test_own_templates_and_thresholds(documents):
    templates = {"the of and to": "common", "in the thing that": "other"}
    for containment in (0.5, 0.75, 1.0):
        got = rows_of(licenses.scan_licenses(documents, templates, containment), *COLUMNS)
        assert got == expected(documents, templates=templates, containment=containment)
    assert rows_of(licenses.scan_licenses(documents, {}), *COLUMNS) == expected(documents, templates={})


def test_other_columns_may_clash(edge):
    assert rows_of(licenses.scan_licenses(clash(edge)), *COLUMNS) == expected(edge)


def test_only_texts_that_may_match_are_split(spark):
    """The last word of a phrase is not enough: most texts hold one somewhere."""
    stray = ["passed by the domain", "all is well, nothing reserved", "a general license", "standby mode of the public"]
    near = ["cc by", "general\npublic license", "all rights reserved", "under the mit license released"]
    df = spark.createDataFrame([(text,) for text in stray + near], "text string")
    held = [r[0] for r in df.select(licenses._may_hold(F.col("text"), ["mit"])).collect()]
    assert held == [False] * len(stray) + [True] * len(near)


@pytest.mark.parametrize("word, own", [(licenses.WORD, "az09"), (licenses.RAW_WORD, "azAZ09")])
def test_characters_of_words(spark, word, own):
    """Every ASCII character on its own, and some beyond; no range that Java would test in turn."""
    letters = [chr(c) for c in [*range(128), 0x80, 0xE9, 0x3B1, 0x1F600]]
    inside = re.compile("[" + "".join(f"{a}-{b}" for a, b in zip(own[::2], own[1::2])) + "\x80-\U0010ffff]")
    rows = spark.createDataFrame(list(enumerate(letters)), "i int, c string").select("i", F.col("c").rlike(word)).collect()
    assert dict(rows) == {i: bool(inside.match(c)) for i, c in enumerate(letters)}
    assert "-" not in word
