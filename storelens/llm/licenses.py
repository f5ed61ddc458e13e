"""License scan: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text



def _run_without(*ranges: tuple[int, int]) -> str:
    """A regular expression for a run of other characters. They are named one by one: Java looks these up in a
    table, but tests ranges in turn, which takes 20 times as long."""
    return "[^" + "".join(f"\\x{c:02X}" for first, last in ranges for c in range(first, last + 1)) + "]+"


# A word of a text after A-Z has become a-z, and the same before.
WORD = _run_without((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
RAW_WORD = _run_without((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What lies between two paragraphs.
BLANK_LINE = "\n[ \t\r]*\n"

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License statements and their labels. The words of a template count as a set.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under cc by nc": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "redistribution and use in source and binary forms with or without modification are permitted":
        "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software":
        "mit-text",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is dedicated to the public domain": "public-domain",
}
CONTAINMENT = 0.8


class Template(NamedTuple):
    """A statement's label, words, least overlap with a block, and the most words of a passage."""

    label: str
    words: list[str]
    least: int
    reach: int


def template_sets(templates: dict[str, str], containment: float) -> list[Template]:
    """The templates as sets. A passage is at most ``1 / containment`` times as long as the statement."""
    split = [(label, text.split()) for text, label in templates.items()]
    return [Template(label, sorted(set(words)), math.ceil(containment * len(set(words)) - 1e-9),
                     math.floor(len(words) / containment + 1e-9)) for label, words in split]


def token_counts(documents: DataFrame, tokens: list[str]) -> dict[str, int]:
    """How often each of ``tokens`` stands in the corpus: counted over all texts in one pass, a row
    per token comes back."""
    words = documents.select(F.explode(F.regexp_extract_all(F.lower(whole_text()), F.lit(WORD), 0)).alias("word"))
    found = words.filter(F.col("word").isin(tokens)).groupBy("word").count().collect()
    counts = {row["word"]: row["count"] for row in found}
    return {token: counts.get(token, 0) for token in tokens}


def _starts(words: Column, phrase: str) -> Column:
    """Places in the array ``words`` at which the words of ``phrase`` stand."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.size(words) - len(parts))
    follow = F.filter(places, lambda i: reduce(
        lambda a, b: a & b, [F.get(words, i + k) == part for k, part in enumerate(parts)]))
    return F.when(F.size(words) >= len(parts), follow).otherwise(F.array().cast("array<int>"))


def _labels(*sets: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*sets))), ",")


def scan_licenses(documents: DataFrame, templates: dict[str, str] | None = None,
                  containment: float = CONTAINMENT) -> DataFrame:
    """Per document ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    A-Z count as a-z, null texts as empty. The ``n_base`` places of the phrases give ``first_word``
    and ``last_word`` (the smallest and largest start, words from 0; else null) and ``base_labels``.
    A block matches a template when it holds at least ``containment`` of the template's words as a
    set; ``labels`` adds the labels of these templates. Blocks are the lines, and the passages that
    run over line ends: consecutive words of a paragraph (up to an empty line), at most
    ``1 / containment`` times as many as the template has, so that wrapped statements are found and
    words strewn over a page are not. ``score`` is 1 where a phrase stands, else the largest
    containment of a matched template, else 0. Repeated rows and ids give a row each; an empty table
    gives none; other columns are ignored.

    The join: template words are ordered by their count in the corpus, the rarest first. A block with
    overlap ``o`` or more holds one of the first ``len - o + 1`` words of the template, and the
    template one of the first ``len - o + 1`` words of the line (prefix filter); a block has ``o``
    words of the vocabulary (length filter); and the words left behind a common word suffice for
    the rest (positional filter). Blocks are reduced to the vocabulary of the templates (bounded by
    the parameter), since other words never match. Passages are looked for around each word of a
    template's prefix only.
    """
    sets = template_sets(TEMPLATES if templates is None else templates, containment)
    vocabulary = sorted({word for template in sets for word in template.words})
    counts = token_counts(documents, vocabulary) if vocabulary else {}
    rank = {word: i for i, word in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}
    ordered = [t._replace(words=sorted(t.words, key=rank.get)) for t in sets]
    prefixes = sorted({word for t in ordered for word in t.words[: len(t.words) - t.least + 1]})

    text = whole_text()
    folded = F.lower(text)
    hopeful = _may_hold(folded, prefixes)
    exact = F.when(hopeful, F.translate(text, UPPER, LOWER)).otherwise(F.lit(""))
    words = F.col("_words")
    starts = {phrase: f"_starts_{i}" for i, phrase in enumerate(PHRASES)}
    every = F.concat(*[F.col(name) for name in starts.values()])
    base = F.filter(F.array(*[F.when(F.size(name) > 0, F.lit(PHRASES[phrase])) for phrase, name in starts.items()]),
                    lambda label: label.isNotNull())
    known = F.array(*[F.lit(word) for word in vocabulary]) if vocabulary else F.array().cast("array<string>")
    firsts = F.array(*[F.lit(word) for word in prefixes]) if prefixes else F.array().cast("array<string>")
    lines = F.filter(F.transform(F.flatten("_paragraphs"), lambda line: F.array_intersect(known, line)),
                     lambda line: F.arrays_overlap(line, firsts))
    wrapped = F.transform(F.filter("_paragraphs", lambda p: F.size(p) > 1), F.flatten)
    scanned = stored(
        documents.select("doc_id", F.size(F.regexp_extract_all(text, F.lit(RAW_WORD), 0)).cast("long").alias("n_words"),
                         exact.alias("_text"))
        .withColumn("_paragraphs", F.transform(F.split("_text", BLANK_LINE), _words_of_lines))
        .withColumn("_words", F.flatten(F.flatten("_paragraphs")))
        .withColumns({name: _starts(words, phrase) for phrase, name in starts.items()})
        .select(F.monotonically_increasing_id().alias("_row"), "doc_id", "n_words",
                F.size(every).cast("long").alias("n_base"),
                F.array_min(every).cast("long").alias("first_word"),
                F.array_max(every).cast("long").alias("last_word"),
                base.alias("_base"), lines.alias("_lines"), _places(wrapped, vocabulary, prefixes).alias("_passages")),
        "licenses")

    index = _prefix_index(scanned, ordered)
    matches = _join_lines(scanned, index, rank)
    if ordered:
        matches = matches.union(_join_passages(scanned, index, prefixes, max(t.reach for t in ordered)))
    found = matches.groupBy(F.col("_row").alias("_found")).agg(
        F.collect_set("label").alias("_more"), F.max("share").alias("_share"))
    more = F.coalesce(F.col("_more"), F.array().cast("array<string>"))
    return (
        scanned.drop("_lines", "_passages").join(found, F.col("_row") == F.col("_found"), "left")
        .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                _labels(F.col("_base")).alias("base_labels"), _labels(F.col("_base"), more).alias("labels"),
                F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("_share"), F.lit(0.0)))
                .alias("score"))
    )


def _may_hold(folded: Column, prefixes: list[str]) -> Column:
    """Whether a lower-cased text holds all words of a phrase or one of ``prefixes``, inside of words at least.
    lower() changes all that A-Z folding changes, so no text with a match fails this test."""
    phrases = [reduce(lambda a, b: a & b, [F.contains(folded, F.lit(word)) for word in phrase.split()]) for phrase in PHRASES]
    return reduce(lambda a, b: a | b, [*phrases, *[F.contains(folded, F.lit(word)) for word in prefixes]])


def _words_of_lines(paragraph: Column) -> Column:
    return F.transform(F.split(paragraph, "\n"), lambda line: F.regexp_extract_all(line, F.lit(WORD), 0))


def _places(paragraphs: Column, vocabulary: list[str], prefixes: list[str]) -> Column:
    """Place and word of what ``vocabulary`` holds of each paragraph, if one of ``prefixes`` stands in it."""
    def known(words: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: F.get(words, i).isin(vocabulary))
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.get(words, i).alias("word")))

    hopeful = F.filter(paragraphs, lambda words: F.exists(words, lambda word: word.isin(prefixes)))
    return F.transform(hopeful, known)


def _prefix_index(scanned: DataFrame, templates: list[Template]) -> DataFrame:
    """A row for each word of a template's prefix, at its place in the order of frequency."""
    schema = "label string, words array<string>, least int, reach int"
    return (
        scanned.sparkSession.createDataFrame(templates, schema)
        .select("*", F.posexplode("words").alias("at", "word"))
        .filter(F.col("at") <= F.size("words") - F.col("least"))
    )


def _join_passages(scanned: DataFrame, index: DataFrame, prefixes: list[str], longest: int) -> DataFrame:
    """``_row, label, share`` of the passages that contain enough of a template.

    A passage that does holds a word of the template's prefix. So the surroundings of each such word
    are taken, and in them the passages that hold it and begin with a word of the vocabulary.
    """
    begin = F.greatest(F.col("_nth") + 2 - longest, F.lit(1))
    anchors = (
        scanned.select("_row", F.explode("_passages").alias("_known"))
        .select("_row", "_known", F.posexplode("_known").alias("_nth", "_anchor"))
        .filter(F.col("_anchor.word").isin(prefixes))
        .select("_row", F.col("_anchor.at").alias("_at"), F.col("_anchor.word").alias("word"),
                F.slice("_known", begin, F.col("_nth") + 1 + longest - begin).alias("_near"))
    )
    reach, words = F.col("reach"), F.col("words")

    def overlap(first: Column) -> Column:
        inside = F.filter("_near", lambda x: (x["at"] >= first["at"]) & (x["at"] < first["at"] + reach))
        return F.size(F.array_intersect(words, inside["word"]))

    firsts = F.filter("_near", lambda x: (x["at"] > F.col("_at") - reach) & (x["at"] <= F.col("_at")))
    return (
        anchors.join(F.broadcast(index), "word")
        .filter(F.size(F.array_intersect(words, F.col("_near.word"))) >= F.col("least"))
        .withColumn("_overlap", F.array_max(F.transform(firsts, overlap)))
        .filter(F.col("_overlap") >= F.col("least"))
        .select("_row", "label", (F.col("_overlap") / F.size("words")).alias("share"))
    )


def _join_lines(scanned: DataFrame, index: DataFrame, rank: dict[str, int]) -> DataFrame:
    """``_row, label, share`` of the lines that contain enough of a template."""
    ranks = F.create_map(*[F.lit(x) for pair in (rank or {"": 0}).items() for x in pair])
    by_rank = F.transform(
        F.array_sort(F.transform("line", lambda w: F.struct(F.element_at(ranks, w).alias("rank"), w.alias("word")))),
        lambda pair: pair["word"])
    lines = (
        scanned.select("_row", F.posexplode("_lines").alias("_line", "line"))
        .withColumn("line", by_rank)
        .select("_row", "_line", "line", F.posexplode("line").alias("_at", "word"))
    )
    size = F.size("line")
    # The first common word passes the positional filter: all others stand behind it on both sides.
    left = F.least(size - F.col("_at"), F.size("words") - F.col("at"))
    candidates = (
        lines.join(F.broadcast(index), "word")
        .filter((size >= F.col("least")) & (F.col("_at") <= size - F.col("least"))
                & (left >= F.col("least")))
        .select("_row", "_line", "label", "line", "words", "least").distinct()
    )
    overlap = F.size(F.array_intersect("line", "words"))
    return (candidates.filter(overlap >= F.col("least"))
            .select("_row", "label", (overlap / F.size("words")).alias("share")))
