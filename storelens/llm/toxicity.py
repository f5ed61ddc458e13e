"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text
from .labels import SAMPLE_ROWS, fit_logistic, held_out, labelled_sample

# Letters that look like Latin ones, and digits that stand for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "ɡ": "g", "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ո": "n", "ս": "u", "ԛ": "q",
    "ѡ": "w", "ν": "v", "ο": "o", "α": "a", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "ε": "e", "ı": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
_WIDE = {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
_FOLD = str.maketrans(HOMOGLYPHS | DIGITS | _WIDE)
_WORD = re.compile(r"[^\W\d_]+")

SHORTEST, LONGEST = 3, 12
# Evidence (twice the log-likelihood ratio) that an exception needs. An entry needs this much beyond
# what the best of all candidates reaches by chance, and a candidate so many documents.
EVIDENCE, LEAST_DOCUMENTS = 10.0, 5
# Share of a document's words from which a prefix counts as dense.
DENSE = 0.005
# Different prefixes a task counts before it hands them on.
_COUNTED = 100_000
FOLDS, FOLD = 5, 0


def fold(text: str) -> str:
    """Lower case, with homoglyphs and digit substitutions undone."""
    return text.lower().translate(_FOLD)


class Lexicon(NamedTuple):
    """Weights of word beginnings, and phrases in which a beginning doesn't count."""

    weights: dict[str, float]
    exceptions: list[str]
    model: list[float]

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0))
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        if len(found):
            found.make_automaton()
        return found


def matches(folded: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """Start, end and weight of the entries that begin a word and stand in no exception phrase."""
    if not len(automaton):
        return []
    hits, spared = [], []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalpha():
            continue
        if weight:
            hits.append((start, end, weight))
        elif end + 1 == len(folded) or not folded[end + 1].isalpha():
            spared.append((start, end))
    if not spared:
        return hits
    spared.sort()
    begins = [start for start, _ in spared]
    furthest = list(accumulate((end for _, end in spared), max))
    out = []
    for hit in hits:
        before = bisect_right(begins, hit[0])
        if not before or furthest[before - 1] < hit[1]:
            out.append(hit)
    return out


def features(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """Weight found per word, as 1000 times its share on a log scale, and the weight on a log scale."""
    found = matches(fold(text or ""), automaton)
    if not found:
        return 0.0, 0.0
    weight = sum(w for _, _, w in found)
    words = len((text or "").split())
    return math.log1p(1000 * weight / max(1, words)), math.log1p(weight)


def evidence(with_1: np.ndarray, with_0: np.ndarray, all_1: int, all_0: int) -> np.ndarray:
    """Twice the log-likelihood ratio of a word against chance; 0 where it speaks for label 0."""
    a, b = np.asarray(with_1, dtype=float), np.asarray(with_0, dtype=float)
    n, share = a + b, all_1 / max(1, all_1 + all_0)
    if not 0 < share < 1:
        return np.zeros(len(a))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (np.where(a > 0, a * np.log(a / n / share), 0) + np.where(b > 0, b * np.log(b / n / (1 - share)), 0))
    return np.where(a / np.maximum(n, 1) > share, gain, 0.0)


def _prefix_counts(sample: DataFrame) -> DataFrame:
    """``prefix`` and how many documents of either label have a word that begins so (``ones, zeros``),
    and how many have several such words in close order (``dense_ones, dense_zeros``)."""
    names = ["ones", "zeros", "dense_ones", "dense_zeros"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()),
                       *[pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(len(names))]]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["prefix", *names])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                words = Counter(_WORD.findall(fold(text.as_py() or "")))
                found: Counter[str] = Counter()
                for word, times in words.items():
                    for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
                        found[word[:n]] += times
                side, many = int(not label.as_py()), max(2, DENSE * words.total())
                for prefix, times in found.items():
                    own = counts.setdefault(prefix, [0, 0, 0, 0])
                    own[side] += 1
                    if times >= many:
                        own[2 + side] += 1
                if len(counts) > _COUNTED:
                    yield rows()
        yield rows()

    parts = sample.select("text", "label").mapInArrow(
        run, "prefix string, " + ", ".join(f"{name} long" for name in names))
    return parts.groupBy("prefix").agg(*[F.sum(name).alias(name) for name in names])


def _phrase_counts(sample: DataFrame, automaton: ahocorasick.Automaton) -> DataFrame:
    """``phrase, ones, zeros``: documents of either label with an entry and the word beside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, int, int]] = []
            for text, label in zip(batch.column(0), batch.column(1)):
                folded, phrases = fold(text.as_py() or ""), set()
                for start, end, _ in matches(folded, automaton):
                    after = re.match(r"\w*[ ]\w+", folded[end + 1:end + 60])
                    before = re.search(r"\w+[ ]$", folded[max(0, start - 60):start])
                    word = re.match(r"\w*", folded[end + 1:end + 60])[0]
                    if after:
                        phrases.add(folded[start:end + 1] + after[0])
                    if before:
                        phrases.add(before[0] + folded[start:end + 1] + word)
                one = int(bool(label.as_py()))
                rows += [(p, one, 1 - one) for p in phrases]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["phrase", "ones", "zeros"])

    parts = sample.select("text", "label").mapInArrow(run, "phrase string, ones long, zeros long")
    return parts.groupBy("phrase").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def choose(candidates: Iterable[tuple[str, int, int, int, int]], all_1: int, all_0: int,
           needed: float) -> dict[str, float]:
    """The entries of the lexicon: word beginnings in the order of their evidence (the longest of
    equals), none of which begins another. The evidence is that of their presence or that of their
    density, whichever is more; the weight is the log of the odds."""
    rows = list(candidates)
    counts = np.array([r[1:] for r in rows], dtype=float).reshape(-1, 4)
    proofs = np.stack([evidence(counts[:, i], counts[:, i + 1], all_1, all_0) for i in (0, 2)])
    best = proofs.argmax(axis=0)
    chosen: dict[str, float] = {}
    begun: set[str] = set()
    for i in sorted(range(len(rows)), key=lambda i: (-proofs[best[i], i], -len(rows[i][0]), rows[i][0])):
        prefix = rows[i][0]
        if proofs[best[i], i] < needed:
            break
        beginnings = [prefix[:n] for n in range(1, len(prefix) + 1)]
        if prefix not in begun and not any(b in chosen for b in beginnings):
            begun.update(beginnings)
            ones, zeros = counts[i, 2 * best[i]:2 * best[i] + 2]
            odds = math.log((ones + 0.5) / (all_1 + 1) / ((zeros + 0.5) / (all_0 + 1)))
            chosen[prefix] = min(6.0, max(0.1, odds))
    return chosen


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Lexicon:
    """Lexicon, exceptions and calibration from about ``rows`` labelled documents that are not held
    out. Without both labels the lexicon is empty and the score even.

    Documents whose least hash of three words in a row agrees count once for the lexicon, so that a text
    with many copies doesn't lift its words. Candidates come to the driver only with enough documents to reach the
    evidence asked for, which bounds them by the size of the sample.
    """
    sample = stored(labelled_sample(documents, labels, "toxic", FOLDS, FOLD, rows), "toxicity")
    words = F.col("_words")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    triples = F.zip_with(pairs, F.slice(words, 3, F.size(words)), lambda a, b: F.xxhash64(a, b))
    spread = stored(
        sample.withColumn("_words", F.split(F.lower(whole_text()), r"\s+"))
        .withColumn("_likeness", F.array_min(triples))
        .dropDuplicates(["_likeness", "label"]).select("text", "label"), "toxicity")
    totals = spread.agg(F.sum(F.col("label")).alias("ones"), F.count("*").alias("n")).first()
    all_1, all_0 = totals["ones"] or 0, (totals["n"] or 0) - (totals["ones"] or 0)
    if not all_1 or not all_0:
        return Lexicon({}, [], [0.0, 0.0, 0.0])
    counted = stored(_prefix_counts(spread), "toxicity")
    tested = counted.filter(F.col("ones") + F.col("zeros") >= LEAST_DOCUMENTS).count()
    needed = EVIDENCE + 2 * math.log(max(1, tested))
    least = math.ceil(needed / 2 / math.log((all_1 + all_0) / all_1))
    likely = [(F.col(a) >= least) & (F.col(a) * all_0 > F.col(b) * all_1)
              for a, b in (("ones", "zeros"), ("dense_ones", "dense_zeros"))]
    weights = choose(map(tuple, counted.filter(likely[0] | likely[1]).collect()), all_1, all_0, needed)
    lexicon = Lexicon(weights, [], [])
    # Exceptions: phrases that speak for the other label, and stand in so many of its documents only that
    # their evidence, 2 n log 2, suffices.
    enough = max(LEAST_DOCUMENTS, math.ceil(EVIDENCE / 2 / math.log(2)))
    spared = (_phrase_counts(spread, lexicon.automaton()).filter((F.col("ones") == 0) & (F.col("zeros") >= enough))
              .orderBy(F.col("zeros").desc(), "phrase").collect())
    exceptions = [r["phrase"] for r in spared]
    lexicon = Lexicon(weights, exceptions, [])
    measured = _features(sample, lexicon).toPandas()
    x = measured[["share", "weight"]].to_numpy(dtype=float)
    return Lexicon(weights, exceptions, fit_logistic(x, measured["label"].to_numpy(dtype=float)).tolist())


def _features(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The columns but the text, with ``share`` and ``weight``."""
    others = [c for c in documents.columns if c != "text"]
    kinds = dict(documents.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [features(t.as_py(), automaton) for t in batch.column(len(others))]
            columns = [*batch.columns[:-1], *[pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)]]
            yield pa.RecordBatch.from_arrays(columns, [*others, "share", "weight"])

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in others] + ["share double", "weight double"])
    return documents.select(*others, "text").mapInArrow(run, schema)


def score(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    The score is a logistic function of the weight of the matches, in all and by the number of words.
    Null and empty texts have no match and the lowest score. Repeated rows give a row each, null ids
    keep theirs; an empty table gives none; other columns are ignored.
    """
    by_share, by_weight, base = lexicon.model
    line = F.col("share") * by_share + F.col("weight") * by_weight + base
    return (
        _features(documents.select("doc_id", "text"), lexicon)
        .withColumn("score", 1.0 / (1.0 + F.exp(-line)))
        .select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )


def clean(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents with a score under 0.5, all columns kept."""
    by_share, by_weight, base = lexicon.model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            found = [features(t.as_py(), automaton) for t in text]
            yield batch.filter(pa.array([s * by_share + w * by_weight + base < 0 for s, w in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
