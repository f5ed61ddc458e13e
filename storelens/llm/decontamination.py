"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
# Words that may differ, as a share of an item's words.
ERRORS = 0.2
# Items that are matched in one pass over the documents.
PASS_ITEMS = 50_000
PASS_WORDS = 5_000_000
# Words of a piece that are looked up; the rest of a piece is left to the verification.
SEED = 3


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def pieces(length: int, budget: int) -> list[tuple[int, int]]:
    """``budget + 1`` pieces of like size: with no more errors, one of them is intact."""
    parts = budget + 1
    return [(length * i // parts, length * (i + 1) // parts) for i in range(parts)]


def error_budget(length: int, errors: float = ERRORS) -> int:
    """Errors that are allowed in an item, as many as leave every piece two words, and none in items
    under two words."""
    return max(0, min(int(errors * length), length // 2 - 1))


class Pattern:
    """An item, ready for Myers' bit-parallel matching over words."""

    def __init__(self, words: list[str], errors: float = ERRORS) -> None:
        self.words = words
        self.budget = error_budget(len(words), errors)
        self.masks: dict[str, int] = {}
        for i, word in enumerate(words):
            self.masks[word] = self.masks.get(word, 0) | 1 << i
        self.full = (1 << len(words)) - 1
        self.high = 1 << len(words) - 1

    def ends(self, words: list[str], start: int, stop: int) -> Iterator[tuple[int, int]]:
        """Places and distances at which a match within the budget ends, in ``words[start:stop]``.
        A match may begin anywhere, so the distance at a place is that of the best one ending there."""
        for place, distance in enumerate(self._distances(words[start:stop], 0), start):
            if distance <= self.budget:
                yield place, distance

    def begin(self, words: list[str], end: int, distance: int) -> int:
        """Where the shortest match that ends at ``end`` with ``distance`` begins."""
        least = max(0, end + 1 - len(self.words) - distance)
        back = Pattern(self.words[::-1])._distances(words[least:end + 1][::-1], 1)
        return next((end - i for i, found in enumerate(back) if found == distance), end)

    def _distances(self, words: list[str], begin_cost: int) -> Iterator[int]:
        """Distance of the item from the words up to each one; ``begin_cost`` is 1 if the first word
        must begin the match, and 0 if any may."""
        plus, minus, distance = self.full, 0, len(self.words)
        masks, full, high = self.masks, self.full, self.high
        for word in words:
            equal = masks.get(word, 0)
            vertical = equal | minus
            across = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(across | plus) & full
            down = plus & across
            if up & high:
                distance += 1
            elif down & high:
                distance -= 1
            up = (up << 1 | begin_cost) & full
            down = down << 1 & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
            yield distance


class Matcher:
    """Finds items in documents: intact pieces by lookup, whole items by verification."""

    def __init__(self, items: list[tuple[int, str]], errors: float = ERRORS) -> None:
        self.patterns: list[tuple[int, Pattern]] = []
        # Seeds (the first words of a piece) by their first and second word; "" if there is one only.
        self.seeds: dict[str, dict[str, list[tuple[list[str], int, int]]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            pattern = Pattern(words, errors)
            self.patterns.append((item_id, pattern))
            for first, last in pieces(len(words), pattern.budget):
                seed = [*words[first:min(last, first + SEED)], ""]
                self.seeds.setdefault(seed[0], {}).setdefault(seed[1], []).append(
                    (seed[2:-1], first, len(self.patterns) - 1))

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """Item, first and last word and distance of what stands in the text."""
        return [match[:4] for match in self.measured(text)]

    def measured(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """``item_id, first_word, last_word, distance`` of the best match of each item found: the
        least distance, the first place where such a match ends, the shortest such match."""
        words = words_of(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        seeds = self.seeds
        for place in [i for i, word in enumerate(words) if word in seeds]:
            second = seeds[words[place]]
            hits = second.get("", [])
            if place + 1 < len(words):
                hits = hits + second.get(words[place + 1], [])
            for rest, offset, item in hits:
                if not rest or words[place + 2:place + 2 + len(rest)] == rest:
                    pattern = self.patterns[item][1]
                    start = place - offset - pattern.budget
                    windows.setdefault(item, []).append(
                        (max(0, start), min(len(words), start + len(pattern.words) + 2 * pattern.budget)))
        found = []
        for item, spans in windows.items():
            item_id, pattern = self.patterns[item]
            best = None
            for start, stop in _joined(spans):
                for place, distance in pattern.ends(words, start, stop):
                    if best is None or distance < best[1]:
                        best = (place, distance)
            if best:
                found.append((item_id, pattern.begin(words, *best), *best, len(pattern.words)))
        return found


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap joined."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _passes(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of bounded size, in the order of their ids. Equal items come once for each
    id."""
    items = (benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
             .distinct().orderBy("item_id", "text"))
    part: list[tuple[int, str]] = []
    size = 0
    for row in items.toLocalIterator():
        part.append((row["item_id"], row["text"]))
        size += len(row["text"]) // 4
        if len(part) >= PASS_ITEMS or size >= PASS_WORDS:
            yield part
            part, size = [], 0
    if part:
        yield part


def contaminated(documents: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """``doc_id, item_id, first_word, last_word, distance, n_words``: a row for each document and
    benchmark item that stands in it.

    Words are runs of letters, digits and underscores in lower case. An item of n words stands in a
    document where some stretch of words differs from it by at most ``errors * n`` insertions,
    deletions and replacements (fewer where pieces would be under two words). Each item is cut into
    one more piece than errors are allowed, so one piece of a match is intact; documents are searched
    for the pieces, and the surroundings of each hit are verified with Myers' algorithm.

    Items without words, id or text match nothing. Null and empty texts contain nothing. Repeated rows
    of documents give their rows each; items that repeat with their id give one. Empty tables give an
    empty result; other columns are ignored. Items are matched in passes of bounded size (one
    pass up to ``PASS_ITEMS`` items), each of which sends its items to the tasks.
    """
    spark = documents.sparkSession
    schema = "doc_id long, item_id long, first_word long, last_word long, distance long, n_words long"
    kinds = [pa.int64()] * 6
    out = spark.createDataFrame([], schema)
    for items in _passes(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, errors)
            for batch in batches:
                rows = [(doc_id.as_py(), *match)
                        for doc_id, text in zip(batch.column(0), batch.column(1))
                        for match in matcher.measured(text.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                     schema.replace(" long", "").split(", "))

        out = out.union(documents.select("doc_id", "text").mapInArrow(run, schema))
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """The documents in which no benchmark item stands (see ``contaminated``), all columns kept."""
    out = documents
    for items in _passes(benchmark):
        shared = documents.sparkSession.sparkContext.broadcast(items)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, errors)
            for batch in batches:
                text = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([not matcher.matches(t.as_py()) for t in text], pa.bool_()))

        out = out.mapInArrow(clean, documents.schema)
    return out
