"""Exact token counts at every prefix of a text, by dynamic programming over its last token.

In byte-pair encoding the tokens of a prefix are those of a shorter prefix and one more token, and tokens
that stand beside each other are right wherever they stand. So the last token of each prefix is
the one that may follow the last token of the prefix before it, and the count at a prefix is one more than
there. Spaces begin tokens and never stand behind other marks in one, so the words of a text are
independent of each other and each different word is worked out once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

LIMIT = 4_096
# The mark that stands for a space in pieces.
SPACE = "▁"
# Words whose counts each Python process keeps, and words up to this length that are worked out together.
KEPT_WORDS, TOGETHER = 400_000, 256
_SLOTS = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")


class PrefixCounter:
    """Counts of a sentencepiece BPE model with byte fallback, without normalisation but for the space that
    it puts before a text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if any(model.is_unused(i) for i in range(size)) or model.normalize("  a  ﬁ ") != f"{SPACE * 3}a{SPACE} ﬁ{SPACE}":
            raise ValueError("the model has unused pieces or normalises texts")
        taken = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.pieces = [""] + [model.id_to_piece(i) for i in taken]
        self.number = {piece: n for n, piece in enumerate(self.pieces) if n}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in taken}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.number):
            raise ValueError("a piece holds a space behind other marks")
        self.longest = max(map(len, self.number))
        self.powers = [np.uint64(1)]
        for _ in range(self.longest):
            self.powers.append(self._times(self.powers[-1], _BASE))
        self.by_length = {}
        for length in range(1, self.longest + 1):
            names = [p for p in self.number if len(p) == length]
            hashes = np.array([self._hash(p) for p in names], dtype=np.uint64)
            order = np.argsort(hashes)
            if len(names):
                self.by_length[length] = hashes[order], np.array([self.number[names[i]] for i in order], np.int64)
        # What is known of pairs: the key that holds a slot, and whether its second piece may follow.
        self.keys = np.zeros(_SLOTS, dtype=np.uint64)
        self.follows = np.zeros(_SLOTS, dtype=bool)
        self.words: dict[str, int] = {}

    @staticmethod
    def _times(a: np.ndarray | np.uint64, b: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return a * b

    def _hash(self, text: str) -> np.uint64:
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for mark in text:
                value = value * _BASE + np.uint64(ord(mark) + 1)
        return value

    def may_follow(self, first: int, second: int) -> bool:
        """Whether the encoding of both pieces together is just these two; ``first`` 0 stands for the
        begin of a word or a mark that no piece has."""
        border, text = len(self.pieces[first]), self.pieces[first] + self.pieces[second]
        ends = list(range(1, len(text) + 1))
        starts = list(range(len(text)))
        while True:
            best = None
            for i in range(len(ends) - 1):
                score = self.score.get(text[starts[i]:ends[i + 1]])
                if score is not None and (best is None or score > best[0]):
                    best = score, i
            if best is None:
                return len(ends) == (2 if border else 1)
            i = best[1]
            if starts[i] < border < ends[i + 1]:
                return False
            ends[i:i + 2] = [ends[i + 1]]
            starts[i:i + 2] = [starts[i]]

    def _may_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = (first.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        slot = (self._times(key, _BASE) >> np.uint64(43)).astype(np.int64)
        good = self.follows[slot]
        unknown = np.flatnonzero(self.keys[slot] != key)
        if unknown.size:
            fresh, back = np.unique(key[unknown], return_inverse=True)
            found = np.array([self.may_follow(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in fresh], dtype=bool)
            at = (self._times(fresh, _BASE) >> np.uint64(43)).astype(np.int64)
            self.keys[at], self.follows[at] = fresh, found
            good[unknown] = found[back]
        return good

    def _numbers(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Numbers of the pieces of this length with these hashes, 0 where there is none."""
        if length not in self.by_length:
            return np.zeros(len(hashes), dtype=np.int64)
        known, numbers = self.by_length[length]
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[place] == hashes, numbers[place], 0)

    def prefixes(self, words: list[str]) -> list[np.ndarray]:
        """Of each word (spaces as ``SPACE``) the counts at its prefixes of one mark and more."""
        out: list[np.ndarray | None] = [None] * len(words)
        order = sorted((i for i, w in enumerate(words) if len(w) <= TOGETHER), key=lambda i: -len(words[i]))
        for i, word in enumerate(words):
            if len(word) > TOGETHER:
                out[i] = self._alone(word)
        if not order:
            return out
        lengths = np.array([len(words[i]) for i in order])
        marks = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        starts = np.cumsum(lengths) - lengths
        wide = 1 + (marks > 0x7F).astype(np.int32) + (marks > 0x7FF) + (marks > 0xFFFF)
        hashes, last, counts = ([np.zeros(len(order), dtype=t)] for t in (np.uint64, np.int64, np.int32))
        for end in range(1, int(lengths[0]) + 1):
            active = int(np.searchsorted(-lengths, -end, side="right"))
            here = starts[:active] + end - 1
            hashes.append(self._times(hashes[-1][:active], _BASE) + marks[here] + np.uint64(1))
            # A mark without a piece becomes its bytes.
            token, count = np.zeros(active, dtype=np.int64), counts[-1][:active] + wide[here]
            left = np.arange(active)
            for length in range(1, min(end, self.longest) + 1):
                begin = end - length
                numbers = self._numbers(hashes[end][left] - self._times(hashes[begin][left], self.powers[length]), length)
                some = np.flatnonzero(numbers)
                if not some.size:
                    continue
                good = some[self._may_follow(last[begin][left[some]], numbers[some])]
                token[left[good]], count[left[good]] = numbers[good], counts[begin][left[good]] + 1
                left = np.delete(left, good)
                if not left.size:
                    break
            last.append(token)
            counts.append(count)
        flat = np.empty(len(marks), dtype=np.int32)
        for end in range(1, len(counts)):
            flat[starts[:len(counts[end])] + end - 1] = counts[end]
        for i, start, length in zip(order, starts, lengths):
            out[i] = flat[start:start + length]
        return out

    def _alone(self, word: str) -> np.ndarray:
        last, counts = [0], [0]
        for end in range(1, len(word) + 1):
            token, count = 0, counts[-1] + len(word[end - 1].encode())
            for length in range(1, min(end, self.longest) + 1):
                number = self.number.get(word[end - length:end])
                if number and self._may_follow(np.array([last[end - length]]), np.array([number]))[0]:
                    token, count = number, counts[end - length] + 1
                    break
            last.append(token)
            counts.append(count)
        return np.array(counts[1:], dtype=np.int32)

    def known(self, words: list[str]) -> np.ndarray:
        """Counts of whole words that follow a space."""
        missing = [w for w in words if w not in self.words]
        if missing:
            self.words.update((w, int(counts[-1])) for w, counts in zip(missing, self.prefixes([SPACE + w for w in missing])))
        found = np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        return found

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        odd = pc.match_substring_regex(texts, f"^ |  |{SPACE}").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        counts = self.known(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        sums = np.concatenate([[0], np.cumsum(counts)])
        bounds = split.offsets.to_numpy()
        out = sums[bounds[1:]] - sums[bounds[:-1]]
        out[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0
        for i in np.flatnonzero(odd):
            out[i] = int(self.known([s[1:] for s in segments(texts[int(i)].as_py())]).sum())
        return out

    def steps(self, text: str) -> bytes:
        """The change of the count with each character of the text, packed."""
        if not text:
            return zlib.compress(b"", 1)
        words = segments(text)
        different = list(dict.fromkeys(words))
        found = dict(zip(different, self.prefixes(different)))
        changes = np.concatenate([np.diff(found[w], prepend=0) for w in words]).astype(np.int8)
        # The space before the text comes with its first character.
        changes[1] += changes[0]
        return zlib.compress(changes[1:].tobytes(), 1)


def segments(text: str) -> list[str]:
    """The text with a space before it, cut before each run of spaces."""
    return _SEGMENT.findall(SPACE + text.replace(" ", SPACE))


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    """One per Python process, so that tasks share what is known."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row: the bytes of its text, its tokens (the count
    at its whole length) and whether they are more than ``limit``.

    Null and empty texts have no tokens. Rows that repeat an id have a row each, an empty table gives
    none; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            totals = counter.totals(batch.column(2).cast(pa.large_string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(totals, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    rows = documents.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), whole_text().alias("text"))
    return (rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def prefix_table(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_chars, steps`` of every row: the count at each prefix of its text, as the packed change
    with each character. ``tokens_at`` and ``chars_within`` read it; texts are not encoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                given = text.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), pa.array([len(given)], pa.int64()),
                     pa.array([counter.steps(given)], pa.binary())], names=["doc_id", "n_chars", "steps"])

    return documents.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id long, n_chars long, steps binary")


def _counts(steps: bytes) -> np.ndarray:
    """The count at each prefix, that of no character included."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(zlib.decompress(steps), dtype=np.int8), dtype=np.int64)])


def tokens_at(steps: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` characters (of all, if there are fewer)."""
    def run(packed: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([int((c := _counts(s))[min(max(int(n), 0), len(c) - 1)]) for s, n in zip(packed, ends)], dtype="int64")

    return F.pandas_udf(run, "long")(steps, n_chars.cast("long"))


def chars_within(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix that has ``budget`` tokens or fewer; 0 for a negative budget."""
    def run(packed: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([int(np.flatnonzero(_counts(s) <= max(int(n), 0))[-1]) for s, n in zip(packed, most)], dtype="int64")

    return F.pandas_udf(run, "long")(steps, budget.cast("long"))
