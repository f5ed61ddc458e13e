"""Quality scores by a sparse rule ensemble, compiled to column expressions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .labels import SAMPLE_ROWS, held_out, labelled_sample

FOLDS, FOLD = 4, 2
TREES, DEPTH, CUTS = 16, 3, 24
LEARNING_RATE = 0.4
LEAST_LEAF = 10
LASSO = 2e-3
THRESHOLD = 0.7
STATISTICS = ["words", "word_length", "different_words", "lines", "different_lines", "words_a_line", "symbols",
              "bars", "exclaimed", "stops", "capitals", "digits"]


def with_statistics(rows: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``_of``, a struct of the statistics the rules speak of. Shares are of
    characters, words or lines; 0 for none.

    Words and lines are split once, in a projection below.
    """
    split = rows.select(*keep, whole_text().alias("_text"),
                        F.split(whole_text(), r"\s+").alias("_words"), F.split(whole_text(), "\n").alias("_lines"))
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    length, count, rows_of = F.length(text), F.when(text == "", 0).otherwise(F.size(words)), F.size(lines)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole.cast("double")).otherwise(0.0)

    def of(*marks: str) -> Column:
        return reduce(lambda a, b: a + b, [length - F.length(F.replace(text, F.lit(m), F.lit(""))) for m in marks])

    measures = {
        "words": count.cast("double"),
        "word_length": share(length, count),
        "different_words": share(F.size(F.array_distinct(words)), count),
        "lines": rows_of.cast("double"),
        "different_lines": share(F.size(F.array_distinct(lines)), rows_of),
        "words_a_line": share(count, rows_of),
        "symbols": share(of("#", "$", "%", "&", "*", "@", "~", "^", "="), length),
        "bars": share(of("|", "\t"), length),
        "exclaimed": share(of("!", "?"), length),
        "stops": share(of(".", ","), count),
        "capitals": share(length - F.length(F.regexp_replace(text, "[A-Z]+", "")), length),
        "digits": share(length - F.length(F.regexp_replace(text, "[0-9]+", "")), length),
    }
    return split.select(*keep, F.struct(*[measures[n].alias(n) for n in STATISTICS]).alias("_of"))


class Condition(NamedTuple):
    statistic: int
    cut: float
    above: bool


class Rule(NamedTuple):
    conditions: tuple[Condition, ...]
    weight: float


def _split(x: np.ndarray, residual: np.ndarray, cuts: list[np.ndarray]) -> tuple[float, int, float]:
    """Gain, statistic and cut of the best split by squared error."""
    best = (1e-9, -1, 0.0)
    total, count = residual.sum(), len(residual)
    for s, places in enumerate(cuts):
        if not len(places):
            continue
        order = np.argsort(x[:, s], kind="stable")
        sums = np.concatenate([[0.0], np.cumsum(residual[order])])
        below = np.searchsorted(x[order, s], places, side="right")
        sound = (below >= LEAST_LEAF) & (count - below >= LEAST_LEAF)
        if not sound.any():
            continue
        low = np.where(sound, below, 1)
        high = np.where(sound, count - below, 1)
        gain = np.where(sound, sums[below] ** 2 / low + (total - sums[below]) ** 2 / high - total ** 2 / count, 0)
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (float(gain[at]), s, float(places[at]))
    return best


def _grow(x: np.ndarray, residual: np.ndarray, cuts: list[np.ndarray], path: tuple[Condition, ...],
          paths: list[tuple[Condition, ...]]) -> np.ndarray:
    """Fits a tree and appends the path to each of its nodes; returns the fitted values."""
    if path:
        paths.append(path)
    if len(path) < DEPTH:
        _, s, cut = _split(x, residual, cuts)
        if s >= 0:
            above = x[:, s] > cut
            out = np.empty(len(x))
            for side in (False, True):
                out[above == side] = _grow(x[above == side], residual[above == side], cuts,
                                           (*path, Condition(s, cut, side)), paths)
            return out
    return np.full(len(x), residual.mean() if len(residual) else 0.0)


def _holds(x: np.ndarray, path: tuple[Condition, ...]) -> np.ndarray:
    return reduce(lambda a, c: a & ((x[:, c.statistic] > c.cut) == c.above), path, np.ones(len(x), dtype=bool))


def fit_rules(x: np.ndarray, y: np.ndarray) -> tuple[list[Rule], float]:
    """Rules with their weights, and the intercept.

    Boosted trees propose conjunctions: the path to each node. A logistic regression with a lasso
    penalty, by accelerated proximal gradient steps, then weighs them and leaves most at zero.
    """
    share = min(0.999, max(0.001, float(y.mean()) if len(y) else 0.5))
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0.01, 0.99, CUTS))) for s in range(x.shape[1])] if len(x) else []
    paths: list[tuple[Condition, ...]] = []
    score = np.full(len(y), base)
    for _ in range(TREES if len(x) and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-score))
        score = score + 4 * LEARNING_RATE * _grow(x, y - p, cuts, (), paths)
    paths = sorted(set(tuple(sorted(path)) for path in paths))
    if not paths:
        return [], base
    design = np.stack([_holds(x, path) for path in paths], axis=1).astype(float)
    scale = np.sqrt(np.maximum(design.mean(axis=0) * (1 - design.mean(axis=0)), 1e-4))
    design = design / scale
    weights, look, momentum, intercept = np.zeros(len(paths)), np.zeros(len(paths)), 1.0, base
    step = 4.0 / (np.linalg.norm(design, 2) ** 2 / len(y) + 1)
    for _ in range(600):
        error = 1 / (1 + np.exp(-np.clip(design @ look + intercept, -30, 30))) - y
        moved = look - step * (design.T @ error / len(y))
        intercept -= step * error.mean()
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * LASSO, 0)
        faster = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        look = new + (momentum - 1) / faster * (new - weights)
        weights, momentum = new, faster
    kept = [Rule(path, float(w / s)) for path, w, s in zip(paths, weights, scale) if abs(w) > 1e-6]
    return kept, float(intercept)


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[Rule], float]:
    """Rules from about ``rows`` labelled documents that are not held out."""
    sample = labelled_sample(documents, labels, "quality", FOLDS, FOLD, rows)
    frame = with_statistics(sample, "label").select("label", "_of.*").toPandas()
    return fit_rules(frame.drop(columns="label").to_numpy(dtype=float), frame["label"].to_numpy(dtype=float))


def compiled(rules: list[Rule], intercept: float, names: list[str]) -> Column:
    """The score as a column over columns of the statistics."""
    line = F.lit(intercept)
    for rule in rules:
        tests = [(F.col(names[c.statistic]) > c.cut) if c.above else (F.col(names[c.statistic]) <= c.cut)
                 for c in rule.conditions]
        line = line + F.when(reduce(lambda a, b: a & b, tests), rule.weight).otherwise(0.0)
    return 1.0 / (1.0 + F.exp(-line))


def score(documents: DataFrame, rules: list[Rule], intercept: float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null texts count as empty; an empty text has the score its statistics (all 0) give. Without both
    labels the score is the same for all. Repeated rows give a row each, null ids keep theirs; an
    empty table gives none; other columns are ignored.
    """
    return (
        with_statistics(documents, "doc_id")
        .withColumn("score", compiled(rules, intercept, [f"_of.{n}" for n in STATISTICS]))
        .select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )
