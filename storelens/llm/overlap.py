"""Near copies by the exact Jaccard similarity of their word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, stored_in_parts, whole_text
from .components import connected_components

WORDS = 5
SEED = 43
# Texts link at a Jaccard similarity of 4/5 or more; tests are made in whole numbers.
# Texts the order of shingles is estimated from, and the shingles ordered by their count there; they
# decide costs, not results.
SAMPLE, LEAST_COUNT, MOST_COUNTED = 16_384, 4, 300_000
# Texts of a shingle that are compared pair by pair at once.
FULL = 32
# Parts that shingles and texts are dealt to by their hashes; what is shuffled of one part is on disk at a time.
PARTS = 4
# Pairs are compared in groups that send as many shingles as all their texts have at most, or so many if that is more.
LEAST_SENT = 1 << 24
# Shingles that are worked on together in a task.
_PORTION = 1 << 18


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the word shingles in order. A-Z count as a-z, words are parted by ASCII
    white space; a shorter text is one shingle, a text without words (or null) has none."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    if len(parts) < words:
        parts, words = [b" ".join(parts)], 1
    total = len(parts) - words + 1
    joined = map(b" ".join, zip(*[parts[i:] for i in range(words)]))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), dtype="<u8", count=total))


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Nodes and their shingles, a bounded number of shingles together."""
    some: list[tuple[int, np.ndarray]] = []
    held = 0
    for batch in batches:
        for node, text in zip(batch.column(0), batch.column(1)):
            some.append((node.as_py(), shingles(text.as_py())))
            held += len(some[-1][1]) + 1
            if held > _PORTION:
                yield some
                some, held = [], 0
    if some:
        yield some


def _sets(texts: DataFrame) -> DataFrame:
    """``node, shingles`` of rows with ``node, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _portions(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([node for node, _ in some], pa.int64()),
                 pa.array([own.view(np.int64) for _, own in some], pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def _counted(texts: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample, in order, and their counts."""
    drawn = texts.filter(F.pmod(F.xxhash64("node"), F.lit(max(rows, 1))) < SAMPLE)
    counts = (_sets(drawn).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= LEAST_COUNT).orderBy(F.col("n").desc(), "s").limit(MOST_COUNTED).toPandas())
    values = counts["s"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], counts["n"].to_numpy(dtype=np.int64)[order]


def _prefixes(texts: DataFrame, values: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``s, node, size, at``: the first shingles of each text, the rarest first. Texts at 4/5 or more
    share one of their first ``size // 5 + 1`` shingles under any order that all texts have."""
    held = texts.sparkSession.sparkContext.broadcast((values, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = held.value
        for some in _portions(batches):
            firsts, sizes = [], []
            for _, own in some:
                size = len(own)
                if len(values):
                    place = np.minimum(np.searchsorted(values, own), len(values) - 1)
                    often = np.where(values[place] == own, counts[place], 0)
                    own = own[np.argsort(often, kind="stable")]
                firsts.append(own[:size // 5 + 1])
                sizes.append(size)
            kept = np.array([len(f) for f in firsts])
            nodes = np.array([node for node, _ in some], dtype=np.int64)
            ends = np.cumsum(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(np.repeat(nodes, kept)),
                 pa.array(np.repeat(np.array(sizes, dtype=np.int32), kept)),
                 pa.array((np.arange(ends[-1]) - np.repeat(ends - kept, kept)).astype(np.int32))],
                ["s", "node", "size", "at"])

    return texts.select("node", "text").mapInArrow(run, "s long, node long, size int, at int")


def _side(rows: DataFrame, mark: str, *more: str) -> DataFrame:
    return rows.select("s", *[F.col(c).alias(f"{c}_{mark}") for c in ("node", "size", "at", "root", *more)])


def _may_match() -> Column:
    """Length and position filters: the first shingle that two texts share passes both."""
    size_a, size_b = F.col("size_a").cast("long"), F.col("size_b").cast("long")
    left = F.least(size_a - F.col("at_a"), size_b - F.col("at_b"))
    return ((F.col("root_a") != F.col("root_b")) & (5 * F.least(size_a, size_b) >= 4 * F.greatest(size_a, size_b))
            & (9 * left >= 4 * (size_a + size_b)))


def _pairs(met: DataFrame) -> DataFrame:
    """``a, b, both``: the pairs that may match, and the sum of their sizes."""
    return (met.filter(_may_match())
            .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"),
                    (F.col("size_a").cast("long") + F.col("size_b")).alias("both")).distinct())


def _of_part(rows: DataFrame, part: int, column: str, parts: int = PARTS) -> DataFrame:
    return rows.filter(F.pmod(F.col(column), F.lit(parts)) == part)


def _cut_sets(texts: DataFrame) -> DataFrame:
    """``node, size, s0, s1, ...`` of rows with ``node, text``: the shingles, cut into ``PARTS`` ranges of hashes."""
    bounds = np.array([(i << 64) // PARTS for i in range(1, PARTS)], dtype=np.uint64)
    names = [f"s{i}" for i in range(PARTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _portions(batches):
            cut = [np.split(own.view(np.int64), np.searchsorted(own, bounds)) for _, own in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node for node, _ in some], pa.int64()), pa.array([len(own) for _, own in some], pa.int64()),
                 *[pa.array([own[i] for own in cut], pa.list_(pa.int64())) for i in range(len(names))]],
                ["node", "size", *names])

    return texts.select("node", "text").mapInArrow(
        run, ", ".join(["node long", "size long", *[f"{n} array<long>" for n in names]]))


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b``: the fingerprints of the pairs whose sets share 4/5 or more.

    They do if what only one of them holds is a ninth of ``both`` at most. It is counted part by part, and a pair that
    has more already is left out of the parts that follow.
    """
    pairs = stored(pairs.withColumn("apart", F.lit(0).cast("long")), "candidates")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = stored(nodes.join(wanted, "node").select(F.col("node").alias("_node"), F.col("doc").alias("_doc")), "chosen")

    def given(part: int) -> DataFrame:
        # One document gives the text of a node, so that copies don't meet in one place.
        same = (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
        return _of_part(texts, part, "node").join(_of_part(chosen, part, "_node"), same).dropDuplicates(["node"])

    sets = stored_in_parts([_cut_sets(given(part)) for part in range(PARTS)], "sets")
    discard(chosen)
    most = max(_sum(sets, "size"), LEAST_SENT)
    for part in range(PARTS):
        # A pair sends the set of one of its texts.
        groups = max(1, -(-_sum(pairs, "both") // (2 * most)))
        before, pairs = pairs, stored_in_parts(
            [_compared(_of_part(pairs, i, "a", groups), sets, f"s{part}") for i in range(groups)], "candidates")
        discard(before)
    x = nodes.select(F.col("node").alias("a"), F.col("fp").alias("x"))
    y = nodes.select(F.col("node").alias("b"), F.col("fp").alias("y"))
    found = stored(pairs.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b")), "alike")
    discard(pairs, sets)
    return found


def _sum(rows: DataFrame, column: str) -> int:
    return rows.agg(F.sum(column)).first()[0] or 0


def _compared(pairs: DataFrame, sets: DataFrame, part: str) -> DataFrame:
    """The pairs with what ``part`` of their sets adds to ``apart``, without those that can't match any more."""
    left = sets.select(F.col("node").alias("a"), F.col(part).alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col(part).alias("_y"))
    shared = F.size(F.array_intersect("_x", "_y"))
    return (pairs.join(left, "a").join(right, "b")
            .withColumn("apart", F.col("apart") + F.size("_x") + F.size("_y") - 2 * shared)
            .filter(9 * F.col("apart") <= F.col("both")).select("a", "b", "both", "apart"))


def links(documents: DataFrame, rows: DataFrame, known: DataFrame) -> DataFrame:
    """``a, b``: pairs of fingerprints that, with the links ``known``, suffice to join all texts at a
    five-word Jaccard similarity of 4/5 or more. ``rows`` holds ``doc_id, content, fp`` of every document.

    A prefix join: texts meet at their rarest shingles, pairs that ``known`` already joins are left out,
    and the whole sets decide. Where a shingle is held by more than ``FULL`` texts, all are first
    compared with the one in which the fewest rarer shingles stand before it: of many copies of a text with
    changes of their own it is the least changed. Then those outside of the shingle's largest component are
    compared with the others of other components. Both are exact. Of a group of copies only what may be at
    4/5 to another but isn't to the least changed one is left for the second step.
    """
    texts = documents.select("doc_id", F.xxhash64(whole_text()).alias("node"), "text")
    nodes = stored(rows.groupBy(F.col("content").alias("node")).agg(F.min("doc_id").alias("doc"), F.first("fp").alias("fp")),
                   "nodes")
    values, counts = _counted(texts, rows.count())
    placed = stored(_prefixes(texts, values, counts), "prefixes")
    shared = stored_in_parts([_common(_of_part(placed, part, "s")) for part in range(PARTS)], "shared")
    discard(placed)
    order = F.struct("at", F.xxhash64("node", "s"), "node")
    crowds = shared.groupBy(F.col("s").alias("_s")).agg(
        F.count("*").alias("n"), F.min(order)["node"].alias("pivot"), F.min("size").alias("_least"))
    # No text of the shingle is small enough for what is left behind it.
    hopeful = 9 * (F.col("size") - F.col("at")).cast("long") >= 4 * (F.col("size") + F.col("_least")).cast("long")
    held = stored(_rooted(shared.join(crowds, F.col("s") == F.col("_s")).filter(hopeful).drop("_s", "_least"),
                          nodes, connected_components(known)), "held")
    discard(shared)
    few, full = held.filter(F.col("n") <= FULL), held.filter(F.col("n") > FULL)
    pairs = _side(few, "a").join(_side(few, "b"), "s").filter(F.col("node_a") < F.col("node_b"))
    pivots = full.filter(F.col("node") == F.col("pivot"))
    stars = _side(full, "a").join(_side(pivots, "b"), "s")
    found = _verified(_pairs(pairs.unionByName(stars)), texts, nodes)
    if full.isEmpty():
        return found
    full = stored(_rooted(full.drop("root"), nodes, connected_components(known.union(found))), "full")
    discard(held)
    sizes = full.groupBy("s", "root").agg(F.count("*").alias("n"))
    largest = (sizes.groupBy(F.col("s").alias("_s"))
               .agg(F.max(F.struct("n", "root")).alias("largest"), F.count("*").alias("components"))
               .filter(F.col("components") > 1).select("_s", F.col("largest.root").alias("main")))
    mixed = full.join(largest, F.col("s") == F.col("_s")).drop("_s")
    outside = mixed.filter(F.col("root") != F.col("main"))
    found = found.union(_verified(_pairs(_side(outside, "a").join(_side(mixed, "b"), "s")), texts, nodes))
    discard(full)
    return found


def _common(placed: DataFrame) -> DataFrame:
    """The rows whose shingle more than one node has."""
    common = (placed.groupBy(F.col("s").alias("_s")).agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .filter(F.col("least") < F.col("most")).select("_s"))
    return placed.join(common, F.col("s") == F.col("_s")).drop("_s").distinct()


def _rooted(rows: DataFrame, nodes: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` with ``root``, the component of the fingerprint of their node."""
    named = components.select(F.col("node").alias("_print"), F.col("root").alias("_root"))
    roots = nodes.join(named, F.col("fp") == F.col("_print"), "left").select(
        F.col("node").alias("_of"), F.coalesce("_root", "fp").alias("root"))
    return rows.join(roots, F.col("node") == F.col("_of")).drop("_of")
