"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import overlap
from .common import stored, whole_text
from .components import connected_components

WORDS = 3
SEED = 42
# Fingerprints link at this many differing bits or fewer. The exact way for full buckets (_dense)
# holds for this distance.
MOST_BITS = 2
PARTS = 3
# Fingerprints the bit groups and thresholds are estimated from; they decide costs, not results.
SAMPLE = 8_192
# Fingerprints of a bucket that are compared pair by pair.
FULL = 64
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the word shingles: a bit is set if more than half of the hashes set it.
    A-Z count as a-z, words are parted by ASCII white space; a shorter text is one shingle, a text
    without words (or null) is zero."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles: Iterator[bytes] = iter([b" ".join(parts)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*[parts[i:] for i in range(words)]))
        total = len(parts) - words + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8", count=total)
    set_bits = np.zeros(64, dtype=np.int64)
    for i in range(0, total, _CHUNK):
        octets = hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, content`` (a hash of the text) and ``fp`` (the fingerprint as a signed long) of
    every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), dtype=np.uint64,
                                 count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(values.view(np.int64))],
                                             ["doc_id", "content", "fp"])

    return (documents.select("doc_id", content().alias("content"), "text")
            .mapInArrow(run, "doc_id long, content long, fp long"))


def content() -> Column:
    return F.xxhash64(whole_text())


def bit_groups(sample: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Bits 0 to 63 in ``parts`` groups of like size; correlated bits come together.

    A group starts with the most correlated pair left and takes the bit that correlates most with
    the group, again and again.
    """
    bits = (sample[:, None] >> np.arange(64, dtype=np.uint64)[None, :]).astype(np.uint8) & 1
    centred = bits - bits.mean(axis=0) if len(bits) else np.zeros((1, 64))
    spread = np.sqrt((centred ** 2).sum(axis=0))
    scale = np.where(spread > 0, spread, 1.0)
    near = np.abs((centred / scale).T @ (centred / scale))
    np.fill_diagonal(near, 0.0)
    left, groups = list(range(64)), []
    for size in [len(x) for x in np.array_split(np.arange(64), parts)]:
        inner = near[np.ix_(left, left)]
        group = [left[int(np.argmax(inner.max(axis=1)))]]
        left.remove(group[0])
        while len(group) < size:
            best = left[int(np.argmax(near[np.ix_(left, group)].mean(axis=1)))]
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def thresholds(sample: np.ndarray, groups: list[list[int]], rows: int, most: int = MOST_BITS) -> list[int]:
    """The threshold of each group, -1 (not probed) to ``most``.

    By the generalised pigeonhole principle a pair within ``most`` bits is within its threshold in
    some group if the thresholds sum up to ``most - len(groups) + 1``. Dynamic programming takes the
    thresholds of the least cost: rows sent to buckets plus candidates, the latter estimated from
    the sample and scaled to ``rows`` fingerprints.
    """
    scale = (rows / max(1, len(sample))) ** 2
    options = range(-1, most + 1)
    cost = []
    for group in groups:
        width = len(group)
        values = np.zeros(len(sample), dtype=np.uint64)
        for place, bit in enumerate(group):
            values |= ((sample >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
        _, counts = np.unique(values, return_counts=True)
        pairs = float((counts.astype(float) * (counts - 1) / 2).sum()) * scale
        variants = [0, 1, 1 + width, 1 + width + width * (width - 1) // 2]
        # Values d bits away are taken to be as crowded as the value itself.
        cost.append([0.0 if t < 0 else (rows + pairs) * variants[t + 1] for t in options])
    target = most - len(groups) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (paid, chosen) in best.items():
            for t, price in zip(options, own):
                if total + t not in step or paid + price < step[total + t][0]:
                    step[total + t] = (paid + price, [*chosen, t])
        best = step
    return best[target][1]


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints (column ``fp``, no repeats) that suffice to join all
    within ``MOST_BITS`` bits. Buckets up to ``FULL`` rows give all their pairs, fuller ones stars.

    Every fingerprint goes to a bucket by its value in each group of bits, and to those of the
    values up to the group's threshold away, so that the pairs sought meet in a bucket.
    """
    rows = prints.count()
    drawn = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(max(rows, 1))) < SAMPLE).toPandas()["fp"]
    sample = drawn.to_numpy(dtype=np.int64).view(np.uint64)
    groups = bit_groups(sample)
    chosen = thresholds(sample, groups, rows)
    buckets = []
    for part, (group, most) in enumerate(zip(groups, chosen)):
        flips = [0]
        if most >= 1:
            flips += [1 << i for i in group]
        if most >= 2:
            flips += [1 << i | 1 << j for i in group for j in group if i < j]
        mask = sum(1 << i for i in group)
        signed = [x - (1 << 64) if x >> 63 else x for x in (mask, *flips)]
        if most >= 0:
            variants = F.array(*[F.lit(x).cast("long") for x in signed[1:]])
            buckets.append(prints.select(
                F.lit(part).alias("part"), "fp",
                F.explode(F.transform(variants, lambda x: (F.col("fp").bitwiseXOR(x)).bitwiseAND(F.lit(signed[0]).cast("long"))))
                .alias("value")))
    placed = buckets[0]
    for more in buckets[1:]:
        placed = placed.unionByName(more)
    counts = (placed.groupBy(F.col("part").alias("_part"), F.col("value").alias("_value"))
              .agg(F.count("*").alias("n")).filter(F.col("n") > 1))
    shared = stored(placed.join(counts, (F.col("part") == F.col("_part")) & (F.col("value") == F.col("_value")))
                    .select("part", "value", "fp", "n"), "buckets")
    few = shared.filter(F.col("n") <= FULL)
    other = few.select("part", "value", F.col("fp").alias("b"))
    pairs = (few.withColumnRenamed("fp", "a").join(other, ["part", "value"])
             .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS))
             .select("a", "b"))
    full = shared.filter(F.col("n") > FULL).select("fp").distinct()
    return pairs.union(_dense(full)).distinct()


def _dense(prints: DataFrame) -> DataFrame:
    """Links among ``prints`` without comparing pairs: a fingerprint goes to itself and to its 64
    neighbours at one bit. Two meet exactly if they differ by two bits or fewer, at most 65 meet in
    one place, and all that meet are linked, so that a star from the smallest suffices."""
    around = [0, *[1 << i if i < 63 else -(1 << 63) for i in range(64)]]
    near = prints.select("fp", F.explode(F.transform(
        F.array(*[F.lit(x).cast("long") for x in around]), lambda x: F.col("fp").bitwiseXOR(x))).alias("spot"))
    met = near.groupBy("spot").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return (met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .filter(F.col("a") != F.col("b")))


def labelled(documents: DataFrame, by_overlap: bool = False) -> DataFrame:
    """``doc_id, content, fp, root, component_id`` of every document; ``root`` is the component's
    smallest fingerprint. Documents with equal fingerprints meet in an aggregate, not as pairs.
    ``by_overlap`` also links texts at a five-word Jaccard similarity of 4/5 or more."""
    rows = stored(fingerprints(documents), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = stored(classes, "classes")
    linked = links(classes.select("fp"))
    if by_overlap:
        linked = stored(linked, "links")
        linked = linked.union(overlap.links(documents, rows, linked))
    found = connected_components(linked)
    named = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = named.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    component = named.join(least, F.col("root") == F.col("_root")).select(
        F.col("fp").alias("_fp"), "root", "component_id")
    return rows.join(component, F.col("fp") == F.col("_fp")).drop("_fp")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every document.

    Documents link when their fingerprints differ by ``MOST_BITS`` bits or fewer; ``component_id``
    is the smallest doc_id that links reach, the own one included. Null and empty texts have
    fingerprint zero and link like others; null ids keep their row but are no component id unless
    all ids are null. Repeated rows give a row each, an empty table gives none; other columns are
    ignored.
    """
    return labelled(documents).select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame, by_overlap: bool = False) -> DataFrame:
    """The documents, one of each near-duplicate component: the one whose doc_id names it.
    ``by_overlap`` also links texts at a five-word Jaccard similarity of 4/5 or more.

    Where rows repeat this doc_id the one with the smallest fingerprint and content hash stays, and
    one of those that repeat these too. A component without ids keeps one row alike.
    """
    naming = labelled(documents, by_overlap).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    least = naming.groupBy("root").agg(F.min(F.struct("fp", "content", "doc_id")).alias("_kept"))
    # Joined by what also parts the copies, so that documents are shuffled once.
    keys = ["_none", "_key", "_content"]

    def placed(doc_id: Column) -> list[Column]:
        none = F.lit(0).cast(documents.schema["doc_id"].dataType)
        return [doc_id.isNull().alias("_none"), F.coalesce(doc_id, none).alias("_key")]

    kept = least.select(*placed(F.col("_kept.doc_id")), F.col("_kept.content").alias("_content"))
    copies = Window.partitionBy(*keys).orderBy(F.lit(0))
    return (documents.select("*", *placed(F.col("doc_id")), content().alias("_content")).join(kept, keys)
            .withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") == 1)
            .select(*documents.columns))
