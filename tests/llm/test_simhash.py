import random
import re
import time

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from storelens.llm import simhash
from storelens.llm.components import connected_components
from storelens.session import prepare

from .conftest import clash, rows_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        r = find(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(doc_id, least.get(find(i))) for i, doc_id in enumerate(ids)]


@pytest.mark.parametrize("table", ["edge", "documents", "empty"])
def test_agrees_with_plain_version(request, table):
    df = request.getfixturevalue(table)
    rows = df.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    want = plain_components([r["doc_id"] for r in rows], prints)
    out = simhash.near_duplicates(df)
    order = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted([tuple(r) for r in out.select("doc_id", "component_id").collect()], key=order) == sorted(want, key=order)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    assert sorted(r["fp"] for r in out.collect()) == sorted(signed)


def crowded(seed=5):
    """Fingerprints in chains and crowds, so that buckets fill up."""
    rng = random.Random(seed)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(150):
            value = centre
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6, 20])):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    return [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]


@pytest.mark.parametrize("parts", [1, 2, 3, 4, 5])
def test_links_join_all_within_two_bits(spark, monkeypatch, parts):
    prints = crowded()
    monkeypatch.setattr(simhash, "FULL", 5 if parts % 2 else 64)
    monkeypatch.setattr(simhash.bit_groups, "__defaults__", (parts,))
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    pairs = [tuple(r) for r in links.collect()]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 for a, b in pairs)
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    want = dict(plain_components(prints, [p & (1 << 64) - 1 for p in prints]))
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(edge, documents):
    for df in (edge, documents, clash(edge)):
        out = simhash.one_of_each(df)
        assert out.columns == df.columns
        want = [r["component_id"] for r in simhash.labelled(df).select("root", "component_id").distinct().collect()]
        assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted(want, key=str)


def test_thresholds_spend_the_budget():
    import numpy as np

    sample = np.arange(500, dtype=np.uint64)
    for parts in (1, 2, 3, 4, 6):
        groups = simhash.bit_groups(sample, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(simhash.thresholds(sample, groups, 10**6)) == 2 - parts + 1


def test_discard_frees_shuffle_files(spark):
    from storelens.llm.common import discard, stored

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).endswith(".data")}

    before = files()
    frames = [stored(spark.range(20_000).groupBy((F.col("id") % n).alias("k")).count(), "counted") for n in (9_000, 8_000)]
    mine = files() - before
    assert mine
    for frame in frames:
        discard(frame)
    until = time.monotonic() + 5
    while files() & mine and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() & mine


def test_batches_for_python_are_small(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    prepare(spark)
    rows = spark.range(0, 240, numPartitions=1).select(F.repeat(F.lit("x"), F.lit(100_000)).alias("text"))
    found = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 24_000_000 and max(found) <= 5 << 20
