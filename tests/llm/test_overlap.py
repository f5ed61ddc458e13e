import os
import random
import threading
import time

import pytest

from storelens.llm import overlap, simhash
from storelens.session import shared_dir

from .conftest import EDGE_ROWS, SF_DIR, clash, rows_of
from .test_simhash import plain_components, plain_fingerprint


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def expected(rows):
    """Components by 2 bits or a brute-force Jaccard similarity of 0.8."""
    sets, prints = [plain_shingles(t) for _, t in rows], [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            alike = 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) > 0 and 9 * len(x & y) >= 4 * (len(x) + len(y))
            if alike or bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((doc_id, least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def crowd(seed=3):
    """Near copies with words changed at both sides of the border, a passage many texts hold, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = ["", None, "one two", "One  two", "one two three four five six", "one two three four five six seven"]
    for length, copies in ((120, 90), (60, 12), (25, 12), (300, 8)):
        base = [word() for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 8]) * length // 120 or rng.choice([0, 1])):
                own[rng.randrange(length)] = word()
            texts.append(" ".join(own))
    passage = [word() for _ in range(40)]
    texts += [" ".join([word() for _ in range(rng.randrange(3, 40))] + passage) for _ in range(70)]
    return list(enumerate(texts))


class Disk:
    """The most that shuffle files and the given folder hold at a time, beyond what they held at first."""

    def __init__(self, spark, folder):
        spark._jvm.System.gc()
        time.sleep(1)
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        self.folders = [folder, *[d.getPath() for d in local]]
        self.first, self.peak, self.over = self.used(), 0, threading.Event()
        self.thread = threading.Thread(target=self.watch)

    def used(self):
        total = 0
        for folder in self.folders:
            for path, _, names in os.walk(folder):
                for name in names:
                    try:
                        total += os.path.getsize(f"{path}/{name}")
                    except OSError:  # files go meanwhile
                        pass
        return total

    def watch(self):
        while not self.over.wait(0.02):
            self.peak = max(self.peak, self.used() - self.first)

    def __enter__(self):
        self.thread.start()
        return self

    def __exit__(self, *_):
        self.over.set()
        self.thread.join()


@pytest.fixture
def no_broadcast(spark):
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


def test_sets_of_pairs_are_sent_in_parts(spark, monkeypatch, no_broadcast):
    """Groups of 10 near copies: 9 pairs for two texts, each pair with all shingles of a text."""
    rng = random.Random(7)
    texts = []
    for _ in range(120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        for _ in range(10):
            own = list(base)
            for i in rng.sample(range(400), 4):
                own[i] = f"v{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    monkeypatch.setattr(overlap, "LEAST_SENT", 10**6, raising=False)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8).cache()
    rows = simhash.fingerprints(df).cache()
    prints = {r["fp"]: r["doc_id"] // 10 for r in rows.collect()}
    with Disk(spark, shared_dir(spark)) as disk:
        links = [tuple(r) for r in overlap.links(df, rows, spark.createDataFrame([], "a long, b long")).collect()]
    rows.unpersist()
    df.unpersist()
    assert len(prints) > 1100 and all(prints[a] == prints[b] for a, b in links)
    # All pairs of a group are at 4/5 or more.
    met = [set(p for p in prints if prints[p] == g) for g in range(120)]
    assert len(set(frozenset(x) for x in links if x[0] != x[1])) == sum(len(m) * (len(m) - 1) // 2 for m in met)
    sets = 1200 * 396 * 8
    assert disk.peak < 3 * sets, disk.peak / sets


def test_documents_are_shuffled_once_for_one_of_each(spark, no_broadcast):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = simhash.one_of_each(df)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("SortMergeJoin")]
    assert "Window [" in above and "Exchange" not in above


@pytest.mark.parametrize("full", [1, 5, 32])
def test_components_agree_with_brute_force(spark, monkeypatch, full):
    rows = crowd()
    monkeypatch.setattr(overlap, "FULL", full)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = simhash.labelled(df, by_overlap=True).select("doc_id", "component_id").collect()
    want = expected(rows)
    assert sorted(tuple(r) for r in got) == want
    plain = plain_components([i for i, _ in rows], [plain_fingerprint(t) for _, t in rows])
    assert len({c for _, c in want}) < len({c for _, c in plain})


def test_near_copies_of_the_tables_leave_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
    kept = simhash.one_of_each(docs, by_overlap=True).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({c for _, c in want})
    assert len(kept) < simhash.one_of_each(docs).count()


def test_edge_rows(spark, edge):
    """Null ids and texts, repeated rows, equal ids, clashing names: copies leave one row, the others stay."""
    for table in (edge, clash(edge)):
        kept = simhash.one_of_each(table, by_overlap=True)
        assert kept.columns == table.columns
        want = [r for i, r in enumerate(EDGE_ROWS) if i in (0, 3, 6, 8, 9, 10, 11, 12)]
        texts = [r.text for r in kept.select("text").collect()]
        assert sorted(t or "" for t in texts) == sorted(r[1] or "" for r in want)


def test_empty_table(spark, empty):
    assert rows_of(simhash.one_of_each(empty, by_overlap=True)) == []


def test_crowd_under_the_border_is_linked_by_what_is_over_it(spark):
    """Copies of a text with so many changes that most pairs are just under 0.8."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for _ in range(120):
        own = list(base)
        for _ in range(rng.choice([2, 4, 4])):
            own[rng.randrange(200)] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    got = simhash.labelled(spark.createDataFrame(rows, "doc_id long, text string"), by_overlap=True)
    assert sorted(tuple(r) for r in got.select("doc_id", "component_id").collect()) == expected(rows)
