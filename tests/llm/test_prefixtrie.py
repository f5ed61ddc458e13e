"""The trie against one built turn by turn."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from storelens.llm import prefixtrie
from tests.llm.conftest import rows_of

COLUMNS = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [r[2:] for r in sorted(turns)] for c, turns in own.items()}
    nodes = {}
    for c in own:
        heads = zlib.crc32(str(c).encode()) % 9
        remainder = abs(c) % 5 * (1 if c >= 0 else -1)
        turns = tuple(own.get(c - remainder, [])[:heads] + own[c][heads:])
        for d in range(len(turns) + 1):
            node = nodes.setdefault(turns[:d], {"members": [], "ends": []})
            node["members"].append(c)
        nodes[turns]["ends"].append(c)
    out = []
    for key, node in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        children = sum(len(k) == len(key) + 1 for k in below)
        leaves = [k for k in below if not any(len(o) == len(k) + 1 and o[:len(k)] == k for o in below)]
        saved = sum((len(nodes[k]["members"]) - 1) * len(k[-1][1]) for k in below if k)
        parent = min(nodes[key[:-1]]["members"]) if key else None
        ends = ",".join(map(str, sorted(node["ends"])))
        out.append((min(node["members"]), len(key), parent, len(node["members"]), children, len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def check(spark, rows):
    table = spark.createDataFrame(rows, COLUMNS)
    assert sorted(tuple(r) for r in prefixtrie.prefix_trie(prefixtrie.rebuilt(table)).select(*NAMES).collect()) == plain(rows)


def test_random_conversations(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(conv, draw.choice([*range(6), None]), draw.choice(["user", "assistant", None]), draw.choice(["", "é", "longer text", None, "x"]))
            for conv in [*range(-12, 80), None] for _ in range(draw.randint(1, 4))]
    # Families that go on together for long, and part or end at every place of a block.
    for conv in range(100, 160):
        rows += [(conv, t, "user", f"{t}") for t in range(draw.randint(5, 15))] + [(conv, 20, "user", draw.choice("ab"))]
    rows += [(conv, t, "user", "same") for conv in range(200, 230) for t in range(17)]
    check(spark, rows)
    monkeypatch.setattr(prefixtrie, "_RUN", 2)
    check(spark, rows)


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(spark, [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_one_long_conversation_and_repeated_rows(spark):
    check(spark, [(5, t, "user", f"turn {t}") for t in range(300)] + [(10, 1, "user", "again")] * 40 + [(3, None, None, None)])


def test_turnless_conversations_are_the_root(spark):
    """Conversation 1 takes five turns of conversation 0, which isn't there, and has fewer of its own."""
    assert zlib.crc32(b"1") % 9 > 1
    rows = [(1, 0, "user", "a")]
    check(spark, rows)
    got = prefixtrie.prefix_trie(prefixtrie.rebuilt(spark.createDataFrame(rows, COLUMNS))).collect()
    assert [(r.depth, r.n_leaves, r.n_children) for r in got] == [(0, 1, 0)]


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert prefixtrie.prefix_trie(prefixtrie.rebuilt(empty)).collect() == []
    rows = [(0, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b")]
    table = spark.createDataFrame(rows, COLUMNS).withColumns(
        {n: F.lit("x") for n in ("at", "u", "v", "n", "base", "heads", "given", "depth", "x", "y", "name", "bytes")})
    got = prefixtrie.prefix_trie(prefixtrie.rebuilt(table))
    assert rows_of(got, *NAMES) == rows_of(spark.createDataFrame(plain(rows), got.select(*NAMES).schema), *NAMES)


def test_blocks_that_all_members_share_are_not_refined(spark):
    rows = [(conv, t, "user", f"{t}") for conv in (1000, 2000) for t in range(16)]
    turns = spark.createDataFrame([(c, t, t + 1, 2 * t, 1) for c, t, *_ in rows], "conv_id long, at long, u long, v long, bytes long")
    convs = turns.select("conv_id").distinct()
    units = prefixtrie._units(prefixtrie._blocks(turns), convs, 2).filter("depth > 0")
    assert {len(r.sizes) for r in units.collect()} == {prefixtrie.BLOCK} and units.count() == 8
