"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from storelens.llm import repair
from tests.llm.conftest import rows_of

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_edits(rows):
    """Least cost, audit and repaired rows of ``(role, text, fault)``, by a search that takes the cheapest
    and then the least audit first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, shape, out = heapq.heappop(heap)
        if (at, shape) in done:
            continue
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, audit, [f"{r}:{t}" for r, t in out]
        done.add((at, shape))
        steps = [(5, "I", at, role, "") for role in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((2, "D", at + 1, None, None))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                steps.append((extra, "K", at + 1, role, text))
                steps += [(1 + extra, "R", at + 1, to, text) for to in ("user", "assistant")]
        for price, edit, to, role, text in steps:
            grown = shape if role is None else shape + (role[:1] or "?")
            if re.fullmatch("s?(ua)*u?", grown):
                heapq.heappush(heap, (cost + price, audit + edit, to, grown,
                                      out if role is None else (*out, (role, text))))


def plain(rows):
    """The contract, row by row. ``rows`` holds ``conv_id, turn, role, text``."""
    result = []
    for conv in dict.fromkeys(r[0] for r in rows):
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            name = ":".join(" " if v is None else str(v) for v in (conv, turn))
            role, text = (" " if v is None else v for v in (role, text))
            harm = zlib.crc32(name.encode()) % 20
            if harm == 0:
                continue
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            kept += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            if not text.strip(SPACES):
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if text.strip(SPACES)[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, *_ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, lines = plain_edits([(r, t, f) for (_, r, t), f in zip(kept, faults)])
        result.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=lambda r: (r[0] is not None, r[0] or 0))


COLUMNS = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows):
    found = rows_of(repair.repaired_conversations(spark.createDataFrame(rows, COLUMNS)), *NAMES)
    assert found == plain(rows)


def test_random_conversations(spark, monkeypatch):
    draw = random.Random(5)
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", "sys", None, "User"]
    texts = ["a.", "b!", "c?", "end", "", " \n", None, "é.\x0b", "dots ... no", "x. "]
    rows = [(conv, draw.choice([*range(9), None]), draw.choice(roles), draw.choice(texts))
            for conv in [*range(300), None, -7] for _ in range(draw.randint(1, 9))]
    check(spark, rows)
    # Conversations of several pieces give the same.
    monkeypatch.setattr(repair, "PIECE", 3)
    check(spark, rows)


def test_long_conversation_and_repeated_rows(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(400)]
    rows += [(2, 0, "user", "same."), *[(2, 1, "assistant", "same.")] * 150, (3, None, None, None)]
    check(spark, rows)


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(repair.repaired_conversations(table), *NAMES) == plain(rows)


def test_matrices_of_rules_agree_with_single_rows():
    """Any grammar over a sequence gives the matrix of its symbols."""
    base = repair.symbols()
    names = list(base)
    draw = random.Random(3)
    for _ in range(60):
        word = [draw.choice(names) for _ in range(6)]
        whole = base[word[0]]
        for name in word[1:]:
            whole = repair.together(whole, base[name])
        rules = [("x", (word[0], word[1])), ("y", (word[3], word[4])), ("z", ("y", word[5]))]
        parts = repair.parts_of(rules)
        other = repair.together(repair.together(parts["x"], parts[word[2]]), parts["z"])
        flat = [{k: (c, repair.text_of(a)) for k, (c, a) in p.matrix.items()} for p in (whole, other)]
        assert flat[0] == flat[1] and whole[1:] == other[1:]


@pytest.mark.parametrize("roles", list(itertools.product("sua?", repeat=3)))
def test_short_sequences(roles):
    named = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}
    for faults in itertools.product(["", "blank", "truncated"], repeat=3):
        base = repair.symbols()
        part = None
        for role, fault in zip(roles, faults):
            one = base[chr(repair.FIRST + 4 * repair.ROLES.index(role) + repair.FAULTS.index(fault))]
            part = one if part is None else repair.together(part, one)
        cells = [{"i": i, "j": j, "cost": c, "audit": repair.text_of(a)} for (i, j), (c, a) in part.matrix.items()]
        cost, found = repair._chosen([{"cells": cells}])
        want = plain_edits([(named[r], "x.", f) for r, f in zip(roles, faults)])
        assert (cost, found[0][1]) == want[:2]


def test_empty_table_and_other_columns(spark):
    assert repair.repaired_conversations(spark.createDataFrame([], COLUMNS)).collect() == []
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b.")]
    table = spark.createDataFrame(rows, COLUMNS).withColumns(
        {n: F.lit("x") for n in ("at", "piece", "seq", "cost", "audit", "_harm", "data", "key")})
    assert rows_of(repair.repaired_conversations(table), *NAMES) == plain(rows)
