"""Repair of conversations: the cheapest edits that give a well-formed sequence of roles.

Every row becomes a symbol of its role and its fault. What rows can do to a sequence of roles is a
min-plus matrix over four states, each cell the cheapest edits and their audit. Symbols that often stand
together get a rule of a grammar (Re-Pair, over the sequences of all conversations), and the matrix of a
rule is the product of those of its two parts. So sequences are evaluated bottom-up, each
different one once, and conversations share what they have in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, zip_longest
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .ordered import numbered, sha256_of

# Cost of each edit, and what a truncated row adds that isn't deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States of a sequence of roles: nothing yet, a system row, a user row last, an assistant row last. It may
# end with nothing or with an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
ROLES, FAULTS = "sua?", ("", "blank", "duplicate", "truncated")
# Symbols of rows from here on, sixteen of them, then those of rules.
FIRST = 0x41
FIRST_RULE = 0x4E00
# Rows of a piece of a conversation; rounds of rules and rules of a round. They decide costs, not results.
PIECE, ROUNDS, RULES = 64, 4, 24
MARKS = r"[^\x20\x09-\x0D]"

Rope = str | tuple
Cell = tuple[int, Rope]
Matrix = dict[tuple[int, int], Cell]


class Part(NamedTuple):
    """What a symbol or a rule stands for: edits, and what its rows are counted for."""

    matrix: Matrix
    faults: tuple[int, int, int]
    illegal: int
    first: str
    last: str


def leaves(rope: Rope) -> Iterator[str]:
    """The texts of a rope in order."""
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += [top[1], top[0]]


def text_of(rope: Rope) -> str:
    return "".join(leaves(rope))


def _joined(left: Rope, right: Rope) -> Rope:
    if not left or not right:
        return left or right
    return left + right if isinstance(left, str) and isinstance(right, str) and len(left) + len(right) <= 16 else (left, right)


def _before(left: Rope, right: Rope) -> bool:
    if left is right:
        return False
    for a, b in zip_longest(chain.from_iterable(leaves(left)), chain.from_iterable(leaves(right)), fillvalue=""):
        if a != b:
            return a < b
    return False


def better(new: Cell, old: Cell | None) -> bool:
    """Cheaper, or as cheap with the lesser audit. Equally cheap audits of the same rows are never a
    beginning of each other, so that what is better stays so when the same edits are added."""
    return old is None or new[0] < old[0] or (new[0] == old[0] and _before(new[1], old[1]))


def product(left: Matrix, right: Matrix) -> Matrix:
    """First the edits of ``left``, then those of ``right``."""
    out: Matrix = {}
    for (i, j), (cost, audit) in left.items():
        for k in range(4):
            more = right.get((j, k))
            if more is None:
                continue
            old = out.get((i, k))
            if old is None or cost + more[0] <= old[0]:
                new = cost + more[0], _joined(audit, more[1])
                if better(new, old):
                    out[i, k] = new
    return out


def inserts() -> Matrix:
    """Any rows put in between others."""
    out: Matrix = {(i, i): (0, "") for i in range(4)}
    for i in (START, SYSTEM, ASSISTANT):
        out[i, USER] = INSERT, "I"
        if i != ASSISTANT:
            out[i, ASSISTANT] = 2 * INSERT, "II"
    out[USER, ASSISTANT] = INSERT, "I"
    return out


def edits(role: str, fault: str) -> Matrix:
    """What may become of a row."""
    out: Matrix = {(i, i): (DELETE, "D") for i in range(4)}
    if fault in ("blank", "duplicate"):
        return out
    added = TRUNCATED if fault else 0
    steps = {"s": [(START, SYSTEM)], "u": [(i, USER) for i in (START, SYSTEM, ASSISTANT)], "a": [(USER, ASSISTANT)]}
    for to, moves in steps.items():
        for move in moves:
            if to == role:
                out[move] = KEEP + added, "K"
            elif to != "s":
                out[move] = REROLE + added, "R"
    return out


def _legal(first: str, second: str) -> bool:
    return first + second in ("su", "ua", "au")


def together(left: Part, right: Part) -> Part:
    return Part(product(left.matrix, right.matrix), tuple(a + b for a, b in zip(left.faults, right.faults)),
                left.illegal + right.illegal + (not _legal(left.last, right.first)), left.first, right.last)


def symbols() -> dict[str, Part]:
    """Parts of the sixteen symbols; rows may be inserted before each."""
    out = {}
    for r, role in enumerate(ROLES):
        for f, fault in enumerate(FAULTS):
            out[chr(FIRST + 4 * r + f)] = Part(product(inserts(), edits(role, fault)),
                                               tuple(int(fault == name) for name in FAULTS[1:]), 0, role, role)
    return out


def parts_of(rules: list[tuple[str, tuple[str, str]]]) -> dict[str, Part]:
    """Parts of all symbols and rules, bottom-up."""
    out = symbols()
    for symbol, (first, second) in rules:
        out[symbol] = together(out[first], out[second])
    return out


def symbol(role: Column, blank: Column, duplicate: Column, truncated: Column) -> Column:
    kind = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    fault = F.when(blank, 1).when(duplicate, 2).when(truncated, 3).otherwise(0)
    return F.char(F.lit(FIRST) + 4 * kind + fault)


def grammar(sequences: DataFrame) -> tuple[list[tuple[str, tuple[str, str]]], DataFrame]:
    """Rules over the column ``seq`` (counted by ``n``), and the sequences with ``coded``, their shorter form.

    Re-Pair in rounds: the most frequent pairs of neighbours over all sequences get a rule each and are
    replaced from the left. The driver sees ``RULES`` pairs a round.
    """
    rules: list = []
    coded = sequences.withColumn("coded", F.col("seq"))
    for _ in range(ROUNDS):
        at = F.sequence(F.lit(1), F.length("coded") - 1)
        pairs = F.when(F.length("coded") > 1, F.transform(at, lambda i: F.substr("coded", i, F.lit(2))))
        found = (coded.select("n", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("n").alias("times"))
                 .filter("times > 1").orderBy(F.col("times").desc(), "pair").limit(RULES).collect())
        if not found:
            break
        changed = F.col("coded")
        for row in found:
            name = chr(FIRST_RULE + len(rules))
            rules.append((name, tuple(row.pair)))
            changed = F.replace(changed, F.lit(row.pair), F.lit(name))
        coded = stored(coded.withColumn("coded", changed), "coded")
    return rules, coded


_SOLVED = ("seq string, blank long, duplicate long, truncated long, illegal long, first string, last string, "
           "cells array<struct<i:int,j:int,cost:long,audit:string>>")
_CELLS = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def evaluated(coded: DataFrame, rules: list) -> DataFrame:
    """Every different sequence with its counts and the cells of its matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parts_of(rules)
        for batch in batches:
            out = []
            for seq, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = reduce(together, map(known.__getitem__, code))
                cells = [{"i": i, "j": j, "cost": cost, "audit": text_of(rope)} for (i, j), (cost, rope) in part.matrix.items()]
                out.append((seq, *part.faults, part.illegal, part.first, part.last, cells))
            kinds = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), _CELLS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    names = [p.split()[0] for p in _SOLVED.split(", ")]
    return coded.select("seq", "coded").mapInArrow(run, _SOLVED)


def _chosen(pieces: list[dict]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a conversation, and for each of its pieces the state it begins in and its audit."""
    closing, states, back = inserts(), {START: (0, "")}, []
    for piece in pieces:
        ways: dict[int, tuple[Cell, int, str]] = {}
        for cell in piece["cells"]:
            i, k = cell["i"], cell["j"]
            if i not in states:
                continue
            new = states[i][0] + cell["cost"], _joined(states[i][1], cell["audit"])
            if k not in ways or better(new, ways[k][0]):
                ways[k] = new, i, cell["audit"]
        back.append(ways)
        states = {k: way[0] for k, way in ways.items()}
    best = None
    for (i, k), (cost, audit) in closing.items():
        if k in ENDS and i in states:
            new = states[i][0] + cost, _joined(states[i][1], audit)
            if best is None or better(new, best[0]):
                best = new, i, audit
    (cost, _), state, tail = best
    found = []
    for ways in reversed(back):
        _, begin, audit = ways[state]
        found.append((begin, audit + tail))
        state, tail = begin, ""
    return cost, found[::-1]


_RESULT = ("conv_id long, piece long, begin int, audit string, cost long, whole string, gaps long, blank long, duplicate long, "
           "truncated long, illegal long")
_RESULT_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 5]


def _conversation(key: int | None, pieces: list[dict]) -> Iterator[tuple]:
    cost, found = _chosen(pieces)
    turns, last = 0, None
    for p in pieces:
        # A turn that two pieces share counts once.
        turns += p["turns"] - (last is not None and p["turns"] > 0 and p["least"] == last)
        last = p["most"] if p["turns"] else last
    least = min((p["least"] for p in pieces if p["turns"]), default=None)
    gaps = last - least + 1 - turns if least is not None else 0
    sums = [sum(p[n] for p in pieces) for n in ("blank", "duplicate", "truncated", "illegal")]
    sums[3] += sum(not _legal(a["last"], b["first"]) for a, b in zip(pieces, pieces[1:]))
    for n, (piece, (begin, audit)) in enumerate(zip(pieces, found)):
        of_all = (cost, "".join(a for _, a in found), gaps, *sums) if n == 0 else (None,) * 7
        yield (key, piece["piece"], begin, audit, *of_all)


def solved(pieces: DataFrame) -> DataFrame:
    """The audit of every piece and the state it begins in; at the first piece of a conversation what holds
    for the whole. A task takes the pieces of a conversation one after another, without texts."""
    names = [p.split()[0] for p in _RESULT.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RESULT_KINDS)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != key:
                    out += _conversation(key, held)
                    held = []
                key = row["conv_id"]
                held.append(row)
            if out:
                yield packed(out)
                out = []
        if held:
            yield packed(list(_conversation(key, held)))

    return (pieces.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "piece")
            .mapInArrow(run, _RESULT))


def _lines(role_texts: list[dict], begin: int, audit: str) -> str | None:
    """The repaired rows of a piece, or null if none is left."""
    rows, state, out = iter(role_texts), begin, []
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        wanted = ASSISTANT if state == USER else USER
        row = {"role": "", "text": ""} if edit == "I" else next(rows)
        if edit == "K":
            role = row["role"]
            wanted = SYSTEM if role.startswith("s") else wanted
        else:
            role = "assistant" if wanted == ASSISTANT else "user"
        out.append(f"{role}:{row['text']}")
        state = wanted
    return "\n".join(out) if out else None


def _repaired(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, begins, audits, texts = batch.columns
            for i in range(batch.num_rows):
                data = _lines(texts[i].as_py(), begins[i].as_py(), audits[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, 1), numbers.slice(i, 1), pa.array([data.encode() if data is not None else None], pa.binary())],
                    ["conv_id", "piece", "data"])

    return rows.select("conv_id", "piece", "begin", "audit", "rows").mapInArrow(run, "conv_id long, piece long, data binary")


def repair(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every
    conversation of rows ``conv_id, turn, role, text``.

    Rows are taken by turn (nulls first), then role and text. Null roles and texts count as one
    space; rows without an id are one conversation of a null id. Repeated rows are duplicates. An
    empty table gives no rows; other columns are ignored.
    """
    space = {c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")}
    rows = turns.select("conv_id", "turn", "role", "text").withColumns(space)
    placed = stored(numbered(rows, "conv_id", ["turn", "role", "text"])
                    .withColumn("piece", F.floor(F.col("at") / PIECE)), "turns")
    firsts = (placed.groupBy("conv_id", "role", F.md5("text")).agg(F.min("at").alias("_at"))
              .select(F.col("conv_id").alias("_conv"), "_at"))
    last = F.regexp_extract("text", rf"({MARKS})[\x20\x09-\x0D]*\z", 1)
    marks = placed.select("conv_id", "at", "piece", "turn", F.substr("role", F.lit(1), F.lit(1)).alias("initial"), last.alias("last"))
    found = marks.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("at") == F.col("_at")), "left")
    own = symbol(F.col("initial"), F.col("last") == "", F.col("_at").isNull(), ~F.col("last").isin(".", "!", "?"))
    pieces = (found.groupBy("conv_id", "piece").agg(
        F.array_sort(F.collect_list(F.struct("at", "turn", own.alias("own")))).alias("_all"),
        F.min("turn").alias("least"), F.max("turn").alias("most"))
        .select("conv_id", "piece", "least", "most",
                F.size(F.array_compact(F.array_distinct("_all.turn"))).cast("long").alias("turns"),
                F.array_join("_all.own", "").alias("seq")))
    pieces = stored(pieces, "pieces")
    rules, coded = grammar(stored(pieces.groupBy("seq").agg(F.count("*").alias("n")), "sequences"))
    done = stored(solved(pieces.join(evaluated(coded, rules), "seq").drop("seq")), "solved")
    texts = placed.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("rows"))
    keyed = done.select(F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"), "begin", "audit")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    digests = sha256_of(_repaired(texts.join(keyed, same)), ["conv_id"], ["piece"], "data", b"\n")
    digests = digests.select(F.col("conv_id").alias("_conv"), "sha256")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (done.filter(F.col("piece") == 0).join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
            .select("conv_id", *counts, F.col("whole").alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, by the checksum of their id and turn (a null stands for one space): one in
    twenty each is dropped, emptied, loses its end marks, is repeated, becomes the user's."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name) % 20).alias("_harm"))
    harm = F.col("_harm")
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.filter(harm != 0).select("conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
                                          text.alias("text"), F.explode(times).alias("_time")).drop("_time"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every conversation. One that has lost all its rows has
    zeros, an empty audit and the digest of an empty text."""
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    found = repair(damaged(conversations))
    kept = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return kept.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zero],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
