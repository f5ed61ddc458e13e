"""Prefix trie of conversations by digests of blocks of turns.

Conversations are grouped by the digests of their blocks of ``BLOCK`` turns, one block after the other. Where
all members of a group go on with the same block, its turns have the same members and are written down
without being looked at; only the turns of blocks in which members part, or end, get a digest of their
own. A digest covers all turns so far and is the exclusive or of the hashes of its turns with their places
(two words of 64 bits), so that the turns of one conversation need not be in one task.

A node bears the name of its smallest member. Along a conversation this name never falls, so that the
nodes named after a conversation are a last part of it, and what lies below a node is what is named after
its members: subtrees are summed up without walking the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prefix_sum, stored
from .ordered import numbered, pieces, prefix_xor, sha256_of

BLOCK = 4
# Turns of a conversation that are ordered in one task when values are summed along it.
_RUN = 1024
_ID = ["depth", "x", "y"]


def rebuilt(conversations: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """``conv_id, at, u, v, bytes`` of all turns of the rebuilt conversations, and a row with null ``at`` for
    each conversation.

    A conversation c begins with the first turns of conversation ``c - c % every``, as many as the
    checksum of c modulo ``most`` (all if it has fewer), and goes on with its own after as many. Turns are
    ordered by turn (null first), then role and text; null roles and texts are empty. Rows without
    conv_id belong to no conversation. ``u, v`` are hashes of role and text, ``bytes`` the length of the text.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = (conversations.filter(F.col("conv_id").isNotNull())
            .select("conv_id", "turn", role.alias("role"), text.alias("text"))
            .select("conv_id", "turn", "role", "text", *_hashes("role", "text"), F.octet_length("text").cast("long").alias("bytes")))
    # Equal hashes are equal turns, so that texts need not be kept: they order the turns only.
    turns = numbered(rows, "conv_id", ["turn", "role", "text"]).select("conv_id", "at", "u", "v", "bytes")
    turns = stored(turns, "turns")
    all_of = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = F.crc32(F.col("conv_id").cast("string")) % most
    known = all_of.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"))
    plans = stored(all_of.select("conv_id", base.alias("base"), heads.alias("heads"))
                   .join(known, F.col("base") == F.col("_base"), "left")
                   .select("conv_id", "base", "heads", F.least("heads", F.coalesce("_n", F.lit(0))).alias("given")), "plans")
    first = turns.filter(F.col("at") < most).withColumnRenamed("conv_id", "_base")
    taken = (plans.filter("given > 0").join(first, (F.col("base") == F.col("_base")) & (F.col("at") < F.col("given")))
             .select("conv_id", "at", "u", "v", "bytes"))
    moved = plans.select(F.col("conv_id").alias("_conv"), "heads", "given")
    own = (turns.join(moved, F.col("conv_id") == F.col("_conv")).filter(F.col("at") >= F.col("heads"))
           .select("conv_id", (F.col("at") - F.col("heads") + F.col("given")).alias("at"), "u", "v", "bytes"))
    none = F.lit(None).cast("long")
    every_one = plans.select("conv_id", *[none.alias(n) for n in ("at", "u", "v", "bytes")])
    return taken.unionByName(own).unionByName(every_one)


def _hashes(role: str, text: str) -> list[Column]:
    """Two words of the MD5 of role and text; the length of the role parts them."""
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), F.col(role), F.col(text)))
    return [F.conv(F.substring(digest, 1 + 16 * i, 15), 16, 10).cast("long").alias(n) for i, n in enumerate("uv")]


def _placed(turns: Column, which: int) -> Column:
    """The first or second hashes of turns at their places."""
    if which == 0:
        return F.transform(turns, lambda t: F.xxhash64(t["at"], t["u"], t["v"]))
    return F.transform(turns, lambda t: F.xxhash64(t["v"], t["at"], t["u"], F.lit(12)))


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def _blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, turns`` (in order), the digests ``a, b`` before the block and ``x, y`` after it."""
    rows = (turns.groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("at", "u", "v", "bytes"))).alias("turns")))
    own = rows.withColumns({f"own_{i}": _xor(_placed(F.col("turns"), i)) for i in range(2)})
    placed = prefix_xor(own, "conv_id", "block", {"a": "own_0", "b": "own_1"}, _RUN)
    return stored(placed.select("conv_id", "block", "turns", "a", "b", F.col("a").bitwiseXOR(F.col("own_0")).alias("x"),
                                F.col("b").bitwiseXOR(F.col("own_1")).alias("y")), "blocks")


def _units(blocks: DataFrame, convs: DataFrame, total: int) -> DataFrame:
    """A row for each member of each unit: a whole block that its group goes through together, or a single
    turn where members part. ``depth, x, y`` are of its last node, ``above, p, q`` of the node before
    its first; ``sizes`` has the bytes of each node."""
    whole = blocks.filter(F.size("turns") == BLOCK)
    groups = stored(whole.groupBy("block", "x", "y").agg(F.count("*").alias("n"), F.first("a").alias("a"), F.first("b").alias("b")), "groups")
    before = groups.select((F.col("block") + 1).alias("_next"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("n").alias("_n"))
    same = (F.col("block") == F.col("_next")) & (F.col("a") == F.col("_x")) & (F.col("b") == F.col("_y"))
    among = F.when(F.col("block") == 0, F.lit(total)).otherwise(F.col("_n"))
    straight = (groups.join(before, same, "left").filter(F.col("n") == among)
                .select(F.col("block").alias("_block"), F.col("x").alias("_x"), F.col("y").alias("_y")))
    met = (F.col("block") == F.col("_block")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))
    found = blocks.join(straight, met, "left").select(*blocks.columns, F.col("_block").isNotNull().alias("together"))
    top = F.col("block") * BLOCK
    sizes = F.transform("turns", lambda t: t["bytes"])
    long = found.filter("together").select("conv_id", (top + BLOCK).alias("depth"), "x", "y", top.alias("above"),
                                           F.col("a").alias("p"), F.col("b").alias("q"), sizes.alias("sizes"))

    def upto(i: Column, which: int, start: str) -> Column:
        return F.col(start).bitwiseXOR(_xor(_placed(F.slice("turns", F.lit(1), i), which)))

    single = F.explode(F.transform(F.sequence(F.lit(1), F.size("turns")), lambda i: F.struct(
        (top + i).alias("depth"), upto(i, 0, "a").alias("x"), upto(i, 1, "b").alias("y"), (top + i - 1).alias("above"),
        upto(i - 1, 0, "a").alias("p"), upto(i - 1, 1, "b").alias("q"),
        F.array(F.element_at("turns", i)["bytes"]).alias("sizes"))))
    short = found.filter("not together").select("conv_id", single.alias("u")).select("conv_id", "u.*")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y"), none.alias("above"),
                        none.alias("p"), none.alias("q"), F.array(zero).alias("sizes"))
    return stored(long.unionByName(short).unionByName(root), "units")


def _ends(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """The node in which each conversation ends."""
    last = F.max(F.struct("block", F.size("turns").alias("n"), "x", "y"))
    found = blocks.groupBy(F.col("conv_id").alias("_conv")).agg(last.alias("last"))
    zero = F.lit(0).cast("long")
    depth = F.col("last.block") * BLOCK + F.col("last.n")
    return stored(convs.join(found, F.col("conv_id") == F.col("_conv"), "left").select(
        "conv_id", F.coalesce(depth, zero).alias("depth"), F.coalesce("last.x", zero).alias("x"),
        F.coalesce("last.y", zero).alias("y")), "ends")


def _on(mark: str) -> Column:
    return (F.col("depth") == F.col(f"_depth{mark}")) & (F.col("x") == F.col(f"_x{mark}")) & (F.col("y") == F.col(f"_y{mark}"))


def _key(mark: str, columns: list[str] = _ID) -> list[Column]:
    return [F.col(c).alias(f"_{n}{mark}") for c, n in zip(columns, _ID)]


def _paid(rows: DataFrame) -> DataFrame:
    """``paid``: what each node of a unit saves."""
    return rows.withColumn("paid", F.transform("sizes", lambda s: (F.col("n") - 1) * s))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie over ``rebuilt`` conversations: ``conv_id`` (its smallest member), ``depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    The root is the node of depth 0, without parent; conversations without turns end there.
    ``saved_tokens`` sums, over the subtree, the bytes of each node's turn that all members but one need not
    store. Without conversations there are no rows.
    """
    turns = stored(turns, "rebuilt")
    convs = turns.filter(F.col("at").isNull()).select("conv_id")
    blocks = _blocks(turns.filter(F.col("at").isNotNull()))
    units = _units(blocks, convs, convs.count())
    ends = _ends(blocks, convs)
    nodes = stored(_paid(units.groupBy(*_ID).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("name"), F.first("sizes").alias("sizes"), F.first("above").alias("above"),
        F.first("p").alias("p"), F.first("q").alias("q"))), "nodes")

    # Leaves are nodes in which all members end; each counts for the conversation that names it.
    ending = stored(ends.groupBy(*_ID).agg(F.count("*").alias("_ending")), "ending")
    leaf = nodes.join(ending.select(*_key("e"), "_ending"), _on("e"), "left").select(
        "name", F.when(F.col("n") == F.col("_ending"), 1).otherwise(0).alias("leaf"), _total(F.col("paid")).alias("paid"))
    named = leaf.groupBy("name").agg(F.sum("leaf").alias("leaves"), F.sum("paid").alias("named"))
    below = (units.join(named, F.col("conv_id") == F.col("name"), "left").groupBy(*_ID)
             .agg(F.sum(F.coalesce("leaves", F.lit(0))).alias("leaves"), F.sum(F.coalesce("named", F.lit(0))).alias("all_named")))

    # What is named after the same conversation but lies above isn't part of the subtree.
    ordered = nodes.withColumn("_run", F.floor(F.col("depth") / _RUN))
    above = prefix_sum(ordered, ["name"], "_run", [F.col("depth")], _total(F.col("paid")), "over").drop("_run")

    children = (nodes.filter(F.col("above").isNotNull()).groupBy("above", "p", "q").agg(F.count("*").alias("children"))
                .select(*_key("c", ["above", "p", "q"]), "children"))
    parents = nodes.select(*_key("p"), F.col("name").alias("parent"))
    sums = sha256_of(pieces(ends.withColumn("data", F.encode(F.col("conv_id").cast("string"), "utf-8")), _ID, ["conv_id"], "data", b","),
                     _ID, ["part", "no"], "data", b",")
    on_parent = ((F.col("above") == F.col("_depthp")) & (F.col("p") == F.col("_xp")) & (F.col("q") == F.col("_yp")))
    whole = (above.join(below.select(*_key("b"), "leaves", "all_named"), _on("b"))
             .join(children, _on("c"), "left").join(parents, on_parent, "left")
             .join(sums.select(*_key("s"), "sha256"), _on("s"), "left"))
    size, i = F.size("sizes"), F.col("i")
    last = i == size - 1
    spread = whole.select("*", F.posexplode("paid").alias("i", "_own"))
    earlier = _total(F.slice("paid", F.lit(1), i))
    return spread.select(
        F.col("name").alias("conv_id"), (F.col("depth") - size + 1 + i).alias("depth"),
        F.when(i == 0, F.col("parent")).otherwise(F.col("name")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("all_named") - F.col("over") - earlier).alias("saved_tokens"),
        F.when(last & F.col("sha256").isNotNull(), F.col("sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"))
