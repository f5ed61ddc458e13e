"""Sharding by vector bin packing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prefix_sum, stored, whole_text

SHARDS = 40
# Parcels per shard. A parcel is what the packing moves: small groups share one, large groups are
# cut. Their number (SHARDS * PARCELS at most for each of three measures, twice) is all the driver sees.
PARCELS = 512
SLOT_ROWS = 5_000
OVERHEAD = 16


def pack(parcels: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each parcel (rows: bytes, tokens, rows).

    Parcels are placed from the largest to the smallest; each goes where the dot product of its
    measures with the residual capacities is highest. Both are taken as shares of the total.
    """
    total = parcels.sum(axis=0).astype(float)
    share = parcels / np.where(total > 0, total, 1)
    residual = np.full((shards, parcels.shape[1]), 1.0 / shards)
    placed = np.empty(len(parcels), dtype=np.int64)
    # Bytes weigh most: they are the measure whose balance is promised.
    emphasis = np.array([1.0, 0.05, 0.05])
    for i in np.lexsort((np.arange(len(parcels)), -share[:, 0])):
        target = int(np.argmax(residual @ (share[i] * emphasis)))
        placed[i] = target
        residual[target] -= share[i]
    return placed


def measured(documents: DataFrame, words: Column) -> DataFrame:
    """``doc_id``, the group (equal texts) and the three measures of each document, and ``_salt``: a number of its
    own, given before rows are stored, since stored files are read in any order."""
    text = whole_text()
    return documents.select(
        "doc_id", F.md5(text).alias("_group"), F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), words.alias("_tokens"),
        F.monotonically_increasing_id().alias("_salt"))


def assign(rows: DataFrame, shards: int = SHARDS, parcels: int = PARCELS) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows of ``doc_id, _group, size, _tokens, _salt`` (stored).

    Law: bytes. Shards get near equal sums of ``size``; their sums of tokens and rows are balanced
    besides. Groups stay together, unless a group alone is more than a parcel: such a group is cut
    by row, repeated rows too. ``slot`` numbers the rows of a shard without gaps from 0.

    The packing sees parcels only. Groups that hold less than a parcel's share of everything are
    dealt to ``shards * parcels`` parcels by hash; a larger group makes at most a parcel for each
    such share it holds. For three measures this bounds large groups and parcels alike. Null ids are documents like others;
    fewer documents than shards leave shards empty; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    wanted = shards * parcels
    names = ["size", "_tokens", "_rows"]
    measures = [F.sum("size").alias("size"), F.sum("_tokens").alias("_tokens"), F.count("*").alias("_rows")]
    groups = rows.groupBy("_group").agg(*measures)
    total = groups.agg(*[F.sum(c).alias(c) for c in names]).first()
    share = [max((total[c] or 0) / wanted, 1e-9) for c in names]
    cuts = F.ceil(F.greatest(*[F.col(c) / F.lit(s) for c, s in zip(names, share)])).cast("long")
    large = (groups.withColumn("_cuts", cuts).filter(F.col("_cuts") > 1)
             .select(F.col("_group").alias("_large"), F.least("_cuts", "_rows").alias("_cuts")))
    # Rows have numbers of their own: those that repeat an id and a text are parted too.
    own = F.xxhash64("_group", F.pmod(F.xxhash64("_salt"), F.col("_cuts")))
    keyed = stored(
        rows.join(F.broadcast(large), F.col("_group") == F.col("_large"), "left")
        .withColumn("_parcel", F.when(F.col("_cuts").isNotNull(), own)
                    .otherwise(F.pmod(F.xxhash64("_group"), F.lit(wanted))))
        .drop("_large", "_cuts"),
        "parcels")
    sums = keyed.groupBy("_parcel").agg(*measures).toPandas().sort_values("_parcel")
    packed = pack(sums[names].to_numpy(dtype=np.int64).reshape(-1, 3), shards)
    table = spark.createDataFrame([*zip(sums["_parcel"].tolist(), packed.tolist())], "_parcel long, shard int")
    placed = keyed.join(F.broadcast(table), "_parcel")
    per_shard = -(-int(total["_rows"] or 0) // shards)
    buckets = max(1, -(-per_shard // SLOT_ROWS))
    spread = F.pmod(F.xxhash64("_salt"), F.lit(buckets))
    numbered = prefix_sum(placed.withColumn("_bucket", spread), ["shard"], "_bucket",
                          [F.col("doc_id"), F.col("_group")], F.lit(1), "slot")
    return numbered.drop("_bucket", "_parcel", "_salt")


def shard_documents(documents: DataFrame, words: Column, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document (see ``assign``)."""
    placed = assign(stored(measured(documents, words), "sharding"), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
