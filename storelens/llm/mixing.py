"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prefix_sum, stored, whole_text

# Word of a text: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
MOST_EPOCHS = 3
# Sampling weights are clipped to this range, which bounds the rows of a key bucket.
LEAST_WEIGHT, MOST_WEIGHT = 0.25, 1.0
BUCKET_ROWS = 2_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for texts of six characters a word (white space included), less on both sides."""
    per_word = F.length(text) / size.cast("double")
    return F.when(size > 0, 1.0 / (1.0 + F.abs(per_word - 6.0) / 6.0)).otherwise(1.0)


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) that a document keeps in every run: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 4503599627370496.0


def source_targets(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """``source, source_size`` (a row per source) with ``target``.

    Sources by code point, null last, weigh 1 to ``cycle``, repeating. The targets share the sum of
    all sizes by weight; no target exceeds ``MOST_EPOCHS`` times its source's size, and what is
    above goes to the others by weight until none is above.

    Sorted by size per weight, the sources at their limit come first: one is at its limit when an
    equal share of what the sources before it leave would pass it.
    """
    every = Window.partitionBy(F.lit(1))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    by_room = every.orderBy(F.col("source_size") / F.col("_weight"), F.col("source").asc_nulls_last())
    limit = F.col("source_size") * MOST_EPOCHS
    total = F.sum("source_size").over(every)
    taken = F.coalesce(F.sum(limit).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    free = F.col("_limited") == F.lit(False)
    left = F.col("_all") - F.coalesce(F.sum(F.when(~free, limit)).over(every), F.lit(0))
    weights = F.sum(F.when(free, F.col("_weight"))).over(every)
    return (
        sources
        .withColumn("_weight", (F.row_number().over(by_name) - 1) % cycle + 1)
        .withColumn("_all", total)
        .withColumn("_share", (F.col("_all") - taken).cast("double") / rest.cast("double"))
        .withColumn("_limited", limit.cast("double") <= F.col("_share") * F.col("_weight"))
        .withColumn("_part", left.cast("double") / weights.cast("double"))
        .withColumn("target", F.when(F.col("_limited"), limit.cast("double"))
                    .otherwise(F.col("_part") * F.col("_weight")))
        .drop("_weight", "_all", "_share", "_limited", "_part")
    )


def mix(rows: DataFrame) -> DataFrame:
    """Adds ``source_size, target, copies, taken`` to rows of ``source, size, weight, uniform``.

    ``copies`` is how often the mix takes a document and ``taken`` the words this makes. Every
    source first gives as many complete epochs as its target holds. The rest comes from documents
    in the order of the exponential keys ``-ln(uniform) / weight``, their sizes summed up; the
    document that crosses the budget is taken if this ends nearer to it. Sources end within half a
    document of their target.

    Null sources are a source of their own. Documents without words count 0 words and follow the
    same order. Equal keys are ordered by ``doc_id`` and size; rows that agree in these are
    interchangeable. An empty table gives an empty result. Other columns pass through unless
    they bear the name of a result.

    The keys are cut into buckets of about ``BUCKET_ROWS`` rows per source by the distribution
    function of the heaviest-tailed key, so that no task orders a whole source.
    """
    made = ["source_size", "target", "copies", "taken"]
    weight = F.least(F.lit(MOST_WEIGHT), F.greatest(F.lit(LEAST_WEIGHT), F.coalesce(F.col("weight"), F.lit(MOST_WEIGHT))))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    targets = source_targets(sources).withColumnRenamed("source", "_source")
    keyed = (
        rows.drop(*made)
        .join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("_key", -F.log(F.col("uniform")) / weight)
        .withColumn("_bucket", F.floor(F.ceil(F.col("_rows") / BUCKET_ROWS)
                                       * (1 - F.exp(-LEAST_WEIGHT * F.col("_key")))))
        .drop("_rows")
    )
    ahead = prefix_sum(keyed, ["source"], "_bucket", [F.col("_key"), F.col("doc_id"), F.col("size")],
                       F.col("size"), "_ahead")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.col("target") - F.col("_epochs") * F.col("source_size")
    crossing = (2 * F.col("_ahead") + F.col("size")).cast("double") < 2.0 * budget
    return (
        ahead.withColumn("_epochs", epochs)
        .withColumn("copies", F.col("_epochs") + crossing.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_key", "_bucket", "_ahead", "_epochs")
    )


def measured(documents: DataFrame) -> DataFrame:
    """``doc_id, source, size, weight, uniform`` of documents, without their texts."""
    text = whole_text()
    return (
        documents.select("doc_id", "source", text.alias("_text"), word_count(text).alias("size"))
        .select("doc_id", "source", "size",
                quality_weight(F.col("_text"), F.col("size")).alias("weight"),
                uniform(F.col("doc_id"), F.col("_text")).alias("uniform"))
    )


def mix_documents(documents: DataFrame) -> DataFrame:
    """The mix of whole documents: ``doc_id, size, source_size, target, copies, taken``."""
    return mix(stored(measured(documents), "mixing")).select(
        "doc_id", "size", "source_size", "target", "copies", "taken")


def mixed_documents(documents: DataFrame) -> DataFrame:
    """Documents as often as the mix takes them, in the columns of ``documents``.

    The mix is planned without texts and joined to the documents by id and content; rows that
    agree in both are numbered and share what the mix takes of them.
    """
    plan = mix(stored(measured(documents), "mixing")).filter(F.col("copies") > 0)
    plan = plan.select(
        F.col("doc_id").alias("_mix_id"), F.col("uniform").alias("_mix_uniform"), F.col("copies").alias("_mix_copies"),
        F.row_number().over(Window.partitionBy("doc_id", "uniform").orderBy(F.col("copies").desc()))
        .alias("_mix_nth"))
    chosen = documents.withColumn("_uniform", uniform(F.col("doc_id"), whole_text())).withColumn(
        "_nth", F.row_number().over(Window.partitionBy("doc_id", "_uniform").orderBy("source")))
    same = (F.col("doc_id").eqNullSafe(F.col("_mix_id"))
            & (F.col("_uniform") == F.col("_mix_uniform")) & (F.col("_nth") == F.col("_mix_nth")))
    return (chosen.join(plan, same)
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_mix_copies").cast("int"))))
            .select(*documents.columns))
