"""Queue messages that announce new objects in a landing bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import CORRUPT, parse_object
from ..schemas import NOTIFICATION

# Fixed value: the message a bucket sends when its notifications are set up.
TEST_EVENT = "s3:TestEvent"

OBJECT, TEST, BAD_MESSAGE, BAD_ENTRY = "object", "test event", "bad message", "bad entry"
EMPTY = "empty message"


def object_manifest(messages: DataFrame, body: str = "body", versions: bool = False) -> DataFrame:
    """One row per announced object, with its bucket, decoded key and what became of it.

    Messages that announce nothing keep one row, so that they can be counted. ``versions`` adds
    ``version``, the version, tag or sequence number of the object, whichever the notice has first.
    """
    others = [c for c in messages.columns if c != body]
    parsed = messages.select(*others, parse_object(F.col(body), NOTIFICATION).alias("m"))
    entries = parsed.select(*others, "m", F.explode_outer("m.Records").alias("entry"))
    bucket = F.col("entry.s3.bucket.name")
    key = F.try_url_decode(F.col("entry.s3.object.key"))
    found = bucket.isNotNull() & (bucket != "") & key.isNotNull() & (key != "")
    announces_nothing = (F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
                         | F.col("m.Records").isNull())
    outcome = (
        F.when(F.col("m.Event") == TEST_EVENT, TEST)
        .when(announces_nothing, BAD_MESSAGE)
        .when(F.size("m.Records") == 0, EMPTY)
        .when(found, OBJECT)
        .otherwise(BAD_ENTRY)
    )
    return entries.select(*others, outcome.alias("outcome"),
                          F.when(found, bucket).alias("bucket"),
                          F.when(found, key).alias("key"),
                          *([_version(found).alias("version")] if versions else []))


def _version(found: Column) -> Column:
    named = [F.col(f"entry.s3.object.{name}") for name in ("versionId", "eTag", "sequencer")]
    return F.when(found, F.coalesce(*named))


def new_notices(messages: DataFrame, within: str, body: str = "body") -> DataFrame:
    """The manifest of a stream of messages without notices that came before: the same bucket, key and version
    of an object, or the same message that announces none, ``within`` the given time of arrival. Queues
    deliver at least once."""
    rows = object_manifest(messages.select(F.col(body), F.md5(body).alias("_message")), body, versions=True)
    none = F.lit("")
    notice = F.struct(*[F.coalesce(c, none).alias(c) for c in ("bucket", "key", "version")],
                      F.when(F.col("outcome") == OBJECT, none).otherwise(F.coalesce("_message", none)).alias("message"))
    return (rows.select("outcome", "bucket", "key", notice.alias("_notice"), F.current_timestamp().alias("_arrived"))
            .withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_notice"]).drop("_notice", "_arrived"))


def _accepted(bucket: str, prefix: str, extension: str) -> Column:
    return ((F.col("outcome") == OBJECT)
            & (F.col("bucket") == bucket)
            & F.col("key").startswith(prefix)
            & F.lower("key").endswith(extension.lower()))


def accepted_objects(manifest: DataFrame, bucket: str, prefix: str, extension: str) -> DataFrame:
    return manifest.filter(_accepted(bucket, prefix, extension))


def manifest_counts(manifest: DataFrame, bucket: str, prefix: str, extension: str) -> DataFrame:
    """Objects to process and failures of a batch of messages; test events and empty lists count as
    neither."""
    accepted = F.coalesce(_accepted(bucket, prefix, extension), F.lit(False))
    return manifest.agg(
        F.count_if(accepted).alias("processed"),
        F.count_if(~accepted & ~F.col("outcome").isin(TEST, EMPTY)).alias("failed"),
    )
