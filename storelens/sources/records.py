"""Streams of base64-wrapped JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import number
from ..functions.payload import CORRUPT, decode_text, parse_object
from ..schemas import RECORD

_STREAM_EVENT = "Records array<struct<kinesis:struct<data:string>>>"
_DELIVERIES = "array<struct<recordId:string,data:string>>"


def open_stream(spark: SparkSession, source: str, schema: T.StructType | None = None,
                **options: str) -> DataFrame:
    """Any streaming source by configuration: files, Kafka, or a connector on the classpath."""
    reader = spark.readStream.format(source).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def read_payload(raw: DataFrame, schema: T.StructType, text: Column,
                 keep: list[str] | None = None) -> DataFrame:
    """A row per element of a payload that is either one JSON object or a list of them.

    Beside the kept columns: ``payload`` (the element's text), ``record`` (its fields) and
    ``decoded``. A payload or an element that is no object is not ``decoded``; other elements of
    its list are. A field of the wrong type is null. Generators keep what is above from repeating the
    decoding and parsing.
    """
    kept = keep or []
    raw = raw.select(*kept, F.explode(F.array(text)).alias("_text"))
    text = F.col("_text")
    listed = F.coalesce(F.from_json(text, "array<string>"), F.array(F.lit(None).cast("string")))
    elements = F.when(F.ltrim(text).startswith("["), listed).otherwise(F.array(text))
    rows = raw.select(*kept, F.explode(elements).alias("_element"))
    read = F.struct(F.col("_element").alias("payload"), parse_object(F.col("_element"), schema).alias("record"))
    rows = rows.select(*kept, F.inline(F.array(read)))
    corrupt = F.col(f"record.{CORRUPT}").isNotNull() & F.json_object_keys("payload").isNull()
    return rows.withColumn("decoded", F.col("record").isNotNull() & ~corrupt)


def explode_payload(raw: DataFrame, schema: T.StructType | str, text: Column,
                    keep: list[str] | None = None) -> DataFrame:
    """The decoded elements of a payload, a column per field."""
    kind = T.StructType.fromDDL(schema.removeprefix("struct<").removesuffix(">")) if isinstance(schema, str) else schema
    rows = read_payload(raw, kind, text, keep).filter("decoded")
    return rows.select(*(keep or []), *[F.col(f"record.{f.name}").alias(f.name) for f in kind])


def _identifier(text: Column) -> Column:
    """Text of an id; a whole number written as a decimal loses its zeros."""
    return F.when(text.rlike(r"^-?(0|[1-9]\d*)\.0+$"), F.regexp_replace(text, r"\.0+$", "")).otherwise(text)


def _typed(field: T.StructField) -> Column:
    text = F.col(f"record.{field.name}")
    if isinstance(field.dataType, T.NumericType):
        text = number(text).try_cast(field.dataType)
    elif field.name == "id" or field.name.endswith("_id"):
        text = _identifier(text)
    return text.alias(field.name)


def read_records(raw: DataFrame, schema: T.StructType = RECORD, data: str = "data",
                 keep: list[str] | None = None, encoded: bool = True) -> DataFrame:
    """Typed records of a stream of JSON payloads, each with its ``payload`` text and whether it was
    ``decoded``; one that was not has no fields.

    Fields are read as text first, so that ids may be texts or numbers and times texts. Function
    events carry payloads in base64, topics carry the plain text (``encoded=False``).
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = read_payload(raw, texts, decode_text(F.col(data), encoded), keep)
    # Fields are computed once, however often plans above speak of them.
    fields = F.inline(F.array(F.struct(*[_typed(f) for f in schema])))
    rows = rows.select(*(keep or []), "payload", "decoded", fields)
    return rows.select(*(keep or []), *schema.names, "payload", "decoded")


def parse_records(raw: DataFrame, schema: T.StructType = RECORD, data: str = "data",
                  keep: list[str] | None = None, encoded: bool = True) -> DataFrame:
    """The decoded records of ``read_records``."""
    return read_records(raw, schema, data, keep, encoded).filter("decoded").drop("payload", "decoded")


def unpack_events(events: DataFrame, event: str = "event") -> DataFrame:
    """Records inside function events, both stream (``Records[].kinesis.data``) and delivery
    (``records[].recordId, data``) events; ``recordId`` is null for the former.
    """
    stream = F.transform(F.col("e.Records"), lambda r: F.struct(
        F.lit(None).cast("string").alias("recordId"), r["kinesis"]["data"].alias("data")))
    nothing = F.array().cast("array<struct<recordId:string,data:string>>")
    found = F.concat(F.coalesce("e.deliveries", nothing), F.coalesce(stream, nothing))
    # The two lists differ only in the case of their name, which one struct cannot hold.
    parsed = F.struct(
        F.from_json(event, _STREAM_EVENT)["Records"].alias("Records"),
        F.from_json(F.get_json_object(event, "$.records"), _DELIVERIES).alias("deliveries"))
    return events.select(parsed.alias("e")).select(F.inline(found))
