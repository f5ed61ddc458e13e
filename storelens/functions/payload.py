"""Payload texts: base64, JSON objects, tagged items."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def decode_text(data: Column, encoded: bool = True) -> Column:
    """UTF-8 text of a payload, behind base64 if ``encoded``; null where the encoding is broken."""
    raw = F.try_to_binary(data.cast("string"), F.lit("base64")) if encoded else data
    return F.try_validate_utf8(raw.cast("string"))


def parse_object(text: Column, schema: T.StructType) -> Column:
    """JSON object as a struct; text that is no object is kept in ``_corrupt_record``."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(text, with_corrupt, options)


def tagged(value: Column, dtype: T.DataType) -> Column:
    """The value under its type tag: ``S N BOOL L M NULL``.

    The recursion runs over the schema while the plan is built. Unused tags are null, and
    ``to_json`` leaves nulls out.
    """
    null_tag = F.when(value.isNull(), F.lit(True)).alias("NULL")
    if isinstance(dtype, T.NullType):
        return F.struct(F.lit(True).alias("NULL"))
    if isinstance(dtype, T.BooleanType):
        return F.struct(value.alias("BOOL"), null_tag)
    if isinstance(dtype, T.NumericType):
        return F.struct(value.cast("string").alias("N"), null_tag)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: tagged(item, dtype.elementType))
        return F.struct(items.alias("L"), null_tag)
    if isinstance(dtype, T.MapType):
        entries = F.transform_values(value, lambda _, item: tagged(item, dtype.valueType))
        return F.struct(entries.alias("M"), null_tag)
    if isinstance(dtype, T.StructType):
        fields = [tagged(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        members = F.when(value.isNotNull(), F.struct(*fields))
        return F.struct(members.alias("M"), null_tag)
    return F.struct(value.cast("string").alias("S"), null_tag)


class _Number(str):
    """A JSON number as it was written."""


def _tag(value: object) -> dict:
    if value is None:
        return {"NULL": True}
    if isinstance(value, bool):
        return {"BOOL": value}
    if isinstance(value, _Number):
        return {"N": str(value)}
    if isinstance(value, str):
        return {"S": value}
    if isinstance(value, list):
        return {"L": [_tag(item) for item in value]}
    return {"M": {name: _tag(item) for name, item in value.items()}}


def _tagged_text(text: str | None) -> str | None:
    try:
        record = json.loads(text or "", parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    except (ValueError, RecursionError):
        return None
    if not isinstance(record, dict):
        return None
    tags = {name: _tag(value) for name, value in record.items()}
    return json.dumps(tags, ensure_ascii=False, separators=(",", ":"))


def tagged_payload(text: Column) -> Column:
    """JSON object as one JSON text of tagged values, whatever fields it has; null for other texts.

    The fields are not known to the plan, so this runs in Python, on Arrow batches.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(_tagged_text)

    return F.pandas_udf(run, "string")(text)


def tagged_item(schema: T.StructType) -> Column:
    """Whole row as one JSON text of tagged values."""
    return F.to_json(F.struct(*[tagged(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                                for f in schema.fields]))
