"""Canonical JSON text and digests of rows."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def canonical(value) -> str:
    """Canonical JSON of a small driver-side value: sorted keys, no blanks, no NaN."""
    # The canonical JSON form.
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def digest(value) -> str:
    """SHA-256 of a value's canonical JSON."""
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def _scalar(col: Column) -> Column:
    boxed = F.to_json(F.array(col))
    return F.substring(boxed, F.lit(2), F.length(boxed) - 2)


def json_text(col: Column, kind: T.DataType) -> Column:
    """JSON text of one value: sorted keys, hex bytes, non-finite numbers and other types as text."""
    null = F.lit("null")
    if isinstance(kind, T.StructType):
        parts = []
        for field in sorted(kind.fields, key=lambda f: f.name):
            name = json.dumps(field.name, ensure_ascii=False)
            parts += [F.lit(("," if parts else "") + name + ":"), json_text(col.getField(field.name), field.dataType)]
        return F.when(col.isNull(), null).otherwise(F.concat(F.lit("{"), *parts, F.lit("}")))
    if isinstance(kind, T.ArrayType):
        items = F.transform(col, lambda x: json_text(x, kind.elementType))
        return F.when(col.isNull(), null).otherwise(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.transform(F.map_entries(col), lambda e: F.struct(
            e["key"].cast("string").alias("k"), json_text(e["value"], kind.valueType).alias("v"))))
        items = F.transform(entries, lambda e: F.concat(_scalar(e["k"]), F.lit(":"), e["v"]))
        return F.when(col.isNull(), null).otherwise(F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}")))
    if isinstance(kind, T.BinaryType):
        text = F.concat(F.lit('{"encoding":"hex","value":"'), F.lower(F.hex(col)), F.lit('"}'))
        return F.when(col.isNull(), null).otherwise(text)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (
            F.when(F.isnan(col), F.lit('"nan"'))
            .when(col == float("inf"), F.lit('"inf"'))
            .when(col == float("-inf"), F.lit('"-inf"'))
            .otherwise(F.coalesce(col.cast("string"), null))
        )
    if isinstance(kind, (*NUMERIC, T.BooleanType)):
        return F.coalesce(col.cast("string"), null)
    if isinstance(kind, T.StringType):
        return _scalar(col)
    return _scalar(col.cast("string"))


def canonical_row(schema: T.StructType) -> Column:
    """Canonical JSON object of the whole row."""
    parts = []
    for field in sorted(schema.fields, key=lambda f: f.name):
        name = json.dumps(field.name, ensure_ascii=False)
        parts += [F.lit(("," if parts else "") + name + ":"),
                  json_text(F.col("`" + field.name.replace("`", "``") + "`"), field.dataType)]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def digest_text(schema: T.StructType) -> Column:
    """The row as text for hashing: every value with its length before it, `n` for null.

    Lengths keep neighbouring values apart, so no escaping is needed; bytes enter as a hash.
    """
    parts = []
    for field in schema.fields:
        col, kind = F.col("`" + field.name.replace("`", "``") + "`"), field.dataType
        if isinstance(kind, T.BinaryType):
            value = F.sha2(col, 256)
        elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            value = F.when(col.isNotNull(), json_text(col, kind))
        else:
            value = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("n")))
    return F.concat(*parts)


def hash_number(text: Column, start: int = 1) -> Column:
    """Fifteen hex digits of a SHA-256, from `start`, as a number wide enough to be summed."""
    return F.conv(F.substring(F.sha2(text, 256), start, 15), 16, 10).cast("decimal(28,0)")
