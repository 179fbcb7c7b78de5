"""Schemas for undeclared records, and unions of frames whose schemas differ."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text
from ..model.specs import DOUBLE, FLAG, INT, LONG, TEXT, TableSpec

_NESTED = (T.StructType, T.ArrayType, T.MapType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)


def _settle(kind: T.DataType) -> T.DataType:
    """Turn what the aggregate found into a storable type; conflicts become text."""
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        # More digits than a bigint or a double holds: keep every one as text. A bigint met
        # before widens the whole part to 19 or 20 digits, which tells nothing of its own.
        whole = kind.precision - kind.scale
        if kind.scale == 0:
            return T.StringType() if kind.precision > 18 else T.DoubleType()
        long = kind.scale > 15 or (kind.precision > 15 and whole not in (19, 20))
        return T.StringType() if long else T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settle(kind.elementType))
    if isinstance(kind, T.StructType):
        return sort_fields(T.StructType([T.StructField(f.name, _settle(f.dataType), True) for f in kind.fields]))
    return kind


def sort_fields(schema: T.StructType) -> T.StructType:
    return T.StructType(sorted(schema.fields, key=lambda f: f.name))


def infer_schema(texts: DataFrame, column: str = "value") -> T.StructType:
    """Schema of all JSON objects in a text column, found with one aggregate.

    The columns are the union of all keys, sorted. Whole and fractional numbers widen to
    double, other conflicts and always-null fields are text. Only the schema reaches the
    driver.
    """
    found = texts.select(F.schema_of_variant_agg(F.parse_json(F.col(column))).alias("s")).first()["s"]
    if not found.startswith("OBJECT<"):
        raise ValueError(f"expected JSON objects, found {found}")
    # Quoted field names are left as they are.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: m[0] if m[0][0] == "`" else "STRUCT<", found)
    return _settle(T.DataType.fromDDL(ddl))


def parse_records(texts: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """One row per JSON object of a text column.

    The generator keeps Spark from parsing a text again for every filter on its fields.
    """
    return texts.select(F.inline(F.array(F.from_json(F.col(column), schema))))


def spec_from_schema(family: str, entity: str, schema: T.StructType, key: str) -> TableSpec:
    """Table declaration for an undeclared object, from an inferred schema."""

    def kind(t: T.DataType) -> str:
        if isinstance(t, T.BooleanType):
            return FLAG
        if isinstance(t, T.LongType):
            return LONG
        if isinstance(t, _WHOLE):
            return INT
        return DOUBLE if isinstance(t, _FRACTION) else TEXT

    names = sorted(schema.names, key=lambda n: (n != key, n))
    return TableSpec(family, entity, tuple((n, kind(schema[n].dataType)) for n in names), key)


def spec_from_sample(texts: DataFrame, family: str, entity: str, key: str, column: str = "value") -> TableSpec:
    """Table declaration from all records of a sample, so that no field of theirs is dropped."""
    return spec_from_schema(family, entity, infer_schema(texts, column), key)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return T.StringType() if isinstance(a, T.NullType) else a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return widen(*[x if not isinstance(x, T.NullType) else y for x, y in ((a, b), (b, a))])
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, (*_WHOLE, *_FRACTION)) and isinstance(b, (*_WHOLE, *_FRACTION)):
        return T.DoubleType()
    return T.StringType()


def widen_union(*frames: DataFrame) -> DataFrame:
    """Bag union over the union of all columns, sorted by name.

    A column missing from a frame is null there; differing types widen as in
    :func:`infer_schema`.
    """
    types: dict[str, T.DataType] = {}
    for field in (f for frame in frames for f in frame.schema.fields):
        types[field.name] = widen(types[field.name], field.dataType) if field.name in types else field.dataType
    types = {n: T.StringType() if isinstance(t, T.NullType) else t for n, t in types.items()}

    def fit(frame: DataFrame) -> DataFrame:
        columns = []
        for name in sorted(types):
            if name not in frame.columns:
                value = F.lit(None).cast(types[name])
            elif isinstance(frame.schema[name].dataType, _NESTED) and isinstance(types[name], T.StringType):
                value = json_text(F.col(f"`{name}`"))
            else:
                value = F.col(f"`{name}`").cast(types[name])
            columns.append(value.alias(name))
        return frame.select(*columns)

    return reduce(DataFrame.union, [fit(f) for f in frames])
