"""Typing: fit records to a declared table, whatever the types they came with.

Nulls stay null. A value that is present but does not parse becomes 0;
it is never an error and never a null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_blank, json_text
from ..model.specs import FLAG, KIND_TYPES, TEXT, TableSpec

# The texts that count as a set flag.
TRUE_TEXTS = ("true", "True")
# Java accepts 1d, 2f and hex as doubles; a number in an export never looks like that.
_JAVA_ONLY_DOUBLE = r"[0-9.][dDfF]\s*$|[xX]"

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _text(value: Column, source: T.DataType) -> Column:
    if isinstance(source, _NESTED):
        return json_text(value)
    if isinstance(source, T.VariantType):
        scalar = F.try_variant_get(value, "$", "string")
        return F.when(~F.is_variant_null(value), scalar)
    return value.cast("string")


def _parse(text: Column, target: T.DataType) -> Column:
    parsed = text.try_cast(target)
    if isinstance(target, T.DoubleType):
        parsed = F.when(~text.rlike(_JAVA_ONLY_DOUBLE), parsed)
    return parsed


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _number(value: Column, source: T.DataType, target: T.DataType) -> Column:
    known = value.isNotNull()
    if isinstance(source, T.VariantType):
        known = known & ~F.is_variant_null(value)
        text = _parse(F.try_variant_get(value, "$", "string"), target)
        parsed = F.when(_is_text(value), text).otherwise(F.try_variant_get(value, "$", target.simpleString()))
    elif isinstance(source, T.StringType):
        parsed = _parse(value, target)
    elif isinstance(source, _NESTED):
        parsed = F.lit(None).cast(target)
    else:
        parsed = value.try_cast(target)
    return F.when(known, F.coalesce(parsed, F.lit(0).cast(target)))


def _flag(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BooleanType):
        return value.cast("int")
    if isinstance(source, T.NumericType):
        return (value == 1).cast("int")
    if isinstance(source, T.StringType):
        return value.isin(*TRUE_TEXTS).cast("int")
    if isinstance(source, T.VariantType):
        as_text = F.try_variant_get(value, "$", "string")
        is_set = F.when(_is_text(value), as_text.isin(*TRUE_TEXTS)).otherwise(
            F.try_variant_get(value, "$", "double") == 1
        )
        known = value.isNotNull() & ~F.is_variant_null(value)
        return F.when(known, F.coalesce(is_set, F.lit(False)).cast("int"))
    return F.when(value.isNotNull(), F.lit(0))


def coerce_column(value: Column, source: T.DataType, kind: str) -> Column:
    if kind == TEXT:
        return _text(value, source)
    if kind == FLAG:
        return _flag(value, source)
    return _number(value, source, KIND_TYPES[kind])


def coerce(records: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the declared columns: missing ones null, undeclared ones dropped."""
    have = {f.name: f.dataType for f in records.schema.fields}
    return records.select(
        *[
            (
                coerce_column(F.col(f"`{name}`"), have[name], kind)
                if name in have
                else F.lit(None).cast(KIND_TYPES[kind])
            ).alias(name)
            for name, kind in spec.columns
        ]
    )


def stringify_nested(records: DataFrame) -> DataFrame:
    """Lists, structs, maps and variants as JSON text; other columns unchanged."""
    return records.select(
        *[
            (json_text(F.col(f"`{f.name}`")) if isinstance(f.dataType, (*_NESTED, T.VariantType)) else F.col(f"`{f.name}`")).alias(f.name)
            for f in records.schema.fields
        ]
    )


def split_by_key(records: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and the rows to quarantine because theirs is null or empty."""
    missing = is_blank(F.col(key))
    return records.where(~missing), records.where(missing)


