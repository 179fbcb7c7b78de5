"""Raw records to flat rows: property bags, users, channels and nested lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import or_blank

_RECORD_FIELDS = ("id", "properties", "createdAt", "updatedAt")


def flatten_properties(records: DataFrame) -> DataFrame:
    """``id``, the record's own fields, its properties, and the two record times.

    A property wins over a record field of the same name. Records without a property bag
    keep their own fields.
    """
    schema = records.schema
    bag = schema["properties"].dataType.names if "properties" in schema.names else []
    own = [n for n in schema.names if n not in _RECORD_FIELDS and n not in bag]
    key = F.coalesce(F.col("properties.id"), F.col("id")) if "id" in bag else F.col("id")

    def stamp(name: str):
        return or_blank(F.col(name)) if name in schema.names else F.lit("")

    return records.select(
        key.alias("id"),
        *[F.col(f"`{n}`") for n in own],
        *[F.col(f"properties.`{n}`").alias(n) for n in bag if n not in ("id", "_created_at", "_updated_at")],
        stamp("createdAt").alias("_created_at"),
        stamp("updatedAt").alias("_updated_at"),
    )


def flatten_users(members: DataFrame) -> DataFrame:
    return members.select(
        "id",
        or_blank(F.col("name")).alias("name"),
        or_blank(F.col("real_name")).alias("real_name"),
        or_blank(F.col("profile.email")).alias("email"),
        or_blank(F.col("profile.title")).alias("title"),
        "is_admin",
        "is_bot",
        or_blank(F.col("tz")).alias("tz"),
    )


def flatten_channels(channels: DataFrame) -> DataFrame:
    return channels.select(
        "id",
        "name",
        "is_private",
        "created",
        or_blank(F.col("creator")).alias("creator"),
        "num_members",
        or_blank(F.col("topic.value")).alias("topic"),
        or_blank(F.col("purpose.value")).alias("purpose"),
    )


def expand_list(records: DataFrame, keys: list[str], items: str, position: str = "position") -> DataFrame:
    """One row per list item, with the keys and the item's place in the list.

    Struct items become columns, other items one column named as the list. Rows whose list
    is empty or absent give nothing.
    """
    element = records.schema[items].dataType.elementType
    rows = records.select(*keys, F.posexplode(items).alias(position, "_item"))
    item = ["_item.*"] if hasattr(element, "fields") else [F.col("_item").alias(items)]
    return rows.select(*keys, position, *item)
