"""Landed API pages: one JSON page per line (or per file) holding a list of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch
from ..model.payloads import page_field, page_schema
from ..operators.infer import infer_schema

#: The column that tells what is no record, and why it is none.
REJECTED = "_rejected"
NO_JSON, NO_LIST, NO_RECORD = "not JSON", "no list of records", "not a record"


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    family: str,
    entity: str,
    *,
    record_schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """One row per record of all pages below ``path``.

    A page that is not valid JSON fails the read, so no records go missing unseen.
    Folders such as ``channel_id=C1/`` become columns. ``record_schema`` replaces the
    declared record, for exports with more fields.
    """
    schema = page_schema(family, entity, record_schema)
    pages = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multiline).json(path)
    return explode_pages(pages, page_field(family, entity))


def rescue_pages(
    spark: SparkSession, path: str | list[str], family: str, entity: str, *, record_schema: T.StructType | None = None
) -> DataFrame:
    """The records of all pages, one page a line, and what is none with the reason why.

    As :func:`read_pages`, with a column ``_rejected``: null for a record; else a struct of the
    file, the place in the page's list (-1: the whole page), the reason and the text, and the
    record's fields are null. A page with a record that does not fit loses that record only: its
    list is read once more, element by element. Sound pages are parsed once.
    """
    field = page_field(family, entity)
    record = page_schema(family, entity, record_schema)[field].dataType.elementType
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

    def parse(text: Column, shape: T.StructType) -> Column:
        return F.from_json(text, T.StructType([*shape.fields, T.StructField("_corrupt", T.StringType())]), options)

    def row(place: Column, found: Column, reason: Column, text: Column) -> Column:
        fields = F.struct(*[found[name].alias(name) for name in record.names])
        sound = reason.isNull()
        why = F.struct(F.col("_file").alias("file"), place.alias("place"), reason.alias("reason"), text.alias("text"))
        return F.struct(F.when(sound, fields).alias("r"), F.when(~sound, why).alias("why"))

    def element(part: Column) -> Column:
        broken = part["r"].isNull() | part["r"]["_corrupt"].isNotNull()
        return row(part["i"], part["r"], F.when(broken, NO_RECORD), part["t"])

    none = F.lit(None).cast("string")
    no_place, empty = F.lit(-1), F.lit(None).cast(record)
    texts = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path")).where(F.trim("value") != "")
    pages = texts.withColumn("_page", parse(F.col("value"), T.StructType([T.StructField(field, T.ArrayType(record))])))
    page, loose = F.col("_page"), F.try_parse_json(F.col("value"))
    listed = F.try_variant_get(loose, f"$.{field}", "array<variant>")
    parts = F.transform(listed, lambda e, i: F.struct(i.alias("i"), F.to_json(e).alias("t")))
    parts = F.transform(parts, lambda e: F.struct(e["i"].alias("i"), e["t"].alias("t"), parse(e["t"], record).alias("r")))
    whole = F.when(loose.isNull(), NO_JSON).when(listed.isNull(), NO_LIST)
    found = (
        F.when(page["_corrupt"].isNull() & page.isNotNull(), F.transform(page[field], lambda r, i: row(i, r, F.when(r.isNull(), NO_RECORD), none)))
        .when(whole.isNotNull(), F.array(row(no_place, empty, whole, F.col("value"))))
        .otherwise(F.transform(parts, element))
    )
    folders = [c for c in texts.columns if c not in ("value", "_file")]
    rows = pages.select(*folders, F.explode(found).alias("_found"))
    return rows.select(*folders, *[F.col("_found.r")[n].alias(n) for n in record.names], F.col("_found.why").alias(REJECTED))


def infer_record(spark: SparkSession, path: str, family: str, entity: str) -> T.StructType:
    """Shape of the records in the pages below ``path``, from all of them."""
    return infer_schema(spark.read.text(path))[page_field(family, entity)].dataType.elementType


def explode_pages(pages: DataFrame, field: str) -> DataFrame:
    """Records of a page list; empty and absent lists give no rows."""
    return pages.select(*[c for c in pages.columns if c != field], F.inline(field))


def within(messages: DataFrame, oldest: str | None = None, latest: str | None = None, ts: str = "ts") -> DataFrame:
    """Messages with ``oldest <= ts <= latest``, compared as numbers."""
    stamp = epoch(F.col(ts))
    if oldest is not None:
        messages = messages.where(stamp >= epoch(F.lit(oldest)))
    if latest is not None:
        messages = messages.where(stamp <= epoch(F.lit(latest)))
    return messages
