"""Bronze tables, views and the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model.specs import FAMILIES, TableSpec, schema_from_names
from .coerce import stringify_nested

# Names an ad-hoc preview may touch.
PREVIEW_PREFIXES = ("bronze_", "v_")
SORT_KEY = "tidewell.sort_key"


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    order_by: list[str] | None = None,
    partition_by: list[str] | None = None,
    location: str | None = None,
    if_not_exists: bool = True,
) -> str:
    """Create a Parquet table and return its DDL. Without a location Spark manages it.

    The sort key, by default the first column, is kept as a table property; inserts sort
    their files by it, which lets scans skip row groups.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}`{name}` ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if location:
        ddl += f" LOCATION '{location}'"
    ddl += f" TBLPROPERTIES ('{SORT_KEY}' = '{','.join(order_by or schema.names[:1])}')"
    spark.sql(ddl)
    return ddl


def sort_key(spark: SparkSession, name: str) -> list[str]:
    """Columns the files of a table are sorted by; none for tables made elsewhere."""
    row = spark.sql(f"SHOW TBLPROPERTIES `{name}`").where(F.col("key") == SORT_KEY).first()
    return row["value"].split(",") if row else []


def create_named_table(spark: SparkSession, name: str, columns: dict[str, str], **options) -> str:
    """Create a table from generic type names such as ``int`` or ``list``."""
    return create_table(spark, name, schema_from_names(columns), **options)


def create_family(spark: SparkSession, family: str, root: str | None = None) -> list[str]:
    """Create all declared tables of a family, below ``root`` when given."""
    return [create_spec_table(spark, spec, root) for spec in FAMILIES[family].values()]


def create_spec_table(spark: SparkSession, spec: TableSpec, root: str | None = None) -> str:
    location = f"{root.rstrip('/')}/{spec.table}" if root else None
    return create_table(spark, spec.table, spec.struct(), location=location)


def insert_rows(rows: DataFrame, table: str, columns: list[str] | None = None) -> None:
    """Append rows to a table by column name, sorted by its key; columns not given are null.

    Lists and structs go into text columns as JSON. Rows for a partitioned table are
    rebalanced by partition first.
    """
    spark = rows.sparkSession
    chosen = stringify_nested(rows.select(*(columns or rows.columns)))
    target = spark.table(table).schema
    unknown = set(chosen.columns) - set(target.names)
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    fitted = chosen.select(
        *[(F.col(f"`{f.name}`") if f.name in chosen.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    )
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if partitions:
        fitted = fitted.hint("rebalance", *partitions)
    order = [*partitions, *sort_key(spark, table)]
    (fitted.sortWithinPartitions(*order) if order else fitted).write.insertInto(table)


def create_view(rows: DataFrame, name: str, replace: bool = True) -> bool:
    """Publish a frame as a temporary view; returns whether it was (re)defined."""
    if replace:
        rows.createOrReplaceTempView(name)
        return True
    if rows.sparkSession.catalog.tableExists(name):
        return False
    rows.createTempView(name)
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a managed table; Spark refuses this for tables with a location of their own."""
    spark.sql(f"TRUNCATE TABLE `{name}`")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _names(spark: SparkSession, views: bool, prefix: str) -> list[str]:
    found = [t for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    return sorted(t.name for t in found if (t.isTemporary or t.tableType == "VIEW") == views)


def list_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    return _names(spark, False, prefix)


def list_views(spark: SparkSession, prefix: str = "") -> list[str]:
    return _names(spark, True, prefix)


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    rows = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "name string, type string")


def preview(
    spark: SparkSession, name: str, n: int = 100, prefixes: tuple[str, ...] = PREVIEW_PREFIXES
) -> DataFrame:
    """First ``n`` rows of a table or view. Over an ordered view Spark plans a top-k."""
    if not name.startswith(prefixes):
        raise ValueError(f"preview of {name!r} is not allowed")
    return spark.table(name).limit(n)


def query(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)
