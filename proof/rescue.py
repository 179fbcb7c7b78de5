"""Loads of pages that can't all be read: quarantine, repair and replay."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.plans import ingest
from tidewell.session import scratch

from . import adapters as a


def quarantine_replay(spark, sf_dir):
    """Customers as account pages: some cut off, some with a record as quoted text, some no JSON; repaired and replayed twice."""
    root = scratch(spark, "quarantine")
    key = F.col("c_custkey")
    record = F.to_json(F.struct(key.cast("string").alias("Id"), F.col("c_name").alias("Name"), F.lit("2024-01-01").alias("LastModifiedDate")))
    sound = F.to_json(F.struct((-key).cast("string").alias("Id"), F.lit("beside").alias("Name")))
    quoted = F.concat(F.lit('"'), F.replace(F.replace(record, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    page = (
        F.when(key % 13 == 0, F.concat(F.lit("oops "), key.cast("string")))
        .when(key % 7 == 0, F.concat(F.lit('{"records":['), record))
        .when(key % 11 == 0, F.concat(F.lit('{"records":['), sound, F.lit(","), quoted, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"records":['), record, F.lit("]}")))
    )
    a.write_texts(a.load(spark, sf_dir, "customer").select(page.alias("value")), f"{root}/pages")
    lake = ingest.Lake(spark, f"{root}/lake")
    ingest.ingest_entity(lake, "sales", "Account", f"{root}/pages", date(2024, 1, 1), rescue=True)

    def repair(text):
        whole = F.when(text.startswith('{"records"'), F.concat(text, F.lit("]}")))
        return whole.when(text.startswith('"'), F.try_variant_get(F.try_parse_json(text), "$", "string"))

    for day in (2, 3):  # the second has nothing left to do
        ingest.replay(lake, "sales", "Account", repair, date(2024, 1, day))
    landed = lake.landed(lake.spec("sales", "Account")).select("Id", "Name", "load", F.lit("").alias("reason"))
    aside = ingest.quarantined(lake, "sales", "Account", all_loads=True).groupBy("load", "reason").count()
    return landed.unionByName(aside.select(F.lit("").alias("Id"), F.col("count").cast("string").alias("Name"), "load", "reason"))


QUERIES = {"quarantine_replay": quarantine_replay}

ORACLE = {
    "quarantine_replay": """
        WITH c AS (
            SELECT c_custkey AS k, c_name,
                   CASE WHEN c_custkey % 13 = 0 THEN 'gone' WHEN c_custkey % 7 = 0 THEN 'cut'
                        WHEN c_custkey % 11 = 0 THEN 'quoted' ELSE 'sound' END AS kind
            FROM customer)
        SELECT k::VARCHAR AS "Id", c_name AS "Name", CAST(CASE kind WHEN 'sound' THEN 0 ELSE 1 END AS INTEGER) AS load, '' AS reason
        FROM c WHERE kind <> 'gone'
        UNION ALL SELECT (-k)::VARCHAR, 'beside', 0, '' FROM c WHERE kind = 'quoted'
        UNION ALL SELECT '', COUNT(*)::VARCHAR, 0, 'not JSON' FROM c WHERE kind IN ('gone', 'cut') HAVING COUNT(*) > 0
        UNION ALL SELECT '', COUNT(*)::VARCHAR, 0, 'not a record' FROM c WHERE kind = 'quoted' HAVING COUNT(*) > 0""",
}
