"""Merge tables, maintained views and counted increments over the given tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.buckets import MergeTable
from tidewell.operators.distinct import DistinctCounts
from tidewell.operators.rollups import MaintainedRollup
from tidewell.plans import maintained as m
from tidewell.session import scratch

from . import adapters as a


def _loads(rows: DataFrame, key: str, group: str) -> Iterator[DataFrame]:
    """The rows as they end up, in three loads: every row in another group at first, a part moved, then all but the moved."""
    part = F.pmod(F.xxhash64(key), F.lit(3))
    # before they are corrected, rows are in the group "early" or in none
    early = rows.withColumn(group, F.when(part == 0, F.lit("early")).when(part == 1, F.lit(None)).otherwise(F.col(group)))
    yield early.where(part < 2)
    yield rows.where(part == 0)
    yield rows.where(part > 0)


def _table(spark: SparkSession, rows: DataFrame, key: str, label: str) -> MergeTable:
    return MergeTable(spark, scratch(spark, label), rows.schema, [key], buckets=4)


def merge_buckets(spark, sf_dir):
    """Orders in three upserts, the third of a few keys; the newest row of each."""
    orders = a.load(spark, sf_dir, "orders")

    def load(day: int, state: str) -> DataFrame:
        changed = F.col("o_orderstatus") == state
        return orders.where(changed | F.lit(day == 1)).select(
            F.col("o_orderkey").cast("string").alias("Id"),
            F.when(changed, f"changed {day}").otherwise("as before").alias("Name"),
            F.col("o_totalprice").alias("Amount"),
            F.when(changed, f"2024-01-0{day + 1}").otherwise("2024-01-01").alias("CreatedDate"),
        )

    table = _table(spark, load(1, "O"), "Id", "merge")
    for day, state in enumerate(("O", "P", "F"), 1):
        table.upsert(load(day, state))
    return table.read()


def merge_pending(spark, sf_dir):
    """Customers merged once, then two loads that wait: versions decide, an older one changes nothing."""
    customer = a.load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.lit(2).alias("v"))
    table = MergeTable(spark, scratch(spark, "pending"), customer.schema, ["c_custkey"], buckets=8, version=["v"])
    table.upsert(customer)
    older = customer.where("c_custkey % 2 = 0").withColumns({"c_name": F.lit("older"), "v": F.lit(1)})
    newer = customer.where("c_custkey % 5 = 0").withColumns({"c_name": F.lit("newer"), "v": F.lit(3)})
    table.append(older)
    table.append(newer)
    return table.read()


def _maintained(spark: SparkSession, rows: DataFrame, key: str, entity: str) -> DataFrame:
    rollup = m.ROLLUPS[entity]
    table = _table(spark, rows, key, f"maintained-{entity}")
    view = MaintainedRollup(spark, f"{table.path}-view", rollup)
    for load in _loads(rows, key, rollup.groups[0]):
        table.upsert(load)
        view.refresh(table)
    return view.read()


def maintained_stages(spark, sf_dir):
    """Deals by stage after inserts, changes and moves between stages."""
    state = _maintained(spark, a.opportunities(spark, sf_dir), "Id", "Opportunity")
    return state.withColumns({"total_amount": F.round("total_amount", 2), "avg_amount": F.round("avg_amount", 4), "avg_probability": F.round("avg_probability", 4)})


def maintained_counts(spark, sf_dir):
    """The four counting rollups, each maintained over three loads, in one listing."""
    engaged = a.load(spark, sf_dir, "events").select(F.col("event_id"), F.col("event_type").alias("hs_engagement_type"), F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("hs_engagement_source"))
    labelled = a.load(spark, sf_dir, "documents").join(a.load(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id", F.col("lang").alias("hs_ticket_priority"), F.col("source").alias("hs_ticket_category"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("hs_pipeline_stage")
    )
    customer, orders = a.load(spark, sf_dir, "customer"), a.load(spark, sf_dir, "orders")
    rating = F.when(F.col("c_acctbal") > 5000, "Hot").when(F.col("c_acctbal") > 0, "Warm").otherwise("Cold")
    leads = customer.select("c_custkey", F.col("c_mktsegment").alias("Status"), F.concat(F.lit("src"), (F.col("c_custkey") % 4).cast("string")).alias("LeadSource"), rating.alias("Rating"))
    cases = orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority"),
        F.concat(F.lit("o"), (F.col("o_custkey") % 3).cast("string")).alias("Origin"), F.year("o_orderdate").cast("string").alias("Type"),
    )
    parts = []
    for entity, rows, key in (("Lead", leads, "c_custkey"), ("Case", cases, "o_orderkey"), ("engagements", engaged, "event_id"), ("tickets", labelled, "doc_id")):
        view = _maintained(spark, rows, key, entity)
        groups = m.ROLLUPS[entity].groups
        named = [F.col(g).alias(f"g{k}") for k, g in enumerate(groups, 1)] + [F.lit(None).cast("string").alias(f"g{k}") for k in range(len(groups) + 1, 5)]
        parts.append(view.select(F.lit(entity).alias("view"), *named, F.col(view.columns[-1]).alias("rows")))
    return reduce(DataFrame.unionAll, parts)


def _quarters(rows: DataFrame, key: str) -> Iterator[DataFrame]:
    for k in range(4):
        yield rows.where(F.pmod(F.xxhash64(key), F.lit(4)) == k)


def channel_activity_increments(spark, sf_dir):
    """Channel activity, users counted by bitmaps, after four increments."""
    view = m.channel_activity(spark, scratch(spark, "channel-activity"))
    for part in _quarters(a.chat_messages(spark, sf_dir), "message_ts"):
        view.add(part)
    return view.read()


def user_activity_increments(spark, sf_dir):
    view = m.user_activity(spark, scratch(spark, "user-activity"))
    for part in _quarters(a.chat_messages(spark, sf_dir), "message_ts"):
        view.add(part)
    return view.read().drop("earliest_message_ts")


def distinct_companies(spark, sf_dir):
    """Companies per lifecycle stage and lead status, counted over four increments of contacts."""
    counts = DistinctCounts(spark, scratch(spark, "companies"), ["lifecyclestage", "hs_lead_status"], "company", buckets=4)
    for part in _quarters(a.contacts(spark, sf_dir).withColumn("row", F.monotonically_increasing_id()), "row"):
        counts.add(part)
    return counts.counts("unique_companies")
