"""The published views: rollups and listings over bronze frames.

Each function takes the bronze frame(s) it reads and returns an ordered frame. Nulls sort
last, as in the views' source system. Ties are settled by the key or the group columns:
the order is then the same on every run, and a value shared by a large part of the rows
still range-partitions over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch, epoch_key, epoch_text
from ..model.specs import FAMILIES
from ..operators.tables import create_view, table_exists


def _ordered(rows: DataFrame, first: Column, *ties: str) -> DataFrame:
    return rows.orderBy(first, *[F.col(f"`{t}`").asc_nulls_last() for t in ties])


def _count_by(rows: DataFrame, groups: list[str], name: str) -> DataFrame:
    counted = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias(name))
    return _ordered(counted, F.col(name).desc(), *groups)


# Sales ------------------------------------------------------------------------------


def opportunity_stage_rollup(opportunity: DataFrame) -> DataFrame:
    rolled = opportunity.groupBy("StageName").agg(
        F.count(F.lit(1)).alias("deal_count"),
        F.sum("Amount").alias("total_amount"),
        F.avg("Amount").alias("avg_amount"),
        F.avg("Probability").alias("avg_probability"),
    )
    return _ordered(rolled, F.col("total_amount").desc_nulls_last(), "StageName")


def account_overview(account: DataFrame) -> DataFrame:
    rows = account.select(
        F.col("Id").alias("account_id"), F.col("Name").alias("account_name"), "Industry", "AnnualRevenue",
        "NumberOfEmployees", F.col("Type").alias("account_type"),
    )
    return _ordered(rows, F.col("AnnualRevenue").desc_nulls_last(), "account_id")


def lead_funnel(lead: DataFrame) -> DataFrame:
    return _count_by(lead, ["Status", "LeadSource", "Rating"], "lead_count")


def case_analysis(case: DataFrame) -> DataFrame:
    return _count_by(case, ["Status", "Priority", "Origin", "Type"], "case_count")


# Marketing --------------------------------------------------------------------------


def deal_listing(deals: DataFrame) -> DataFrame:
    """Deals, newest first. ``amount`` stays text; ``amount_value`` is the number in it."""
    rows = deals.select(
        F.col("id").alias("deal_id"), "dealname", "dealstage", "amount", "closedate", "pipeline", "dealtype",
        "hs_priority", "createdate", F.col("amount").try_cast("double").alias("amount_value"),
    )
    return _ordered(rows, F.col("createdate").desc_nulls_last(), "deal_id")


def contact_lifecycle(contacts: DataFrame) -> DataFrame:
    rolled = contacts.groupBy("lifecyclestage", "hs_lead_status").agg(
        F.count(F.lit(1)).alias("contact_count"), F.count_distinct("company").alias("unique_companies")
    )
    return _ordered(rolled, F.col("contact_count").desc(), "lifecyclestage", "hs_lead_status")


def company_overview(companies: DataFrame) -> DataFrame:
    rows = companies.select(
        "id", "name", "domain", "industry", "annualrevenue", "numberofemployees", "type", "city", "state",
        F.col("annualrevenue").try_cast("double").alias("annualrevenue_value"),
    )
    return _ordered(rows, F.col("name").asc_nulls_last(), "id")


def engagement_summary(engagements: DataFrame) -> DataFrame:
    return _count_by(engagements, ["hs_engagement_type", "hs_engagement_source"], "engagement_count")


def ticket_analysis(tickets: DataFrame) -> DataFrame:
    return _count_by(tickets, ["hs_ticket_priority", "hs_ticket_category", "hs_pipeline_stage"], "ticket_count")


# Chat -------------------------------------------------------------------------------


def compliance_timeline(messages: DataFrame) -> DataFrame:
    rows = messages.select(
        "channel_id", "channel_name", "message_ts", "user_id", "text", "thread_ts", "reactions",
        "ingestion_mode", "processing_date",
    )
    return _ordered(rows, epoch(F.col("message_ts")).desc_nulls_last(), "channel_id", "message_ts")


def channel_activity(messages: DataFrame) -> DataFrame:
    stamp = epoch_key(F.col("message_ts"))
    rolled = messages.groupBy("channel_name", "channel_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_distinct("user_id").alias("unique_users"),
        epoch_text(F.max(stamp)).alias("latest_message_ts"),
        epoch_text(F.min(stamp)).alias("earliest_message_ts"),
        F.sum("reply_count").alias("total_replies"),
        F.sum("file_count").alias("total_files"),
    )
    return _ordered(rolled, F.col("message_count").desc(), "channel_name", "channel_id")


def user_activity(messages: DataFrame) -> DataFrame:
    rolled = messages.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_distinct("channel_id").alias("channels_active"),
        epoch_text(F.max(epoch_key(F.col("message_ts")))).alias("latest_message_ts"),
    )
    return _ordered(rolled, F.col("message_count").desc(), "user_id")


def live_feed(events: DataFrame) -> DataFrame:
    rows = events.select("event_type", "channel_id", "user_id", "text", "message_ts", "event_time", "processing_date")
    return _ordered(rows, epoch(F.col("event_time")).desc_nulls_last(), "channel_id", "user_id", "message_ts")


# Publishing -------------------------------------------------------------------------


@dataclass(frozen=True)
class Mart:
    view: str
    family: str
    entity: str
    build: Callable[[DataFrame], DataFrame]


MARTS = [
    Mart("v_sales_pipeline_summary", "sales", "Opportunity", opportunity_stage_rollup),
    Mart("v_sales_account_overview", "sales", "Account", account_overview),
    Mart("v_sales_lead_funnel", "sales", "Lead", lead_funnel),
    Mart("v_sales_case_analysis", "sales", "Case", case_analysis),
    Mart("v_marketing_deal_pipeline", "marketing", "deals", deal_listing),
    Mart("v_marketing_contact_lifecycle", "marketing", "contacts", contact_lifecycle),
    Mart("v_marketing_company_overview", "marketing", "companies", company_overview),
    Mart("v_marketing_engagement_summary", "marketing", "engagements", engagement_summary),
    Mart("v_marketing_ticket_analysis", "marketing", "tickets", ticket_analysis),
    Mart("v_chat_compliance_timeline", "chat", "messages", compliance_timeline),
    Mart("v_chat_channel_activity", "chat", "messages", channel_activity),
    Mart("v_chat_user_activity", "chat", "messages", user_activity),
    Mart("v_chat_realtime_feed", "chat", "realtime_events", live_feed),
]


def publish_views(spark: SparkSession, family: str | None = None, replace: bool = True) -> list[str]:
    """Define the views whose bronze table exists; returns their names."""
    published = []
    for mart in MARTS:
        table = FAMILIES[mart.family][mart.entity].table
        if family in (None, mart.family) and table_exists(spark, table):
            create_view(mart.build(spark.table(table)), mart.view, replace)
            published.append(mart.view)
    return published
