"""One query per operator: the given tables, adapted, through the library's own code."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import epoch
from tidewell.model import CHAT, MARKETING, SALES
from tidewell.model.payloads import CHANNEL, ENVELOPE, USER, marketing_record, sales_record
from tidewell.operators import incremental as inc
from tidewell.operators import messages as msg
from tidewell.operators import reports, tables
from tidewell.operators.coerce import coerce
from tidewell.operators.events import classify_events
from tidewell.operators.flatten import expand_list, flatten_channels, flatten_properties, flatten_users
from tidewell.operators.infer import infer_schema, parse_records, widen_union
from tidewell.operators.landing import append_bronze, land, replace, write_parquet
from tidewell.operators.state import current_state
from tidewell.plans import ingest, marts
from tidewell.session import scratch
from tidewell.sources.landed import load_bronze, read_landed
from tidewell.sources.pages import read_pages, within
from tidewell.streaming import events as live

from . import adapters as a
from . import catalog, clustered, maintained, rescue, threads

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def proof(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# Views ------------------------------------------------------------------------------


def _rounded(rollup: DataFrame) -> DataFrame:
    # Double sums depend on the order of addition in the last digits.
    return rollup.withColumns(
        {
            "total_amount": F.round("total_amount", 2),
            "avg_amount": F.round("avg_amount", 4),
            "avg_probability": F.round("avg_probability", 4),
        }
    )


@proof
def opportunity_stage_rollup(spark, sf_dir):
    return _rounded(marts.opportunity_stage_rollup(a.opportunities(spark, sf_dir)))


@proof
def account_overview(spark, sf_dir):
    return marts.account_overview(a.accounts(spark, sf_dir))


@proof
def lead_funnel(spark, sf_dir):
    return marts.lead_funnel(a.leads(spark, sf_dir))


@proof
def case_analysis(spark, sf_dir):
    return marts.case_analysis(a.cases(spark, sf_dir))


@proof
def contact_lifecycle(spark, sf_dir):
    return marts.contact_lifecycle(a.contacts(spark, sf_dir))


@proof
def deal_listing(spark, sf_dir):
    return marts.deal_listing(a.deals(spark, sf_dir))


@proof
def company_overview(spark, sf_dir):
    return marts.company_overview(a.companies(spark, sf_dir))


@proof
def engagement_summary(spark, sf_dir):
    return marts.engagement_summary(a.engagements(spark, sf_dir))


@proof
def ticket_analysis(spark, sf_dir):
    return marts.ticket_analysis(a.tickets(spark, sf_dir))


@proof
def channel_activity(spark, sf_dir):
    return marts.channel_activity(a.chat_messages(spark, sf_dir))


@proof
def user_activity(spark, sf_dir):
    return marts.user_activity(a.chat_messages(spark, sf_dir))


@proof
def compliance_timeline(spark, sf_dir):
    rows = msg.normalize_messages(a.raw_conversations(spark, sf_dir), F.lit(a.LOAD_DATE))
    return marts.compliance_timeline(rows)


@proof
def message_normalization(spark, sf_dir):
    attached = F.struct(F.concat("user", F.lit("-file")).alias("id"), F.length("text").cast("long").alias("size"))
    raw = a.raw_conversations(spark, sf_dir).withColumns(
        {
            "files": F.when(F.col("user") == "assistant", F.array(attached, attached)).when(F.col("user") == "user", F.array()),
            "subtype": F.when(F.col("user") == "system", "notice"),
            "reply_count": F.when(F.col("user") == "user", 3),
        }
    )
    return msg.normalize_messages(raw, F.lit(a.LOAD_DATE))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = a.envelopes_json(spark, sf_dir)
    return classify_events(parse_records(texts, ENVELOPE), F.lit(a.LOAD_DATE))


@proof
def live_feed(spark, sf_dir):
    return marts.live_feed(_classified(spark, sf_dir))


@proof
def event_classification(spark, sf_dir):
    return _classified(spark, sf_dir)


@proof
def preview_topk(spark, sf_dir):
    tables.create_view(marts.deal_listing(a.deals(spark, sf_dir)), "v_proof_deals")
    return tables.preview(spark, "v_proof_deals", 100)


# Flattening and typing --------------------------------------------------------------


@proof
def flatten_property_bag(spark, sf_dir):
    properties = F.struct(
        F.col("c_name").alias("firstname"),
        F.col("c_mktsegment").alias("lifecyclestage"),
        F.col("c_nationkey").alias("country"),
        a.money_text("c_acctbal").alias("undeclared"),
    )
    record = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", properties).alias("properties"),
        F.lit("2024-01-01").alias("createdAt"),
        F.when(F.col("c_acctbal") > 0, "2024-01-02").alias("updatedAt"),
    )
    texts = a.load(spark, sf_dir, "customer").select(F.to_json(record).alias("value"))
    spec = MARKETING["contacts"]
    rows = coerce(flatten_properties(parse_records(texts, marketing_record(spec))), spec)
    return rows.select("id", "firstname", "lastname", "lifecyclestage", "country", "_created_at", "_updated_at")


def _mixed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records whose fields change their JSON type with the event type."""
    kind = F.col("event_type")
    quoted_value = F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
    number = (
        F.when(kind == "view", F.col("value").cast("string"))
        .when(kind == "click", quoted_value)
        .when(kind == "error", F.lit('"abc"'))
        .when(kind == "signup", F.concat(F.lit('" '), F.col("user_id").cast("string"), F.lit(' "')))
        .otherwise(F.lit("null"))
    )
    flag = (
        F.when(kind == "view", "true").when(kind == "click", '"True"').when(kind == "error", '"yes"')
        .when(kind == "signup", "1").otherwise("null")
    )
    name = F.when(kind == "view", F.col("props")).when(kind == "purchase", F.lit("12.50")).otherwise(F.lit('"plain"'))
    text = F.concat(
        F.lit('{"Id":'), F.col("event_id").cast("string"),
        F.lit(',"Name":'), name,
        F.lit(',"Amount":'), number,
        F.lit(',"Probability":'), number,
        F.lit(',"IsClosed":'), flag,
        F.lit(',"Undeclared":1}'),
    )
    return a.load(spark, sf_dir, "events").select(text.alias("value"))


@proof
def coerce_declared(spark, sf_dir):
    spec = SALES["Opportunity"]
    records = parse_records(_mixed_json(spark, sf_dir), sales_record(spec))
    return coerce(records, spec).select(
        "Id", F.get_json_object("Name", "$.k").alias("name_k"),
        F.when(~F.col("Name").startswith("{"), F.col("Name")).alias("name_plain"),
        "Amount", "Probability", "IsClosed", "IsWon", "StageName",
    )


@proof
def schema_inference(spark, sf_dir):
    kind = F.col("event_type")
    text = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.when(kind == "view", F.col("user_id").cast("string")).when(kind == "click", F.col("value").cast("string"))
            .alias("mixed"),
            F.when(kind == "signup", F.col("props")).alias("only_signup"),
        )
    )
    # Numbers without quotes, so that whole and fractional values meet in one field.
    bare = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"),
        F.lit(',"reading":'), F.when(kind == "view", F.col("user_id").cast("string")).otherwise(F.col("value").cast("string")),
        F.lit(',"clash":'), F.when(kind == "view", F.lit("7")).otherwise(F.lit('"seven"')),
        F.lit(',"never":null}'),
    )
    events = a.load(spark, sf_dir, "events")
    texts = events.select(F.when(kind == "error", text).otherwise(bare).alias("value"))
    rows = parse_records(texts, infer_schema(texts))
    return rows.select("id", "reading", "clash", "never")


@proof
def schema_inference_widen(spark, sf_dir):
    customer = a.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("tag"), F.col("c_mktsegment").alias("segment"),
    )
    part = a.load(spark, sf_dir, "part").select(
        F.col("p_size").alias("key"), F.col("p_name").alias("name"), F.col("p_partkey").alias("balance"),
        F.col("p_brand").alias("tag"), F.lit(None).alias("nothing"),
    )
    return widen_union(customer, part)


@proof
def dimension_flatten_users(spark, sf_dir):
    record = F.struct(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 0, F.struct(F.concat("s_name", F.lit("@example.com")).alias("email"))).alias("profile"),
        (F.col("s_acctbal") > 5000).alias("is_admin"),
        F.when(F.col("s_nationkey") > 10, 1).alias("is_bot"),
    )
    texts = a.load(spark, sf_dir, "supplier").select(F.to_json(record).alias("value"))
    return coerce(flatten_users(parse_records(texts, USER)), CHAT["users"])


@proof
def dimension_flatten_channels(spark, sf_dir):
    record = F.struct(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        (F.col("n_regionkey") == 0).alias("is_private"),
        (F.col("n_nationkey") + 1700000000).alias("created"),
        F.struct(F.lower("n_name").alias("value")).alias("topic"),
        F.col("n_regionkey").cast("string").alias("num_members"),
    )
    texts = a.load(spark, sf_dir, "nation").select(F.to_json(record).alias("value"))
    return coerce(flatten_channels(parse_records(texts, CHANNEL)), CHAT["channels"])


@proof
def nested_items_explode(spark, sf_dir):
    lines = F.split("text", "\n")
    items = F.transform(lines, lambda line: F.struct(line.alias("label"), F.length(line).alias("width")))
    documents = a.load(spark, sf_dir, "documents").select("doc_id", "lang", items.alias("stages"))
    return expand_list(documents, ["doc_id", "lang"], "stages")


@proof
def nested_values_explode(spark, sf_dir):
    return expand_list(a.load(spark, sf_dir, "embeddings"), ["vec_id", "label"], "embedding").withColumn(
        "embedding", F.col("embedding").cast("double")
    )


@proof
def reaction_listing(spark, sf_dir):
    reacted = msg.with_reactions(a.raw_conversations(spark, sf_dir))
    return expand_list(reacted, ["channel_id", "ts"], "reactions").select(
        "channel_id", "ts", "position", "name", F.element_at("users", 1).alias("first_user"), "count"
    )


# Incremental ------------------------------------------------------------------------


@proof
def thread_expansion(spark, sf_dir):
    raw = a.raw_conversations(spark, sf_dir)
    turn = F.substring_index("ts", ".", -1).cast("int")
    root = F.concat(F.substring_index("ts", ".", 1), F.lit(".000000"))
    sizes = raw.groupBy("channel_id").agg((F.count(F.lit(1)) - 1).alias("reply_count"))
    parents = raw.where(turn == 0).join(sizes, "channel_id").withColumn(
        "thread_ts", F.when(F.col("user") == "user", F.col("ts"))
    )
    # As an API gives them: the thread's parent comes first among its replies.
    replies = raw.drop("channel_name", "reactions").withColumn("thread_ts", root)
    rows = msg.normalize_messages(msg.with_replies(parents.drop("reactions"), replies), F.lit(a.LOAD_DATE))
    return rows.select("channel_id", "message_ts", "user_id", "text", "thread_ts", "reply_count")


@proof
def skip_completed(spark, sf_dir):
    orders = a.load(spark, sf_dir, "orders")
    is_open = F.max((F.col("o_orderstatus") == "O").cast("int"))
    state = orders.groupBy("o_custkey").agg((is_open == 0).alias("completed"))
    return inc.skip_completed(orders, state, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_orderstatus")


def _stamped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.load(spark, sf_dir, "events").select(
        "event_id", a.channel_of().alias("channel_id"), a.seconds_text().alias("message_ts"), "ts"
    )


@proof
def resume_from_hwm(spark, sf_dir):
    events = _stamped_events(spark, sf_dir)
    earlier = events.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    marks = inc.high_water_marks(earlier, "channel_id", "message_ts")
    newer = inc.newer_than(events, marks, "channel_id", epoch(F.col("message_ts")), epoch(F.col("mark")))
    return newer.select("event_id", "channel_id", "message_ts")


@proof
def message_range(spark, sf_dir):
    return within(_stamped_events(spark, sf_dir), "999.5", "1000000.25", "message_ts").select("event_id", "message_ts")


@proof
def high_water_marks(spark, sf_dir):
    return inc.high_water_marks(_stamped_events(spark, sf_dir), "channel_id", "message_ts")


@proof
def incremental_modified(spark, sf_dir):
    rows = a.deals(spark, sf_dir).select(
        "id",
        F.when(F.col("dealstage") == "F", F.col("closedate")).alias("_updated_at"),
        F.when(F.col("dealstage") != "P", F.col("createdate")).alias("_created_at"),
    )
    return inc.modified_since(rows, ("_updated_at", "_created_at"), "1998-06-30")


def _order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order twice; the second copy is newer, older or undated by its status."""
    orders = a.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    moved = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 5 days"))
        .when(F.col("o_orderstatus") == "O", F.col("o_orderdate") - F.expr("interval 5 days"))
    )
    changed = orders.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderdate": moved})
    return orders.unionByName(changed).withColumnRenamed("o_orderdate", "modified")


@proof
def latest_per_key(spark, sf_dir):
    return inc.latest_per_key(_order_versions(spark, sf_dir), ["o_orderkey"], ["modified"])


@proof
def unify_history_and_live(spark, sf_dir):
    events = a.load(spark, sf_dir, "events")

    def part(rows: DataFrame, mode: str) -> DataFrame:
        return rows.select(
            F.lit("message").alias("event_type"),
            a.channel_of().alias("channel_id"),
            F.lit("").alias("channel_name"),
            a.message_id().alias("message_ts"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("props").alias("text"),
            F.lit("").alias("thread_ts"),
            F.lit("").alias("team"),
            F.lit("").alias("subtype"),
            F.lit(a.LOAD_DATE).alias("processing_date"),
            F.lit(mode).alias("ingestion_mode"),
            (F.col("event_id") % 4).cast("int").alias("reply_count"),
        )

    until, since = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-20", "2024-01-10"))
    history = part(events.where(F.col("ts") < until), "historical").drop("event_type").withColumns(
        {"reactions": F.lit("[]"), "has_files": F.lit(0), "file_count": F.lit(0)}
    )
    stream = msg.live_messages(part(events.where(F.col("ts") >= since), "realtime"))
    return msg.unify_messages(history, stream).select(
        "channel_id", a.message_time("message_ts"), "user_id", "text", "reply_count", "ingestion_mode"
    )


@proof
def ingest_state_upsert(spark, sf_dir):
    events = a.load(spark, sf_dir, "events")
    log = events.select(
        F.col("event_type").alias("pipeline"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("resource"),
        F.col("props").alias("state"),
        F.lit(False).alias("completed"),
        F.col("event_id").alias("version"),
        (F.col("value") < 5).alias("cleared"),
    )
    return current_state(log).select("pipeline", "resource", "state", "version")


# Landing ----------------------------------------------------------------------------


def _line_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.load(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Id"),
        F.col("l_suppkey").cast("string").alias("AccountId"),
        F.col("l_partkey").cast("string").alias("Product2Id"),
        F.col("l_returnflag").alias("Status"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("Price"),
    )


@proof
def page_explode(spark, sf_dir):
    folder = scratch(spark, "pages")
    a.write_pages(_line_assets(spark, sf_dir), "records", folder)
    records = read_pages(spark, folder, "sales", "Asset")
    return coerce(records, SALES["Asset"]).select("Id", "AccountId", "Product2Id", "Status", "Quantity", "Price")


@proof
def bronze_append(spark, sf_dir):
    spec, folder = SALES["Asset"], scratch(spark, "append")
    assets = _line_assets(spark, sf_dir)
    append_bronze(assets.where("Status = 'R'"), folder, spec)
    append_bronze(assets.where("Status <> 'R'"), folder, spec)
    return load_bronze(spark, folder, spec).select("Id", "AccountId", "Product2Id", "Status", "Quantity", "Price", "Name")


@proof
def users_page_landing(spark, sf_dir):
    """Customers as user pages, landed as the users dimension."""
    folder, spec = scratch(spark, "users"), CHAT["users"]
    members = a.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.concat("c_name", F.lit("@example.com")).alias("email"), F.col("c_mktsegment").alias("title")).alias("profile"),
        (F.col("c_acctbal") > 5000).alias("is_admin"),
        F.when(F.col("c_nationkey") > 10, "True").otherwise("no").alias("is_bot"),
    )
    a.write_pages(members, "members", f"{folder}/in")
    replace(coerce(flatten_users(read_pages(spark, f"{folder}/in", "chat", "users")), spec), f"{folder}/out")
    return load_bronze(spark, f"{folder}/out", spec)


@proof
def channels_page_landing(spark, sf_dir):
    """Suppliers as channel pages, landed as the channels dimension."""
    folder, spec = scratch(spark, "channels"), CHAT["channels"]
    channels = a.load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        (F.col("s_acctbal") < 0).alias("is_private"),
        (F.col("s_suppkey") + 1700000000).alias("created"),
        F.struct(F.col("s_name").alias("value"), F.lit("U1").alias("creator")).alias("purpose"),
        F.col("s_acctbal").alias("num_members"),
    )
    a.write_pages(channels, "channels", f"{folder}/in")
    replace(coerce(flatten_channels(read_pages(spark, f"{folder}/in", "chat", "channels")), spec), f"{folder}/out")
    return load_bronze(spark, f"{folder}/out", spec)


@proof
def marketing_load(spark, sf_dir):
    """Customers as contact pages and nations as owner pages, loaded and read as bronze."""
    root = scratch(spark, "marketing")
    lake = ingest.Lake(spark, root)
    properties = F.struct(F.col("c_name").alias("firstname"), F.col("c_mktsegment").alias("lifecyclestage"))
    contact = a.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), properties.alias("properties"), F.lit("2024-01-01").alias("createdAt")
    )
    a.write_pages(contact, "results", f"{root}/in/contacts")
    owner = a.load(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
        F.lower("n_name").alias("firstName"),
        F.col("n_nationkey").alias("userId"),
        F.array(F.struct(F.col("n_regionkey").cast("string").alias("id"), F.col("n_name").alias("name"))).alias("teams"),
    )
    a.write_pages(owner, "results", f"{root}/in/owners")
    sources = {name: f"{root}/in/{name}" for name in ("contacts", "owners")}
    ingest.run_family(lake, "marketing", sources, date(2024, 1, 31))
    contacts = lake.bronze("marketing", "contacts").select(
        "id", F.col("firstname").alias("first"), F.col("lifecyclestage").alias("detail"), "_created_at", "_updated_at"
    )
    owners = lake.bronze("marketing", "owners").select(
        "id", F.col("firstName").alias("first"), F.concat_ws("/", F.col("userId").cast("string"), "teams").alias("detail"),
        "_created_at", "_updated_at",
    )
    return contacts.unionByName(owners)


@proof
def custom_object_load(spark, sf_dir):
    """Parts as an object nobody declared: its table is typed by its pages."""
    root = scratch(spark, "custom")
    lake = ingest.Lake(spark, root)
    part = a.load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Id"),
        F.col("p_name").alias("Name"),
        F.col("p_size").alias("Size"),
        F.col("p_retailprice").alias("Price"),
        (F.col("p_size") > 25).alias("Large"),
        F.when(F.col("p_size") > 25, F.array("p_brand", "p_type")).alias("Labels"),
    )
    a.write_pages(part, "records", f"{root}/in")
    ingest.ingest_custom(lake, "Part", f"{root}/in", date(2024, 1, 1))
    return lake.bronze("sales", "Part")


@proof
def bronze_snapshot(spark, sf_dir):
    """Three loads of orders with a snapshot after the second, read through it."""
    root = scratch(spark, "snapshot")
    lake = ingest.Lake(spark, root)
    orders = a.load(spark, sf_dir, "orders")
    for day, state in enumerate(("O", "P", "F"), 1):
        deal = orders.select(
            F.col("o_orderkey").cast("string").alias("Id"),
            F.when(F.col("o_orderstatus") == state, f"changed {day}").otherwise("as before").alias("Name"),
            F.col("o_totalprice").alias("Amount"),
            F.when(F.col("o_orderstatus") == state, f"2024-01-0{day + 1}").otherwise("2024-01-01").alias("CreatedDate"),
        ).withColumn("LastModifiedDate", F.col("CreatedDate"))
        a.write_pages(deal, "records", f"{root}/in/{day}")
        ingest.ingest_entity(lake, "sales", "Opportunity", f"{root}/in/{day}", date(2024, 2, day))
        if day == 2:
            lake.take_snapshot("sales", "Opportunity")
    return lake.bronze("sales", "Opportunity").select("Id", "Name", "Amount", "CreatedDate")


@proof
def landing_roundtrip(spark, sf_dir):
    folder = scratch(spark, "landing")
    orders = a.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
        F.col("o_orderstatus").alias("stage"),
    )
    land(orders, folder, ["year", "month"], ["o_orderkey"], codec="zstd")
    # Same partitions of one year again, changed: replaces them and no others.
    again = orders.where(F.col("year") == 1998).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    land(again, folder, ["year", "month"], ["o_orderkey"], codec="gzip")
    return read_landed(spark, folder, orders.schema).select(orders.columns)


@proof
def parquet_roundtrip(spark, sf_dir):
    folder = scratch(spark, "parquet")
    rows = a.load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_parquet(rows, folder, "zstd")
    return read_landed(spark, folder)


@proof
def bronze_table_views(spark, sf_dir):
    spec = SALES["Opportunity"]
    tables.drop_table(spark, spec.table)
    tables.create_spec_table(spark, spec, scratch(spark, "bronze"))
    tables.insert_rows(a.opportunities(spark, sf_dir), spec.table)
    marts.publish_views(spark, "sales")
    return _rounded(tables.query(spark, "SELECT * FROM v_sales_pipeline_summary"))


@proof
def ingest_two_loads(spark, sf_dir):
    """A full load of accounts, then a load of those changed since, read as bronze."""
    root = scratch(spark, "ingest")
    lake = ingest.Lake(spark, root)
    customer = a.load(spark, sf_dir, "customer")

    def pages(modified: str, balance, rows: DataFrame, folder: str) -> str:
        records = rows.select(
            F.col("c_custkey").cast("string").alias("Id"),
            F.col("c_name").alias("Name"),
            balance.alias("AnnualRevenue"),
            F.lit(modified).alias("LastModifiedDate"),
        )
        a.write_pages(records, "records", f"{root}/in/{folder}")
        return f"{root}/in/{folder}"

    first = pages("2024-01-01", F.col("c_acctbal"), customer, "first")
    ingest.run_family(lake, "sales", {"Account": first}, date(2024, 1, 1))
    second = f"{root}/in/second"
    pages("2023-12-31", F.lit(0.0), customer.where("c_mktsegment = 'BUILDING'"), "second")
    pages("2024-01-02", F.col("c_acctbal") + 1, customer.where("c_mktsegment <> 'BUILDING'"), "second")
    ingest.run_family(lake, "sales", {"Account": second}, date(2024, 1, 2))
    return lake.bronze("sales", "Account").select("Id", "Name", "AnnualRevenue", "LastModifiedDate")


def _deal_pages(rows: DataFrame, stage, modified: str, folder: str) -> str:
    records = rows.withColumns(
        {"StageName": stage, "CreatedDate": F.lit("2023-01-01"), "LastModifiedDate": F.lit(modified)}
    )
    a.write_pages(records, "records", folder)
    return folder


@proof
def ingest_changed_undated(spark, sf_dir):
    """Deals whose stage changes in a second load; the table declares no modification time."""
    root = scratch(spark, "changed")
    lake, deals = ingest.Lake(spark, root), a.opportunities(spark, sf_dir)
    moved = deals.where("CAST(Id AS BIGINT) % 3 = 0")
    first = _deal_pages(deals, F.col("StageName"), "2024-01-01", f"{root}/in/1")
    second = _deal_pages(moved, F.lit("Closed Won"), "2024-01-02", f"{root}/in/2")
    _deal_pages(deals.where("CAST(Id AS BIGINT) % 3 = 1"), F.lit("Stale"), "2023-12-31", f"{root}/in/2b")
    ingest.run_family(lake, "sales", {"Opportunity": first}, date(2024, 1, 1))
    ingest.run_family(lake, "sales", {"Opportunity": [second, f"{root}/in/2b"]}, date(2024, 1, 2))
    return _rounded(marts.opportunity_stage_rollup(lake.bronze("sales", "Opportunity")))


@proof
def ingest_after_reset(spark, sf_dir):
    """Deals loaded, forgotten, and loaded again from an export that holds half of them."""
    root = scratch(spark, "reset")
    lake, deals = ingest.Lake(spark, root), a.opportunities(spark, sf_dir)
    half = deals.where("CAST(Id AS BIGINT) % 2 = 0")
    first = _deal_pages(deals, F.col("StageName"), "2024-01-05", f"{root}/in/1")
    second = _deal_pages(half, F.lit("Again"), "2024-01-01", f"{root}/in/2")
    ingest.run_family(lake, "sales", {"Opportunity": first}, date(2024, 1, 1))
    ingest.reset(lake, "sales")
    ingest.run_family(lake, "sales", {"Opportunity": second}, date(2024, 1, 1))
    return lake.bronze("sales", "Opportunity").select("Id", "StageName", "Amount", "Probability")


@proof
def custom_object_two_sessions(spark, sf_dir):
    """An undeclared object whose whole numbers become fractions in a load of another session."""
    root = scratch(spark, "custom-sessions")
    parts = a.load(spark, sf_dir, "part")
    old = parts.select(F.col("p_partkey").cast("string").alias("Id"), F.col("p_size").alias("Size"), F.col("p_type").alias("Kind"))
    new = parts.where("p_partkey % 2 = 0").select(
        F.col("p_partkey").cast("string").alias("Id"), (F.col("p_size") + F.lit(0.5)).alias("Size"), F.col("p_brand").alias("Brand")
    )
    for k, records in enumerate((old, new)):
        a.write_pages(records, "records", f"{root}/in/{k}")
        ingest.ingest_custom(ingest.Lake(spark, root), "Part__c", f"{root}/in/{k}", date(2024, 1, 1 + k))
    return ingest.Lake(spark, root).bronze("sales", "Part__c").select("Id", "Size", "Kind", "Brand")


@proof
def chat_late_replies(spark, sf_dir):
    """A thread whose replies arrive in two later loads that bring no message."""
    root = scratch(spark, "late")
    lake = ingest.Lake(spark, root)
    talk = a.load(spark, sf_dir, "conversations").select(
        F.lit("C1").alias("channel_id"),
        F.concat(F.col("conv_id").cast("string"), F.lit("."), F.lpad(F.col("turn").cast("string"), 6, "0")).alias("ts"),
        F.concat(F.col("conv_id").cast("string"), F.lit(".000000")).alias("thread_ts"),
        F.col("role").alias("user"), "text", "turn", F.when(F.col("turn") == 0, "2").alias("reply_count"),
    )

    def pages(rows: DataFrame, folder: str) -> str:
        page = F.to_json(F.struct(F.array(F.struct("ts", "thread_ts", "user", "text", "reply_count")).alias("messages")))
        rows.select("channel_id", page.alias("value")).write.partitionBy("channel_id").text(f"{root}/in/{folder}")
        return f"{root}/in/{folder}"

    parents = pages(talk.where("turn = 0"), "parents")
    for k, until in enumerate((0, 2, 1_000_000)):
        replies = pages(talk.where(F.col("turn") <= until), f"replies{k}")
        ingest.backfill_chat(lake, date(2024, 2, 1 + k), messages=parents, replies=replies)
    return lake.bronze("chat", "messages").select("message_ts", "thread_ts", "user_id", "text", "reply_count", "processing_date")


@proof
def chat_backfill(spark, sf_dir):
    """Chat history in two loads that overlap, with thread replies, read as bronze."""
    root = scratch(spark, "backfill")
    lake = ingest.Lake(spark, root)
    raw = a.numbered_messages(a.load(spark, sf_dir, "events")).select(
        "channel_id", F.col("message_ts").alias("ts"), F.col("user_id").cast("string").alias("user"),
        F.col("props").alias("text"), "event_type", F.col("ts").alias("at"), "reply_ts",
    )
    history = raw.withColumn("reply_count", F.when(F.col("event_type") == "view", 1))
    history = history.withColumn("thread_ts", F.when(F.col("event_type") == "view", F.col("ts")))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")

    def pages(rows: DataFrame, folder: str) -> str:
        one = F.struct(*[c for c in ("ts", "user", "text", "reply_count", "thread_ts") if c in rows.columns])
        page = F.to_json(F.struct(F.array(one).alias("messages")))
        rows.select("channel_id", page.alias("value")).write.partitionBy("channel_id").text(f"{root}/in/{folder}")
        return f"{root}/in/{folder}"

    thread = history.where("event_type = 'view'").drop("reply_count")
    reply = thread.withColumn("ts", F.col("reply_ts")).withColumn("text", F.lit("reply"))
    replies = pages(thread.unionByName(reply), "replies")
    for day, rows in (("first", history.where(F.col("at") < cut)), ("second", history)):
        load_date = date(2024, 2, 1) if day == "first" else date(2024, 2, 2)
        ingest.backfill_chat(lake, load_date, messages=pages(rows, day), replies=replies)
    return lake.bronze("chat", "messages").select(
        a.told_channel("channel_id"), a.told_time("message_ts"), "user_id", "text", a.told_time("thread_ts"), "reply_count", "processing_date"
    )


# Streaming --------------------------------------------------------------------------


def _live_run(spark: SparkSession, sf_dir: str, start: Callable) -> str:
    """Envelopes in two waves, every one redelivered in the second, around a restart."""
    root = scratch(spark, "live")
    texts = a.envelopes_json(spark, sf_dir)
    greeting = F.lit('{"type":"hello","connection_info":{"app_id":"A1"}}')
    hello = a.load(spark, sf_dir, "region").select(greeting.alias("value"))
    for wave in (texts.unionAll(hello), texts):
        a.write_texts(wave, f"{root}/in")
        start(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", interval=None).awaitTermination()
    return f"{root}/out"


def _events_stream(spark, source, sink, checkpoint, **options):
    return live.start_event_stream(spark, source, sink, checkpoint, load_date=F.lit(a.LOAD_DATE), **options)


@proof
def stream_event_landing(spark, sf_dir):
    return live.read_events(spark, _live_run(spark, sf_dir, _events_stream))


@proof
def stream_new_checkpoint(spark, sf_dir):
    """All events landed, then again by a query with a new checkpoint on the same sink."""
    root = scratch(spark, "new-checkpoint")
    a.write_texts(a.envelopes_json(spark, sf_dir), f"{root}/in")
    for checkpoint in ("first", "second"):
        _events_stream(spark, f"{root}/in", f"{root}/out", f"{root}/{checkpoint}", interval=None).awaitTermination()
    return live.read_events(spark, f"{root}/out")


@proof
def stream_high_water_marks(spark, sf_dir):
    return live.read_marks(spark, _live_run(spark, sf_dir, _events_stream))


@proof
def stream_counters(spark, sf_dir):
    return live.read_counters(spark, _live_run(spark, sf_dir, live.start_event_counters))


# Maintained tables and views -------------------------------------------------------

for _query in (
    maintained.merge_buckets, maintained.merge_pending, maintained.maintained_stages, maintained.maintained_counts,
    maintained.channel_activity_increments, maintained.user_activity_increments, maintained.distinct_companies,
    catalog.scan_by_suffix, catalog.column_catalog, catalog.table_overview, catalog.family_statistics, catalog.truncate_and_reload,
    catalog.file_attachments, catalog.run_states, catalog.feed_pause_resume, *threads.QUERIES.values(),
    *rescue.QUERIES.values(), *clustered.QUERIES.values(),
):
    proof(_query)


# Reports ----------------------------------------------------------------------------


@proof
def status_summary(spark, sf_dir):
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    )
    return reports.run_summary(a.load(spark, sf_dir, "orders").select(status.alias("status"), F.col("o_custkey").alias("records")))


@proof
def table_stats(spark, sf_dir):
    return reports.table_stats({t: a.load(spark, sf_dir, t) for t in TABLES})


@proof
def workspace_counts(spark, sf_dir):
    channels = a.load(spark, sf_dir, "nation").select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name")
    )
    return reports.channel_counts(a.chat_messages(spark, sf_dir), channels)


@proof
def workspace_totals(spark, sf_dir):
    frames = [a.load(spark, sf_dir, t) for t in ("nation", "customer", "events")]
    return reports.workspace_totals(*frames)


@proof
def storage_stats(spark, sf_dir):
    """Files of every table beside its rows; of the sizes, that they are there and agree."""
    stored = reports.storage_stats(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})
    rows = reports.table_stats({t: a.load(spark, sf_dir, t) for t in TABLES})
    agree = F.abs(F.col("total_size_mb") - F.col("total_size_bytes") / 1048576) <= 0.005
    return stored.join(rows.withColumnRenamed("name", "dataset"), "dataset").select(
        "dataset", "total_objects", "rows", (F.col("total_size_bytes") > 0).alias("has_bytes"), agree.alias("sizes_agree")
    )


@proof
def dataset_describe(spark, sf_dir):
    described = [reports.describe_dataset(a.load(spark, sf_dir, t), t) for t in TABLES]
    rows = described[0]
    for more in described[1:]:
        rows = rows.unionAll(more)
    return rows
