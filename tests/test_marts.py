from tests.conftest import plan, rows
from tidewell.model import CHAT, MARKETING, SALES
from tidewell.operators.coerce import coerce
from tidewell.operators.tables import create_view, preview
from tidewell.plans import marts


def bronze(spark, spec, ddl, *values):
    return coerce(spark.createDataFrame(list(values), ddl), spec)


def test_stage_rollup(spark):
    frame = bronze(
        spark, SALES["Opportunity"], "StageName string, Amount double, Probability int",
        ("a", 1.0, 10), ("a", None, 20), ("b", 5.0, None), (None, None, None),
    )
    assert rows(marts.opportunity_stage_rollup(frame)) == [
        ("b", 1, 5.0, 5.0, None), ("a", 2, 1.0, 1.0, 15.0), (None, 1, None, None, None),
    ]


def test_account_overview_orders_nulls_last(spark):
    frame = bronze(
        spark, SALES["Account"], "Id string, Name string, AnnualRevenue double",
        ("1", "x", None), ("2", "y", 5.0), ("3", "z", 9.0), ("0", "w", 5.0),
    )
    got = marts.account_overview(frame)
    assert got.columns == ["account_id", "account_name", "Industry", "AnnualRevenue", "NumberOfEmployees", "account_type"]
    assert [r["account_id"] for r in got.collect()] == ["3", "0", "2", "1"]


def test_counting_views(spark):
    leads = bronze(spark, SALES["Lead"], "Status string, LeadSource string, Rating string",
                   ("n", "w", "h"), ("n", "w", "h"), ("n", None, "h"), ("n", None, "h"), ("n", None, "h"))
    assert rows(marts.lead_funnel(leads)) == [("n", None, "h", 3), ("n", "w", "h", 2)]
    cases = bronze(spark, SALES["Case"], "Status string, Priority string, Origin string, Type string",
                   ("s", "p", "o", "t"), ("s", "p", "o", None))
    assert rows(marts.case_analysis(cases)) == [("s", "p", "o", "t", 1), ("s", "p", "o", None, 1)]
    engagements = bronze(spark, MARKETING["engagements"], "hs_engagement_type string, hs_engagement_source string",
                         ("CALL", "API"), ("CALL", "API"), ("NOTE", "API"))
    assert rows(marts.engagement_summary(engagements)) == [("CALL", "API", 2), ("NOTE", "API", 1)]
    tickets = bronze(spark, MARKETING["tickets"],
                     "hs_ticket_priority string, hs_ticket_category string, hs_pipeline_stage string", ("LOW", "c", "1"))
    assert rows(marts.ticket_analysis(tickets)) == [("LOW", "c", "1", 1)]


def test_contact_lifecycle_ignores_null_companies(spark):
    frame = bronze(spark, MARKETING["contacts"], "lifecyclestage string, hs_lead_status string, company string",
                   ("lead", "NEW", "a"), ("lead", "NEW", "a"), ("lead", "NEW", None), (None, "NEW", None))
    assert rows(marts.contact_lifecycle(frame)) == [("lead", "NEW", 3, 1), (None, "NEW", 1, 0)]


def test_deals_and_companies(spark):
    deals = bronze(spark, MARKETING["deals"], "id string, amount string, createdate string",
                   ("1", "10.5", "2024-01-01"), ("2", "n/a", None), ("3", None, "2024-02-01"))
    assert rows(marts.deal_listing(deals).select("deal_id", "amount", "amount_value")) == [
        ("3", None, None), ("1", "10.5", 10.5), ("2", "n/a", None),
    ]
    companies = bronze(spark, MARKETING["companies"], "id string, name string, annualrevenue string",
                       ("1", None, "5"), ("2", "b", "x"), ("3", "a", "7.5"))
    assert rows(marts.company_overview(companies).select("id", "annualrevenue_value")) == [("3", 7.5), ("2", None), ("1", 5.0)]


def messages(spark):
    return bronze(
        spark, CHAT["messages"], "channel_id string, channel_name string, message_ts string, user_id string, reply_count int, file_count int",
        ("C1", "a", "999.5", "U1", 1, 0), ("C1", "a", "1000.25", "U2", 2, 1), ("C1", "a", "", None, 0, 0),
        ("C2", "b", "5", "U1", None, None),
    )


def test_chat_views(spark):
    frame = messages(spark)
    assert rows(marts.channel_activity(frame)) == [
        ("a", "C1", 3, 2, "1000.25", "999.5", 3, 1), ("b", "C2", 1, 1, "5", "5", None, None),
    ]
    assert rows(marts.user_activity(frame)) == [("U1", 2, 2, "999.5"), ("U2", 1, 1, "1000.25"), (None, 1, 1, None)]
    assert [r["message_ts"] for r in marts.compliance_timeline(frame).collect()] == ["1000.25", "999.5", "5", ""]
    events = bronze(spark, CHAT["realtime_events"], "event_type string, event_time string", ("m", "999.5"), ("r", "1000"), ("j", ""))
    assert [r["event_type"] for r in marts.live_feed(events).collect()] == ["r", "m", "j"]


def test_preview_of_an_ordered_view_is_a_top_k(spark):
    create_view(marts.compliance_timeline(messages(spark)), "v_timeline")
    got = preview(spark, "v_timeline", 2)
    assert "TakeOrderedAndProject(limit=2" in plan(got)
    assert [r["message_ts"] for r in got.collect()] == ["1000.25", "999.5"]


def test_rollups_read_only_their_columns_and_combine_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "opportunity")
    bronze(spark, SALES["Opportunity"], "Id string, StageName string, Amount double", ("1", "a", 1.0)).write.parquet(path)
    text = plan(marts.opportunity_stage_rollup(spark.read.parquet(path)))
    assert "ReadSchema: struct<StageName:string,Amount:double,Probability:int>" in text
    assert "partial_sum(Amount" in text
    path = str(tmp_path / "messages")
    messages(spark).write.parquet(path)
    text = plan(marts.channel_activity(spark.read.parquet(path)))
    assert "SortAggregate" not in text and "text:string" not in text
