"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from . import clustered, rescue, threads
from .queries import TABLES

# Seconds since 2024-01-01 as text, and the channel of an event.
_US = "(epoch_us(ts) - 1704067200000000)"
_TS = f"(({_US} // 1000000)::VARCHAR || '.' || lpad(({_US} % 1000000)::VARCHAR, 6, '0'))"
_CHANNEL = "('C' || (user_id % 15)::VARCHAR)"
_MONEY = "CAST(CAST({0} AS DECIMAL(18,2)) AS VARCHAR)"

_DEALS = f"""
    SELECT o_orderkey::VARCHAR AS deal_id,
           'Order ' || o_orderkey::VARCHAR AS dealname,
           o_orderstatus AS dealstage,
           {_MONEY.format('o_totalprice')} AS amount,
           strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS closedate,
           'default' AS pipeline,
           CASE WHEN o_custkey % 2 = 0 THEN 'newbusiness' ELSE 'existingbusiness' END AS dealtype,
           o_orderpriority AS hs_priority,
           strftime(o_orderdate, '%Y-%m-%d') AS createdate,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount_value
    FROM orders"""

_STAGES = """
    SELECT o_orderpriority AS "StageName",
           COUNT(*) AS deal_count,
           ROUND(SUM(o_totalprice), 2) AS total_amount,
           ROUND(AVG(o_totalprice), 4) AS avg_amount,
           ROUND(AVG((o_orderkey % 8) * 10 + 10), 4) AS avg_probability
    FROM orders GROUP BY 1"""
_CHANGED_STAGES = """
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'Closed Won' ELSE o_orderpriority END AS "StageName",
           COUNT(*) AS deal_count,
           ROUND(SUM(o_totalprice), 2) AS total_amount,
           ROUND(AVG(o_totalprice), 4) AS avg_amount,
           ROUND(AVG((o_orderkey % 8) * 10 + 10), 4) AS avg_probability
    FROM orders GROUP BY 1"""

_CLASSIFIED = f"""
    SELECT CASE event_type WHEN 'view' THEN 'message' WHEN 'click' THEN 'reaction_added'
                ELSE 'member_joined_channel' END AS event_type,
           {_CHANNEL} AS channel_id,
           'U' || user_id::VARCHAR AS user_id,
           CASE event_type WHEN 'view' THEN props WHEN 'click' THEN ':r' || (event_id % 10)::VARCHAR || ':'
                ELSE 'joined channel' END AS text,
           {_TS} AS message_ts,
           '' AS thread_ts,
           CASE event_type WHEN 'click' THEN '' ELSE 'T1' END AS team,
           CASE event_type WHEN 'click' THEN '' ELSE 'channel' END AS channel_type,
           CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'reaction' ELSE 'member_join' END AS subtype,
           CASE event_type WHEN 'view' THEN ({_US} // 1000000)::VARCHAR ELSE {_TS} END AS event_time,
           '2024-02-01' AS processing_date,
           'realtime' AS ingestion_mode,
           'e-' || event_id::VARCHAR AS envelope_id
    FROM events WHERE event_type IN ('view', 'click', 'signup')"""

_MESSAGES = f"""
    SELECT {_CHANNEL} AS channel_id, 'chan-' || (user_id % 15)::VARCHAR AS channel_name, {_TS} AS message_ts,
           user_id::VARCHAR AS user_id, event_id % 4 AS reply_count, event_id % 2 AS file_count,
           CAST({_TS} AS DECIMAL(28,9)) AS n
    FROM events"""

_VERSIONS = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS modified FROM orders
    UNION ALL
    SELECT o_orderkey, o_orderstatus, o_totalprice + 1,
           CASE o_orderstatus WHEN 'F' THEN o_orderdate + INTERVAL 5 DAY WHEN 'O' THEN o_orderdate - INTERVAL 5 DAY END
    FROM orders"""

# Catalog types as Spark names them.
_TYPE = """CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
               WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(column_type) END"""


def _described(table: str) -> str:
    return f"""
        SELECT '{table}' AS dataset, (SELECT COUNT(*) FROM {table}) AS num_rows,
               CAST(COUNT(*) OVER () AS INTEGER) AS num_columns, CAST(1 AS BIGINT) AS num_files,
               CAST(ROW_NUMBER() OVER () AS INTEGER) AS position, column_name AS "column", {_TYPE} AS type,
               TRUE AS nullable
        FROM (DESCRIBE SELECT * FROM {table})"""


_LINES = """
    SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS "Id", l_suppkey::VARCHAR AS "AccountId",
           l_partkey::VARCHAR AS "Product2Id", l_returnflag AS "Status",
           CAST(trunc(l_quantity) AS INTEGER) AS "Quantity", l_extendedprice AS "Price"
    FROM lineitem"""

ORACLE = {
    "opportunity_stage_rollup": _STAGES,
    "bronze_table_views": _STAGES,
    "account_overview": """
        SELECT c_custkey::VARCHAR AS account_id, c_name AS account_name, c_mktsegment AS "Industry",
               c_acctbal AS "AnnualRevenue", c_nationkey AS "NumberOfEmployees", n_name AS account_type
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "lead_funnel": """
        SELECT c_mktsegment AS "Status", 'src' || (c_custkey % 4)::VARCHAR AS "LeadSource",
               CASE WHEN c_acctbal > 5000 THEN 'Hot' WHEN c_acctbal > 0 THEN 'Warm' ELSE 'Cold' END AS "Rating",
               COUNT(*) AS lead_count
        FROM customer GROUP BY 1, 2, 3""",
    "case_analysis": """
        SELECT o_orderstatus AS "Status", o_orderpriority AS "Priority", 'o' || (o_custkey % 3)::VARCHAR AS "Origin",
               year(o_orderdate)::VARCHAR AS "Type", COUNT(*) AS case_count
        FROM orders GROUP BY 1, 2, 3, 4""",
    "contact_lifecycle": """
        SELECT c_mktsegment AS lifecyclestage, 's' || (c_custkey % 5)::VARCHAR AS hs_lead_status,
               COUNT(*) AS contact_count,
               COUNT(DISTINCT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END) AS unique_companies
        FROM customer GROUP BY 1, 2""",
    "deal_listing": _DEALS,
    "preview_topk": _DEALS + " ORDER BY createdate DESC, deal_id LIMIT 100",
    "company_overview": f"""
        SELECT s_suppkey::VARCHAR AS id, s_name AS name, 's' || s_suppkey::VARCHAR || '.example.com' AS domain,
               lower(r_name) AS industry, {_MONEY.format('s_acctbal')} AS annualrevenue,
               s_nationkey::VARCHAR AS numberofemployees,
               CASE WHEN s_acctbal > 0 THEN 'PARTNER' ELSE 'VENDOR' END AS type, n_name AS city, r_name AS state,
               CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS annualrevenue_value
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "engagement_summary": """
        SELECT event_type AS hs_engagement_type, 's' || (user_id % 3)::VARCHAR AS hs_engagement_source,
               COUNT(*) AS engagement_count
        FROM events GROUP BY 1, 2""",
    "ticket_analysis": """
        SELECT lang AS hs_ticket_priority, source AS hs_ticket_category, 'q' || quality::VARCHAR AS hs_pipeline_stage,
               COUNT(*) AS ticket_count
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2, 3""",
    "channel_activity": f"""
        SELECT channel_name, channel_id, COUNT(*) AS message_count, COUNT(DISTINCT user_id) AS unique_users,
               arg_max(message_ts, n) AS latest_message_ts, arg_min(message_ts, n) AS earliest_message_ts,
               CAST(SUM(reply_count) AS BIGINT) AS total_replies, CAST(SUM(file_count) AS BIGINT) AS total_files
        FROM ({_MESSAGES}) GROUP BY 1, 2""",
    "user_activity": f"""
        SELECT user_id, COUNT(*) AS message_count, COUNT(DISTINCT channel_id) AS channels_active,
               arg_max(message_ts, n) AS latest_message_ts
        FROM ({_MESSAGES}) GROUP BY 1""",
    "compliance_timeline": """
        SELECT 'C' || conv_id::VARCHAR AS channel_id, 'conv-' || conv_id::VARCHAR AS channel_name,
               conv_id::VARCHAR || '.' || lpad(turn::VARCHAR, 6, '0') AS message_ts, role AS user_id, text,
               '' AS thread_ts,
               CASE WHEN role = 'user'
                    THEN '[{"name":"user","users":["user"],"count":' || turn::VARCHAR || '}]' ELSE '[]' END AS reactions,
               'historical' AS ingestion_mode, '2024-02-01' AS processing_date
        FROM conversations""",
    "reaction_listing": """
        SELECT 'C' || conv_id::VARCHAR AS channel_id, conv_id::VARCHAR || '.' || lpad(turn::VARCHAR, 6, '0') AS ts,
               0 AS position, role AS name, role AS first_user, turn AS count
        FROM conversations WHERE role = 'user'""",
    "event_classification": _CLASSIFIED,
    "stream_event_landing": _CLASSIFIED,
    "stream_new_checkpoint": _CLASSIFIED,
    "ingest_changed_undated": _CHANGED_STAGES,
    "ingest_after_reset": """
        SELECT o_orderkey::VARCHAR AS "Id", 'Again' AS "StageName", o_totalprice AS "Amount",
               CAST((o_orderkey % 8) * 10 + 10 AS INTEGER) AS "Probability"
        FROM orders WHERE o_orderkey % 2 = 0""",
    "custom_object_two_sessions": """
        SELECT p_partkey::VARCHAR AS "Id", CASE WHEN p_partkey % 2 = 0 THEN p_size + 0.5 ELSE p_size END::DOUBLE AS "Size",
               CASE WHEN p_partkey % 2 = 1 THEN p_type END AS "Kind", CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS "Brand"
        FROM part""",
    "chat_late_replies": """
        SELECT conv_id::VARCHAR || '.' || lpad(turn::VARCHAR, 6, '0') AS message_ts, conv_id::VARCHAR || '.000000' AS thread_ts,
               role AS user_id, text, CAST(CASE WHEN turn = 0 THEN 2 ELSE 0 END AS INTEGER) AS reply_count,
               CASE WHEN turn = 0 THEN '2024-02-01' WHEN turn <= 2 THEN '2024-02-02' ELSE '2024-02-03' END AS processing_date
        FROM conversations c
        WHERE turn = 0 OR conv_id IN (SELECT conv_id FROM conversations WHERE turn = 0)""",
    "live_feed": f"""
        SELECT event_type, channel_id, user_id, text, message_ts, event_time, processing_date FROM ({_CLASSIFIED})""",
    "stream_high_water_marks": f"""
        SELECT channel_id, arg_max(message_ts, CAST(message_ts AS DECIMAL(28,9))) AS mark
        FROM ({_CLASSIFIED}) WHERE event_type = 'message' GROUP BY 1""",
    "stream_counters": """
        SELECT CASE event_type WHEN 'view' THEN 'message' WHEN 'click' THEN 'reaction_added'
                    WHEN 'signup' THEN 'member_joined_channel' ELSE event_type END AS event_type,
               2 * COUNT(*) AS events
        FROM events GROUP BY 1""",
    "flatten_property_bag": """
        SELECT c_custkey::VARCHAR AS id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS firstname,
               CAST(NULL AS VARCHAR) AS lastname,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS lifecyclestage,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey::VARCHAR END AS country,
               '2024-01-01' AS _created_at,
               CASE WHEN c_acctbal > 0 THEN '2024-01-02' ELSE '' END AS _updated_at
        FROM customer""",
    "coerce_declared": """
        SELECT event_id::VARCHAR AS "Id",
               CASE WHEN event_type = 'view' THEN json_extract_string(props, '$.k') END AS name_k,
               CASE event_type WHEN 'view' THEN NULL WHEN 'purchase' THEN '12.5' ELSE 'plain' END AS name_plain,
               CASE event_type WHEN 'view' THEN value WHEN 'click' THEN value WHEN 'error' THEN 0.0
                    WHEN 'signup' THEN user_id::DOUBLE END AS "Amount",
               CAST(CASE event_type WHEN 'view' THEN trunc(value) WHEN 'click' THEN 0 WHEN 'error' THEN 0
                    WHEN 'signup' THEN user_id END AS INTEGER) AS "Probability",
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'error' THEN 0
                    WHEN 'signup' THEN 1 END AS "IsClosed",
               CAST(NULL AS INTEGER) AS "IsWon",
               CAST(NULL AS VARCHAR) AS "StageName"
        FROM events""",
    "schema_inference": """
        SELECT event_id AS id,
               CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN user_id::DOUBLE ELSE value END AS reading,
               CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '7' ELSE 'seven' END AS clash,
               CAST(NULL AS VARCHAR) AS never
        FROM events""",
    "schema_inference_widen": """
        SELECT c_acctbal AS balance, c_custkey AS key, c_name AS name, CAST(NULL AS VARCHAR) AS nothing,
               c_mktsegment AS segment, c_nationkey::VARCHAR AS tag FROM customer
        UNION ALL
        SELECT p_partkey::DOUBLE, p_size::BIGINT, p_name, NULL, NULL, p_brand FROM part""",
    "dimension_flatten_users": """
        SELECT s_suppkey::VARCHAR AS id, s_name AS name, '' AS real_name,
               CASE WHEN s_acctbal > 0 THEN s_name || '@example.com' ELSE '' END AS email, '' AS title,
               CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS is_admin,
               CASE WHEN s_nationkey > 10 THEN 1 END AS is_bot, '' AS tz
        FROM supplier""",
    "dimension_flatten_channels": """
        SELECT n_nationkey::VARCHAR AS id, n_name AS name, CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END AS is_private,
               CAST(n_nationkey + 1700000000 AS BIGINT) AS created, '' AS creator, n_regionkey AS num_members,
               lower(n_name) AS topic, '' AS purpose
        FROM nation""",
    "nested_items_explode": """
        SELECT doc_id, lang, CAST(i - 1 AS INTEGER) AS position, line AS label, CAST(length(line) AS INTEGER) AS width
        FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""",
    "nested_values_explode": """
        SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS position, CAST(x AS DOUBLE) AS embedding
        FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
    "thread_expansion": """
        WITH sizes AS (SELECT conv_id, COUNT(*) - 1 AS replies FROM conversations GROUP BY 1),
        parents AS (
            SELECT c.*, CAST(replies AS INTEGER) AS reply_count,
                   CASE WHEN role = 'user' THEN conv_id::VARCHAR || '.000000' ELSE '' END AS thread_ts
            FROM conversations c JOIN sizes USING (conv_id) WHERE turn = 0)
        SELECT 'C' || conv_id::VARCHAR AS channel_id, conv_id::VARCHAR || '.000000' AS message_ts, role AS user_id, text,
               thread_ts, reply_count
        FROM parents
        UNION ALL
        SELECT 'C' || c.conv_id::VARCHAR, c.conv_id::VARCHAR || '.' || lpad(c.turn::VARCHAR, 6, '0'), c.role, c.text,
               c.conv_id::VARCHAR || '.000000', 0
        FROM conversations c JOIN parents p ON c.conv_id = p.conv_id
        WHERE c.turn > 0 AND p.thread_ts <> '' AND p.reply_count > 0""",
    "skip_completed": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
        WHERE EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = o.o_custkey AND x.o_orderstatus = 'O')""",
    "resume_from_hwm": f"""
        WITH e AS (SELECT event_id, {_CHANNEL} AS channel_id, {_TS} AS message_ts, CAST({_TS} AS DECIMAL(28,9)) AS n, ts
                   FROM events),
        marks AS (SELECT channel_id, MAX(n) AS mark FROM e WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1)
        SELECT event_id, channel_id, message_ts FROM e LEFT JOIN marks USING (channel_id)
        WHERE mark IS NULL OR n > mark""",
    "high_water_marks": f"""
        SELECT channel_id, arg_max(message_ts, n) AS mark FROM ({_MESSAGES}) GROUP BY 1""",
    "incremental_modified": """
        WITH d AS (
            SELECT o_orderkey::VARCHAR AS id,
                   CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS _updated_at,
                   CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS _created_at
            FROM orders)
        SELECT * FROM d
        WHERE COALESCE(_updated_at, _created_at) IS NULL OR COALESCE(_updated_at, _created_at) > '1998-06-30'""",
    "latest_per_key": f"""
        SELECT o_orderkey, o_orderstatus, o_totalprice, modified FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY modified DESC NULLS LAST) AS rn
            FROM ({_VERSIONS})) WHERE rn = 1""",
    "unify_history_and_live": f"""
        SELECT {_CHANNEL} AS channel_id, {_TS} AS message_ts, user_id::VARCHAR AS user_id, props AS text,
               CAST(CASE WHEN ts < TIMESTAMP '2024-01-20' THEN event_id % 4 ELSE 0 END AS INTEGER) AS reply_count,
               CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'historical' ELSE 'realtime' END AS ingestion_mode
        FROM events""",
    "ingest_state_upsert": """
        SELECT pipeline, resource, state, version FROM (
            SELECT event_type AS pipeline, 'user_' || user_id::VARCHAR AS resource, props AS state, event_id AS version,
                   value < 5 AS cleared,
                   ROW_NUMBER() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS rn
            FROM events) WHERE rn = 1 AND NOT cleared""",
    "page_explode": _LINES,
    "bronze_append": f'SELECT *, CAST(NULL AS VARCHAR) AS "Name" FROM ({_LINES})',
    "users_page_landing": """
        SELECT c_custkey::VARCHAR AS id, c_name AS name, '' AS real_name, c_name || '@example.com' AS email,
               c_mktsegment AS title, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS is_admin,
               CASE WHEN c_nationkey > 10 THEN 1 ELSE 0 END AS is_bot, '' AS tz
        FROM customer""",
    "channels_page_landing": """
        SELECT s_suppkey::VARCHAR AS id, s_name AS name, CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS is_private,
               s_suppkey + 1700000000 AS created, '' AS creator, CAST(trunc(s_acctbal) AS INTEGER) AS num_members,
               '' AS topic, s_name AS purpose
        FROM supplier""",
    "marketing_load": """
        SELECT c_custkey::VARCHAR AS id, c_name AS first, c_mktsegment AS detail, '2024-01-01' AS _created_at,
               '' AS _updated_at
        FROM customer
        UNION ALL
        SELECT 'n' || n_nationkey::VARCHAR, lower(n_name),
               n_nationkey::VARCHAR || '/[{"id":"' || n_regionkey::VARCHAR || '","name":"' || n_name || '"}]', '', ''
        FROM nation""",
    "custom_object_load": """
        SELECT p_partkey::VARCHAR AS "Id", p_name AS "Name", p_size::BIGINT AS "Size", p_retailprice AS "Price",
               CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS "Large",
               CASE WHEN p_size > 25 THEN '["' || p_brand || '","' || p_type || '"]' END AS "Labels"
        FROM part""",
    "bronze_snapshot": """
        SELECT o_orderkey::VARCHAR AS "Id",
               CASE o_orderstatus WHEN 'O' THEN 'changed 1' WHEN 'P' THEN 'changed 2' ELSE 'changed 3' END AS "Name",
               o_totalprice AS "Amount",
               CASE o_orderstatus WHEN 'O' THEN '2024-01-02' WHEN 'P' THEN '2024-01-03' ELSE '2024-01-04' END AS "CreatedDate"
        FROM orders""",
    "message_range": f"""
        SELECT event_id, {_TS} AS message_ts FROM events
        WHERE CAST({_TS} AS DECIMAL(28,9)) BETWEEN 999.5 AND 1000000.25""",
    "message_normalization": """
        SELECT 'C' || conv_id::VARCHAR AS channel_id, 'conv-' || conv_id::VARCHAR AS channel_name,
               conv_id::VARCHAR || '.' || lpad(turn::VARCHAR, 6, '0') AS message_ts, role AS user_id, text,
               '' AS thread_ts, CASE WHEN role = 'user' THEN 3 ELSE 0 END AS reply_count,
               CASE WHEN role = 'user'
                    THEN '[{"name":"user","users":["user"],"count":' || turn::VARCHAR || '}]' ELSE '[]' END AS reactions,
               CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS has_files,
               CASE WHEN role = 'assistant' THEN 2 ELSE 0 END AS file_count, '' AS team,
               CASE WHEN role = 'system' THEN 'notice' ELSE '' END AS subtype,
               '2024-02-01' AS processing_date, 'historical' AS ingestion_mode
        FROM conversations""",
    "dataset_describe": " UNION ALL ".join(_described(t) for t in TABLES),
    "landing_roundtrip": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%m') AS month, o_orderstatus AS stage
        FROM orders""",
    "parquet_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "ingest_two_loads": """
        SELECT c_custkey::VARCHAR AS "Id", c_name AS "Name",
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal ELSE c_acctbal + 1 END AS "AnnualRevenue",
               CASE WHEN c_mktsegment = 'BUILDING' THEN '2024-01-01' ELSE '2024-01-02' END AS "LastModifiedDate"
        FROM customer""",
    "chat_backfill": f"""
        WITH m AS (
            SELECT {_CHANNEL} AS channel_id, {_TS} AS message_ts, user_id::VARCHAR AS user_id, props AS text,
                   CASE WHEN event_type = 'view' THEN {_TS} ELSE '' END AS thread_ts,
                   CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS reply_count,
                   CASE WHEN ts < TIMESTAMP '2024-01-15' THEN '2024-02-01' ELSE '2024-02-02' END AS processing_date
            FROM events)
        SELECT channel_id, message_ts, user_id, text, thread_ts, reply_count, processing_date FROM m
        UNION ALL
        SELECT channel_id, message_ts || '5', user_id, 'reply', thread_ts, 0, processing_date FROM m WHERE reply_count = 1""",
    "status_summary": """
        SELECT COUNT(*) AS total, COUNT(*) FILTER (o_orderstatus = 'F') AS completed,
               COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failed,
               COUNT(*) FILTER (o_orderstatus = 'O') AS running, CAST(0 AS BIGINT) AS pending, CAST(0 AS BIGINT) AS paused,
               CAST(SUM(o_custkey) AS BIGINT) AS total_records
        FROM orders""",
    "table_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS name, 'table' AS type, COUNT(*) AS rows FROM {t}" for t in TABLES
    ),
    "storage_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, 1 AS total_objects, COUNT(*) AS rows, true AS has_bytes, true AS sizes_agree FROM {t}" for t in TABLES
    ),
    "workspace_counts": """
        SELECT 'C' || n_nationkey::VARCHAR AS channel_id, n_name AS name, COUNT(event_id) AS message_count
        FROM nation LEFT JOIN events ON n_nationkey = user_id % 15 GROUP BY 1, 2""",
    "workspace_totals": """
        SELECT 'channels' AS name, COUNT(*) AS rows FROM nation UNION ALL
        SELECT 'users', COUNT(*) FROM customer UNION ALL
        SELECT 'messages', COUNT(*) FROM events""",
    "merge_pending": """
        SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'newer' ELSE c_name END AS c_name, c_acctbal,
               CAST(CASE WHEN c_custkey % 5 = 0 THEN 3 ELSE 2 END AS INTEGER) AS v
        FROM customer""",
    "distinct_companies": """
        SELECT c_mktsegment AS lifecyclestage, 's' || (c_custkey % 5)::VARCHAR AS hs_lead_status,
               COUNT(DISTINCT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END) AS unique_companies
        FROM customer GROUP BY 1, 2""",
}

ORACLE["merge_buckets"] = ORACLE["bronze_snapshot"]
ORACLE["maintained_stages"] = ORACLE["opportunity_stage_rollup"]
ORACLE["channel_activity_increments"] = ORACLE["channel_activity"]
ORACLE["user_activity_increments"] = ORACLE["user_activity"]
ORACLE["maintained_counts"] = f"""
    SELECT 'Lead' AS view, "Status" AS g1, "LeadSource" AS g2, "Rating" AS g3, CAST(NULL AS VARCHAR) AS g4, lead_count AS rows
    FROM ({ORACLE["lead_funnel"]}) UNION ALL
    SELECT 'Case', "Status", "Priority", "Origin", "Type", case_count FROM ({ORACLE["case_analysis"]}) UNION ALL
    SELECT 'engagements', hs_engagement_type, hs_engagement_source, NULL, NULL, engagement_count FROM ({ORACLE["engagement_summary"]}) UNION ALL
    SELECT 'tickets', hs_ticket_priority, hs_ticket_category, hs_pipeline_stage, NULL, ticket_count FROM ({ORACLE["ticket_analysis"]})"""
ORACLE["scan_by_suffix"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
ORACLE["column_catalog"] = """
    SELECT 'bronze_columns_' || t AS "table", c AS name, k AS type, n AS rows
    FROM (VALUES ('region', 'r_regionkey', 'bigint'), ('region', 'r_name', 'string'), ('nation', 'n_nationkey', 'bigint'),
                 ('nation', 'n_name', 'string'), ('nation', 'n_regionkey', 'bigint'), ('customer', 'c_name', 'string'),
                 ('customer', 'c_acctbal', 'double'), ('customer', 'c_custkey', 'bigint'), ('customer', 'active', 'int'),
                 ('customer', 'tags', 'string')) x(t, c, k)
    JOIN (SELECT 'region' AS t, COUNT(*) AS n FROM region UNION ALL SELECT 'nation', COUNT(*) FROM nation
          UNION ALL SELECT 'customer', COUNT(*) FROM customer) USING (t)"""
ORACLE["table_overview"] = """
    SELECT 'bronze_overview_region' AS name, 'table' AS type, COUNT(*) AS rows FROM region UNION ALL
    SELECT 'bronze_overview_nation', 'table', COUNT(*) FROM nation UNION ALL
    SELECT 'bronze_overview_customer', 'table', COUNT(*) FROM customer UNION ALL
    SELECT 'v_overview_region', 'view', NULL"""
ORACLE["family_statistics"] = """
    SELECT 'bronze_chat_users' AS name, 'table' AS type, COUNT(*) AS rows FROM customer UNION ALL
    SELECT 'bronze_chat_channels', 'table', COUNT(*) FROM nation UNION ALL
    SELECT 'bronze_chat_messages', 'table', COUNT(*) FROM events UNION ALL
    SELECT 'bronze_chat_realtime_events', 'table', 0"""
ORACLE["truncate_and_reload"] = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'"
ORACLE["file_attachments"] = f"""
    SELECT {_CHANNEL} AS channel_id, {_TS} AS ts, CAST(k - 1 AS INTEGER) AS position, 'F' || event_id::VARCHAR || '-' || k::VARCHAR AS id,
           event_type || '.txt' AS name, CAST(length(props) * k AS INTEGER) AS size
    FROM (SELECT *, unnest(range(1, event_id % 4 + 1)) AS k FROM events WHERE event_id % 4 > 1)"""
ORACLE["run_states"] = """
    SELECT r_name AS pipeline, CASE WHEN r_regionkey % 2 = 1 THEN 'live' ELSE 'batch' END AS mode,
           CASE r_regionkey WHEN 3 THEN 'running' WHEN 4 THEN 'failed' ELSE 'completed' END AS state
    FROM region"""
ORACLE["feed_pause_resume"] = """
    SELECT 'stopped' AS state, false AS running,
           CASE event_type WHEN 'view' THEN 'message' WHEN 'click' THEN 'reaction_added'
                           WHEN 'signup' THEN 'member_joined_channel' ELSE event_type END AS event_type, COUNT(*) AS events
    FROM events GROUP BY 3"""
ORACLE |= threads.ORACLE | rescue.ORACLE | clustered.oracle(_CHANNEL, _TS)
