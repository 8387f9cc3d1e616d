"""ANSI SQL that gives the result of each registered query."""

from __future__ import annotations

_BASE = """
WITH source AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), common AS (
  SELECT event_type AS source_type, event_id AS number, value, k,
         'E' || event_id AS event_id,
         'E' || (event_id - 1 - k % 3) AS impression_id,
         'U' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(5, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS user_id,
         'C' || lpad(CAST(1 + k % 50 AS VARCHAR), 3, '0') AS campaign_id,
         '10.0.0.' || (1 + user_id % 10) AS ip_address,
         CAST(NULL AS VARCHAR) AS user_agent,
         CAST(NULL AS VARCHAR) AS geo_country,
         ts AS timestamp,
         'normal' AS fraud_label
  FROM source
), impressions AS (
  SELECT event_id, 'impression' AS event_type, user_id, campaign_id, ip_address, user_agent,
         geo_country, timestamp, fraud_label
  FROM common WHERE source_type = 'view'
), clicks AS (
  SELECT event_id, 'click' AS event_type, impression_id, user_id, campaign_id, ip_address,
         user_agent, CAST(round(value * 100) AS INTEGER) AS time_since_impression_ms,
         timestamp, fraud_label
  FROM common WHERE source_type = 'click'
), conversions AS (
  SELECT event_id, 'conversion' AS event_type, 'E' || (number + k % 9 - 4) AS click_id,
         impression_id, user_id, campaign_id, source_type AS conversion_type,
         value AS revenue_usd, timestamp, fraud_label
  FROM common WHERE source_type IN ('purchase', 'signup')
)"""


def _flagged(flood: int, bot: int, scope: str) -> str:
    """CTE ``flagged``: clicks with their flags; ``scope`` is an expression over a click."""
    return f"""{_BASE}, scoped AS (
  SELECT *, {scope} AS scope FROM clicks
), per_user AS (
  SELECT scope, user_id, count(event_id) AS n FROM scoped GROUP BY scope, user_id
), per_ip AS (
  SELECT scope, ip_address, count(DISTINCT campaign_id) AS n FROM scoped GROUP BY scope, ip_address
), flags AS (
  SELECT c.*, u.n > {flood} AS is_click_flood, i.n > {bot} AS is_bot_ip,
         c.time_since_impression_ms < 200 AS is_instant_click
  FROM scoped c
  LEFT JOIN per_user u ON c.scope = u.scope AND c.user_id = u.user_id
  LEFT JOIN per_ip i ON c.scope = i.scope AND c.ip_address = i.ip_address
), flagged AS (
  SELECT event_id, impression_id, user_id, campaign_id, ip_address, user_agent,
         time_since_impression_ms, timestamp, fraud_label, is_click_flood, is_bot_ip,
         is_instant_click, is_click_flood OR is_bot_ip OR is_instant_click AS is_fraud
  FROM flags
)"""


def _flagged_late(flood: int, bot: int, scope: str, late: str) -> str:
    """CTE ``flagged``: all clicks, flagged by the counts of those that are not late."""
    whole = _flagged(flood, bot, scope)
    counted = whole.replace("FROM scoped GROUP BY", f"FROM scoped WHERE NOT ({late}) GROUP BY")
    counted = counted.replace(f"u.n > {flood} AS", f"coalesce(u.n > {flood}, FALSE) AS")
    return counted.replace(f"i.n > {bot} AS", f"coalesce(i.n > {bot}, FALSE) AS")


def _alerts(flagged: str, width: str) -> str:
    """CTE ``alerts``: flagged clicks rolled up per window of the width and campaign."""
    return f"""{flagged}, counted AS (
  SELECT campaign_id, time_bucket(INTERVAL '{width}', timestamp) AS window_start,
         count(event_id) AS total_clicks,
         CAST(sum(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_clicks,
         CAST(sum(CAST(is_click_flood AS INTEGER)) AS BIGINT) AS flood_clicks,
         CAST(sum(CAST(is_bot_ip AS INTEGER)) AS BIGINT) AS bot_ip_clicks,
         CAST(sum(CAST(is_instant_click AS INTEGER)) AS BIGINT) AS instant_clicks
  FROM flagged GROUP BY 1, 2
), alerts AS (
  SELECT campaign_id, window_start, window_start + INTERVAL '{width}' AS window_end,
         total_clicks, fraud_clicks,
         round(fraud_clicks / CAST(total_clicks AS DOUBLE), 4) AS fraud_rate,
         flood_clicks, bot_ip_clicks, instant_clicks
  FROM counted
)"""


def _orphans(latest: str) -> str:
    """CTE ``checked``: conversions with the orphan flag; ``latest`` is the last time of a click."""
    return f"""{_BASE}, checked AS (
  SELECT v.event_id, v.click_id, v.impression_id, v.user_id, v.campaign_id, v.conversion_type,
         v.revenue_usd, v.timestamp, v.fraud_label, c.event_id IS NULL AS is_orphan_conversion,
         c.event_id IS NULL AS is_fraud
  FROM conversions v
  LEFT JOIN clicks c ON v.click_id = c.event_id
    AND c.timestamp >= v.timestamp - INTERVAL '30 minutes' AND c.timestamp <= {latest}
)"""


def _flagged_sliding(flood: int, bot: int) -> str:
    """CTE ``flagged``: clicks in any window of ten minutes, beginning at a minute, over a limit."""
    return f"""{_BASE}, paned AS (
  SELECT *, CAST(floor(epoch(timestamp) / 60) AS BIGINT) AS pane FROM clicks
), users AS (
  SELECT user_id, pane, count(event_id) AS n FROM paned GROUP BY user_id, pane
), user_sums AS (
  SELECT a.user_id, a.pane, sum(b.n) AS n FROM users a
  JOIN users b ON a.user_id = b.user_id AND b.pane BETWEEN a.pane - 9 AND a.pane GROUP BY a.user_id, a.pane
), per_user AS (
  SELECT a.user_id, a.pane, max(s.n) AS n FROM users a
  JOIN user_sums s ON a.user_id = s.user_id AND s.pane BETWEEN a.pane AND a.pane + 9 GROUP BY a.user_id, a.pane
), addresses AS (
  SELECT DISTINCT ip_address, pane, campaign_id FROM paned
), ip_sums AS (
  SELECT a.ip_address, a.pane, count(DISTINCT b.campaign_id) AS n FROM (SELECT DISTINCT ip_address, pane FROM addresses) a
  JOIN addresses b ON a.ip_address = b.ip_address AND b.pane BETWEEN a.pane - 9 AND a.pane GROUP BY a.ip_address, a.pane
), per_ip AS (
  SELECT a.ip_address, a.pane, max(s.n) AS n FROM ip_sums a
  JOIN ip_sums s ON a.ip_address = s.ip_address AND s.pane BETWEEN a.pane AND a.pane + 9 GROUP BY a.ip_address, a.pane
), flags AS (
  SELECT c.*, u.n > {flood} AS is_click_flood, i.n > {bot} AS is_bot_ip, c.time_since_impression_ms < 200 AS is_instant_click
  FROM paned c
  JOIN per_user u ON c.pane = u.pane AND c.user_id = u.user_id
  JOIN per_ip i ON c.pane = i.pane AND c.ip_address = i.ip_address
), flagged AS (
  SELECT event_id, impression_id, user_id, campaign_id, ip_address, user_agent,
         time_since_impression_ms, timestamp, fraud_label, is_click_flood, is_bot_ip,
         is_instant_click, is_click_flood OR is_bot_ip OR is_instant_click AS is_fraud
  FROM flags
)"""


_WHOLE = _flagged(13, 48, "1")
_TEN_MINUTES = _flagged(1, 1, "time_bucket(INTERVAL '10 minutes', timestamp)")
_LATE = _flagged_late(
    1, 1, "time_bucket(INTERVAL '10 minutes', timestamp)", "CAST(substr(event_id, 2) AS BIGINT) % 7 = 0"
)
_DAILY = _flagged(1, 8, "time_bucket(INTERVAL '1 day', timestamp)")
_PUBLISHED = _flagged(50, 20, "time_bucket(INTERVAL '10 minutes', timestamp)")
_ROW_LOCAL = f"""{_BASE}, flagged AS (
  SELECT *, FALSE AS is_click_flood, FALSE AS is_bot_ip,
         time_since_impression_ms < 200 AS is_instant_click,
         time_since_impression_ms < 200 AS is_fraud
  FROM clicks
)"""
_BOTH_WAYS = _orphans("v.timestamp + INTERVAL '30 minutes'")
_PRIOR = _orphans("v.timestamp")
_ONE_MINUTE_ROW_LOCAL = _alerts(_ROW_LOCAL, "1 minute") + " SELECT * FROM alerts"

ORACLE_SQL: dict[str, str] = {
    "parse_impressions": _BASE + " SELECT * FROM impressions",
    "parse_clicks": _BASE + " SELECT * FROM clicks",
    "parse_conversions": _BASE + " SELECT * FROM conversions",
    "click_counts_per_user": _BASE
    + " SELECT user_id, count(event_id) AS click_count FROM clicks GROUP BY user_id",
    "campaigns_per_ip": _BASE
    + " SELECT ip_address, count(DISTINCT campaign_id) AS distinct_campaigns FROM clicks"
    + " GROUP BY ip_address",
    "instant_clicks": _BASE + " SELECT * FROM clicks WHERE time_since_impression_ms < 200",
    "flag_clicks_batch": _WHOLE + " SELECT * FROM flagged",
    "flag_clicks_10min": _TEN_MINUTES + " SELECT * FROM flagged",
    "flag_clicks_daily": _DAILY + " SELECT * FROM flagged",
    "flag_clicks_sliding": _flagged_sliding(1, 1) + " SELECT * FROM flagged",
    "flag_orphans": _BOTH_WAYS + " SELECT * FROM checked",
    "flag_orphans_once": _BOTH_WAYS + " SELECT DISTINCT * FROM checked",
    "orphans_prior_only": _PRIOR + " SELECT * FROM checked",
    "orphan_anti_join": _BASE
    + """ SELECT * FROM conversions v WHERE NOT EXISTS (
        SELECT 1 FROM clicks c WHERE c.event_id = v.click_id
          AND c.timestamp BETWEEN v.timestamp - INTERVAL '30 minutes'
                              AND v.timestamp + INTERVAL '30 minutes')""",
    "alerts_1min": _alerts(_PUBLISHED, "1 minute") + " SELECT * FROM alerts",
    "alerts_10min": _alerts(_TEN_MINUTES, "10 minutes") + " SELECT * FROM alerts",
    "alerts_daily": _alerts(_DAILY, "1 day") + " SELECT * FROM alerts",
    "bronze_click_sample": _BASE + " SELECT * FROM clicks ORDER BY timestamp, event_id LIMIT 5",
    "fraud_click_sample": _DAILY
    + " SELECT * FROM flagged WHERE is_fraud ORDER BY timestamp, event_id LIMIT 10",
    "fraud_totals": _DAILY
    + """ SELECT count(*) AS total_clicks, count(*) FILTER (WHERE is_fraud) AS fraud_clicks,
        round(count(*) FILTER (WHERE is_fraud) / CAST(count(*) AS DOUBLE) * 100, 1) AS fraud_pct
        FROM flagged""",
    "top_alerts": _alerts(_DAILY, "1 day")
    + " SELECT * FROM alerts ORDER BY fraud_rate DESC NULLS LAST, window_start, campaign_id LIMIT 10",
    "orphan_report": _BOTH_WAYS
    + """ SELECT event_id, click_id, campaign_id, revenue_usd, is_orphan_conversion FROM checked
        WHERE is_orphan_conversion ORDER BY timestamp, event_id LIMIT 10""",
    "dedupe_clicks": _BASE
    + " SELECT DISTINCT * FROM (SELECT * FROM clicks UNION ALL SELECT * FROM clicks)",
    "dedupe_few_copies": _BASE
    + """ SELECT * FROM clicks UNION ALL
        SELECT clicks.* REPLACE (CAST(NULL AS VARCHAR) AS event_id) FROM clicks, (VALUES (1), (2)) AS twice (copy)
        WHERE CAST(substr(event_id, 2) AS BIGINT) % 50 = 0""",
    "stream_bronze_clicks": _BASE + " SELECT * FROM clicks",
    "stream_dedupe": _BASE
    + " SELECT DISTINCT * FROM (SELECT * FROM clicks UNION ALL SELECT * FROM clicks)",
    "stream_flag_clicks": _TEN_MINUTES + " SELECT * FROM flagged",
    "stream_flag_clicks_deferred": _TEN_MINUTES + " SELECT * FROM flagged",
    "stream_late_clicks": _LATE + " SELECT * FROM flagged",
    "stream_flag_clicks_microbatch": _WHOLE + " SELECT * FROM flagged",
    "stream_flag_orphans": _BOTH_WAYS + " SELECT * FROM checked",
    "stream_orphans_prior_only": _PRIOR + " SELECT * FROM checked",
    "stream_flag_orphans_once": _BOTH_WAYS + " SELECT DISTINCT * FROM checked",
    "stream_alerts_merged": _ONE_MINUTE_ROW_LOCAL,
    "stream_alerts_append": _ONE_MINUTE_ROW_LOCAL,
    "stream_alerts_complete": _ONE_MINUTE_ROW_LOCAL,
    "stream_alerts_update": _ONE_MINUTE_ROW_LOCAL,
    "medallion_alerts": _alerts(_TEN_MINUTES, "1 minute") + " SELECT * FROM alerts",
}
