"""The sample mapping once more, as SQL for the checking engine, independent of the Spark code."""

from __future__ import annotations

from usagelens.schemas import BODIES

BROKEN = "CAST(event_id AS BIGINT) % 101 = 0"
JUNK = "CAST(event_id AS BIGINT) % 1000 = 0"

_BODY_CASES = " ".join(f"WHEN '{kind}' THEN '{body}'" for kind, body in BODIES.items())
_STATUS = """CASE event_id % 7 WHEN 0 THEN '429' WHEN 1 THEN '400' WHEN 2 THEN '500'
    WHEN 3 THEN '401' ELSE 'undefined' END"""

_TABLES = """
dim_employees AS (
  SELECT concat('user', c_custkey, '@example.com') AS email, c_name AS full_name,
    c_mktsegment AS practice, concat('L', c_nationkey % 10 + 1) AS level, n_name AS location
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
kinds AS (
  SELECT *, CASE event_type WHEN 'view' THEN 'api_request' WHEN 'click' THEN 'tool_decision'
    WHEN 'purchase' THEN 'tool_result' WHEN 'error' THEN 'api_error' ELSE 'user_prompt' END AS kind
  FROM events),
all_stg AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, kind, epoch_us(ts) // 1000 AS epoch_ms,
    CASE kind {bodies} END AS body,
    concat('s', user_id, '-', CAST(ts AS DATE)) AS session_id,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 7 THEN concat('guest', user_id, '@example.com')
      ELSE concat('user', user_id, '@example.com') END AS user_email,
    kind AS event_name,
    CASE WHEN event_id % 61 = 0 THEN NULL ELSE concat('model-', event_id % 5) END AS model,
    CASE WHEN event_id % 97 = 0 THEN 'not_a_number' ELSE CAST(value AS VARCHAR) END AS cost_usd,
    CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS duration_ms,
    CAST(event_id % 900 AS VARCHAR) AS input_tokens,
    CAST(event_id % 450 + 1 AS VARCHAR) AS output_tokens,
    CAST(event_id * 37 % 90000 AS VARCHAR) AS cache_read_tokens,
    CAST(event_id * 13 % 6000 AS VARCHAR) AS cache_creation_tokens,
    CASE WHEN event_type = 'click' AND event_id % 50 = 3 THEN 'reject'
      WHEN event_type IN ('click', 'purchase') THEN 'accept' END AS decision,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'config' END AS decision_source,
    concat('tool-', event_id % 6) AS tool_name,
    CASE WHEN event_id % 15 = 0 THEN 'false' ELSE 'true' END AS success,
    concat('err-', {status}) AS error_message, {status} AS status_code,
    CAST(CAST(round(value * 10) AS BIGINT) AS VARCHAR) AS prompt_length
  FROM kinds),
stg AS (SELECT * FROM all_stg WHERE {where}),
fact_api_requests AS (
  SELECT epoch_ms, session_id, user_email, model, TRY_CAST(cost_usd AS DOUBLE) AS cost_usd,
    TRY_CAST(duration_ms AS BIGINT) AS duration_ms, TRY_CAST(input_tokens AS BIGINT) AS input_tokens,
    TRY_CAST(output_tokens AS BIGINT) AS output_tokens,
    TRY_CAST(cache_read_tokens AS BIGINT) AS cache_read_tokens,
    TRY_CAST(cache_creation_tokens AS BIGINT) AS cache_creation_tokens
  FROM stg WHERE kind = 'api_request'),
fact_tool_usage AS (
  SELECT epoch_ms, session_id, user_email, tool_name, decision, decision_source,
    CASE WHEN kind = 'tool_result' THEN success = 'true' END AS is_success,
    CASE WHEN kind = 'tool_result' THEN TRY_CAST(duration_ms AS BIGINT) END AS duration_ms,
    kind AS event_kind
  FROM stg WHERE kind IN ('tool_decision', 'tool_result')),
fact_api_errors AS (
  SELECT epoch_ms, session_id, user_email, model, error_message,
    TRY_CAST(status_code AS INTEGER) AS status_code
  FROM stg WHERE kind = 'api_error'),
fact_user_prompts AS (
  SELECT epoch_ms, session_id, user_email, TRY_CAST(prompt_length AS BIGINT) AS prompt_length
  FROM stg WHERE kind = 'user_prompt')
"""


def over(select: str, where: str = "true") -> str:
    """`select` over the mapped tables, built from the events that satisfy `where`."""
    tables = _TABLES.format(bodies=_BODY_CASES, status=_STATUS, where=where)
    return f"WITH {tables} {select}"



def without_broken(sql: str) -> str:
    """The same question, asked `over` the events whose message is whole."""
    return sql.replace("FROM all_stg WHERE true", f"FROM all_stg WHERE NOT {BROKEN}")
