"""SQL counterparts of the named queries, for DuckDB over the same tables.

They are written from the definition of each operator, not from the Spark code: fixed-window and gap
sessions, ranks, intervals and lookups are plain SQL, and the outcome of parsing a broken JSON text
is stated by which defect the text was given.
"""

from __future__ import annotations

from eventlode.schemas import DEVICE_ROWS, EVENT_TYPE_ROWS

_EV = """
ev as (
  select cast(event_id as varchar) as event_id, event_id as event_no, cast(user_id as varchar) as user_id,
    user_id as user_no,
    'k' || cast(case when event_id % 10 = 9 then event_id - 1 else event_id end as varchar) as idempotency_key,
    case event_type when 'signup' then 'user_signup' when 'view' then 'page_view' when 'click' then 'page_view'
      when 'purchase' then 'purchase' else 'payment_failed' end as event_type,
    case when user_id % 10 < 5 then 'mobile' when user_id % 10 < 8 then 'desktop'
      when user_id % 10 = 8 then 'tablet' else 'other' end as device_type,
    '10.0.' || cast(user_id % 256 as varchar) || '.1' as ip_address,
    case user_id % 3 when 0 then 'US' when 1 then 'DE' else 'BR' end as country,
    ts as event_timestamp,
    cast(1 + event_id % 5 as int) as quantity,
    cast(value as decimal(12,2)) as unit_price,
    cast(cast(value as decimal(12,2)) * cast(1 + event_id % 5 as int)
      + case when event_id % 100 = 50 then 1 else 0 end as decimal(12,2)) as total_amount
  from events)"""

_DED = _EV + """,
ded as (
  select * exclude (rn) from (
    select *, row_number() over (partition by idempotency_key order by event_timestamp, event_id) as rn from ev)
  where rn = 1)"""

_SESS = _DED + """,
sess as (
  select user_id, time_bucket(interval 30 minute, event_timestamp) as window_start,
    time_bucket(interval 30 minute, event_timestamp) + interval 30 minute as window_end,
    count(*) as event_count, min(event_timestamp) as session_start, max(event_timestamp) as session_end,
    list(event_type order by event_timestamp, event_id) as event_types,
    list(event_id order by event_timestamp, event_id) as event_ids,
    first(device_type order by event_timestamp, event_id) as primary_device,
    first(ip_address order by event_timestamp, event_id) as primary_ip,
    first(country order by event_timestamp, event_id) as country
  from ded group by all)"""

_USERS = _SESS + """,
users as (
  select user_id, last(primary_device order by window_start) as device_type,
    last(country order by window_start) as country, count(*) as sessions
  from sess group by user_id),
dim as (
  select cast(c_custkey as bigint) as user_key, cast(c_custkey * 2 as varchar) as user_id, c_name as username,
    case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'free' else 'premium' end as plan_type,
    'active' as subscription_status, 'gold' as user_tier, n_name as country, date '2023-01-01' as signup_date,
    'organic' as signup_source, timestamp '2023-01-01' as effective_start_date,
    cast(null as timestamp) as effective_end_date, true as is_current, cast(1 as bigint) as version_number
  from customer left join nation on c_nationkey = n_nationkey),
due as (
  select dim.* from dim join users using (user_id) where plan_type = 'free' and sessions > 58)"""

_AS_OF = "timestamp '2024-02-01'"

_NEW_VERSIONS = f"""
new_versions as (
  select user_id, username, 'basic' as plan_type, subscription_status, 'silver' as user_tier, country, signup_date,
    signup_source, {_AS_OF} as effective_start_date, cast(null as timestamp) as effective_end_date,
    true as is_current, version_number + 1 as version_number
  from due)"""

_FIRST_VERSIONS = f"""
first_versions as (
  select user_id, cast(null as varchar) as username, 'free' as plan_type, 'active' as subscription_status,
    'bronze' as user_tier, country, date '2024-02-01' as signup_date, 'organic' as signup_source,
    {_AS_OF} as effective_start_date, cast(null as timestamp) as effective_end_date, true as is_current,
    cast(1 as bigint) as version_number
  from users where user_id not in (select user_id from dim))"""

_EXPIRED = f"""
expired as (
  select user_key, user_id, username, plan_type, subscription_status, user_tier, country, signup_date, signup_source,
    effective_start_date,
    case when user_id in (select user_id from due) then {_AS_OF} else effective_end_date end as effective_end_date,
    user_id not in (select user_id from due) as is_current, version_number
  from dim)"""


def _keyed(source: str) -> str:
    return (
        "(select cast((select max(c_custkey) from customer) + row_number() over (order by md5(user_id), user_id) "
        f"as bigint) as user_key, * from {source})"
    )


# What becomes of each defect: kind is the id modulo one hundred.
_RAW = """
raw as (
  select event_id, ts, user_id, event_id % 100 as kind, value,
    case event_type when 'signup' then 'user_signup' when 'view' then 'page_view' when 'click' then 'page_view'
      when 'purchase' then 'purchase' else 'payment_failed' end as kind_name
  from events)"""

_ISO = "replace(cast(ts as varchar), ' ', 'T') || '+00:00'"

_RAW_TEXT = _RAW + f""",
texts as (
  select *, case when kind = 7 then '{{"event_id":"7","user_' when kind = 8 then 'event_id=8;user_id=3'
    when kind = 9 then '[1,2]' when kind = 10 then 'null'
    else '{{"event_id":"' || event_id || '"'
      || case when kind = 1 then '' else ',"user_id":"' || user_id || '"' end
      || ',"timestamp":' || case kind when 2 then '"yesterday noon"' when 3 then '"2024-02-30T10:00:00Z"'
           when 4 then '" "' when 5 then 'null' when 6 then '86400' else '"' || {_ISO} || '"' end
      || ',"event_type":"' || kind_name || '","schema_version":"v1","idempotency_key":"k' || event_id || '"'
      || case when kind = 11 then ',"client_build":"2211","debug":true' else '' end
      || ',"payload":' || case kind when 12 then 'null' when 13 then '"amount=9.90"' when 14 then '["P1",2]'
           when 15 then '{{"note":"nothing the registry asks for"}}'
           else '{{"email":"a@b.c","username":"u","signup_source":"organic","page_url":"https://x","session_id":"s",'
             || '"transaction_id":"T' || event_id || '","product_id":"P","total_amount":"'
             || cast(cast(value as decimal(12,2)) as varchar)
             || '","currency":"USD","failure_reason":"card_declined","error_code":"ERR_002"}}' end
      || '}}' end as raw_value
  from raw)"""

_UNREADABLE = "kind in (7, 8, 9, 10)"
_REQUIRED_FAIL = "kind in (1, 5, 7, 8, 9, 10)"
_STRICT_FAIL = "kind in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)"
_GOOD = f"not {_STRICT_FAIL}"

_CLOSED = "(select max(ts) - interval 10 minute from raw where " + _GOOD + ")"

_RAW_WINDOWS = _RAW + f""",
windows as (
  select cast(user_id as varchar) as user_id, time_bucket(interval 30 minute, ts) as window_start,
    time_bucket(interval 30 minute, ts) + interval 30 minute as window_end, count(*) as event_count,
    min(ts) as session_start, max(ts) as session_end,
    array_to_string(list(kind_name order by ts, event_id), ',') as event_types,
    array_to_string(list(cast(event_id as varchar) order by ts, event_id), ',') as event_ids
  from raw where {_GOOD} group by all)"""

_TUMBLING = f"""with {_RAW_WINDOWS}
select *, cast(cast(window_start as date) as varchar) as date from windows where window_end <= {_CLOSED}"""


def _gap(source: str) -> str:
    """Gaps and islands over (user_id, t): a session starts where the gap exceeds thirty minutes."""
    return f"""
marked as (
  select *, case when t - lag(t) over w <= interval 30 minute then 0 else 1 end as starts
  from {source} window w as (partition by user_id order by t)),
numbered as (
  select *, sum(starts) over (partition by user_id order by t) as n from marked),
gaps as (
  select user_id, min(t) as session_start, max(t) + interval 30 minute as session_end,
    max(t) as last_event_at, count(*) as event_count, first(device order by t) as primary_device
  from numbered group by user_id, n)"""


def _values(rows: list[tuple], columns: str) -> str:
    def text(value: object) -> str:
        if isinstance(value, bool):
            return "true" if value else "false"
        return str(value) if isinstance(value, int) else f"'{value}'"

    lines = ",\n    ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"(values {lines}) as t({columns})"


_DEVICES = _values(
    [(key, *row) for key, row in enumerate(DEVICE_ROWS, start=1)],
    "device_key, device_type, device_category, os_family, browser_family, is_mobile, is_tablet, is_desktop",
)
_EVENT_TYPES = _values(
    [(key, *row) for key, row in enumerate(EVENT_TYPE_ROWS, start=1)],
    "event_type_key, event_type, event_category, description",
)

_DEVICE_KEY = "case device_type when 'mobile' then 1 when 'tablet' then 6 when 'desktop' then 8 else 16 end"
_TIME_KEY = (
    "case when year({0}) between 2020 and 2030 then date_diff('hour', timestamp '2020-01-01', "
    "date_trunc('hour', {0})) + 1 end"
)
_TIME_KEY_EVENT = _TIME_KEY.format("event_timestamp")

_FACTS = _DED + f""",
facts as (
  select event_no, event_id, idempotency_key, case when user_no % 2 = 0
      and user_no / 2 <= (select max(c_custkey) from customer) then cast(user_no // 2 as bigint) end as user_key,
    cast({_TIME_KEY_EVENT} as bigint) as time_key, cast({_DEVICE_KEY} as bigint) as device_key, event_type,
    'v1' as schema_version, ip_address, country as geo_country,
    cast(case when event_type = 'page_view' then 1 else 0 end as bigint) as page_view_count,
    case when event_type = 'purchase' then total_amount else 0 end as amount,
    cast(case when event_type = 'purchase' then quantity else 0 end as bigint) as purchase_quantity,
    event_type = 'purchase' as is_conversion, event_type = 'payment_failed' as is_error, event_timestamp
  from ded)"""

_MART_FACTS = _EV + """,
facts as (
  select user_no + 1 as user_key, event_type, event_timestamp,
    case when event_type = 'purchase' then total_amount else 0 end as purchase_amount,
    case when event_type = 'purchase' then quantity else 0 end as purchase_quantity
  from ev),
dim as (
  select cast(c_custkey as bigint) as user_key, cast(c_custkey * 2 as varchar) as user_id,
    lower(c_name) || '@example.com' as email,
    case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'free' else 'premium' end as plan_type,
    'active' as subscription_status, date '2023-01-01' as signup_date, n_name as country, c_custkey % 7 <> 0 as is_current
  from customer left join nation on c_nationkey = n_nationkey)"""


def _half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator to two places, halves up, in whole numbers (both are positive)."""
    return f"((200 * {numerator} + {denominator}) // (2 * {denominator})) / 100.0"


_DAU_ROWS = _MART_FACTS + f""",
dau as (
  select cast(event_timestamp as date) as activity_date, count(distinct user_key) as daily_active_users,
    cast(count(*) as bigint) as total_events,
    {_half_up('count(*)', 'count(distinct user_key)')} as avg_events_per_user
  from facts group by 1)"""

_REVENUE_ROWS = _MART_FACTS + f""",
sums as (
  select f.user_key, d.user_id, d.email, d.plan_type, d.subscription_status, count(*) as total_purchases,
    sum(purchase_amount) as total, cast(sum(purchase_amount) * 100 as bigint) as cents,
    cast(sum(purchase_quantity) as bigint) as total_items, min(event_timestamp) as first_purchase_at,
    max(event_timestamp) as last_purchase_at
  from facts f left join dim d on f.user_key = d.user_key and d.is_current
  where event_type = 'purchase' and purchase_amount > 0 group by 1, 2, 3, 4, 5),
revenue as (
  select user_key, user_id, email, plan_type, subscription_status, total_purchases,
    cast(total as double) as total_revenue, total_items,
    ((2 * cents + total_purchases) // (2 * total_purchases)) / 100.0 as avg_order_value,
    {_half_up('total_items', 'total_purchases')} as avg_items_per_order, first_purchase_at, last_purchase_at,
    cast(date_diff('day', cast(first_purchase_at as date), cast(last_purchase_at as date)) as bigint)
      as customer_lifespan_days
  from sums)"""

_CHURN_CTES = """,
moved as (
  select user_key, event_timestamp - to_days(cast(user_key % 40 as int)) as event_timestamp from facts),
activity as (
  select m.user_key, d.user_id, d.email, d.plan_type, d.subscription_status, d.signup_date,
    max(event_timestamp) as last_activity_at, count(*) as total_events,
    count(distinct cast(event_timestamp as date)) as active_days,
    cast(date_diff('day', cast(max(event_timestamp) as date), date '2024-02-05') as bigint)
      as days_since_last_activity
  from moved m left join dim d on m.user_key = d.user_key and d.is_current group by 1, 2, 3, 4, 5, 6),
levels as (
  select *, days_since_last_activity >= 7 as is_at_churn_risk,
    case when days_since_last_activity >= 30 then 'high' when days_since_last_activity >= 14 then 'medium'
      when days_since_last_activity >= 7 then 'low' else 'none' end as churn_risk_level
  from activity)"""
_CHURN_ROWS = _MART_FACTS + _CHURN_CTES
_BOTH_ROWS = _REVENUE_ROWS + _CHURN_CTES

_VOLUME = """
days as (select cast(cast(ts as date) as varchar) as date, cast(ts as date) as day, count(*) as n from events group by all),
volume as (
  select d.date, d.n, count(p.n) as days_before, avg(p.n) as mean_before
  from days d left join days p on p.day between d.day - 7 and d.day - 1 group by all),
checked as (
  select date, abs(n - mean_before) / mean_before * 100 as deviation,
    case when days_before = 0 then 'WARNING' when abs(n - mean_before) / mean_before * 100 <= 5 then 'PASSED'
      else 'FAILED' end as status
  from volume)"""


def _failures(rows: list[tuple[str, str, str, str]]) -> str:
    return "\nunion all\n".join(
        f"select '{table}' as table_name, '{column}' as column_name, '{test}' as test, "
        f"cast({failures} as bigint) as failures, case when {failures} = 0 then 'pass' else 'fail' end as status"
        for table, column, test, failures in rows
    )


_NULL_USERS = "(select count(*) from facts where user_key is null)"
_NULL_BUYERS = ("(select count(*) from (select 1 from facts where user_key is null and amount > 0 limit 1))")
_NULL_IDLE = ("(select count(*) from (select user_key, max(event_timestamp) as t from facts group by 1) "
              "where user_key is null and date_diff('day', cast(t as date), date '2024-02-05') >= 7)")

_COLUMN_TESTS = [
    ("fact_events", "event_key", "unique", "0"), ("fact_events", "event_key", "not_null", "0"),
    ("fact_events", "event_id", "not_null", "0"),
    ("fact_events", "idempotency_key", "unique",
     "(select count(*) from (select idempotency_key from facts group by 1 having count(*) > 1))"),
    ("fact_events", "idempotency_key", "not_null", "0"),
    ("fact_events", "event_type", "not_null", "0"),
    ("fact_events", "event_type", "accepted_values",
     "(select count(*) from facts where event_type not in "
     "('user_signup', 'page_view', 'purchase', 'payment_failed'))"),
    ("fact_events", "event_timestamp", "not_null", "0"),
    ("dim_user", "user_key", "unique",
     "(select count(*) from (select c_custkey from customer group by 1 having count(*) > 1))"),
    ("dim_user", "user_key", "not_null", "(select count(*) from customer where c_custkey is null)"),
    ("dim_user", "user_id", "not_null", "0"),
    ("dim_user", "is_current", "not_null", "0"), ("dim_user", "is_current", "accepted_values", "0"),
    ("dim_time", "time_key", "unique", "0"), ("dim_time", "time_key", "not_null", "0"),
    ("dim_device", "device_key", "unique", "0"), ("dim_device", "device_key", "not_null", "0"),
    ("daily_active_users", "activity_date", "unique", "0"), ("daily_active_users", "activity_date", "not_null", "0"),
    ("daily_active_users", "daily_active_users", "not_null", "0"),
    ("revenue_per_user", "user_key", "unique", "0"), ("revenue_per_user", "user_key", "not_null", _NULL_BUYERS),
    ("revenue_per_user", "total_revenue", "not_null", "0"),
    ("churn_risk", "user_key", "unique", "0"), ("churn_risk", "user_key", "not_null", _NULL_IDLE),
    ("churn_risk", "days_since_last_activity", "not_null", "0"),
    ("churn_risk", "churn_risk_level", "not_null", "0"),
    ("churn_risk", "churn_risk_level", "accepted_values", "0"),
    ("churn_risk", "is_at_churn_risk", "not_null", "0"), ("churn_risk", "is_at_churn_risk", "accepted_values", "0"),
    ("fact_events", "user_key", "relationships",
     "(select count(*) from facts where user_key not in (select c_custkey from customer))"),
    ("fact_events", "time_key", "relationships", "0"), ("fact_events", "device_key", "relationships", "0"),
]

_USER_COLUMNS = (
    "user_key, user_id, username, plan_type, subscription_status, user_tier, country, signup_date, signup_source, "
    "effective_start_date, effective_end_date, is_current, version_number"
)

_SESSION_OUT = """user_id, window_start, window_end, event_count, session_start, session_end,
  array_to_string(event_types, ',') as event_types, array_to_string(event_ids, ',') as event_ids"""

_LATE = _EV + """,
first_delivery as (select * from ev where event_no % 20 <> 3),
mark as (select max(event_timestamp) - interval 10 minute as t from first_delivery),
last_mark as (select max(event_timestamp) - interval 10 minute as t from ev),
windowed as (
  select *, time_bucket(interval 30 minute, event_timestamp) as window_start from ev
  where event_no % 20 <> 3
    or time_bucket(interval 30 minute, event_timestamp) + interval 30 minute > (select t from mark))"""

_HISTORY = """
changes as (
  select cast(c_custkey * 2 as varchar) as user_id, 'free' as plan_type, timestamp '2023-01-01' as changed_at
  from customer
  union all
  select cast(c_custkey * 2 as varchar), 'basic', timestamp '2024-01-10' + to_days(cast(c_custkey % 10 as int))
  from customer),
history as (
  select user_id, plan_type, changed_at as effective_start_date,
    lead(changed_at) over (partition by user_id order by changed_at) as effective_end_date,
    lead(changed_at) over (partition by user_id order by changed_at) is null as is_current,
    row_number() over (partition by user_id order by changed_at) as version_number
  from changes)"""

_PRODUCT_KEY = (
    "case when event_no % 250 in (select p_partkey from part) then cast(event_no % 250 as bigint) end"
)

ORACLE_SQL: dict[str, str] = {
    # parsing and validation
    "json_parse": f"""with {_RAW}
select event_id as source_id,
  case when not {_UNREADABLE} then cast(event_id as varchar) end as event_id,
  case when not {_UNREADABLE} and kind <> 1 then cast(user_id as varchar) end as user_id,
  case when {_UNREADABLE} or kind = 5 then null when kind = 2 then 'yesterday noon'
    when kind = 3 then '2024-02-30T10:00:00Z' when kind = 4 then ' ' when kind = 6 then '86400'
    else {_ISO} end as event_time_text,
  case when not {_UNREADABLE} then kind_name end as event_type,
  case when not {_UNREADABLE} then 'v1' end as schema_version,
  case when not {_UNREADABLE} then 'k' || event_id end as idempotency_key,
  case when not {_UNREADABLE} and kind not in (12, 13, 14, 15) then 'T' || event_id end as transaction_id,
  case when not {_UNREADABLE} and kind not in (12, 13, 14, 15) then 'USD' end as currency
from raw""",
    "validate_split": f"""with {_RAW}
select event_id as source_id, case when {_REQUIRED_FAIL} then 'invalid' else 'valid' end as side from raw""",
    "dlq_rate": f"""with {_RAW}
select cast(ts as date) as day, count(*) as total, count(*) filter ({_STRICT_FAIL}) as dead,
  cast(count(*) filter ({_STRICT_FAIL}) as double) / count(*) as dlq_rate,
  cast(count(*) filter ({_STRICT_FAIL}) as double) / count(*) > 0.01 as over_limit
from raw group by 1""",
    "registry_validate": f"""with {_RAW}
select event_id as source_id,
  case when {_UNREADABLE} then 'unregistered' when kind in (1, 5) then 'missing_field'
    when kind in (12, 13, 14, 15) then 'invalid_payload' else 'ok' end as registry_status,
  cast(case when kind in (1, 5) then 1 when not {_UNREADABLE} then 0 end as bigint) as fields_missing,
  cast(case when {_UNREADABLE} then null when kind not in (12, 13, 14, 15) then 0
    when kind_name = 'purchase' then 4 when kind_name = 'page_view' then 2 else 3 end as bigint) as payload_missing
from raw""",
    "corruption_classify": f"""with {_RAW}
select event_id as source_id,
  case when {_UNREADABLE} then 'malformed_json' when kind = 1 then 'missing_field'
    when kind in (2, 3, 4, 5, 6) then 'invalid_timestamp' when kind in (12, 13, 14, 15) then 'invalid_payload'
    when kind = 11 then 'extra_fields' else 'clean' end as defect
from raw""",
    # streams
    "bronze_ingest": f"""with {_RAW_TEXT}
select cast(event_id as varchar) as kafka_key, ts as kafka_timestamp, raw_value,
  case when not {_UNREADABLE} then cast(event_id as varchar) end as event_id,
  case when not {_UNREADABLE} and kind <> 1 then cast(user_id as varchar) end as user_id,
  case when not {_UNREADABLE} then kind_name end as event_type,
  case when not {_UNREADABLE} and kind not in (2, 3, 4, 5, 6) then cast(cast(ts as date) as varchar) end
    as partition_date
from texts""",
    "bronze_compacted": f"""with {_RAW_TEXT}
select cast(event_id as varchar) as kafka_key, ts as kafka_timestamp, raw_value,
  case when not {_UNREADABLE} then cast(event_id as varchar) end as event_id,
  case when not {_UNREADABLE} and kind <> 1 then cast(user_id as varchar) end as user_id,
  case when not {_UNREADABLE} then kind_name end as event_type,
  case when not {_UNREADABLE} and kind not in (2, 3, 4, 5, 6) then cast(cast(ts as date) as varchar) end
    as partition_date
from texts""",
    "dlq_route": f"""with {_RAW}
select cast(event_id as varchar) as kafka_key,
  case when {_REQUIRED_FAIL} then 'schema_validation_failed' else 'invalid_timestamp' end as dlq_reason,
  case when kind = 1 then 'user_id' when kind = 5 then 'timestamp'
    when {_UNREADABLE} then 'event_id,user_id,timestamp,event_type,idempotency_key' else '' end as missing_fields
from raw where {_STRICT_FAIL}""",
    "silver_tumbling": _TUMBLING,
    "restart_idempotent": _TUMBLING,
    "silver_sessions": f"""with {_RAW},
good as (select cast(user_id as varchar) as user_id, ts as t, '' as device from raw where {_GOOD}), {_gap('good')}
select * exclude (primary_device) from gaps where session_end <= {_CLOSED}""",
    "silver_tumbling_batch": f"""with {_SESS}
select {_SESSION_OUT}, primary_device, primary_ip, country, cast(cast(window_start as date) as varchar) as date
from sess""",
    "silver_sessions_batch": f"""with {_DED},
timed as (select user_id, event_timestamp as t, device_type as device from ded), {_gap('timed')}
select * from gaps""",
    "processed_feed": f"""with {_RAW}
select cast(user_id as varchar) as key, cast(event_id as varchar) as event_id, kind_name as event_type,
  case when kind not in (12, 13, 14, 15) then 'T' || event_id end as transaction_id
from raw where {_GOOD}""",
    "dedup_stream": f"with {_EV} select distinct idempotency_key from ev",
    "late_data": f"""with {_LATE}
select user_id, window_start, count(*) as event_count from windowed
where window_start + interval 30 minute <= (select t from last_mark) group by 1, 2""",
    "late_rows": f"""with {_LATE}
select cast(event_no as varchar) as event_id, event_timestamp,
  case when event_no % 20 = 3 then (select t from mark) end as watermark,
  case when event_no % 20 = 3 and event_timestamp <= (select t from mark) then 'late_event' end as dlq_reason
from ev""",
    "run_stream": f"""with {_RAW_WINDOWS}
select 'bronze' as table_name, count(*) as rows from raw
union all select 'dead_letters', count(*) from raw where {_STRICT_FAIL}
union all select 'silver_tumbling', count(*) from windows where window_end <= {_CLOSED}
union all select 'feed', count(*) from raw where {_GOOD}""",
    "live_revenue": f"""with {_RAW}
select cast(coalesce(sum(cast(value as decimal(12,2))) filter (kind not in (12, 13, 14, 15)), 0) as double)
  as live_revenue, count(*) as purchases
from raw where {_GOOD} and kind_name = 'purchase'""",
    "live_summary": f"""with {_BOTH_ROWS}, {_RAW}
select cast((select coalesce(sum(total), 0) from sums)
    + (select coalesce(sum(cast(value as decimal(12,2))), 0) from raw
       where {_GOOD} and kind_name = 'purchase' and kind not in (12, 13, 14, 15)) as double) as total_revenue,
  (select count(*) from levels where churn_risk_level = 'high') as high_risk_users""",
    "live_dau_patch": f"""with {_DAU_ROWS},
trend as (select * from dau order by activity_date limit 20)
select cast(activity_date as varchar) as date,
  daily_active_users + case when activity_date = (select max(activity_date) from trend)
    then (select count(distinct user_id) from events) else 0 end as daily_active_users,
  total_events, avg_events_per_user
from trend""",
    "live_dau": "select cast(ts as date) as day, count(distinct user_id) as live_users from events group by 1",
    "live_dau_merged": """select cast(cast(ts as date) as varchar) as date, count(distinct user_id) as daily_active_users,
  case when cast(ts as date) < date '2024-01-22' then count(distinct user_id) end as stored_users
from events group by cast(ts as date)""",
    "live_dau_sketch": """select cast(ts as date) as day, count(distinct user_id) as users, true as close
from events group by 1""",
    "live_recent": f"""with {_EV}
select event_id, user_id, event_type, event_timestamp from ev order by event_timestamp desc, event_id desc limit 10""",
    # batch operators
    "dedup_events": f"with {_DED} select idempotency_key, event_id, user_id, event_timestamp from ded",
    "explode_sessions": f"""with {_SESS}
select user_id, session_start as event_timestamp, unnest(event_ids) as event_id, unnest(event_types) as event_type,
  primary_device as device_type, event_count
from sess""",
    "users_from_sessions": f"with {_USERS} select user_id, device_type, country, sessions from users",
    "high_activity_users": f"with {_USERS} select user_id, sessions from users where sessions > 58",
    "silver_partition_read": f"""with {_SESS}
select user_id, window_start, event_count, '2024-01-15' as date from sess
where cast(window_start as date) = date '2024-01-15'""",
    # dimensions
    "dim_time_build": f"""with hours as (
  select distinct date_trunc('hour', ts) as h from events union select date_trunc('hour', o_orderdate) from orders)
select cast(date_diff('hour', timestamp '2020-01-01', h) + 1 as bigint) as time_key,
  cast(h as timestamp) as full_timestamp, cast(h as date) as date_actual, cast(year(h) as bigint) as year,
  cast(quarter(h) as bigint) as quarter, cast(month(h) as bigint) as month, strftime(h, '%B') as month_name,
  cast(week(h) as bigint) as week_of_year, cast(day(h) as bigint) as day_of_month,
  cast(isodow(h) as bigint) as day_of_week, strftime(h, '%A') as day_name, cast(hour(h) as bigint) as hour,
  cast(0 as bigint) as minute, isodow(h) in (6, 7) as is_weekend, false as is_holiday
from hours""",
    "dim_device_build": f"""with {_EV},
used as (select {_DEVICE_KEY} as device_key, count(*) as events from ev group by 1)
select cast(t.device_key as bigint) as device_key, device_type, device_category, os_family, browser_family, is_mobile,
  is_tablet, is_desktop, coalesce(events, 0) as events
from {_DEVICES} left join used on t.device_key = used.device_key""",
    "dim_event_type_build": f"""with {_EV}
select cast(event_type_key as bigint) as event_type_key, event_type, event_category, description,
  event_type in (select event_type from ev) as from_data
from {_EVENT_TYPES}""",
    "dim_reads": f"""select 'dim_user' as table_name, count(*) as rows, cast(min(c_custkey) as bigint) as low,
  cast(max(c_custkey) as bigint) as high from customer
union all select 'dim_product', count(*), cast(min(p_partkey) as bigint), cast(max(p_partkey) as bigint) from part
union all select 'dim_time', count(distinct date_trunc('hour', ts)),
  cast(min({_TIME_KEY.format('ts')}) as bigint), cast(max({_TIME_KEY.format('ts')}) as bigint) from events""",
    "surrogate_keys": f"""with {_DED}
select event_id, cast(1000 + row_number() over (order by md5(event_id), event_id) as bigint) as event_key from ded""",
    "time_lookup": f"""with {_EV}
select event_id, event_timestamp, cast({_TIME_KEY_EVENT} as bigint) as time_key from ev""",
    "event_type_lookup": f"""with {_EV}
select event_id, cast(t.event_type_key as bigint) as event_type_key, t.event_category, {_PRODUCT_KEY} as product_key
from ev left join {_EVENT_TYPES} on ev.event_type = t.event_type""",
    # user history
    "new_users": f"""with {_USERS}
select user_id, device_type, country from users where user_id not in (select user_id from dim)""",
    "scd2_insert_new": f"""with {_USERS}, {_FIRST_VERSIONS}
select {_USER_COLUMNS} from {_keyed('first_versions')}""",
    "scd2_expire": f"with {_USERS}, {_EXPIRED} select {_USER_COLUMNS} from expired",
    "scd2_upgrade": f"""with {_USERS}, {_NEW_VERSIONS}
select user_id, username, plan_type, user_tier, country, effective_start_date, is_current, version_number
from new_versions""",
    "scd2_full": f"""with {_USERS}, {_FIRST_VERSIONS}, {_NEW_VERSIONS}, {_EXPIRED},
added as (select * from first_versions union all by name select * from new_versions)
select {_USER_COLUMNS} from expired union all select {_USER_COLUMNS} from {_keyed('added')}""",
    "scd2_bucketed": f"""with {_USERS}, {_FIRST_VERSIONS}, {_NEW_VERSIONS}, {_EXPIRED},
added as (select * from first_versions union all by name select * from new_versions)
select {_USER_COLUMNS} from expired union all select {_USER_COLUMNS} from {_keyed('added')}""",
    "scd2_history": f"with {_HISTORY} select * from history",
    "view_current_users": f"with {_MART_FACTS} select user_key, user_id, plan_type, country from dim where is_current",
    "revenue_by_plan_pit": f"""with {_EV}, {_HISTORY}
select plan_type, cast(sum(total_amount) as double) as revenue, count(*) as purchases
from ev join history h on ev.user_id = h.user_id and event_timestamp >= effective_start_date
  and (effective_end_date is null or event_timestamp < effective_end_date)
where event_type = 'purchase' group by 1""",
    "revenue_by_plan_merged": f"""with {_EV}, {_HISTORY}
select plan_type, cast(sum(total_amount) as double) as revenue, count(*) as purchases
from ev join history h on ev.user_id = h.user_id and event_timestamp >= effective_start_date
  and (effective_end_date is null or event_timestamp < effective_end_date)
where event_type = 'purchase' group by 1""",
    # facts
    "fact_measures": f"""with {_EV}
select event_id, cast(case when event_type = 'page_view' then 1 else 0 end as bigint) as page_view_count,
  cast(case when event_type = 'purchase' then total_amount else 0 end as double) as purchase_amount,
  cast(case when event_type = 'purchase' then quantity else 0 end as bigint) as purchase_quantity,
  event_type = 'purchase' as is_conversion, event_type = 'payment_failed' as is_error,
  cast(case when event_type = 'purchase' then 99.99 else 0 end as double) as constant_purchase_amount,
  cast(case when event_type = 'purchase' then 1 else 0 end as bigint) as constant_purchase_quantity
from ev""",
    "fact_build": f"""with {_FACTS}
select event_id, idempotency_key, user_key, time_key, device_key, event_type, schema_version, ip_address, geo_country,
  page_view_count, cast(amount as double) as purchase_amount, purchase_quantity, is_conversion, is_error,
  event_timestamp, cast(1 as double) as data_quality_score
from facts""",
    "fact_upsert": f"""with {_DED},
rows as (
  select *, case when event_timestamp < timestamp '2024-01-16' then '2024-01-16' else '2024-01-31' end as load_date,
    case when event_type = 'purchase' then total_amount else 0 end as amount
  from ded),
keyed as (
  select *, row_number() over (order by load_date, md5(idempotency_key), idempotency_key) as event_key from rows)
select load_date, count(*) as rows, count(*) as keys, min(event_key) as low_key, max(event_key) as high_key,
  cast(sum(amount) as double) as amount, count(*) as inserted
from keyed group by 1""",
    "fact_key_filter": f"""with {_DED},
rows as (select *, cast(substr(idempotency_key, 2) as bigint) % 4 as part from ded),
dated as (
  select *, case part when 0 then '2024-01-10' when 3 then '2024-01-12' else '2024-01-11' end as load_date from rows),
keyed as (
  select *, row_number() over (order by load_date, md5(idempotency_key), idempotency_key) as event_key from dated)
select load_date, count(*) as rows, min(event_key) as low_key, max(event_key) as high_key, count(*) as keys,
  cast(case load_date when '2024-01-12' then 2 else 0 end as bigint) as loads_joined
from keyed group by 1""",
    "daily_rerun": f"""with {_DED}
select idempotency_key, event_id, row_number() over (order by md5(idempotency_key), idempotency_key) as event_key,
  (select count(*) from ded) as first_load, cast(0 as bigint) as second_load
from ded""",
    "fact_from_bronze": f"""with {_RAW}
select cast(event_id as varchar) as event_id, 'k' || event_id as idempotency_key,
  case when user_id % 2 = 0 and user_id / 2 <= (select max(c_custkey) from customer)
    then cast(user_id // 2 as bigint) end as user_key,
  cast({_TIME_KEY.format('ts')} as bigint) as time_key, cast(16 as bigint) as device_key, kind_name as event_type,
  case when kind not in (12, 13, 14, 15) then 's' end as session_id,
  cast(case when kind_name <> 'purchase' then 0 when kind not in (12, 13, 14, 15)
    then cast(value as decimal(12,2)) end as double) as purchase_amount,
  cast(case when kind_name = 'purchase' then 1 else 0 end as bigint) as purchase_quantity,
  kind_name = 'payment_failed' as is_error, ts as event_timestamp, ts as kafka_timestamp
from raw where {_GOOD}""",
    "fact_purchases_build": f"""with {_DED}
select event_id, case when user_no % 2 = 0 and user_no / 2 <= (select max(c_custkey) from customer)
    then cast(user_no // 2 as bigint) end as user_key,
  cast({_TIME_KEY_EVENT} as bigint) as time_key, {_PRODUCT_KEY} as product_key, 'T' || event_id as transaction_id,
  case when event_no % 2 = 0 then 'credit_card' else 'paypal' end as payment_method, 'USD' as currency,
  cast(total_amount as double) as amount, cast(0 as double) as discount_amount, cast(quantity as bigint) as quantity,
  case when event_type = 'purchase' then 'completed' else 'failed' end as status, event_timestamp
from ded where event_type in ('purchase', 'payment_failed')""",
    "view_denormalized": f"""with {_FACTS},
dim as (
  select c_custkey as k, cast(c_custkey * 2 as varchar) as user_id, lower(c_name) || '@example.com' as email,
    case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'free' else 'premium' end as plan_type,
    'active' as subscription_status, n_name as user_country
  from customer left join nation on c_nationkey = n_nationkey)
select event_no as event_key, event_id, event_type, event_timestamp, user_id, email, plan_type, subscription_status,
  user_country, cast(event_timestamp as date) as date_actual, cast(year(event_timestamp) as bigint) as year,
  cast(month(event_timestamp) as bigint) as month, strftime(event_timestamp, '%B') as month_name,
  strftime(event_timestamp, '%A') as day_name, cast(hour(event_timestamp) as bigint) as hour,
  isodow(event_timestamp) in (6, 7) as is_weekend, t.device_type, t.os_family, t.browser_family, t.is_mobile,
  cast(amount as double) as purchase_amount, purchase_quantity, is_conversion, is_error
from facts f left join dim on f.user_key = dim.k left join {_DEVICES} on f.device_key = t.device_key""",
    # marts and KPIs
    "mart_dau": f"with {_DAU_ROWS} select * from dau",
    "mart_materialize": f"with {_DAU_ROWS} select * from dau",
    "mart_revenue": f"with {_REVENUE_ROWS} select * from revenue",
    "mart_churn": f"with {_CHURN_ROWS} select * from levels where is_at_churn_risk",
    "mart_dau_incremental": f"with {_DAU_ROWS} select * from dau",
    "mart_revenue_incremental": f"with {_REVENUE_ROWS} select * from revenue",
    "mart_churn_incremental": f"with {_CHURN_ROWS} select * from levels where is_at_churn_risk",
    "churn_levels": f"""with {_CHURN_ROWS}
select churn_risk_level, count(*) as users, cast(sum(total_events) as bigint) as events from levels group by 1""",
    "kpi_dau": f"""with {_DAU_ROWS}
select cast(activity_date as varchar) as date, daily_active_users, total_events, avg_events_per_user
from dau order by activity_date limit 20""",
    "kpi_dau_latest": f"""with {_DAU_ROWS}
select cast(activity_date as varchar) as date, daily_active_users, total_events, avg_events_per_user
from dau order by activity_date desc limit 20""",
    "kpi_revenue_top": f"""with {_REVENUE_ROWS}
select user_key, total_revenue, total_purchases, avg_order_value from revenue
order by total_revenue desc, user_key limit 50""",
    "kpi_churn_high": f"""with {_CHURN_ROWS}
select user_key, days_since_last_activity, churn_risk_level from levels where churn_risk_level = 'high'
order by days_since_last_activity desc, user_key limit 50""",
    "kpi_summary": f"""with {_BOTH_ROWS}
select (select cast(coalesce(sum(total), 0) as double) from sums) as total_revenue,
  (select count(*) from levels where churn_risk_level = 'high') as high_risk_users""",
    # quality
    "dq_freshness": f"""with {_SESS}
select distinct cast(cast(window_start as date) as varchar) as date, 'Freshness Check' as check_name,
  'PASSED' as status from sess""",
    "dq_volume": f"""with {_VOLUME} select date, status, round(deviation, 6) as deviation_pct from checked""",
    "dq_nulls": f"""with {_RAW},
days as (
  select cast(cast(ts as date) as varchar) as date, count(*) as total_count,
    count(*) filter ({_UNREADABLE}) as e, count(*) filter ({_UNREADABLE} or kind = 1) as u,
    count(*) filter ({_UNREADABLE} or kind = 5) as t
  from raw group by 1),
profile as (
  select date, 'event_id' as column_name, total_count, e as null_count from days
  union all select date, 'user_id', total_count, u from days
  union all select date, 'timestamp', total_count, t from days
  union all select date, 'no_such_column', total_count, null from days)
select *, case when null_count = 0 then 'PASSED' else 'FAILED' end as status from profile""",
    "dq_report": f"""with {_VOLUME}
select date, case when status = 'FAILED' then 'FAILED' else 'PASSED' end as overall_status,
  cast(2 as bigint) as total_checks, cast(1 + case when status = 'PASSED' then 1 else 0 end as bigint)
    as passed_checks, cast(case when status = 'FAILED' then 1 else 0 end as bigint) as failed_checks
from checked""",
    "dq_log": f"""with {_VOLUME}
select 'Volume Check' as check_name, 'events' as table_name, 'volume' as check_type,
  case status when 'PASSED' then 'pass' when 'FAILED' then 'fail' else 'warning' end as status,
  cast(5 as double) as threshold_value
from checked""",
    "job_runs": f"""with {_DED}
select 'count_events' as job_name, 'batch' as job_type, 'success' as status, count(*) as records_processed,
  cast(null as varchar) as error_message
from ded""",
    "test_unique": f"""with {_EV}
select idempotency_key, count(*) as occurrences from ev group by 1 having count(*) > 1""",
    "test_not_null": f"with {_RAW} " + _failures([
        ("parsed", "event_id", "not_null", f"(select count(*) from raw where {_UNREADABLE})"),
        ("parsed", "user_id", "not_null", f"(select count(*) from raw where {_UNREADABLE} or kind = 1)"),
        ("parsed", "timestamp", "not_null", f"(select count(*) from raw where {_UNREADABLE} or kind = 5)"),
        ("parsed", "event_type", "not_null", f"(select count(*) from raw where {_UNREADABLE})"),
        ("parsed", "schema_version", "not_null", f"(select count(*) from raw where {_UNREADABLE})"),
    ]),
    "test_accepted_values": f"with {_EV} " + _failures([
        ("events", "event_type", "accepted_values",
         "(select count(*) from ev where event_type not in ('page_view', 'purchase'))"),
        ("events", "device_type", "accepted_values", "0"),
    ]),
    "test_relationships": f"""with {_EV}
select user_id, count(*) as occurrences from ev
where user_id not in (select cast(c_custkey * 2 as varchar) from customer) group by 1""",
    "column_tests": f"with {_FACTS} " + _failures(_COLUMN_TESTS),
    "purchase_total_check": f"""with {_EV}
select event_id, cast(unit_price as double) as unit_price, cast(quantity as bigint) as quantity,
  cast(total_amount as double) as total_amount
from ev where event_type = 'purchase' and total_amount <> unit_price * quantity""",
}
