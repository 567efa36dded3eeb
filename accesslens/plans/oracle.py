"""The registered queries restated as plain SQL for DuckDB.

Each statement is self-contained: the projections of ``events`` come first as common table
expressions, then the query is written from its definition, not from the Spark plan.
"""

from accesslens.constants import REPLY_REASONS, RISK_UNKNOWN

_NOW = "TIMESTAMP '2024-01-01 12:00:00'"
_UNKNOWN_REPLY = "099:Some other failure"


def _since(hours: int) -> str:
    return f"({_NOW} - INTERVAL {hours} HOUR)"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(column: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in table.items())
    return f"CASE {column} {arms} ELSE {default} END"


_REASON = _case("reply_msg", {k: v[0] for k, v in REPLY_REASONS.items()}, "reply_msg")
_RISK = _case("reply_msg", {k: v[1] for k, v in REPLY_REASONS.items()}, _quote(RISK_UNKNOWN))
_MESSAGE = (
    "CASE k % 7 "
    + " ".join(f"WHEN {n} THEN {_quote(m)}" for n, m in enumerate(REPLY_REASONS))
    + f" ELSE {_quote(_UNKNOWN_REPLY)} END"
)


def _base(name: str, factor: int) -> str:
    return f"""{name} AS (
  SELECT event_id AS id, user_id, event_type, value, k,
    make_timestamp(1704067200000000
      + ((epoch_us(ts) - 1704067200000000) // {factor * 1000}) * 1000) AS ts,
    'GDF' || (user_id + 10000) AS username,
    'a:' || user_id || '::gdf' || (user_id + 10000) AS raw_username,
    CASE WHEN k % 9 <> 0 THEN '02:00:00:00:00:0' || (k % 4) END AS mac_addr,
    CASE WHEN k % 9 <> 0 THEN '02-00-00-00-00-0' || (k % 4) END AS calling_sta,
    'bras-' || (user_id % 8) AS called_sta, '10.0.0.' || (user_id % 8) AS nas_ip,
    user_id % 16 AS nas_port, 'nas-' || (user_id % 8) AS nas_identifier,
    'slot=0;port=' || (user_id % 16) AS nas_port_id, 15 AS nas_port_type,
    '100.64.' || (user_id % 256) || '.' || k AS framed_ip,
    '10.0.0.' || (user_id % 8) AS src_ip, '10.9.0.1' AS dst_ip
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def _auth(name: str = "auth", factor: int = 60) -> str:
    return _base(f"{name}_base", factor) + f""",
{name} AS (
  SELECT *, ts - latency_ms * INTERVAL 1 MILLISECOND AS req_ts,
    {_REASON} AS reason_zh, {_RISK} AS risk_level
  FROM (SELECT *,
      CASE WHEN result = 3 THEN {_MESSAGE} ELSE '' END AS reply_msg,
      CASE WHEN k % 7 <> 0 THEN CAST(floor(value) AS INTEGER) END AS latency_ms
    FROM (SELECT *, CASE WHEN event_type = 'error' THEN 3
        WHEN event_type = 'signup' AND k % 10 = 0 THEN 11 ELSE 2 END AS result
      FROM {name}_base WHERE event_type IN ('signup', 'purchase', 'error'))))"""


def _acct(name: str = "acct", factor: int = 60) -> str:
    return _base(f"{name}_base", factor) + f""",
{name} AS (
  SELECT *, CASE WHEN k < 5 THEN 1 WHEN k >= 95 THEN 2 WHEN k = 50 THEN 7 ELSE 3 END
      AS acct_status_type,
    CASE WHEN k <> 77 THEN 's-' || user_id || '-' || (k % 3) END AS acct_session_id,
    CAST(floor(value * 100) AS BIGINT) AS input_octets,
    CAST(floor(value * 50) AS BIGINT) AS output_octets,
    CAST(CASE WHEN k % 20 = 0 THEN 1 ELSE 0 END AS BIGINT) AS input_gigawords,
    CAST(CASE WHEN k % 20 = 0 THEN 1 ELSE 0 END AS BIGINT) AS output_gigawords
  FROM {name}_base WHERE event_type IN ('click', 'view'))"""


_BUCKET = "time_bucket(INTERVAL 10 MINUTE, ts)"
_M = """count(*) AS request_count, count(*) FILTER (result = 2) AS accept_count,
  count(*) FILTER (result = 3) AS reject_count, min(ts) AS first_seen, max(ts) AS last_seen"""
_L = """count(latency_ms) AS latency_count,
  CAST(coalesce(sum(latency_ms), 0) AS BIGINT) AS latency_sum_ms,
  min(latency_ms) AS latency_min_ms, max(latency_ms) AS latency_max_ms"""
_MAIN = """arg_max(reason_zh, (ts, id)) FILTER (result = 3 AND reason_zh <> '') AS main_reason"""
_PLACE = ", ".join(
    f"arg_max({c}, (ts, id)) FILTER ({c} IS NOT NULL) AS {c}"
    for c in ("nas_ip", "nas_port", "nas_identifier", "nas_port_id")
)

_STAT = f"stat AS (SELECT {_BUCKET} AS bucket_start, {_M}, {_L} FROM auth GROUP BY 1)"
_REASON10 = f"""reason AS (SELECT {_BUCKET} AS bucket_start, result,
  coalesce(reason_zh, '') AS reason_zh, count(*) AS request_count, min(ts) AS first_seen,
  max(ts) AS last_seen FROM auth GROUP BY ALL)"""
_NAS10 = f"""nas AS (SELECT {_BUCKET} AS bucket_start, coalesce(nas_ip, '') AS nas_ip, {_M}
  FROM auth GROUP BY 1, 2)"""
_USER10 = f"""users AS (SELECT {_BUCKET} AS bucket_start, username, {_M}, {_MAIN}
  FROM auth GROUP BY 1, 2)"""
_USER_MAC10 = f"""terminals AS (SELECT {_BUCKET} AS bucket_start, username,
  coalesce(mac_addr, '') AS mac_addr, {_M}, {_MAIN}, {_PLACE} FROM auth GROUP BY 1, 2, 3)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


_RECORD = "ts, ts AS first_seen, ts AS last_seen, 1 AS request_count"
_RECENT = """username, raw_username, result, reason_zh, mac_addr, nas_ip, nas_identifier,
  nas_port_id, nas_port_type, nas_port"""
_KEY_HASH = """sha256(concat_ws(chr(31), strftime(bucket_start, '%Y-%m-%d %H:%M:%S.000'),
  username, src_ip, coalesce(mac_addr, '<NULL>'), nas_port_id, CAST(result AS VARCHAR)))"""


def _latest(*columns: str) -> str:
    return ", ".join(f"arg_max({c}, (ts, id)) FILTER ({c} IS NOT NULL) AS {c}" for c in columns)


# NULL attributes must survive, so the whole row is ranked instead of using arg_max.
_WIDE = f"""SELECT agg.*, row.raw_username, row.reply_msg, row.risk_level, row.calling_sta,
    row.called_sta, row.nas_ip, row.nas_port, row.nas_identifier, row.nas_port_type, row.framed_ip,
    fst.reason_zh, {_KEY_HASH.replace('bucket_start', 'agg.bucket_start').replace('username', 'agg.username').replace('src_ip', 'agg.src_ip').replace('mac_addr', 'agg.mac_addr').replace('nas_port_id', 'agg.nas_port_id').replace('result', 'agg.result')} AS rollup_key
  FROM (SELECT {_BUCKET} AS bucket_start, username, src_ip, mac_addr, nas_port_id, result,
      {_M}, {_L}, max((ts, id))[2] AS last_id, min((ts, id))[2] AS first_id
    FROM auth GROUP BY 1, 2, 3, 4, 5, 6) agg
  JOIN auth row ON row.id = agg.last_id JOIN auth fst ON fst.id = agg.first_id"""

_PER_MAC = f"""per_mac AS (SELECT username, mac_addr, sum(request_count) AS total_cnt,
  sum(accept_count) AS accept_cnt, sum(reject_count) AS reject_cnt, max(nas_ip) AS nas_ip,
  max(nas_identifier) AS nas_identifier, max(nas_port_id) AS nas_port_id,
  max(nas_port) AS nas_port, max(last_seen) AS last_seen
  FROM terminals WHERE bucket_start >= {_since(24)} AND mac_addr <> '' GROUP BY 1, 2)"""
_TOP_USERS = """top_users AS (SELECT username, CAST(sum(total_cnt) AS BIGINT) AS total_cnt,
  CAST(sum(accept_cnt) AS BIGINT) AS accept_cnt, CAST(sum(reject_cnt) AS BIGINT) AS reject_cnt,
  count(*) AS mac_count, count(DISTINCT nas_ip) AS nas_count, max(last_seen) AS last_seen
  FROM per_mac GROUP BY 1 HAVING count(*) >= 3
  ORDER BY mac_count DESC, total_cnt DESC, reject_cnt DESC, username LIMIT 100)"""


def _sums(**columns: str) -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in columns.items())


AUTH = {
    "rollup_stat_10m": _with(_auth(), _STAT, body="SELECT * FROM stat"),
    "rollup_reason_10m": _with(_auth(), _REASON10, body="SELECT * FROM reason"),
    "rollup_nas_10m": _with(_auth(), _NAS10, body="SELECT * FROM nas"),
    "rollup_user_10m": _with(_auth(), _USER10, body="SELECT * FROM users"),
    "rollup_user_mac_10m": _with(_auth(), _USER_MAC10, body="SELECT * FROM terminals"),
    "rollup_auth_wide_10m": _with(
        _auth(), body=f"SELECT * EXCLUDE (last_id, first_id) FROM ({_WIDE})"
    ),
    "user_summary": _with(_auth(), body="""SELECT username,
      count(*) FILTER (result = 2) AS accept_cnt, count(*) FILTER (result <> 2) AS reject_cnt,
      array_to_string(list_sort(list(DISTINCT mac_addr) FILTER (mac_addr IS NOT NULL)), ',')
        AS mac_list,
      array_to_string(list_sort(list(DISTINCT nas_ip)), ',') AS nas_list,
      arg_max(reason_zh, (ts, id)) FILTER (result <> 2 AND reason_zh <> '') AS main_reason,
      min(ts) AS first_seen, max(ts) AS last_seen FROM auth GROUP BY username"""),
    "nas_stats": _with(_auth(), body="""SELECT coalesce(nas_ip, 'unknown') AS nas_ip,
      count(*) AS total_cnt, count(*) FILTER (result = 2) AS accept_cnt,
      count(*) FILTER (result <> 2) AS reject_cnt, max(ts) AS last_seen FROM auth GROUP BY 1"""),
    "user_mac_summary": _with(_auth(), body=f"""SELECT upper(username) AS username, mac_addr,
      count(*) AS total_cnt, count(*) FILTER (result = 2) AS accept_cnt,
      count(*) FILTER (result = 3) AS reject_cnt, min(ts) AS first_seen, max(ts) AS last_seen,
      {_MAIN}, {_PLACE} FROM auth WHERE mac_addr IS NOT NULL GROUP BY 1, 2"""),
    "auth_rollup_states": _with(_auth(), body=f"""SELECT {_BUCKET} AS bucket, username,
      coalesce(mac_addr, '') AS mac_addr, nas_ip, reason_zh, count(*) AS requests,
      count(*) FILTER (result = 2) AS accepts, count(*) FILTER (result = 3) AS rejects,
      count(*) FILTER (result = 11) AS challenges, max(ts) AS last_seen FROM auth
      GROUP BY 1, 2, 3, 4, 5"""),
    "stats": _with(_auth(), _STAT, body=f"""SELECT total, accepts, rejects,
      coalesce(round(accepts * 100.0::DOUBLE / nullif(total, 0), 1), 0.0) AS accept_rate,
      coalesce(round(rejects * 100.0::DOUBLE / nullif(total, 0), 1), 0.0) AS reject_rate,
      coalesce(round(ls::DOUBLE / nullif(ln, 0), 1), 0.0) AS avg_latency_ms, 24 AS hours
      FROM (SELECT CAST(coalesce(sum(request_count), 0) AS BIGINT) AS total,
        CAST(coalesce(sum(accept_count), 0) AS BIGINT) AS accepts,
        CAST(coalesce(sum(reject_count), 0) AS BIGINT) AS rejects, sum(latency_sum_ms) AS ls,
        sum(latency_count) AS ln FROM stat WHERE bucket_start >= {_since(24)})"""),
    "recent": _with(_auth(), body=f"""SELECT {_RECORD}, {_RECENT}, latency_ms, reply_msg
      FROM auth ORDER BY auth.ts DESC, id DESC LIMIT 100"""),
    "record_search": _with(_auth(), body=f"""SELECT {_RECORD}, {_RECENT}, framed_ip, src_ip,
      latency_ms, reply_msg FROM auth WHERE auth.ts >= {_since(3)} AND result = 3
      AND mac_addr = '02:00:00:00:00:01' ORDER BY auth.ts DESC, id DESC LIMIT 300"""),
    "record_search_account": _with(_auth(), body=f"""SELECT {_RECORD}, {_RECENT}, framed_ip, src_ip,
      latency_ms, reply_msg FROM auth WHERE auth.ts >= {_since(24)} AND username = 'GDF10003'
      ORDER BY auth.ts DESC, id DESC LIMIT 300"""),
    "user_detail": _with(_auth(), body=f"""SELECT {_RECORD}, raw_username, result, reason_zh,
      mac_addr, nas_ip, nas_identifier, nas_port_id, nas_port_type, nas_port, reply_msg, latency_ms,
      framed_ip FROM auth WHERE username = 'GDF10005' ORDER BY auth.ts DESC, id DESC LIMIT 50"""),
    "timeline": _with(_auth(), _STAT, body=f"""SELECT
      strftime(time_bucket(INTERVAL 30 MINUTE, bucket_start), '%Y-%m-%d %H:%M') AS bucket,
      {_sums(accepts='accept_count', rejects='reject_count')} FROM stat
      WHERE bucket_start >= {_since(6)} GROUP BY 1"""),
    "top_reject": _with(_auth(), _USER10, body=f"""SELECT username,
      {_sums(reject_cnt='reject_count', accept_cnt='accept_count', total_cnt='request_count')},
      0 AS mac_count, 0 AS nas_count, max(main_reason) AS last_reason,
      max(last_seen) AS last_seen, '' AS mac_list, '' AS nas_list
      FROM users WHERE bucket_start >= {_since(24)} GROUP BY username
      HAVING sum(reject_count) > 0
      ORDER BY reject_cnt DESC, max(users.last_seen) DESC, username LIMIT 20"""),
    "risk_accounts": _with(_auth(), _USER10, f"""hits AS (SELECT username,
      {_sums(total_cnt='request_count', reject_cnt='reject_count', accept_cnt='accept_count')},
      max(last_seen) AS last_seen FROM users WHERE bucket_start >= {_since(24)} GROUP BY 1
      HAVING sum(request_count) > 30)""", body="""SELECT username, total_cnt, reject_cnt,
      accept_cnt, '' AS mac_list, '' AS nas_list, '' AS nas_ports, '' AS nas_port_ids, last_seen,
      20 + least(n - 20, 20) + CAST(n > 40 AS INTEGER) AS total, n > 40 AS has_next,
      rank - 20 AS page_rank
      FROM (SELECT *, row_number() OVER (ORDER BY reject_cnt DESC, total_cnt DESC, last_seen DESC,
        username) AS rank, count(*) OVER () AS n FROM hits) WHERE rank BETWEEN 21 AND 40"""),
    "multi_mac_summary": _with(_auth(), _USER_MAC10, _PER_MAC, _TOP_USERS,
      body="SELECT * FROM top_users"),
    "multi_mac_detail": _with(_auth(), _USER_MAC10, _PER_MAC, _TOP_USERS,
      body=f"""SELECT username, mac_addr, {_sums(total_cnt='total_cnt', accept_cnt='accept_cnt',
      reject_cnt='reject_cnt')}, max(nas_ip) AS nas_ip, max(nas_identifier) AS nas_identifier,
      max(nas_port_id) AS nas_port_id, max(nas_port) AS nas_port, max(last_seen) AS last_seen
      FROM per_mac WHERE username IN (SELECT username FROM top_users) GROUP BY 1, 2"""),
    "reason_distribution": _with(_auth(), _REASON10, body=f"""SELECT reason_zh,
      {_sums(cnt='request_count')} FROM reason WHERE bucket_start >= {_since(24)} AND result = 3
      GROUP BY 1"""),
    "nas_distribution": _with(_auth(), _NAS10, body=f"""SELECT nas_ip,
      {_sums(total='request_count', accepts='accept_count', rejects='reject_count')},
      max(last_seen) AS last_seen FROM nas WHERE bucket_start >= {_since(24)} AND nas_ip <> ''
      GROUP BY 1"""),
    "ingest_status": _with(_auth(), _acct(), _STAT, body=f"""SELECT {_NOW} AS db_now,
      last_response_ts, CAST(NULL AS TIMESTAMP) AS last_request_ts,
      (epoch_us({_NOW}) - epoch_us(last_response_ts)) // 1000000 AS auth_response_lag_seconds,
      CAST(NULL AS BIGINT) AS auth_request_lag_seconds, last_accounting_ts,
      (epoch_us({_NOW}) - epoch_us(last_accounting_ts)) // 1000000 AS accounting_lag_seconds
      FROM (SELECT max(last_seen) AS last_response_ts FROM stat),
        (SELECT max(ts) AS last_accounting_ts FROM acct)"""),
}

_BYTES = """coalesce(input_gigawords, 0) * 4294967296 + coalesce(input_octets, 0) AS input_bytes,
  coalesce(output_gigawords, 0) * 4294967296 + coalesce(output_octets, 0) AS output_bytes"""
_SAMPLE = f"""sample AS (SELECT *, input_bytes + output_bytes AS total_bytes FROM (
    SELECT *, {_BYTES} FROM acct ORDER BY ts DESC, id DESC)),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY
      CASE WHEN nullif(acct_session_id, '') IS NULL THEN 'event:' || id
        ELSE concat_ws('|', coalesce(nas_ip, ''), acct_session_id) END
      ORDER BY ts DESC, id DESC) AS rn FROM sample) WHERE rn = 1)"""
_COUNTERS = """ts, username, raw_username, acct_status_type, acct_session_id, input_octets,
  input_gigawords, output_octets, output_gigawords, input_bytes, output_bytes, total_bytes,
  mac_addr"""

ACCOUNTING = {
    "acct_dashboard_stats": _with(_acct(), _SAMPLE, body=f"""SELECT * FROM
      (SELECT count(*) AS report_count, count(*) FILTER (acct_status_type = 1) AS start_count,
        count(*) FILTER (acct_status_type = 2) AS stop_count FROM sample),
      (SELECT count(*) AS session_count,
        count(*) FILTER (acct_status_type IN (1, 3)) AS active_sessions,
        {_sums(input_bytes='input_bytes', output_bytes='output_bytes', total_bytes='total_bytes')},
        max(ts) AS last_seen FROM latest)"""),
    "acct_dashboard_sessions": _with(_acct(), _SAMPLE, body=f"""SELECT {_COUNTERS}, framed_ip,
      nas_ip, nas_identifier, nas_port_id, nas_port FROM latest
      ORDER BY ts DESC, id DESC LIMIT 80"""),
    "acct_history": _with(_acct(), body=f"""SELECT {_COUNTERS}, calling_sta, framed_ip, nas_ip,
      nas_identifier, nas_port_id, nas_port, src_ip, dst_ip FROM
      (SELECT *, input_bytes + output_bytes AS total_bytes FROM (SELECT *, {_BYTES} FROM acct))
      WHERE username = 'GDF10007' AND ts >= {_since(48)} ORDER BY ts DESC, id DESC LIMIT 300"""),
    "latest_per_session": _with(_acct(), body="""SELECT id, ts, username, nas_ip, acct_session_id,
      acct_status_type, session_key FROM (SELECT *, row_number() OVER (PARTITION BY session_key
        ORDER BY ts DESC, id DESC) AS rn FROM (SELECT *,
          CASE WHEN nullif(acct_session_id, '') IS NULL THEN 'event:' || id
          ELSE concat_ws('|', coalesce(nas_ip, ''), acct_session_id) END AS session_key FROM acct))
      WHERE rn = 1"""),
}



# --- Stateful operators -----------------------------------------------------------------------

_DELTAS = """totals AS (SELECT *,
    (coalesce(input_gigawords, 0) * 4294967296 + coalesce(input_octets, 0)) * 1024 AS input_total,
    (coalesce(output_gigawords, 0) * 4294967296 + coalesce(output_octets, 0)) * 1024 AS output_total
    FROM acct),
  counters AS (SELECT *, lag(input_total) OVER w AS p_in, lag(output_total) OVER w AS p_out,
      lag(acct_status_type) OVER w AS p_status, lag(ts) OVER w AS p_ts FROM totals
    WINDOW w AS (PARTITION BY username, coalesce(nas_ip, src_ip), acct_session_id ORDER BY ts, id)),
  deltas AS (SELECT * EXCLUDE (input_total, output_total),
      CAST(input_total AS BIGINT) AS input_total, CAST(output_total AS BIGINT) AS output_total,
      CAST(CASE WHEN live THEN greatest(input_total - p_in, 0) ELSE 0 END AS BIGINT) AS input_delta,
      CAST(CASE WHEN live THEN greatest(output_total - p_out, 0) ELSE 0 END AS BIGINT) AS output_delta,
      CASE WHEN live AND (input_total < p_in OR output_total < p_out) THEN 1 ELSE 0 END
        AS counter_rollback
    FROM (SELECT *, coalesce(acct_session_id <> '' AND p_in IS NOT NULL AND p_status <> 2
      AND ts - p_ts <= INTERVAL 2 DAY, false) AS live FROM counters))"""

_SPANS = f"""marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 10 MINUTE THEN 0 ELSE 1 END
    AS opens FROM auth
    WINDOW w AS (PARTITION BY username, src_ip, mac_addr, nas_port_id, result ORDER BY ts, id)),
  numbered AS (SELECT *, sum(opens) OVER (PARTITION BY username, src_ip, mac_addr, nas_port_id,
    result ORDER BY ts, id) AS span FROM marked),
  spans AS (SELECT username, src_ip, mac_addr, nas_port_id, result, count(*) AS request_count,
      {_L}, min(ts) AS first_seen, max(ts) AS last_seen, max((ts, id))[2] AS last_id,
      min((ts, id))[2] AS first_id FROM numbered
    GROUP BY username, src_ip, mac_addr, nas_port_id, result, span)"""

_INTERIM = """interim AS (SELECT concat_ws('|', coalesce(nullif(nas_ip, ''), src_ip),
      coalesce(nullif(acct_session_id, ''), username)) AS key, ts, min(id) AS id
    FROM acct WHERE acct_status_type = 3 GROUP BY 1, 2),
  succ AS (SELECT a.id, arg_min(b.id, b.ts) AS next_id FROM interim a JOIN interim b
    ON a.key = b.key AND a.ts + INTERVAL 300 SECOND <= b.ts GROUP BY a.id),
  kept AS (SELECT arg_min(id, ts) AS id FROM interim GROUP BY key
    UNION ALL SELECT s.next_id FROM kept k JOIN succ s ON s.id = k.id)"""

_SNAPSHOTS = """hourly AS (SELECT date_trunc('hour', ts) AS hour, mac_addr, max(id) AS snap_id,
      min(ts) AS collected_at, max(nas_port) AS olt_device_id, min(nas_port_id) AS port_name
    FROM auth WHERE mac_addr IS NOT NULL GROUP BY 1, 2),
  paths AS (SELECT *, 'batch-' || hour(hour) AS batch_id, 100 + hour(hour) AS vlan_id,
      '0a00000000' || lpad(CAST(hour(hour) AS VARCHAR), 2, '0') AS onu_mac
    FROM hourly WHERE hour(hour) % 4 <> 3)"""

STATEFUL = {
    "dedup_events": _with(_acct(), body="""SELECT id, ts, username, raw_username, acct_status_type,
      acct_session_id, input_octets, input_gigawords, output_octets, output_gigawords, mac_addr,
      calling_sta, called_sta, nas_ip, nas_identifier, nas_port, nas_port_id, nas_port_type,
      framed_ip, src_ip, dst_ip FROM acct"""),
    "sample_interim": "WITH RECURSIVE " + _acct(factor=600) + ",\n" + _INTERIM + """
      SELECT id, ts, username, acct_status_type FROM acct
      WHERE acct_status_type <> 3 OR id IN (SELECT id FROM kept)""",
    "accounting_deltas": _with(_acct(), _DELTAS, body="""SELECT id, input_total, output_total,
      input_delta, output_delta, counter_rollback FROM deltas"""),
    "acct_rollup_1h_exact": _with(_acct(), _DELTAS, body=f"""SELECT date_trunc('hour', ts) AS bucket,
      username, coalesce(mac_addr, '') AS mac_addr, nas_ip,
      {_sums(input_bytes='input_delta', output_bytes='output_delta')},
      count(*) FILTER (acct_status_type = 1) AS starts,
      count(*) FILTER (acct_status_type = 2) AS stops,
      count(*) FILTER (acct_status_type = 3) AS interims,
      count(*) FILTER (acct_status_type IN (7, 8)) AS nas_restarts,
      count(DISTINCT nullif(acct_session_id, '')) AS sessions, max(ts) AS last_seen
      FROM deltas GROUP BY 1, 2, 3, 4"""),
    "event_spans": _with(_auth(factor=600), _SPANS, body="""SELECT s.username, s.src_ip, s.mac_addr,
      s.nas_port_id, s.result, request_count, latency_count, latency_sum_ms, latency_min_ms,
      latency_max_ms, first_seen, last_seen, r.raw_username, r.reply_msg, r.risk_level,
      r.calling_sta, r.called_sta, r.nas_ip, r.nas_port, r.nas_identifier, r.nas_port_type,
      r.framed_ip, r.req_ts AS latest_req_ts, r.latency_ms, f.reason_zh,
      sha256(concat_ws(chr(31), s.username, s.src_ip, coalesce(s.mac_addr, '<NULL>'),
        s.nas_port_id, CAST(s.result AS VARCHAR))) AS event_key
      FROM spans s JOIN auth r ON r.id = s.last_id JOIN auth f ON f.id = s.first_id"""),
    "latest_version": _with(_auth(), body="""SELECT username, arg_max(nas_ip, id) AS nas_ip, result,
      max(id) AS version FROM auth GROUP BY username, result"""),
    "merge_rollup": _with(_auth(), _USER_MAC10, body="SELECT * FROM terminals"),
    "retention": _with(_auth(), body="""SELECT id, ts, CAST(ts AS DATE) AS dt FROM auth
      WHERE ts >= TIMESTAMP '2024-01-01 07:30:00'"""),
    "terminal_path": _with(_auth(), _SNAPSHOTS, body="""SELECT a.id, a.ts, CASE a.id % 19 WHEN 1 THEN NULL
        WHEN 2 THEN '' WHEN 3 THEN 'zz' WHEN 4 THEN upper(replace(a.mac_addr, ':', '-')) ELSE a.mac_addr END AS mac_addr, p.batch_id,
      p.collected_at, p.olt_device_id, CASE WHEN p.batch_id IS NOT NULL THEN 'olt' END AS olt_name,
      p.vlan_id, CASE WHEN p.batch_id IS NOT NULL THEN '0/1' END AS if_index, p.port_name, p.onu_mac
      FROM auth a ASOF LEFT JOIN paths p
        ON (CASE WHEN a.id % 19 NOT IN (1, 2, 3) THEN a.mac_addr END) = p.mac_addr AND a.ts >= p.collected_at"""),
    "text_functions": _with(_auth(), body=f"""SELECT id,
      CASE WHEN calling_sta IS NOT NULL THEN lower(replace(calling_sta, '-', ':')) END AS mac,
      lower(called_sta) AS not_a_mac,
      CASE id % 4 WHEN 3 THEN '' WHEN 1 THEN '(未匹配)'
        WHEN 2 THEN CASE WHEN id >= 1000 THEN CAST(id AS VARCHAR) ELSE '(未匹配)' END
        ELSE username END AS username,
      id % 4 = 2 AND false AS is_business, left(called_sta, 4) AS clipped,
      nullif(reason_zh, '') AS reason, risk_level AS risk,
      CASE result WHEN 2 THEN 'Access-Accept' WHEN 3 THEN 'Access-Reject' ELSE 'Access-Challenge' END
        AS code_name,
      CASE id % 50 WHEN 1 THEN 'Access-Request' WHEN 2 THEN 'Access-Accept' WHEN 3 THEN 'Access-Reject'
        WHEN 4 THEN 'Accounting-Request' WHEN 5 THEN 'Accounting-Response'
        WHEN 11 THEN 'Access-Challenge' WHEN 40 THEN 'Disconnect-Request'
        WHEN 41 THEN 'Disconnect-ACK' WHEN 42 THEN 'Disconnect-NAK' WHEN 43 THEN 'CoA-Request'
        WHEN 44 THEN 'CoA-ACK' WHEN 45 THEN 'CoA-NAK' ELSE 'code=' || (id % 50) END AS any_code_name,
      sha256(concat_ws(chr(31), username, coalesce(mac_addr, '<NULL>'), CAST(result AS VARCHAR)))
        AS stable_key,
      latency_ms AS latency,
      strftime(make_timestamp((epoch_us(ts) // 420000000) * 420000000), '%Y-%m-%d %H:%M') AS slot,
      CASE WHEN epoch_us(req_ts) % 1000000 <> 0 THEN req_ts END AS parsed FROM auth"""),
}

# --- Packets ----------------------------------------------------------------------------------

# What the encoder put on the wire, as rows. Sizes count the 20 byte header and two bytes per
# attribute in front of its value.
_WIRE = """sent AS (SELECT *, id % 256 AS ident, 40000 + id % 4 AS client_port,
    coalesce(2 + strlen(calling_sta), 0) AS sta_len FROM auth WHERE latency_ms IS NOT NULL),
  request AS (
    SELECT id, id * 8 AS seq, req_ts - INTERVAL 50 MILLISECOND AS sent_at FROM sent
    UNION ALL SELECT id, id * 8 + 1, req_ts - INTERVAL 10 MILLISECOND FROM sent WHERE k % 10 = 1),
  response AS (
    SELECT id, id * 8 + 2 AS seq, ts AS sent_at FROM sent WHERE k % 13 <> 0
    UNION ALL SELECT id, id * 8 + 3, ts + INTERVAL 5 MILLISECOND FROM sent
      WHERE k % 17 = 0 AND k % 13 <> 0),
  flow AS (SELECT e.*, s.src_ip, s.client_port, s.ident FROM (
      SELECT id, seq, sent_at, true AS is_request FROM request
      UNION ALL SELECT id, seq, sent_at, false FROM response) e JOIN sent s USING (id)),
  seen AS (SELECT *, lag(is_request) OVER w AS p_request, lag(sent_at) OVER w AS p_at,
      lag(id) OVER w AS p_id, lead(sent_at) OVER w AS n_at FROM flow
    WINDOW w AS (PARTITION BY src_ip, client_port, ident ORDER BY sent_at, seq)),
  answered AS (SELECT * FROM seen WHERE NOT is_request AND p_request
    AND sent_at - p_at <= INTERVAL 30 SECOND)"""
_NO_TEXT = "CAST(NULL AS VARCHAR)"
_NO_INT = "CAST(NULL AS BIGINT)"
_PAIRED = f"""paired AS (SELECT a.seq, q.username, q.raw_username, q.username AS subscriber_id,
    q.nas_ip, q.nas_identifier, q.nas_port, q.nas_port_id, CAST(q.nas_port_type AS BIGINT) AS nas_port_type, q.calling_sta, q.mac_addr,
    q.called_sta, q.ident AS packet_identifier, q.client_port AS src_port, 1812 AS dst_port,
    q.src_ip, '10.9.0.1' AS dst_ip, a.p_at AS req_ts,
    CASE WHEN r.result = 2 THEN r.framed_ip END AS framed_ip, {_NO_TEXT} AS framed_ip_netmask,
    {_NO_TEXT} AS class_attr, {_NO_TEXT} AS connect_info, {_NO_INT} AS service_type,
    {_NO_INT} AS framed_protocol, a.sent_at AS resp_ts, r.result AS result_code,
    CASE r.result WHEN 2 THEN 'Access-Accept' WHEN 3 THEN 'Access-Reject' ELSE 'Access-Challenge' END
      AS result,
    r.reply_msg AS reply_raw, nullif(r.reason_zh, '') AS reason_zh, r.risk_level AS risk,
    true AS matched
  FROM answered a JOIN sent r ON r.id = a.id JOIN sent q ON q.id = a.p_id)"""
_ACCT_WIRE = f"""acct_sent AS (SELECT id * 8 AS seq, username, raw_username, '' AS subscriber_id,
    nas_ip, mac_addr, {_NO_TEXT} AS nas_identifier, {_NO_TEXT} AS nas_port_id, calling_sta,
    {_NO_TEXT} AS called_sta, {_NO_TEXT} AS class_attr, {_NO_TEXT} AS connect_info, framed_ip,
    {_NO_TEXT} AS framed_ip_netmask, {_NO_INT} AS nas_port, {_NO_INT} AS nas_port_type,
    {_NO_INT} AS service_type, {_NO_INT} AS framed_protocol, acct_session_id,
    {_NO_TEXT} AS acct_multi_session_id, CAST(acct_status_type AS BIGINT) AS acct_status_type,
    {_NO_INT} AS acct_authentic, {_NO_INT} AS acct_session_time, input_octets, input_gigawords,
    output_octets, output_gigawords, {_NO_INT} AS input_packets, {_NO_INT} AS output_packets,
    {_NO_INT} AS terminate_cause, {_NO_INT} AS acct_delay_time, {_NO_INT} AS event_timestamp,
    CAST(0 AS BIGINT) AS input_average_rate, CAST(0 AS BIGINT) AS output_average_rate,
    '' AS product_id, id % 256 AS packet_identifier, src_ip, dst_ip, 40000 + id % 4 AS src_port,
    1813 AS dst_port, ts, 'accounting' AS record_type, id FROM acct)"""
_CONTROL_WIRE = f"""control_sent AS (SELECT id * 8 + 4 AS seq, 'control' AS record_type, username,
    username AS raw_username, '' AS subscriber_id,
    CASE WHEN code IN (40, 43) THEN '10.9.0.1' ELSE src_ip END AS nas_ip, {_NO_TEXT} AS mac_addr,
    {_NO_TEXT} AS nas_identifier, {_NO_TEXT} AS nas_port_id, {_NO_TEXT} AS calling_sta,
    {_NO_TEXT} AS called_sta, {_NO_TEXT} AS class_attr, {_NO_TEXT} AS connect_info,
    {_NO_TEXT} AS framed_ip, {_NO_TEXT} AS framed_ip_netmask, {_NO_INT} AS nas_port,
    {_NO_INT} AS nas_port_type, {_NO_INT} AS service_type, {_NO_INT} AS framed_protocol,
    acct_session_id, {_NO_TEXT} AS acct_multi_session_id,
    CAST(CASE WHEN code IN (42, 45) THEN 503 END AS BIGINT) AS error_cause,
    {_NO_INT} AS event_timestamp, code AS result_code,
    CASE code WHEN 40 THEN 'Disconnect-Request' WHEN 41 THEN 'Disconnect-ACK'
      WHEN 42 THEN 'Disconnect-NAK' WHEN 43 THEN 'CoA-Request' WHEN 44 THEN 'CoA-ACK'
      ELSE 'CoA-NAK' END AS result,
    id % 256 AS packet_identifier, src_ip, dst_ip, 51000 AS src_port, 3799 AS dst_port, ts
  FROM (SELECT *, CAST(40 + (id // 10) % 6 AS INTEGER) AS code FROM acct WHERE id % 10 = 0))"""
# Interim updates at the default interval of 60 s. The sampler tells sessions apart by the session
# id and falls back on the account name.
_INTERIM_60 = _INTERIM.replace("INTERVAL 300 SECOND", "INTERVAL 60 SECOND")
_KEPT = """acct_kept AS (SELECT * FROM acct_sent WHERE acct_status_type <> 3
  OR id IN (SELECT id FROM kept))"""
_KEPT_DELTAS = _DELTAS.replace("FROM acct)", "FROM acct_kept)")


def _with_recursive(*ctes: str, body: str) -> str:
    return _with(*ctes, body=body).replace("WITH ", "WITH RECURSIVE ", 1)


def _event(kind: str, sent_at: str, **values: str) -> str:
    """One branch of the unified table; whatever is not given is blank or zero."""
    from accesslens.constants import EVENT_COLUMNS, EVENT_TEXT_COLUMNS
    from accesslens.schemas import _EVENT_SMALL_INTS

    out = []
    for c in EVENT_COLUMNS:
        if c == "event_id":
            continue
        if c == "event_time":
            out.append(f"{sent_at} AS event_time")
        elif c == "event_type":
            out.append(f"'{kind}' AS event_type")
        elif c in EVENT_TEXT_COLUMNS:
            out.append(f"coalesce({values.get(c, c)}, '') AS {c}")
        else:
            width = "INTEGER" if c in _EVENT_SMALL_INTS else "BIGINT"
            out.append(f"CAST(coalesce({values.get(c, c)}, 0) AS {width}) AS {c}")
    return "SELECT " + ", ".join(out)


def _blank(*columns: str) -> dict:
    from accesslens.constants import EVENT_TEXT_COLUMNS

    return {c: "''" if c in EVENT_TEXT_COLUMNS else "0" for c in columns}


_TRAFFIC = (
    "acct_authentic acct_session_time input_total output_total input_delta output_delta "
    "input_packets output_packets terminate_cause acct_delay_time input_average_rate "
    "output_average_rate counter_rollback"
).split()
_EVENTS = "\nUNION ALL ".join([
    _event("auth", "resp_ts", **_blank(
        "acct_status_type", "acct_session_id", "acct_multi_session_id", "error_cause",
        "event_timestamp", "product_id", *_TRAFFIC)) + " FROM paired",
    _event("accounting", "ts", **_blank(
        "result_code", "result", "reply_raw", "reason_zh", "risk", "error_cause")) + " FROM deltas",
    _event("control", "ts", **_blank(
        "reply_raw", "reason_zh", "risk", "acct_status_type", "product_id", *_TRAFFIC))
    + " FROM control_sent",
])

_LENGTHS = f"""lengths AS (
  SELECT q.seq, q.sent_at AS pkt_time, s.src_ip, '10.9.0.1' AS dst_ip, s.client_port AS src_port,
    1812 AS dst_port, 20 + 7 + 2 + strlen(s.raw_username) + 6 + 6 + 6 + 2 + strlen(s.nas_port_id)
      + 2 + strlen(s.nas_identifier) + s.sta_len + 2 + strlen(s.called_sta)
      + 8 + strlen(s.username) + CASE WHEN s.calling_sta IS NULL THEN 0 ELSE 8 + strlen(s.calling_sta) END
      AS payload_length
  FROM request q JOIN sent s USING (id)
  UNION ALL SELECT p.seq, p.sent_at, '10.9.0.1', s.src_ip, 1812, s.client_port,
    20 + CASE WHEN s.reply_msg = '' THEN 0 ELSE 2 + strlen(s.reply_msg) END
      + CASE WHEN s.result = 2 THEN 6 ELSE 0 END
  FROM response p JOIN sent s USING (id)
  UNION ALL SELECT id * 8, ts, src_ip, '10.9.0.1', 40000 + id % 4, 1813,
    20 + 2 + strlen(raw_username) + 6 * 6 + coalesce(2 + strlen(acct_session_id), 0)
      + coalesce(2 + strlen(calling_sta), 0) + 6 FROM acct
  UNION ALL SELECT id * 8 + 4, ts, src_ip, '10.9.0.1', 51000, 3799, 20 + 2 + strlen(username)
      + coalesce(2 + strlen(acct_session_id), 0)
      + CASE WHEN 40 + (id // 10) % 6 IN (42, 45) THEN 6 ELSE 0 END FROM acct WHERE id % 10 = 0
  UNION ALL SELECT id * 8 + n, ts + INTERVAL 3 MILLISECOND, '10.9.0.1', src_ip, 1813, 40000, len
  FROM acct, (VALUES (1, 3, 20), (2, 7, 20), (3, 11, 2)) o(n, every, len) WHERE id % every = 0)"""

DECODING = {
    "extract_udp": _with(_auth(), _acct(), _WIRE, _LENGTHS, body="SELECT * FROM lengths"),
    "decode_accounting": _with(_acct(), _ACCT_WIRE, body="SELECT * EXCLUDE (id) FROM acct_sent"),
    "decode_control": _with(_acct(), _CONTROL_WIRE, body="SELECT * FROM control_sent"),
    "pair_auth": _with(_auth(), _WIRE, _PAIRED, body="SELECT * FROM paired"),
    "unmatched_responses": _with(_auth(), _WIRE, body="""SELECT s.seq, s.sent_at AS resp_ts,
      r.result AS result_code, s.src_ip AS dst_ip FROM seen s JOIN sent r ON r.id = s.id
      WHERE NOT is_request AND s.seq NOT IN (SELECT seq FROM answered)"""),
    "expired_requests": _with(_auth(), _WIRE, body="""SELECT s.seq, s.sent_at AS req_ts, r.username,
      s.src_ip FROM seen s JOIN sent r ON r.id = s.id
      WHERE is_request AND coalesce(n_at - s.sent_at > INTERVAL 30 SECOND, true)"""),
    "stream_quality": _with_recursive(_auth(), _acct(), _WIRE, _LENGTHS, _INTERIM_60, body="""
      SELECT time_bucket(INTERVAL 10 MINUTE, sent_at) AS metric_time,
        CAST(sum(cap) AS BIGINT) AS captured_packets,
        CAST(sum(au + ac + co) AS BIGINT) AS parsed_records, CAST(sum(au) AS BIGINT) AS auth_records,
        CAST(sum(ac - drp) AS BIGINT) AS accounting_records,
        CAST(sum(co) AS BIGINT) AS control_records, CAST(sum(ch) AS BIGINT) AS challenge_records,
        CAST(sum(drp) AS BIGINT) AS interim_sampled_out,
        CAST(sum(un) AS BIGINT) AS unmatched_auth_responses,
        CAST(sum(ex) AS BIGINT) AS expired_auth_requests, CAST(sum(bad) AS BIGINT) AS malformed_packets,
        CAST(sum(ar) AS BIGINT) AS accounting_responses, CAST(sum(uk) AS BIGINT) AS unknown_codes
      FROM (
        SELECT pkt_time AS sent_at, 1 AS cap, 0 AS au, CAST(seq % 8 = 0 AND dst_port = 1813 AS INT) AS ac,
          CAST(dst_port = 3799 AS INT) AS co, 0 AS ch, CAST(seq % 8 = 0 AND dst_port = 1813
            AND seq // 8 IN (SELECT id FROM acct WHERE acct_status_type = 3)
            AND seq // 8 NOT IN (SELECT id FROM kept) AS INT) AS drp, 0 AS un, 0 AS ex,
          CAST(payload_length < 20 AS INT) AS bad,
          CAST(src_port = 1813 AND seq % 8 = 1 AS INT) AS ar,
          CAST(src_port = 1813 AND seq % 8 = 2 AS INT) AS uk FROM lengths
        UNION ALL SELECT s.sent_at, 0, CAST(a.seq IS NOT NULL AS INT), 0, 0,
          CAST(a.seq IS NOT NULL AND r.result = 11 AS INT), 0,
          CAST(NOT s.is_request AND a.seq IS NULL AS INT),
          CAST(s.is_request AND coalesce(s.n_at - s.sent_at > INTERVAL 30 SECOND, true) AS INT), 0, 0, 0
        FROM seen s JOIN sent r ON r.id = s.id LEFT JOIN answered a ON a.seq = s.seq)
      GROUP BY 1"""),
    "aaa_events": _with_recursive(
        _auth(), _acct(), _WIRE, _PAIRED, _ACCT_WIRE, _CONTROL_WIRE, _INTERIM_60, _KEPT,
        _KEPT_DELTAS, body=_EVENTS),
    "auth_log_from_packets": _with(_auth(), _WIRE, _PAIRED, body="""SELECT seq AS id, resp_ts AS ts,
      req_ts, CAST((epoch_us(resp_ts) - epoch_us(req_ts)) // 1000 AS INTEGER) AS latency_ms, username,
      raw_username, result_code AS result, reply_raw AS reply_msg, coalesce(reason_zh, '') AS reason_zh,
      risk AS risk_level, mac_addr, calling_sta, called_sta, nas_ip, nas_port, nas_identifier,
      nas_port_id, nas_port_type, framed_ip, src_ip FROM paired"""),
    "acct_log_from_packets": _with_recursive(_acct(), _ACCT_WIRE, _INTERIM_60, _KEPT,
      body="""SELECT seq AS id, ts, username, raw_username, acct_status_type, acct_session_id,
      input_octets, input_gigawords, output_octets, output_gigawords, mac_addr, calling_sta,
      called_sta, nas_ip, nas_identifier, nas_port, nas_port_id, nas_port_type, framed_ip, src_ip,
      dst_ip FROM acct_kept"""),
}


DECODING["decode_requests"] = _with(_auth(), _WIRE, body=f"""SELECT q.seq, q.sent_at AS req_ts,
  s.username, s.raw_username, s.username AS subscriber_id, s.nas_ip, s.mac_addr, s.nas_identifier,
  s.nas_port_id, s.calling_sta, s.called_sta, {_NO_TEXT} AS class_attr, {_NO_TEXT} AS connect_info,
  {_NO_TEXT} AS framed_ip, {_NO_TEXT} AS framed_ip_netmask, s.nas_port,
  CAST(s.nas_port_type AS BIGINT) AS nas_port_type, {_NO_INT} AS service_type,
  {_NO_INT} AS framed_protocol, s.ident AS packet_identifier, s.src_ip, s.dst_ip,
  s.client_port AS src_port, 1812 AS dst_port FROM request q JOIN sent s USING (id)""")
DECODING["business_auth_log"] = _with(
    _auth(), _WIRE, _PAIRED, body="SELECT seq AS id, username, result_code AS result FROM paired"
)
DECODING["event_views"] = _with_recursive(
    _auth(), _acct(), _WIRE, _PAIRED, _ACCT_WIRE, _CONTROL_WIRE, _INTERIM_60, _KEPT, body="""
  SELECT 'auth' AS event_type, result_code, count(*) AS n FROM paired GROUP BY 2
  UNION ALL SELECT 'accounting', 0, count(*) FROM acct_kept
  UNION ALL SELECT 'control', result_code, count(*) FROM control_sent GROUP BY 2"""
)

# The streaming twins give what the batch operators give.
STREAMING = {
    "stream_deltas": STATEFUL["accounting_deltas"],
    "stream_sample": STATEFUL["sample_interim"],
    "stream_dedup": STATEFUL["dedup_events"],
    "stream_merge": AUTH["rollup_user_mac_10m"],
    "stream_pair": DECODING["pair_auth"],
    "stream_writes": AUTH["rollup_stat_10m"],
}

# Streams in order: rows late by the rule are left out before the operator's own definition applies.
def _judged(source: str, ts: str, minutes: int, delayed: str, delay: str) -> str:
    """CTEs that tell for each row of ``source`` whether it came late: slices of the time axis, delayed rows one later."""
    start = "TIMESTAMP '2024-01-01 00:00:00'"
    return f"""sliced AS (SELECT *, CAST(floor((epoch_us({ts}) - epoch_us({start})) / {minutes * 60000000}) AS INTEGER)
    + CASE WHEN {delayed} THEN 1 ELSE 0 END AS slice FROM {source}),
  slices AS (SELECT slice, max({ts}) AS high FROM sliced GROUP BY 1),
  marks AS (SELECT slice, max(high) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM slices),
  judged AS (SELECT s.* EXCLUDE (slice), coalesce(s.{ts} <= m.mark - {delay}, false) AS is_late FROM sliced s JOIN marks m USING (slice))"""


def _on_time(name: str, minutes: int = 240) -> str:
    return _judged(f"{name}_all", "ts", minutes, "id % 40 = 0", "INTERVAL 10 MINUTE") + f""",
  {name} AS (SELECT * EXCLUDE (is_late) FROM judged WHERE NOT is_late)"""


_LATE_IDS = "SELECT id, true AS is_late FROM judged WHERE is_late"
_LATE_WIRE = _WIRE.replace("  flow AS (", "  flow_all AS (").replace(
    "  seen AS (", "  " + _judged("flow_all", "sent_at", 240, "id % 40 = 0", "INTERVAL 10 SECOND")
    + ",\n  flow AS (SELECT * FROM judged WHERE NOT is_late),\n  seen AS (")


def _part(relation: str, source: str, keys: str, *numbers: str) -> str:
    names = (*numbers, "0", "0", "0")[:3]
    columns = ", ".join(f"CAST(coalesce({n}, 0) AS BIGINT) AS n{i}" for i, n in enumerate(names))
    text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys.split())
    return f"SELECT '{relation}' AS relation, {text} AS key, {columns} FROM {source}"


_LOGGED = """auth_logged AS (SELECT seq AS id, resp_ts AS ts, CAST((epoch_us(resp_ts) - epoch_us(req_ts)) // 1000 AS INTEGER) AS latency_ms,
    username, result_code AS result, coalesce(reason_zh, '') AS reason_zh, mac_addr, nas_ip, nas_port, nas_identifier, nas_port_id,
    framed_ip, src_ip FROM paired),
  bucketed AS (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts) AS bucket_start FROM auth_logged)"""
_REQUESTS = "count(*) AS r, count(*) FILTER (result = 2) AS a, count(*) FILTER (result = 3) AS j"
_TABLES = "\nUNION ALL ".join([
    _part("auth_log", "auth_logged", "id username reason_zh", "result", "latency_ms"),
    _part("acct_log", "acct_kept", "seq username acct_session_id", "acct_status_type", "input_octets"),
    _part("aaa_events", f"(SELECT event_type, username, count(*) AS n, sum(input_delta) AS d, sum(result_code) AS c FROM ({_EVENTS}) GROUP BY 1, 2)",
          "event_type username", "n", "d", "c"),
    _part("auth_stat_10m", f"(SELECT bucket_start, {_REQUESTS} FROM bucketed GROUP BY 1)", "bucket_start", "r", "a", "j"),
    _part("auth_nas_10m", f"(SELECT bucket_start, coalesce(nas_ip, '') AS nas_ip, {_REQUESTS} FROM bucketed GROUP BY 1, 2)", "bucket_start nas_ip", "r", "a", "j"),
    _part("auth_user_10m", f"(SELECT bucket_start, username, {_REQUESTS}, {_MAIN} FROM bucketed GROUP BY 1, 2)", "bucket_start username main_reason", "r", "a", "j"),
    _part("auth_user_mac_10m", f"""(SELECT bucket_start, username, coalesce(mac_addr, '') AS mac_addr, {_REQUESTS},
      arg_max(nas_port_id, (ts, id)) FILTER (nas_port_id IS NOT NULL) AS nas_port_id FROM bucketed GROUP BY 1, 2, 3)""",
          "bucket_start username mac_addr nas_port_id", "r", "a", "j"),
    _part("auth_rollup_10m", f"""(SELECT bucket_start, username, src_ip, mac_addr, nas_port_id, result, {_REQUESTS},
      max((ts, id, framed_ip))[3] AS framed_ip FROM bucketed GROUP BY 1, 2, 3, 4, 5, 6)""",
          "bucket_start username src_ip mac_addr nas_port_id result framed_ip", "r", "a", "j"),
    _part("auth_reason_10m", "(SELECT bucket_start, result, reason_zh, count(*) AS r FROM bucketed GROUP BY 1, 2, 3)", "bucket_start result reason_zh", "r"),
    _part("auth_rollup_states", """(SELECT bucket_start, username, coalesce(mac_addr, '') AS mac_addr, coalesce(nas_ip, '') AS nas_ip, reason_zh,
      count(*) AS r, count(*) FILTER (result = 2) AS a, count(*) FILTER (result = 11) AS c FROM bucketed GROUP BY 1, 2, 3, 4, 5)""",
          "bucket_start username mac_addr nas_ip reason_zh", "r", "a", "c"),
    _part("acct_rollup_1h", """(SELECT date_trunc('hour', ts) AS bucket, username, coalesce(mac_addr, '') AS mac_addr, coalesce(nas_ip, '') AS nas_ip,
      sum(input_delta) AS b, count(*) FILTER (acct_status_type = 1) AS s, count(DISTINCT nullif(acct_session_id, '')) AS d
      FROM deltas GROUP BY 1, 2, 3, 4)""", "bucket username mac_addr nas_ip", "b", "s", "d"),
])

ORDERED = {
    "late_deltas": _with(_acct("acct_all"), _on_time("acct"), _DELTAS, body=f"""SELECT id, input_total, output_total,
      input_delta, output_delta, counter_rollback, false AS is_late FROM deltas
      UNION ALL BY NAME {_LATE_IDS}"""),
    "late_sample": "WITH RECURSIVE " + ",\n".join([_acct("acct_all", factor=600), _on_time("acct", 24), _INTERIM]) + f"""
      SELECT id, ts, username, acct_status_type, false AS is_late FROM acct
      WHERE acct_status_type <> 3 OR id IN (SELECT id FROM kept)
      UNION ALL BY NAME {_LATE_IDS}""",
    "late_pair": _with(_auth(), _LATE_WIRE, body="""SELECT s.seq, a.seq IS NOT NULL AS is_matched,
      s.is_request AND coalesce(s.n_at - s.sent_at > INTERVAL 30 SECOND, true) AS is_expired, false AS is_late
      FROM seen s LEFT JOIN answered a USING (seq)
      UNION ALL BY NAME SELECT seq, true AS is_late FROM judged WHERE is_late"""),
    "late_rollup": _with(_auth("auth_all"), _on_time("auth"), _USER10, body=f"""SELECT * FROM users
      UNION ALL BY NAME SELECT {_BUCKET} AS bucket_start, count(*) AS late_rows FROM judged WHERE is_late GROUP BY 1"""),
    "late_spans": STATEFUL["event_spans"].replace(_auth(factor=600), ",\n".join([_auth("auth_all", factor=600), _on_time("auth", 24)])),
    "stream_ingest": _with_recursive(
        _auth(), _acct(), _WIRE, _PAIRED, _ACCT_WIRE, _CONTROL_WIRE, _INTERIM_60, _KEPT,
        _KEPT_DELTAS, _LOGGED, body=_TABLES),
    "acct_rollup_1h_stored": _with(_acct(), _DELTAS, body="""
      SELECT date_trunc('hour', ts) AS bucket, username, coalesce(mac_addr, '') AS mac_addr, coalesce(nas_ip, '') AS nas_ip,
        count(DISTINCT nullif(acct_session_id, '')) AS sessions, true AS is_near FROM deltas GROUP BY 1, 2, 3, 4"""),
}

# Reports over stored tables give what they give over the rows that were stored.
STORED = {
    "recent_stored": AUTH["recent"].replace(_auth(), _auth(factor=1)).replace("LIMIT 100", "LIMIT 700"),
    "ingest_status_stored": AUTH["ingest_status"].replace(_auth(), _auth(factor=1)).replace(_acct(), _acct(factor=1)),
    "export_csv": _with(_auth(), body="""SELECT s AS ts, s AS first_seen, s AS last_seen, '1' AS request_count, username, raw_username, CAST(result AS VARCHAR) AS result,
      coalesce(reason_zh, '') AS reason_zh, coalesce(mac_addr, '') AS mac_addr, nas_ip, nas_identifier, nas_port_id, CAST(nas_port_type AS VARCHAR) AS nas_port_type,
      CAST(nas_port AS VARCHAR) AS nas_port, coalesce(CAST(latency_ms AS VARCHAR), '') AS latency_ms, reply_msg
      FROM (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s FROM auth ORDER BY ts DESC, id DESC LIMIT 500)"""),
    "top_reject_range": AUTH["top_reject"].replace(_auth(), _auth(factor=1)).replace(
        f"bucket_start >= {_since(24)}", "bucket_start >= TIMESTAMP '2024-01-05 00:00:00' AND bucket_start < TIMESTAMP '2024-01-10 00:00:00'").replace(" LIMIT 20", ""),
    "identifiable": _with(_acct(), """named AS (SELECT id, CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN '(未匹配)' WHEN 2 THEN '' ELSE username END NOT IN ('', '(未匹配)') AS who,
        id % 4 < 2 AS device, id % 3 < 2 OR id % 4 = 0 AS reporter,
        (id % 6 = 0 AND acct_session_id IS NOT NULL) OR (id % 7 = 0 AND mac_addr IS NOT NULL) OR id % 3 < 2 AS other,
        id % 4 >= 2 AND acct_status_type = 7 AS device_anyway FROM acct)""", body="""SELECT id, 'auth' AS kind FROM named WHERE who
      UNION ALL SELECT id, 'accounting' FROM named WHERE CASE WHEN device OR device_anyway THEN reporter ELSE who END
      UNION ALL SELECT id, 'control' FROM named WHERE who OR other"""),
    "multi_mac_nested": _with(_auth(), _USER_MAC10, _PER_MAC, _TOP_USERS, """details AS (SELECT username, mac_addr,
        CAST(sum(total_cnt) AS BIGINT) AS t, CAST(sum(accept_cnt) AS BIGINT) AS a, CAST(sum(reject_cnt) AS BIGINT) AS r,
        max(nas_port_id) AS p, max(last_seen) AS l FROM per_mac GROUP BY 1, 2)""", body="""SELECT u.username, u.mac_count, u.total_cnt,
      (SELECT string_agg(concat_ws('|', mac_addr, t, r, p), ';' ORDER BY l DESC, mac_addr DESC) FROM details d WHERE d.username = u.username) AS details
      FROM top_users u"""),
    "stream_rollup": _with(_auth(), _USER10, body="""SELECT * FROM users
      WHERE bucket_start + INTERVAL 10 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM auth)"""),
    "stream_spans": STATEFUL["event_spans"] + " WHERE last_seen + INTERVAL 10 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM auth)",
    "port_filter": _with(_auth(), _acct(), _WIRE, _LENGTHS, body="""SELECT seq, CAST(src_port AS INTEGER) AS src_port, CAST(dst_port AS INTEGER) AS dst_port
      FROM lengths WHERE src_port IN (1812, 51000) OR dst_port IN (1812, 51000)"""),
    "risk_accounts_pages": _with(_auth(), _USER10, f"""hits AS (SELECT username,
      {_sums(total_cnt='request_count', reject_cnt='reject_count', accept_cnt='accept_count')},
      max(last_seen) AS last_seen FROM users WHERE bucket_start >= {_since(24)} GROUP BY 1
      HAVING sum(request_count) > 30),
      ranked AS (SELECT *, row_number() OVER (ORDER BY reject_cnt DESC, total_cnt DESC, last_seen DESC, username) AS rank FROM hits)""",
      body="""SELECT CAST((rank - 1) // 30 + 1 AS INTEGER) AS page, CAST((rank - 1) % 30 + 1 AS INTEGER) AS page_rank, username, total_cnt, reject_cnt,
        accept_cnt, last_seen, CAST(NULL AS BIGINT) AS total, CAST(NULL AS BOOLEAN) AS has_next FROM ranked WHERE rank <= 90
      UNION ALL BY NAME SELECT CAST(p AS INTEGER) AS page, 0 AS page_rank, (SELECT count(*) FROM hits) AS total,
        (SELECT count(*) FROM hits) > last AS has_next FROM (VALUES (1, 30), (2, 60), (3, 90), (99, 1000000)) v(p, last)"""),
    "metric_versions": _with(_auth(factor=1), body="""SELECT metric_time,
      sha256('metrics||' || strftime(metric_time, '%Y-%m-%d %H:%M:%S.%g')) AS event_id,
      CASE WHEN metric_time < TIMESTAMP '2024-01-21' THEN every_n ELSE first_n END AS auth_records,
      CASE WHEN metric_time < TIMESTAMP '2024-01-21' THEN every_c ELSE first_c END AS challenge_records,
      CASE WHEN metric_time < TIMESTAMP '2024-01-21' THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS ingested_at
      FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS metric_time, count(*) AS every_n,
        count(*) FILTER (result = 11) AS every_c, count(*) FILTER (id % 3 > 0) AS first_n,
        count(*) FILTER (id % 3 > 0 AND result = 11) AS first_c FROM auth GROUP BY 1)
      WHERE metric_time >= TIMESTAMP '2024-01-03 12:00:00' AND (metric_time < TIMESTAMP '2024-01-21' OR first_n > 0)"""),
    "compacted_store": _with(_auth(factor=1), _USER10, body=f"""SELECT u.*, b.before_count FROM users u LEFT JOIN (
      SELECT {_BUCKET} AS bucket_start, username, count(*) AS before_count FROM auth WHERE id % 3 < 2 GROUP BY 1, 2) b
      USING (bucket_start, username)"""),
    "retention_border": _with(_auth(factor=1), _acct(factor=1), body="""SELECT 'auth_log' AS relation, id, ts FROM auth
      WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' UNION ALL SELECT 'acct_log', id, ts FROM acct WHERE ts >= TIMESTAMP '2024-01-05 12:00:00'"""),
    "retention_stored": _with(_auth(factor=1), body="SELECT id, ts FROM auth WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'"),
    "range_stored": _with(_auth(factor=1), body="""SELECT CAST(ts AS DATE) AS dt, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
      FROM auth WHERE ts >= TIMESTAMP '2024-01-05 12:00:00' AND ts < TIMESTAMP '2024-01-25 12:00:00' GROUP BY 1"""),
    "record_search_stored": AUTH["record_search"],
    "nas_stats_ndjson": AUTH["nas_stats"],
    "top_reject_stored": AUTH["top_reject"],
}


# Columns that are four bytes wide where DuckDB's arithmetic gives eight.
_INTEGERS = {
    "risk_accounts": ["page_rank"],
    "terminal_path": ["olt_device_id", "vlan_id"],
    "extract_udp": ["src_port", "dst_port", "payload_length"],
    "decode_accounting": ["packet_identifier", "src_port"],
    "decode_control": ["packet_identifier"],
    "pair_auth": ["packet_identifier", "src_port"],
    "stream_pair": ["packet_identifier", "src_port"],
    "decode_requests": ["packet_identifier", "src_port"],
    "auth_log_from_packets": ["nas_port_type"],
    "acct_log_from_packets": ["acct_status_type", "nas_port_type"],
}


def _narrowed(name: str, sql: str) -> str:
    if name not in _INTEGERS:
        return sql
    casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in _INTEGERS[name])
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def statements() -> dict[str, str]:
    every = {**AUTH, **ACCOUNTING, **STATEFUL, **DECODING, **STREAMING, **ORDERED, **STORED}
    return {name: _narrowed(name, sql) for name, sql in every.items()}
