"""Stand-in telemetry derived from the ``events`` test table.

``events`` has no network-access meaning, so authentication and accounting rows are projected from
it by fixed rules. The time axis is compressed (60 = one month to twelve hours) so that ten-minute
buckets and spans hold several rows each. Every rule can be restated in plain SQL, which is what
makes the DuckDB comparison possible.
"""

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from accesslens.constants import REPLY_REASONS
from accesslens.functions.keys import reply_reason
from accesslens.schemas import ACCT_LOG, AUTH_LOG

NOW = datetime(2024, 1, 1, 12, 0, 0)
UNKNOWN_REPLY = "099:Some other failure"

_BASE = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
_US = f"cast(cast((ts - {_BASE}) * 1000000 AS INTERVAL SECOND) AS BIGINT)"


_EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(_EVENTS).parquet(f"{sf_dir}/events*.parquet")


def _common(ev: DataFrame, factor: int) -> DataFrame:
    return ev.selectExpr(
        "event_id AS id", "user_id", "event_type", "value",
        "cast(get_json_object(props, '$.k') AS INT) AS k",
        f"{_BASE} + ({_US} div {factor * 1000}) * INTERVAL '0.001' SECOND AS ts",
    ).selectExpr(
        "*", "concat('GDF', user_id + 10000) AS username",
        "concat('a:', user_id, '::gdf', user_id + 10000) AS raw_username",
        "if(k % 9 <> 0, concat('02:00:00:00:00:0', k % 4), NULL) AS mac_addr",
        "if(k % 9 <> 0, concat('02-00-00-00-00-0', k % 4), NULL) AS calling_sta",
        "concat('bras-', user_id % 8) AS called_sta", "concat('10.0.0.', user_id % 8) AS nas_ip",
        "user_id % 16 AS nas_port", "concat('nas-', user_id % 8) AS nas_identifier",
        "concat('slot=0;port=', user_id % 16) AS nas_port_id", "15 AS nas_port_type",
        "concat('100.64.', user_id % 256, '.', k) AS framed_ip",
        "concat('10.0.0.', user_id % 8) AS src_ip", "'10.9.0.1' AS dst_ip",
    )


def _reply_message() -> str:
    arms = " ".join(f"WHEN {n} THEN '{m}'" for n, m in enumerate(REPLY_REASONS))
    return f"CASE k % 7 {arms} ELSE '{UNKNOWN_REPLY}' END"


_AUTH_EVENTS = "event_type IN ('signup', 'purchase', 'error')"
_ACCT_EVENTS = "event_type IN ('click', 'view')"
_AUTH_COLUMNS = [
    "CASE WHEN event_type = 'error' THEN 3 "
    "WHEN event_type = 'signup' AND k % 10 = 0 THEN 11 ELSE 2 END AS result",
    f"if(event_type = 'error', {_reply_message()}, '') AS reply_msg",
    "cast(if(k % 7 <> 0, floor(value), NULL) AS INT) AS latency_ms",
]
_REQ_TS = "ts - latency_ms * INTERVAL '0.001' SECOND AS req_ts"
_ACCT_COLUMNS = [
    "CASE WHEN k < 5 THEN 1 WHEN k >= 95 THEN 2 WHEN k = 50 THEN 7 ELSE 3 END AS acct_status_type",
    "if(k <> 77, concat('s-', user_id, '-', k % 3), NULL) AS acct_session_id",
    "cast(floor(value * 100) AS BIGINT) AS input_octets",
    "cast(floor(value * 50) AS BIGINT) AS output_octets",
    "if(k % 20 = 0, 1L, 0L) AS input_gigawords", "if(k % 20 = 0, 1L, 0L) AS output_gigawords",
]


def auth_log(ev: DataFrame, factor: int = 60) -> DataFrame:
    """Authentication detail rows from the signup, purchase and error events."""
    rows = _common(ev.filter(_AUTH_EVENTS), factor).selectExpr("*", *_AUTH_COLUMNS)
    reason, risk = reply_reason(rows["reply_msg"])
    return rows.select("*", reason.alias("reason"), risk.alias("risk_level")).selectExpr(
        "*", _REQ_TS, "coalesce(reason, '') AS reason_zh",
    ).select(AUTH_LOG.fieldNames())


def acct_log(ev: DataFrame, factor: int = 60) -> DataFrame:
    """Accounting detail rows from the click and view events."""
    rows = _common(ev.filter(_ACCT_EVENTS), factor).selectExpr("*", *_ACCT_COLUMNS)
    return rows.select(ACCT_LOG.fieldNames())


def all_rows(ev: DataFrame, factor: int = 60) -> DataFrame:
    """Both kinds in one pass, marked by ``is_auth``, with the columns of either."""
    rows = _common(ev, factor).selectExpr(
        "*", f"{_AUTH_EVENTS} AS is_auth", *_AUTH_COLUMNS, *_ACCT_COLUMNS
    )
    return rows.selectExpr("*", _REQ_TS)


def with_duplicates(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Every fiftieth row once more, as a mirrored capture would deliver it."""
    return df.unionByName(df.filter(f"{id_col} % 50 = 0"))


def delivered(rows: DataFrame, path: str, ts: str = "ts", minutes: int = 240, key: str = "id", delayed: str = "{key} % 40 = 0") -> Iterator[int]:
    """Store rows as slices of the time axis, written by all their tasks, in the order in which a stream gets them; hands
    out the number of each slice stored. Rows for which ``delayed`` holds come one slice later; ``{us}`` there are
    microseconds since the start."""
    late = delayed.format(key=key, us=f"cast(cast(({ts} - {_BASE}) * 1000000 AS INTERVAL SECOND) AS BIGINT)")
    piece = f"cast(floor(cast(cast({ts} - {_BASE} AS INTERVAL SECOND) AS DECIMAL(20, 6)) / {minutes * 60}) + if({late}, 1, 0) AS INT)"
    sliced = rows.withColumn("slice", F.expr(piece)).persist()
    numbers = [r[0] for r in sliced.select("slice").distinct().orderBy("slice").collect()]
    for number in numbers:
        sliced.filter(F.col("slice") == number).drop("slice").write.mode("append").parquet(path)
        yield number
    sliced.unpersist()


def snapshots(auth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terminal-path snapshots, one per hour and terminal seen in it, and their batches.

    Every fourth batch failed; later snapshots of a batch come from other devices.
    """
    hourly = auth.filter("mac_addr IS NOT NULL").selectExpr(
        "window(ts, '1 hour').start AS hour", "mac_addr", "ts", "nas_port", "nas_port_id", "id"
    ).groupBy("hour", "mac_addr").agg(
        {"ts": "min", "nas_port": "max", "nas_port_id": "min", "id": "max"}
    )
    batch = "concat('batch-', hour(hour))"
    rows = hourly.selectExpr(
        "`max(id)` AS id", f"{batch} AS batch_id", "`min(ts)` AS collected_at",
        "cast(`max(nas_port)` AS INT) AS olt_device_id", "'olt' AS olt_name",
        "cast(100 + hour(hour) AS INT) AS vlan_id", "'0/1' AS if_index",
        "`min(nas_port_id)` AS port_name", "concat('0a00000000', lpad(hour(hour), 2, '0')) AS onu_mac",
        "upper(replace(mac_addr, ':', '')) AS terminal_mac", "'show' AS source_command",
    )
    batches = hourly.groupBy("hour").agg({"min(ts)": "max"}).selectExpr(
        f"{batch} AS batch_id", "`max(min(ts))` AS finished_at",
        "if(hour(hour) % 4 = 3, 'failed', 'completed') AS status",
    )
    return rows, batches
