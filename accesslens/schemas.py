"""Explicit schemas: nothing in the package infers types from data."""

from pyspark.sql import types as T

from accesslens.constants import EVENT_COLUMNS, EVENT_TEXT_COLUMNS

_S, _L, _I, _N = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()


def _struct(text: str, **types) -> T.StructType:
    return T.StructType([T.StructField(n, types.get(n, _S)) for n in text.split()])


PACKETS = T.StructType([
    T.StructField("seq", _L), T.StructField("pkt_time", _N),
    T.StructField("link_type", _I), T.StructField("frame", T.BinaryType()),
])

DATAGRAMS = T.StructType([
    T.StructField("seq", _L), T.StructField("pkt_time", _N),
    T.StructField("src_ip", _S), T.StructField("dst_ip", _S),
    T.StructField("src_port", _I), T.StructField("dst_port", _I),
    T.StructField("payload", T.BinaryType()),
])

AUTH_LOG = _struct(
    "id ts req_ts latency_ms username raw_username result reply_msg reason_zh risk_level "
    "mac_addr calling_sta called_sta nas_ip nas_port nas_identifier nas_port_id nas_port_type "
    "framed_ip src_ip",
    id=_L, ts=_N, req_ts=_N, latency_ms=_I, result=_I, nas_port=_L, nas_port_type=_I,
)

ACCT_LOG = _struct(
    "id ts username raw_username acct_status_type acct_session_id input_octets input_gigawords "
    "output_octets output_gigawords mac_addr calling_sta called_sta nas_ip nas_identifier "
    "nas_port nas_port_id nas_port_type framed_ip src_ip dst_ip",
    id=_L, ts=_N, acct_status_type=_I, input_octets=_L, input_gigawords=_L, output_octets=_L,
    output_gigawords=_L, nas_port=_L, nas_port_type=_I,
)

AUTH_RECORD = _struct(
    "username raw_username subscriber_id nas_ip nas_identifier nas_port nas_port_id "
    "nas_port_type service_type framed_protocol calling_sta mac_addr called_sta framed_ip "
    "framed_ip_netmask class_attr connect_info packet_identifier src_port dst_port req_ts "
    "src_ip dst_ip resp_ts result_code result reply_raw reason_zh risk matched",
    nas_port=_L, nas_port_type=_L, service_type=_L, framed_protocol=_L, packet_identifier=_I,
    src_port=_I, dst_port=_I, req_ts=_N, resp_ts=_N, result_code=_I, matched=T.BooleanType(),
)

_EVENT_SMALL_INTS = {
    "src_port", "dst_port", "packet_identifier", "result_code", "acct_status_type",
    "counter_rollback",
}
AAA_EVENTS = T.StructType([
    T.StructField(
        name,
        _N if name == "event_time"
        else _S if name in ("event_id", "event_type") or name in EVENT_TEXT_COLUMNS
        else _I if name in _EVENT_SMALL_INTS
        else _L,
    )
    for name in EVENT_COLUMNS
])

SNAPSHOT_BATCH = _struct("batch_id finished_at status", finished_at=_N)
SNAPSHOT = _struct(
    "id batch_id collected_at olt_device_id olt_name vlan_id if_index port_name onu_mac "
    "terminal_mac source_command",
    id=_L, collected_at=_N, olt_device_id=_I, vlan_id=_I,
)
